"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word's vector is the sum of the embeddings of its character n-grams (of the word in angle
brackets) and of the word itself, found in ``BUCKETS`` hash buckets. A document's vector is the mean
of its words' vectors and ``PAD`` zero vectors (which keeps very short texts near the prior), times
``SCALE``; a linear softmax over the two labels follows. Embeddings and
softmax are trained jointly, by Adam on the whole sample, in numpy. A misspelt word that was never
seen shares most n-grams with the word it stands for.

The model is fitted on the driver from at most ``TRAINING_ROWS`` labelled documents (taken in the
order of a hash of the id) with at most ``TRAINING_WORDS`` distinct words each, so its cost does not
grow with the corpus. Buckets found in fewer than ``LEAST_DOCUMENTS`` of them, or about as often under
either label (less than ``LEAST_DEVIATIONS`` standard deviations apart), stay zero.
Scoring reads every whole text: with two labels only the difference of the two logits matters, hence
one number per bucket travels to the tasks (512 kB), and a word's number is the sum of its buckets'.

Defined results: a null or empty text scores the model's prior. Without labelled rows, or with only
one label among them, every score is the share of that label (0 without rows). Of several labels of
one id the largest counts; null labels and ids are left out. Repeated rows score alike. Null ids are
scored and are not held out. Other columns play no part. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import string
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import TextFunction, map_texts

BUCKETS = 1 << 17
DIMENSIONS = 6
SHORTEST, LONGEST = 3, 6
SCALE = 20.0
PAD = 10
TRAINING_ROWS = 4_000
TRAINING_WORDS = 1_000
LEAST_DOCUMENTS = 8
LEAST_DEVIATIONS = 4.0
STEPS = 120
RATE = 0.05
DECAY = 1e-4
REMEMBERED = 500_000


def _plain(token: str) -> str:
    return token.lower().strip(string.punctuation)


def _grams(word: str) -> set[str]:
    marked = f"<{word}>"
    grams = {marked}
    for n in range(SHORTEST, LONGEST + 1):
        grams.update([marked[i : i + n] for i in range(len(marked) - n + 1)])
    return grams


def _buckets(word: str) -> np.ndarray:
    return np.array([zlib.crc32(g.encode()) % BUCKETS for g in _grams(word)], dtype=np.int32)


def word_counts(text: str) -> Counter[str]:
    counts = Counter(text.split())
    plain: Counter[str] = Counter()
    for token, n in counts.items():
        if word := _plain(token):
            plain[word] += n
    return plain


# Distinct words separated by spaces, their counts, and the label.
Sample = tuple[str, list[int], int]


@dataclass
class Model:
    """``weights[bucket]`` adds to the logit of label 1, times ``SCALE`` over the number of words."""

    weights: np.ndarray
    bias: float


def _bag(sample: Sample, memo: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and their weights in its mean vector."""
    words, counts = sample[0].split(" "), sample[1]
    lists = []
    for w in words:
        if w not in memo:
            memo[w] = _buckets(w)
        lists.append(memo[w])
    n = np.repeat(np.array(counts, dtype=np.float64), [len(x) for x in lists])
    ids, inverse = np.unique(np.concatenate(lists), return_inverse=True)
    return ids, np.bincount(inverse, weights=n) * (SCALE / (sum(counts) + PAD))


def train(samples: list[Sample]) -> Model:
    """Fit on samples; only the buckets of one document at a time are held before the choice."""
    labels = np.array([s[2] for s in samples], dtype=np.float64)
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(BUCKETS, np.float32), 50.0 * (2 * share - 1) if len(labels) else -50.0)
    memo: dict[str, np.ndarray] = {}
    found = np.zeros((2, BUCKETS), dtype=np.int64)
    for sample in samples:
        found[sample[2], _bag(sample, memo)[0]] += 1
    # Only buckets that tell the labels apart are trained; the others stay zero.
    with_0, with_1 = found
    both = (with_1 + with_0) / len(labels)
    spread = np.sqrt(both * (1 - both) * (1 / labels.sum() + 1 / (1 - labels).sum())) + 1e-9
    gap = np.abs(with_1 / labels.sum() - with_0 / (1 - labels).sum())
    telling = (gap >= LEAST_DEVIATIONS * spread) & (with_1 + with_0 >= LEAST_DOCUMENTS)
    docs, buckets, parts = [], [], []
    for i, sample in enumerate(samples):
        ids, weight = _bag(sample, memo)
        kept = telling[ids]
        docs.append(np.full(kept.sum(), i))
        buckets.append(ids[kept])
        parts.append(weight[kept])
    doc, bucket = np.concatenate(docs), np.concatenate(buckets)
    if not len(bucket):
        return Model(np.zeros(BUCKETS, np.float32), math.log(share / (1 - share)))
    part = np.concatenate(parts).astype(np.float32)[:, None]
    present, bucket = np.unique(bucket, return_inverse=True)
    by_bucket = np.argsort(bucket, kind="stable")
    bucket_starts = np.flatnonzero(np.diff(bucket[by_bucket], prepend=-1))
    doc_starts = np.flatnonzero(np.diff(doc, prepend=-1))
    random = np.random.default_rng(7)
    embeddings = random.normal(0, 0.1, (len(present), DIMENSIONS)).astype(np.float32)
    softmax = random.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.array([math.log(1 - share), math.log(share)], dtype=np.float32)
    target = np.stack([1 - labels, labels], axis=1).astype(np.float32)
    weights = [embeddings, softmax, bias]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        documents = np.zeros((len(samples), DIMENSIONS), np.float32)
        documents[doc[doc_starts]] = np.add.reduceat(embeddings[bucket] * part, doc_starts)
        logits = documents @ softmax + bias
        shares = np.exp(logits - logits.max(axis=1, keepdims=True))
        shares /= shares.sum(axis=1, keepdims=True)
        error = (shares - target) / len(samples)
        to_documents = error @ softmax.T
        to_embeddings = np.add.reduceat(
            to_documents[doc[by_bucket]] * part[by_bucket], bucket_starts
        )
        slopes = [
            to_embeddings + DECAY * embeddings,
            documents.T @ error + DECAY * softmax,
            error.sum(axis=0),
        ]
        for w, g, m, v in zip(weights, slopes, first, second, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    table = np.zeros(BUCKETS, np.float32)
    table[present] = embeddings @ (softmax[:, 1] - softmax[:, 0])
    return Model(table, float(bias[1] - bias[0]))


def held_out(key: str) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id") -> Model:
    """Train on a bounded sample of the labelled documents that are not held out."""
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
        .groupBy(key)
        .agg(F.max(F.col(label)).cast("int").alias("_label"))
        .orderBy(F.xxhash64(key), key)
        .limit(TRAINING_ROWS)
    )

    def make() -> TextFunction:
        def count(texts: list[str]) -> tuple[None, dict[str, list]]:
            found = []
            for t in texts:
                words = word_counts(t)
                kept = sorted(words, key=lambda w: zlib.crc32(w.encode()))[:TRAINING_WORDS]
                found.append((kept, [words[w] for w in kept]))
            return None, {"words": [" ".join(f[0]) for f in found], "counts": [f[1] for f in found]}

        return count

    # At most TRAINING_ROWS ids and labels.
    sample = docs.select(key, text).join(F.broadcast(known), key).limit(2 * TRAINING_ROWS)
    rows = map_texts(sample, make, "words string, counts array<long>", text, [key, "_label"]).collect()
    return train([(r["words"], r["counts"], r["_label"]) for r in sorted(rows, key=lambda r: r[key]) if r["words"]])


_MEMORY: dict[int, tuple[dict, dict, dict]] = {}


def _remembered(model: Model) -> tuple[dict, dict, dict]:
    """Numbers of tokens and words met so far, and the trained buckets; one set per Python worker."""
    name = zlib.crc32(model.weights.tobytes() + repr(model.bias).encode())
    if name not in _MEMORY:
        _MEMORY.clear()
        used = np.flatnonzero(model.weights)
        _MEMORY[name] = ({}, {}, dict(zip(used.tolist(), model.weights[used].tolist(), strict=True)))
    return _MEMORY[name]


def score(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, ``held_out``, ``score`` and ``predicted``."""

    def make() -> TextFunction:
        seen, values, telling = _remembered(model)

        def scores(texts: list[str]) -> tuple[None, dict[str, list]]:
            if len(seen) > REMEMBERED:
                seen.clear()
                values.clear()
            result = []
            for t in texts:
                tokens = t.split()
                for token in set(tokens).difference(seen):
                    word = _plain(token)
                    if word not in values:
                        # fsum() does not depend on the order of the set.
                        values[word] = math.fsum(
                            [telling.get(zlib.crc32(g.encode()) % BUCKETS, 0.0) for g in _grams(word)]
                        )
                    seen[token] = (values[word], 1) if word else (0.0, 0)
                pairs = [seen[x] for x in tokens]
                n = sum(p[1] for p in pairs)
                logit = model.bias + (SCALE * sum(p[0] for p in pairs) / (n + PAD))
                result.append(1 / (1 + math.exp(-max(-50.0, min(50.0, logit)))))
            return None, {"score": result, "predicted": [int(s >= threshold) for s in result]}

        return scores

    scored = map_texts(docs, make, "score double, predicted int", text, [key])
    return scored.select(key, held_out(key).alias("held_out"), "score", "predicted")


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    return score(docs, fit(docs, labels), threshold)
