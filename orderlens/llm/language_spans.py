"""Languages of mixed text: script ranges, word scores, and a Viterbi path over the words.

A word is a run of letters of one script between white space or other signs. Its script narrows the
languages to those that write at least ``SCRIPT_SHARE`` of their letters in it; the others can't take
the word. Among the candidates a word's score is the mean, over n-gram lengths 1 to ``LONGEST``, of
the log probability of its character n-grams (word ends marked), less the best candidate's, and not
below ``-CLIP``. A word that no language writes scores alike in all of them.

The label of each word is the Viterbi path: the sum of the words' scores, the log share of the first
word's language, and ``-PENALTY`` for every switch of language. Scores are whole numbers of
1/``UNIT``, so that sums are exact in any order. If no stretch of words prefers another language to the
best single one by more than half the penalty, no path with a switch can be better, and the search is
spared; all other texts go through it, many at a time, one word per step.

A text's language is the one with most letters (ties: the first by name); its score is the mean over
all letters of how likely the letter's word alone is to be of that language, where the path says so.

Counts of n-grams and scripts are taken over all learned documents: a task adds words up, then hashes
the n-grams of the distinct ones into ``BUCKETS`` buckets for each language, and Spark adds the
buckets. The model (languages x buckets) is all that reaches the driver. It grows with the number of
languages, not of documents.

Defined results: a null text, and one without a letter, is ``und`` with score 0, and so is every text
if nothing was learned. Null languages are not learned from. Repeated rows count each time. Rows
without an id are learned from and are not held out. Long texts are labelled whole. Other columns play
no part. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import TextFunction, map_texts

BUCKETS = 1 << 15
LONGEST = 4
SMOOTHING = 0.5
SCRIPT_SHARE = 0.005
CLIP = 8.0
PENALTY = 12.0
UNIT = 256
UNKNOWN = "und"
# Characters that are labelled together (at least one text), and distinct tokens of a language that a
# learning task adds up before it hashes them.
CHARACTERS_AT_ONCE = 4_000_000
TOKENS_AT_ONCE = 200_000

# First and last code point of the scripts.
SCRIPTS = [
    ("Latin", 0x0041, 0x024F),
    ("Latin", 0x1E00, 0x1EFF),
    ("Greek", 0x0370, 0x03FF),
    ("Greek", 0x1F00, 0x1FFF),
    ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F),
    ("Hebrew", 0x0590, 0x05FF),
    ("Arabic", 0x0600, 0x06FF),
    ("Arabic", 0x0750, 0x077F),
    ("Devanagari", 0x0900, 0x097F),
    ("Bengali", 0x0980, 0x09FF),
    ("Gurmukhi", 0x0A00, 0x0A7F),
    ("Gujarati", 0x0A80, 0x0AFF),
    ("Tamil", 0x0B80, 0x0BFF),
    ("Telugu", 0x0C00, 0x0C7F),
    ("Kannada", 0x0C80, 0x0CFF),
    ("Malayalam", 0x0D00, 0x0D7F),
    ("Sinhala", 0x0D80, 0x0DFF),
    ("Thai", 0x0E00, 0x0E7F),
    ("Lao", 0x0E80, 0x0EFF),
    ("Georgian", 0x10A0, 0x10FF),
    ("Hangul", 0x1100, 0x11FF),
    ("Hangul", 0xAC00, 0xD7AF),
    ("Ethiopic", 0x1200, 0x137F),
    ("Khmer", 0x1780, 0x17FF),
    ("Kana", 0x3040, 0x30FF),
    ("Han", 0x3400, 0x4DBF),
    ("Han", 0x4E00, 0x9FFF),
    ("Han", 0x20000, 0x2FA1F),
]
OTHER_SCRIPT = "other"
NAMES = [OTHER_SCRIPT, *dict.fromkeys(name for name, _, _ in SCRIPTS)]


@functools.lru_cache(maxsize=None)
def script_of(point: int) -> int:
    """Number of a letter's script in ``NAMES``; -1 for what is no letter."""
    category = unicodedata.category(chr(point))
    inside = next((name for name, low, high in SCRIPTS if low <= point <= high), None)
    # Vowel signs belong to the letters of their script.
    if category[0] == "L" or (category[0] == "M" and inside is not None):
        return NAMES.index(inside or OTHER_SCRIPT)
    return -1


@dataclass
class Words:
    """Runs of letters of one script in some tokens, and the hashes of their n-grams."""

    token: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    # One entry per n-gram: its word, its bucket, its length.
    of_word: np.ndarray
    bucket: np.ndarray
    length: np.ndarray


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def words_in(tokens: list[str]) -> Words:
    """All words of tokens without white space, in order, by arrays of all their characters."""
    joined = ("\n".join(tokens) + "\n").lower()
    points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    # Combining accents are passed over; they would cut words.
    points = points[(points < 0x300) | (points > 0x36F)]
    distinct, place = np.unique(points, return_inverse=True)
    script = np.array([script_of(p) for p in distinct.tolist()], dtype=np.int64)[place]
    starts = np.flatnonzero((script >= 0) & (script != np.concatenate(([-1], script[:-1]))))
    at = np.flatnonzero(script >= 0)
    owner = np.searchsorted(starts, at, side="right") - 1
    letters = np.bincount(owner, minlength=len(starts))
    token = np.cumsum(points == 10)[starts]
    # All words in turn, each between a mark for its start and one for its end.
    marked = np.zeros(len(at) + 2 * len(starts), dtype=np.uint64)
    marked_owner = np.repeat(np.arange(len(starts)), letters + 2)
    ends = np.cumsum(letters + 2)
    marked[ends - letters - 2], marked[ends - 1] = 1, 2
    marked[np.arange(len(at)) + 2 * owner + 1] = points[at]
    of_word, bucket, length = [], [], []
    rolled = np.zeros(len(marked), dtype=np.uint64)
    for n in range(1, LONGEST + 1):
        # What the last n characters up to here hash to.
        rolled = _mixed(np.concatenate(([np.uint64(0)], rolled[:-1])) * np.uint64(31) + marked + np.uint64(n))
        inside = marked_owner[n - 1 :] == marked_owner[: len(marked) - n + 1]
        last = np.flatnonzero(inside & (marked > 2) if n == 1 else inside) + n - 1
        of_word.append(marked_owner[last])
        bucket.append((rolled[last] % np.uint64(BUCKETS)).astype(np.int64))
        length.append(np.full(len(last), n))
    return Words(token, script[starts], letters, *map(np.concatenate, (of_word, bucket, length)))


# What a language has counts of: buckets, then letters by script, then n-grams by length.
_ITEMS = BUCKETS + len(NAMES) + LONGEST


def _add_up(counts: np.ndarray, tokens: Counter[str]) -> None:
    if not tokens:
        return
    times = np.array(list(tokens.values()), dtype=np.int64)
    words = words_in(list(tokens))
    by_gram = times[words.token][words.of_word]
    items = (words.bucket, BUCKETS + words.script, BUCKETS + len(NAMES) + words.length - 1)
    weights = (by_gram, (times[words.token] * words.letters), by_gram)
    for item, weight in zip(items, weights, strict=True):
        counts += np.bincount(item, weights=weight, minlength=_ITEMS).astype(np.int64)


@dataclass
class Model:
    """Log probabilities of buckets, who writes which script, and log shares of all letters."""

    languages: list[str]
    bucket: np.ndarray
    by_length: np.ndarray
    writes: np.ndarray
    share: np.ndarray

    @classmethod
    def of(cls, counts: dict[str, np.ndarray]) -> Model:
        languages = sorted(name for name, c in counts.items() if c.any())
        table = np.array([counts[x] for x in languages], dtype=np.float64).reshape(len(languages), _ITEMS)
        scripts = table[:, BUCKETS : BUCKETS + len(NAMES)]
        letters = scripts.sum(axis=1, keepdims=True)
        grams = table[:, BUCKETS + len(NAMES) :]
        return cls(
            languages,
            np.log(table[:, :BUCKETS] + SMOOTHING),
            np.log(grams + SMOOTHING * BUCKETS),
            (scripts >= SCRIPT_SHARE * letters) & (scripts > 0),
            np.log(letters[:, 0] / letters.sum()) if languages else np.zeros(0),
        )

    def scores(self, words: Words) -> np.ndarray:
        """Words by languages, in units: 0 for the best candidate, least for who cannot write it."""
        n = len(words.script)
        raw = np.zeros((n, len(self.languages)))
        for i in range(len(self.languages)):
            logs = self.bucket[i][words.bucket] - self.by_length[i][words.length - 1]
            raw[:, i] = np.bincount(words.of_word, weights=logs, minlength=n) / LONGEST
        candidate = self.writes.T[words.script]
        # A script that no language writes says nothing.
        raw[~candidate.any(axis=1)] = 0.0
        candidate = candidate | ~candidate.any(axis=1, keepdims=True)
        best = np.max(raw, axis=1, keepdims=True, where=candidate, initial=-np.inf)
        units = np.rint(np.maximum(raw - best, -CLIP) * UNIT)
        return np.where(candidate, units, -(CLIP + 2 * PENALTY) * UNIT).astype(np.int64)


def best_paths(scores: np.ndarray, sizes: np.ndarray, penalty: int) -> np.ndarray:
    """The language of each word (row) on the best path of its text; texts hold ``sizes`` words, all > 0."""
    starts = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    single = np.add.reduceat(scores, starts).argmax(axis=1)
    labels = single[text]
    own = scores[np.arange(len(scores)), labels]
    # Most that any stretch of words prefers another language by. Sums run over all texts; each text is
    # set so far below the one before it that the least earlier sum is always one of its own.
    most = np.zeros(len(sizes), dtype=np.int64)
    for language in range(scores.shape[1]):
        gain = scores[:, language] - own
        total = np.cumsum(gain)
        below = text * (2 * int(np.abs(total).max()) + 1)
        lowest = np.minimum.accumulate(total - gain - below)
        most = np.maximum(most, np.maximum.reduceat(total - below - lowest, starts))
    # Stretches of m other languages gain at most m halves of a penalty and cost m - 1 penalties or more.
    mixed = 2 * most > penalty
    _viterbi(scores, starts[mixed], sizes[mixed], penalty, labels)
    return labels


def _viterbi(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, penalty: int, labels: np.ndarray) -> None:
    """Set the labels of some texts; a step takes the next word of all texts that still have one."""
    if not len(starts):
        return
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left").tolist()
    first = np.cumsum([0, *active])
    came_from = np.empty(first[-1], dtype=np.int32)
    stays = np.empty((first[-1], scores.shape[1]), dtype=bool)
    value = scores[starts]
    for t in range(1, int(sizes[0])):
        m = active[t]
        value = value[:m] if len(value) > m else value
        best = value.argmax(axis=1)
        switched = (value[np.arange(m), best] - penalty)[:, None]
        came_from[first[t] : first[t] + m] = best
        stays[first[t] : first[t] + m] = value >= switched
        value = np.maximum(value, switched) + scores[starts[:m] + t]
        if t + 1 == sizes[0] or active[t + 1] < m:
            # These texts end here.
            done = np.arange(active[t + 1] if t + 1 < sizes[0] else 0, m)
            labels[starts[done] + t] = value[done].argmax(axis=1)
    ends_at_once = sizes == 1
    labels[starts[ends_at_once]] = scores[starts[ends_at_once]].argmax(axis=1)
    for t in range(int(sizes[0]) - 1, 0, -1):
        m = active[t]
        label = labels[starts[:m] + t]
        rows = np.arange(first[t], first[t] + m)
        labels[starts[:m] + t - 1] = np.where(stays[rows, label], label, came_from[rows])


def _by_characters(texts: list[str]) -> Iterator[list[str]]:
    some, n = [], 0
    for t in texts:
        if some and n + len(t) > CHARACTERS_AT_ONCE:
            yield some
            some, n = [], 0
        some.append(t)
        n += len(t)
    if some:
        yield some


@dataclass
class Labelled:
    """The words of some texts in turn: text, token within the text, letters, label, likelihood."""

    text: np.ndarray
    token: np.ndarray
    letters: np.ndarray
    label: np.ndarray
    likely: np.ndarray


def label_words(texts: list[str], model: Model) -> Labelled:
    split = [t.split() for t in texts]
    distinct = list(dict.fromkeys(x for tokens in split for x in tokens))
    number = dict(zip(distinct, range(len(distinct)), strict=True))
    words = words_in(distinct)
    scores = model.scores(words)
    chances = np.exp(scores / UNIT)
    chances /= chances.sum(axis=1, keepdims=True)
    # From the tokens of the texts to their words.
    held = np.bincount(words.token, minlength=len(distinct))
    first = np.cumsum(held) - held
    used = np.array([i for tokens in split for i in map(number.__getitem__, tokens)], dtype=np.int64)
    sizes = np.array([len(tokens) for tokens in split], dtype=np.int64)
    each = held[used]
    own = np.repeat(np.arange(len(used)), each)
    row = np.arange(len(own)) - np.repeat(np.cumsum(each) - each, each) + first[used][own]
    text = np.repeat(np.arange(len(texts)), sizes)[own]
    token = (np.arange(len(used)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[own]
    mine = scores[row]
    begins = np.flatnonzero(np.diff(text, prepend=-1))
    mine[begins] += np.rint(model.share * UNIT).astype(np.int64)
    label = best_paths(mine, np.diff(np.append(begins, len(text))), int(PENALTY * UNIT)) if len(row) else row
    return Labelled(text, token, words.letters[row], label, chances[row, label])


def predict_texts(texts: list[str], model: Model) -> list[tuple[str, float]]:
    if not model.languages:
        return [(UNKNOWN, 0.0)] * len(texts)
    result: list[tuple[str, float]] = []
    n = len(model.languages)
    for some in _by_characters(texts):
        w = label_words(some, model)
        letters = np.bincount(w.text * n + w.label, weights=w.letters, minlength=len(some) * n).reshape(-1, n)
        best, total = letters.argmax(axis=1), letters.sum(axis=1)
        fits = w.label == best[w.text]
        likely = np.bincount(w.text, weights=w.letters * w.likely * fits, minlength=len(some))
        for b, t, x in zip(best.tolist(), total.tolist(), likely.tolist(), strict=True):
            result.append((model.languages[b], min(1.0, x / t)) if t else (UNKNOWN, 0.0))
    return result


def spans_of(text: str, model: Model) -> list[tuple[int, int, str]]:
    """Stretches of one language: start and end (exclusive) in code points, and the language.

    A token (what stands between white space) takes the label of its first word; tokens without a
    letter belong to what stands before them.
    """
    if not model.languages or not text.split():
        return []
    w = label_words([text], model)
    places = [m.span() for m in re.finditer(r"\S+", text)]
    tokens, first = np.unique(w.token, return_index=True)
    labels = w.label[first]
    changes = np.flatnonzero(np.diff(labels, prepend=-1)).tolist()
    spans = []
    for i, at in enumerate(changes):
        begin = tokens[at]
        end = (tokens[changes[i + 1]] if i + 1 < len(changes) else len(places)) - 1
        spans.append((places[begin][0], places[end][1], model.languages[labels[at]]))
    return spans


def held_out(key: str) -> Column:
    """Documents whose languages are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Counts over all documents that have a language and are not held out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        tokens: dict[str, Counter[str]] = {}

        def flush(name: str) -> None:
            _add_up(counts.setdefault(name, np.zeros(_ITEMS, dtype=np.int64)), tokens.pop(name))

        for batch in batches:
            for name, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen = tokens.setdefault(name, Counter())
                seen.update(whole.as_py().split())
                if len(seen) > TOKENS_AT_ONCE:
                    flush(name)
        for name in list(tokens):
            flush(name)
        for name, c in counts.items():
            item = np.flatnonzero(c)
            if len(item):
                columns = [pa.array([name] * len(item)), pa.array(item), pa.array(c[item])]
                yield pa.RecordBatch.from_arrays(columns, names=["language", "item", "n"])

    # At most `_ITEMS` rows for each language, whatever the number of documents.
    learned = (
        docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(key))
        .select(F.col(lang).alias("language"), F.col(text).alias("text"))
        .mapInArrow(count, "language string, item long, n long")
        .groupBy("language", "item")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts: dict[str, np.ndarray] = {}
    names, items, sums = (learned.column(c).to_pylist() for c in ("language", "item", "n"))
    for name, item, n in zip(names, items, sums, strict=True):
        counts.setdefault(name, np.zeros(_ITEMS, dtype=np.int64))[item] = n
    return Model.of(counts)


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, ``held_out``, ``lang_pred`` and ``score``."""

    def make() -> TextFunction:
        def function(texts: list[str]) -> tuple[None, dict[str, list]]:
            found = predict_texts(texts, model)
            return None, {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

        return function

    predicted = map_texts(docs, make, "lang_pred string, score double", text, [key], rows_at_once=4_000)
    return predicted.select(key, held_out(key).alias("held_out"), "lang_pred", "score")


def find_spans(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per span: key, ``start``, ``end`` (exclusive, code points) and ``language``."""

    def make() -> TextFunction:
        def function(texts: list[str]) -> tuple[list[int], dict[str, list]]:
            rows = [(i, *span) for i, t in enumerate(texts) for span in spans_of(t, model)]
            index, start, end, language = map(list, zip(*rows, strict=True)) if rows else ([], [], [], [])
            return index, {"start": start, "end": end, "language": language}

        return function

    return map_texts(docs, make, "start long, end long, language string", text, [key])


def predict_languages(docs: DataFrame) -> DataFrame:
    return predict(docs, learn(docs))
