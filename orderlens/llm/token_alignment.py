"""Alignment of two tokenizations of the same text by diagonal run skipping.

A byte-level BPE (A) and a byte-fallback BPE (B) cut the same bytes, a space and the text, into
tokens. Both lists of end offsets rise. Where the ends of A and B agree at the current shift of their
indexes, tokens correspond one to one; such a stretch is jumped by comparing blocks of ends of
doubling length, until one differs, and halving inside that block. Then the irregular group is
resolved by advancing whichever list is behind until both end at the same byte; that sets the new
shift. A group is what lies between two common ends. Two tokens are linked if they share a byte.

Both tokenizers cut a text at every single space between two other characters, so that only distinct
stretches between such spaces need to be encoded and aligned; those of some texts are laid end to end
for that. A worker remembers stretches until they exceed ``REMEMBERED_CHARACTERS``, then it starts
anew. A stretch whose joined tokens are not its bytes spoils its document.

How many documents link a pair of ids is counted by one aggregation over all documents, which store
their distinct pairs with the number of links. The counts meet the documents in a join: by broadcast
if a count shows at most ``BROADCAST_PAIRS`` pairs, by shuffle otherwise, and both give the same rows.
Sums by document are taken in the tasks before they are shuffled.

Defined results: a null or empty text, and one that either tokenizer does not give back byte by byte
(such as a text with the sign that B writes for a space), has no tokens: zeros and an empty digest.
Repeated rows and rows without an id count as documents of their own. Other columns play no part. An
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import TextFunction, map_texts
from orderlens.session import broadcast_if_small, scratch_folder

BROADCAST_PAIRS = 1_000_000
# Characters of the texts that are encoded and aligned together (at least one text).
CHARACTERS_AT_ONCE = 2_000_000
REMEMBERED_CHARACTERS = 5_000_000
_CUT = re.compile(r"(?<=\S) (?=\S)")
# How byte-level vocabularies write bytes: printing Latin-1 as it is, the others from code point 256 on.
_HIDDEN = [*range(33), *range(127, 161), 173]
_BYTE_OF = {chr(256 + i): b for i, b in enumerate(_HIDDEN)} | {
    chr(b): b for b in range(256) if b not in set(_HIDDEN)
}


def common_ends(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B end at or before each byte offset where both end.

    ``a`` and ``b`` are rising end offsets; the last ones must agree.
    """
    i = j = 0
    # Stretches of groups that take one token of either: where they start, and how many.
    from_a, from_b, lengths = [], [], []
    while i < len(a) and j < len(b):
        # One to one: blocks of doubling length agree at this shift of the indexes.
        run, step, most = 0, 2, min(len(a) - i, len(b) - j)
        while run < most:
            size = min(step, most - run)
            x, y = i + run, j + run
            if a[x : x + size] == b[y : y + size]:
                run += size
                step *= 2
                continue
            # The first difference, by halving.
            while size > 1:
                half = size // 2
                x, y = i + run, j + run
                if a[x : x + half] == b[y : y + half]:
                    run += half
                    size -= half
                else:
                    size = half
            break
        if run:
            from_a.append(i)
            from_b.append(j)
            lengths.append(run)
            i, j = i + run, j + run
            if i == len(a) or j == len(b):
                break
        # Irregular: whichever is behind moves on, until both end at one byte.
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        # The last tokens of the group end as those of a stretch of one would.
        from_a.append(i)
        from_b.append(j)
        lengths.append(1)
        i, j = i + 1, j + 1
    sizes = np.array(lengths, dtype=np.int64)
    along = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
    return np.repeat(np.array(from_a, np.int64), sizes) + along, np.repeat(np.array(from_b, np.int64), sizes) + along


def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all pairs of tokens that share a byte, in order of their bytes.

    Between two neighbouring ends of either list lies exactly one token of each, so every stretch
    is one pair, and every pair is one stretch.
    """
    stretches = np.union1d(a, b)
    return np.searchsorted(a, stretches), np.searchsorted(b, stretches)


class Tokenizers:
    """Ids and token bytes of both tokenizers; special strings are plain text."""

    def __init__(self, byte_level_file: str, piece_file: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level_file)
        self.a.encode_special_tokens = True
        entries = self.a.get_vocab()
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes_a[i] = bytes(_BYTE_OF[c] for c in entry if c in _BYTE_OF)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.bytes_b = [
            bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        self.lengths_a = np.array([len(x) for x in self.bytes_a])
        self.lengths_b = np.array([len(x) for x in self.bytes_b])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and of B for a space and ``text``; None if either does not give its bytes back."""
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        whole = (" " + text).encode()
        if b"".join([self.bytes_a[i] for i in a]) != whole or b"".join([self.bytes_b[i] for i in b]) != whole:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


class SingleGroups(dict):
    """Text of a group of one token of either, by the number of their pair."""

    def __init__(self, pieces: int) -> None:
        self.pieces = pieces

    def __missing__(self, pair: int) -> str:
        a, b = divmod(pair, self.pieces)
        self[pair] = text = f"{a}|{b}"
        return text


class Stretches:
    """What documents take from each distinct stretch, by its number."""

    def __init__(self, tokenizers: Tokenizers) -> None:
        self.tokenizers = tokenizers
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.single = SingleGroups(len(self.tokenizers.bytes_b))
        self.characters = 0
        # Numbers of A, B, groups and links of each stretch, and the pairs of all links in turn.
        self._counts = [np.zeros((4, 0), dtype=np.int64)]
        self._pairs = [np.zeros(0, dtype=np.int64)]

    def learn(self, wanted: set[str]) -> tuple[np.ndarray, np.ndarray]:
        """Make sure that all of ``wanted`` are known; counts and pairs of all that are."""
        if self.characters > REMEMBERED_CHARACTERS:
            self._forget()
        new = wanted.difference(self.number)
        self.characters += sum(map(len, new))
        inner = [s for s in new if not (s[0].isspace() or s[-1].isspace())]
        if inner:
            self._add(inner)
        for s in new.difference(self.number):
            # Only the first or last stretch of a text can be one of these.
            self._add([s])
        self._counts = [np.concatenate(self._counts, axis=1)]
        self._pairs = [np.concatenate(self._pairs)]
        return self._counts[0], self._pairs[0]

    def _add(self, stretches: list[str]) -> None:
        """Align stretches that, but for a single one, neither begin nor end with white space."""
        tokenizers = self.tokenizers
        encoded = tokenizers.encode(" ".join(stretches))
        if encoded is None:
            # Find those that do not come back by halves.
            if len(stretches) == 1:
                self.number[stretches[0]] = -1
            else:
                half = len(stretches) // 2
                self._add(stretches[:half])
                self._add(stretches[half:])
            return
        a, b = encoded
        ends_a, ends_b = np.cumsum(tokenizers.lengths_a[a]), np.cumsum(tokenizers.lengths_b[b])
        upto_a, upto_b = common_ends(ends_a.tolist(), ends_b.tolist())
        link_a, link_b = links(ends_a, ends_b)
        pairs = a[link_a] * len(tokenizers.bytes_b) + b[link_b]
        # Every stretch ends at a common end.
        stops = np.cumsum(np.array([len(s.encode()) for s in stretches]) + 1)
        stop_a, stop_b = np.searchsorted(ends_a, stops) + 1, np.searchsorted(ends_b, stops) + 1
        stop_group = np.searchsorted(ends_a[upto_a - 1], stops) + 1
        stop_link = np.searchsorted(link_a, stop_a)
        # Most groups are one to one, of few different pairs, whose text is remembered.
        from_a, from_b = np.concatenate(([0], upto_a[:-1])), np.concatenate(([0], upto_b[:-1]))
        single = a[from_a] * len(tokenizers.bytes_b) + b[from_b]
        texts = list(map(self.single.__getitem__, single.tolist()))
        for k in np.flatnonzero((upto_a - from_a != 1) | (upto_b - from_b != 1)).tolist():
            own_a, own_b = a[from_a[k] : upto_a[k]].tolist(), b[from_b[k] : upto_b[k]].tolist()
            texts[k] = ",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b))
        first = len(self.groups)
        at = 0
        for to in stop_group.tolist():
            self.groups.append(";".join(texts[at:to]))
            at = to
        self.number.update(zip(stretches, range(first, len(self.groups)), strict=True))
        ends = np.stack((stop_a, stop_b, stop_group, stop_link))
        self._counts.append(np.diff(ends, axis=1, prepend=0))
        self._pairs.append(pairs)


@functools.lru_cache(maxsize=1)
def _stretches(byte_level_file: str, piece_file: str) -> Stretches:
    """One per Python worker, so what it remembers serves all tasks that the worker runs."""
    return Stretches(Tokenizers(byte_level_file, piece_file))


# Counts of A, B, groups and links; the digest; the distinct pairs and how many links each has.
Row = tuple[int, int, int, int, str, np.ndarray, np.ndarray]


def _aligned(texts: list[str], stretches: Stretches) -> list[Row]:
    cut = [_CUT.split(t) if t else [] for t in texts]
    counts, pairs = stretches.learn(set().union(*cut))
    own = [list(map(stretches.number.__getitem__, x)) for x in cut]
    # A stretch without tokens spoils its text.
    own = [[] if -1 in x else x for x in own]
    used = np.array([i for x in own for i in x], dtype=np.int64)
    owner = np.repeat(np.arange(len(own)), [len(x) for x in own])
    n_a, n_b, n_groups, n_links = (
        np.bincount(owner, weights=c[used], minlength=len(own)).astype(np.int64).tolist() for c in counts
    )
    # The links of each used stretch, one after another.
    size = counts[3][used]
    shift = (np.cumsum(counts[3]) - counts[3])[used] - (np.cumsum(size) - size)
    held = pairs[np.arange(size.sum()) + np.repeat(shift, size)]
    # Sorted by document, then pair; equal ones stand together.
    room = int(held.max(initial=0)) + 1
    marked = np.sort(np.repeat(owner, size) * room + held)
    first = np.flatnonzero(np.diff(marked, prepend=-1))
    times = np.diff(np.append(first, len(marked)))
    cuts = np.searchsorted(marked[first], np.arange(1, len(own)) * room)
    per_text = zip(own, np.split(marked[first] % room, cuts), np.split(times, cuts), strict=True)
    group = stretches.groups.__getitem__
    digests = [hashlib.sha256(";".join(map(group, x)).encode()).hexdigest() if x else "" for x in own]
    return [
        (n_a[i], n_b[i], n_groups[i], n_links[i], digests[i], p, t) for i, (_, p, t) in enumerate(per_text)
    ]


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


_FIXED = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def align(
    docs: DataFrame,
    byte_level_file: Callable[[], str],
    piece_file: Callable[[], str],
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Per row: key, counts, digest, and the distinct linked ``pairs`` of ids with their ``times``.

    A pair is written as one number: the id of A times the size of B's vocabulary, plus the id of B.
    The files are looked up where they are opened.
    """

    def make() -> TextFunction:
        stretches = _stretches(byte_level_file(), piece_file())

        def function(texts: list[str]) -> tuple[None, dict[str, list]]:
            rows = [row for some in _by_characters(texts) for row in _aligned(some, stretches)]
            return None, dict(zip((*_FIXED, "pairs", "times"), map(list, zip(*rows, strict=True)), strict=True))

        return function

    added = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    return map_texts(docs, make, added, text, [key], rows_at_once=4_000)


def pair_counts(aligned: DataFrame, pieces: int) -> DataFrame:
    """Per linked pair: ``documents`` that hold it, and whether no other pair of its A id has more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count(F.lit(1)).alias("documents")
    )
    counts = counts.withColumn("id_a", F.floor(F.col("pair") / pieces))
    highest = counts.groupBy("id_a").agg(F.max("documents").alias("most"))
    return counts.join(highest, "id_a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def align_corpus(
    docs: DataFrame,
    byte_level_file: Callable[[], str],
    piece_file: Callable[[], str],
    pieces: int,
    text: str = "text",
    key: str = "doc_id",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """Per row: key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, digest.

    ``pieces`` is the size of B's vocabulary.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    numbered = align(docs, byte_level_file, piece_file, text, key).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), *_FIXED, "pairs", "times"
    )
    numbered.write.option("compression", "zstd").parquet(f"{folder}/aligned")
    aligned = spark.read.schema(numbered.schema).parquet(f"{folder}/aligned")
    counts = pair_counts(aligned, pieces)
    counts.write.parquet(f"{folder}/counts")
    counts = spark.read.schema(counts.schema).parquet(f"{folder}/counts")
    # The rows of a document stand in one task, which adds them up before the shuffle.
    sums = (
        aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
        .select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
        .join(broadcast_if_small(counts, broadcast_pairs), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
            F.sum(F.col("documents") * F.col("times")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "times").join(sums, "row", "left").select(
        F.col("key").alias(key),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
