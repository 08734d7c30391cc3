"""Best-two-fit packing of token sequences.

Documents become token ids once, inside the tasks; only (document, piece, length, checksum) leaves
them. Packing looks at lengths alone, and there are at most ``capacity`` of them, so the plan is made
from their counts: that table has at most ``capacity`` rows, whatever the corpus holds.

A sequence is filled greedily, the longest remaining piece that fits first. Then its smallest piece
is taken out, and if two unpacked pieces fit the widened gap more tightly than it did, they take its
place; this is repeated while it helps. As many sequences of that pattern are made at once as the
counts allow, so the number of patterns depends on the number of lengths, not of documents. The plan
says which ranks within a length go to which sequences and offsets. Ranks come from one
range-partitioned sort by (length, id, piece), which spreads a length that a third of all pieces
share, and each piece looks its place up by binary search.

Defined results: a null or empty text is its end token alone. Equal documents are packed one by one.
Rows that agree in id, piece and checksum are interchangeable. Other columns play no part. An empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderlens.llm.common import TextFunction, map_texts, stored
from orderlens.operators.ordering import rows_before

REMEMBERED = 300_000
LONGEST_REMEMBERED = 100
# Letters that then end in signs: the tokenizer lower-cases, and cuts between the two. (No
# apostrophe, which it may join with letters, and only letters whose lower case is one letter.)
_LETTERS_AND_SIGNS = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")
# How byte-level vocabularies write bytes that do not print in Latin-1: from code point 256 on.
_HIDDEN = [*range(33), *range(127, 161), 173]
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(_HIDDEN)}


class Encoder:
    """Ids as bytes (little-endian, four each), remembering the words it has met.

    White space separates words for the tokenizer, so a text's ids are those of its words in turn.
    """

    def __init__(self, tokenizer_file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.seen: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        # Each word is one item of a list, so the library has no text to cut.
        for i in range(0, len(words), 2_000):
            some = words[i : i + 2_000]
            encoded = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            ends = np.cumsum(np.bincount(np.array(encoded.word_ids, dtype=np.int64), minlength=len(some)))
            for word, start, end in zip(some, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                self.seen[word] = ids[start:end].tobytes()

    def _learn_letters(self, words: set[str]) -> None:
        # Lower-case letters alone are one word to the tokenizer: only its model has work to do.
        tokenize = self.tokenizer.model.tokenize
        for word in words:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
            self.seen[word] = array("I", [t.id for t in tokenize(shown)]).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.seen) > REMEMBERED:
            self.seen = {}
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        new = set().union(*split).difference(self.seen)
        made: dict[str, tuple[str, str]] = {}
        letters_only, others = set(), set()
        for word in new:
            if match := _LETTERS_AND_SIGNS.fullmatch(word):
                letters, signs = match.groups()
                letters = letters.lower()
                made[word] = (letters, signs)
                letters_only.add(letters)
                others.add(signs)
            else:
                others.add(word)
        others.discard("")
        self.seen[""] = b""
        self._learn_letters(letters_only.difference(self.seen))
        self._learn(list(others.difference(self.seen)))
        known = self.seen.__getitem__
        for word, (letters, signs) in made.items():
            self.seen[word] = known(letters) + known(signs)
        encoded = [b"".join(map(known, words)) for words in split]
        # What is kept has a bound in bytes, too: very long words are rare and would fill it.
        for word in new | letters_only | others:
            if len(word) > LONGEST_REMEMBERED:
                self.seen.pop(word, None)
        return encoded


@functools.lru_cache(maxsize=1)
def _encoder(tokenizer_file: str) -> Encoder:
    """One per Python worker, so what it remembers serves all tasks that the worker runs."""
    return Encoder(tokenizer_file)


def cut_into_pieces(
    docs: DataFrame,
    tokenizer_file: Callable[[], str],
    capacity: int,
    end_id: int,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Key, ``piece``, ``start``, ``length`` and ``ids_crc32`` of every piece of every document."""
    end = np.array([end_id], "<u4").tobytes()

    def make() -> TextFunction:
        encoder = _encoder(tokenizer_file())

        def cut(texts: list[str]) -> tuple[list[int], dict[str, list]]:
            rows = []
            for i, ids in enumerate(encoder(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((i, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            index, *columns = map(list, zip(*rows, strict=True))
            return index, dict(zip(("piece", "start", "length", "ids_crc32"), columns, strict=True))

        return cut

    return map_texts(docs, make, "piece int, start long, length long, ids_crc32 long", text, [key])


@dataclass
class Plan:
    """Runs of ranks per length: rank r of a run goes to sequence ``sequence + (r - first) // copies``."""

    first: np.ndarray
    length: np.ndarray
    sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    sequences: int


def best_two_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Pack ``counts[length]`` pieces of each length into sequences of ``capacity``."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    taken = np.zeros(capacity + 1, dtype=np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    lengths = np.arange(capacity + 1)
    while (present := np.flatnonzero(left)).size:
        use: dict[int, int] = {}
        gap = capacity

        def put(length: int, n: int) -> None:
            nonlocal gap
            use[length] = use.get(length, 0) + n
            left[length] -= n
            gap -= n * length

        candidates = present[::-1]
        for length in candidates:
            length = int(length)
            if n := min(gap // length, int(left[length])):
                put(length, n)
            if not gap:
                break
        while gap:
            smallest = min(use)
            room = gap + smallest
            # The longest unpacked piece of each length or less.
            longest = np.maximum.accumulate(np.where(left > 0, lengths, 0))
            a = np.flatnonzero(left[: room + 1])
            b = longest[room - a]
            # A pair of equal lengths needs two of them.
            twice = (a == b) & (left[a] < 2)
            b[twice] = longest[np.maximum(a[twice] - 1, 0)]
            fill = np.where(b > 0, a + b, 0)
            if not fill.size or fill.max() <= smallest:
                break
            best = int(fill.argmax())
            use[smallest] -= 1
            if not use[smallest]:
                del use[smallest]
            left[smallest] += 1
            gap += smallest
            put(int(a[best]), 1)
            put(int(b[best]), 1)
        copies = 1 + min(int(left[x]) // n for x, n in use.items())
        offset = 0
        for length in sorted(use, reverse=True):
            n = use[length]
            left[length] -= n * (copies - 1)
            # n slots of one length are n runs, so a rank's place needs no division by slots.
            for _ in range(n):
                runs.append((int(taken[length]), length, sequences, copies, offset))
                taken[length] += copies
                offset += length
        sequences += copies
    table = np.array(sorted(runs, key=lambda r: (r[1], r[0])), dtype=np.int64).reshape(-1, 5)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], table[:, 4], sequences)


def pack(pieces: DataFrame, capacity: int, key: str = "doc_id") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have a ``length`` of 1 to ``capacity``."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = best_two_fit(counts, capacity)
    before = np.zeros(capacity + 2, dtype=np.int64)
    for length, n in counts.items():
        before[length + 1] = n
    before = np.cumsum(before)
    # One sorted array for all lengths: global rank of each run's first piece.
    starts = plan.first + before[plan.length]
    placed = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    arrow = to_arrow_schema(placed)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(batch.num_columns - 1).to_numpy()
            run = np.searchsorted(starts, rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *[c.cast(arrow.field(i).type) for i, c in enumerate(batch.columns[:-1])],
                    pa.array(plan.sequence[run] + rank - starts[run]),
                    pa.array(plan.offset[run]),
                ],
                schema=arrow,
            )

    order = [F.col("length"), F.col(key), F.col("piece"), F.col("ids_crc32")]
    return rows_before(pieces, order, name="_rank").mapInArrow(place, placed)


def pack_documents(
    docs: DataFrame,
    tokenizer_file: Callable[[], str],
    capacity: int = 2048,
    end_id: int = 0,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    pieces = stored(cut_into_pieces(docs, tokenizer_file, capacity, end_id, text, key))
    return pack(pieces, capacity, key)
