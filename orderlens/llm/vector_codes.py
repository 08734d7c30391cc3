"""Integer product codes of vectors, searched in the Walsh-Hadamard domain.

Every component x becomes the whole number floor(scale * x). Vectors are cut into equal consecutive
parts; each part position has a codebook, which starts as that part of the vectors with the smallest
ids and is refined in a fixed number of rounds (assign, then replace every entry by the rounded-down
mean of its parts). The result is one entry number per part.

The nearest entry is found exactly, in whole numbers. Parts and entries are padded with zeros to a
power of two and transformed; the sum of the squared differences of two transforms is the squared
distance times that power. Coefficients are taken in sequency order, slow changes first. The entry
that leads after ``HEAD`` coefficients gives a full distance as bound, and any entry whose partial sum
exceeds it is dropped before the next coefficient. What is left at the end is compared in full; of
equal distances the lower entry wins.

A round is one pass of the tasks over the stored vectors: a task adds its parts up by entry and hands
on at most parts * entries * width sums, which Spark adds up. The driver holds the codebooks alone.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped.
Vectors shorter than the longest one (or than a multiple of ``parts``) are padded with zeros. A whole
component outside the range in which all sums of squares fit 64 bits (2^27 for parts of eight) counts
as the end of that range. Rows without an id are coded like any other but found only behind all ids
when codebooks start; of rows that share an id the smallest vector starts a codebook, and all are
coded. With fewer ids than entries the codebooks are shorter. Null labels count as one label. An
error summed over a label that exceeds 64 bits counts as the largest long. Other columns play no
part. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import stored
from orderlens.session import broadcast_if_small

HEAD = 2
ROWS_AT_ONCE = 4096
_LARGEST = 2**63 - 1
_LARGEST_DOUBLE = 1.7976931348623157e308


def sequency_order(size: int) -> np.ndarray:
    """Where the transform of natural order keeps the function with 0, 1, 2 ... changes of sign."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    reverse = np.zeros(size, dtype=np.int64)
    for b in range(bits):
        reverse |= ((gray >> b) & 1) << (bits - 1 - b)
    return reverse


def walsh_hadamard(rows: np.ndarray) -> np.ndarray:
    """The integer transform of each row, zero-padded to a power of two, in sequency order."""
    n, width = rows.shape
    size = 1 << max(0, width - 1).bit_length()
    out = np.zeros((n, size), dtype=np.int64)
    out[:, :width] = rows
    half = 1
    while half < size:
        pairs = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2)
        half *= 2
    return out.reshape(n, size)[:, sequency_order(size)]


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and the squared distance to it; both sides are transforms."""
    n, size = rows.shape
    first = rows[:, None, :HEAD] - entries[None, :, :HEAD]
    partial = (first * first).sum(axis=2)
    gap = rows - entries[partial.argmin(axis=1)]
    bound = (gap * gap).sum(axis=1)
    row, entry = np.nonzero(partial <= bound[:, None])
    total = partial[row, entry]
    for s in range(HEAD, size):
        gap = rows[row, s] - entries[entry, s]
        total = total + gap * gap
        alive = total <= bound[row]
        row, entry, total = row[alive], entry[alive], total[alive]
    # The candidates of a row stand together, lower entries first; the bound's own entry is one of them.
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(total, starts)
    hits = np.flatnonzero(total == least[row])
    best = entry[hits[np.unique(row[hits], return_index=True)[1]]]
    return best, least // size


@dataclass
class Codebooks:
    """``entries[part, entry, position]``, whole numbers."""

    entries: np.ndarray

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers (rows by parts) and squared distances of the same shape."""
        parts, _, width = self.entries.shape
        codes = np.zeros((len(vectors), parts), dtype=np.int64)
        errors = np.zeros((len(vectors), parts), dtype=np.int64)
        for p in range(parts):
            mine = walsh_hadamard(vectors[:, p * width : (p + 1) * width])
            codes[:, p], errors[:, p] = nearest(mine, walsh_hadamard(self.entries[p]))
        return codes, errors

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _blocks(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        some = batch.column(column).slice(at, ROWS_AT_ONCE)
        yield at, some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), width)


def _whole_vectors(vectors: DataFrame, key: str, label: str, vector: str, parts: int, scale: int) -> tuple[DataFrame, int]:
    """Stored columns ``key``, ``label``, ``whole`` (of equal length), and the width of a part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= _LARGEST_DOUBLE))
    kept = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector")).where(
        F.col(vector).isNotNull() & fine
    )
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    size = 1 << (width - 1).bit_length()
    limit = 1 << ((62 - (size * width - 1).bit_length()) // 2 - 1)

    def whole(x: Column) -> Column:
        return F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(limit)), F.lit(-limit))

    # Padding is appended to the whole numbers; array_repeat takes what each vector lacks.
    padded = F.concat(
        F.transform("vector", whole), F.array_repeat(F.lit(0).cast("long"), F.lit(parts * width) - F.size("vector"))
    )
    return stored(kept.select("key", "label", padded.alias("whole"))), width


def _first_codebooks(whole: DataFrame, parts: int, entries: int, width: int) -> Codebooks:
    """Parts of the vectors with the smallest ids, a bounded number of rows."""
    ids = whole.select("key").distinct().orderBy(F.col("key").asc_nulls_last()).limit(entries)
    chosen = ids.withColumnRenamed("key", "id")
    found = (
        whole.join(F.broadcast(chosen), F.col("key").eqNullSafe(F.col("id")))
        .groupBy("key")
        .agg(F.min("whole").alias("whole"))
        .orderBy(F.col("key").asc_nulls_last())
        .collect()
    )
    rows = np.array([r["whole"] for r in found], dtype=np.int64).reshape(len(found), parts, width)
    return Codebooks(rows.transpose(1, 0, 2).copy())


def _refined(whole: DataFrame, books: Codebooks) -> Codebooks:
    parts, entries, width = books.entries.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        counts = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for _, vectors in _blocks(batch, 0, parts * width):
                codes, _ = books.assign(vectors)
                for p in range(parts):
                    np.add.at(sums[p], codes[:, p], vectors[:, p * width : (p + 1) * width])
                    counts[p] += np.bincount(codes[:, p], minlength=entries)
        part, entry = np.nonzero(counts)
        place = np.tile(np.arange(width), len(part))
        part, entry = np.repeat(part, width), np.repeat(entry, width)
        columns = [part, entry, place, sums[part, entry, place], counts[part, entry]]
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "total", "n"]
            )

    # One row per part, entry and position, whatever the number of vectors.
    sums = (
        whole.select("whole")
        .mapInArrow(add_up, "part long, entry long, place long, total long, n long")
        .groupBy("part", "entry", "place")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        .collect()
    )
    refined = books.entries.copy()
    for r in sums:
        refined[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return Codebooks(refined)


def fit_codebooks(whole: DataFrame, parts: int, entries: int, rounds: int, width: int) -> Codebooks:
    books = _first_codebooks(whole, parts, entries, width)
    for _ in range(rounds if books.entries.size else 0):
        books = _refined(whole, books)
    return books


def encode(whole: DataFrame, books: Codebooks) -> DataFrame:
    """``key``, ``label``, ``codes`` (one entry number per part) and ``error`` of every stored row."""
    parts, _, width = books.entries.shape
    schema = whole.select(
        "key", "label", F.array(F.lit(0)).alias("codes"), F.lit(0).cast("long").alias("error")
    ).schema

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, vectors in _blocks(batch, 2, parts * width):
                codes, errors = books.assign(vectors)
                ends = np.arange(0, codes.size + 1, parts, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(codes)),
                        batch.column(1).slice(at, len(codes)),
                        pa.ListArray.from_arrays(ends, pa.array(codes.ravel(), pa.int32())),
                        pa.array(errors.sum(axis=1), pa.int64()),
                    ],
                    names=["key", "label", "codes", "error"],
                )

    return whole.mapInArrow(code, schema)


def compress(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> tuple[DataFrame, Codebooks]:
    """Per kept row: key, label, ``codes`` and ``error`` (written once); and the codebooks."""
    whole, width = _whole_vectors(vectors, key, label, vector, parts, scale)
    books = fit_codebooks(whole, parts, entries, rounds, width)
    coded = stored(encode(whole, books))
    return coded.select(F.col("key").alias(key), F.col("label").alias(label), "codes", "error"), books


def digest(coded: DataFrame, books: Codebooks, key: str = "vec_id", label: str = "label") -> DataFrame:
    """Codes as text, errors by row and by label, and the codebooks' checksum."""
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    by_label = coded.groupBy(F.col(label).alias("_label")).agg(
        F.least(exact, F.lit(_LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error")
    )
    two_digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return coded.join(broadcast_if_small(by_label), F.col(label).eqNullSafe(F.col("_label"))).select(
        key,
        F.array_join(two_digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )
