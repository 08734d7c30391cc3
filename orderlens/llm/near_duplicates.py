"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

1. A document is the set of its distinct word shingles, as 64-bit hashes. Documents with equal sets
   form a class; from here on only classes count, so copies cost nothing.
2. Sketch: ``BANDS * ROWS`` bins are filled in rounds. A round hashes every shingle to a bin and a
   value, and a bin takes the smallest value of the first round that reaches it. From round t on,
   round t + i sends everything to bin i, so after 2t rounds every bin is filled; long documents
   fill them all in the first. The share of equal bins concentrates around the Jaccard similarity as
   with t independent hashes.
3. Banding: classes with equal bins in a band share a bucket. A pair at similarity 0.8 shares none
   of the buckets with a chance of (1 - 0.8^6)^42 < 3e-6.
4. Candidates: no bucket is expanded into its pairs. Every member is paired with the bucket's leader
   (the member that shares most buckets overall, usually the original of a group of copies), and
   those pairs are verified on the full sets. Two members already connected need no test. A member
   that is apart from its leader's component is compared with that component's members, inside a
   join that emits links only; members that are both apart are compared with each other in the first
   bucket they share. Either join looks at sketches first: more than ``MOST_UNLIKE`` unequal bins
   (5.5 standard deviations past 0.8) rule a pair out. So every pair of a bucket is verified or
   connected through verified links.
5. Verified links give components; the joins spread hot buckets, whose rows are ids only.

Defined results: a null or empty text (or one without words) has no shingles, is linked with
nothing and is its own component. A text with fewer words than a shingle is one shingle. Rows with
equal ids are one node. Rows without an id take the component of their class, and are kept only if
no row of it has an id. Other columns play no part. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import TextFunction, map_texts, stored
from orderlens.llm.components import components
from orderlens.session import broadcast_if_small

ROWS = 6
BANDS = 42
BINS = ROWS * BANDS
REMEMBERED = 400_000
# Of 252 bins, compared by 4 bits each, 47 +- 6.2 differ at similarity 0.8.
MOST_UNLIKE = 82
_SIGNATURE_LONGS = 16
_EMPTY_BIN = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ROUND_KEYS = _mixed(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BAND_KEYS = _mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


class Shingles:
    """Sorted distinct shingle hashes of texts; remembers the hashes of words it has met."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.seen: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        # bytes.lower() changes A-Z only, and bytes.split() splits at the six white-space bytes.
        words = text.encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.seen) > REMEMBERED:
            self.seen = {}
        seen = self.seen
        for w in set(words).difference(seen):
            seen[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        ids = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        k = min(self.words, len(ids))
        # The length goes in first, so a short text is no shingle of a longer one.
        hashes = np.full(len(ids) - k + 1, k, np.uint64)
        for i in range(k):
            hashes = _mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(ids) - k + 1 + i])
        return np.unique(hashes)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One value per bin: the round in the upper 16 bits, a hash below."""
    bins = np.full(BINS, _EMPTY_BIN)
    at = 0
    while at < 2 * BINS and (at == 0 or (bins == _EMPTY_BIN).any()):
        rounds = np.arange(at, min(2 * BINS, at + max(1, 2048 // len(shingles))))
        hashed = _mixed(shingles[None, :] ^ _ROUND_KEYS[rounds][:, None])
        place = (hashed >> np.uint64(40)) % np.uint64(BINS)
        fixed = rounds >= BINS
        place[fixed] = (rounds[fixed] - BINS)[:, None].astype(np.uint64)
        value = (_mixed(hashed) >> np.uint64(16)) | (rounds.astype(np.uint64) << np.uint64(48))[:, None]
        np.minimum.at(bins, place.ravel().astype(np.intp), value.ravel())
        at = int(rounds[-1]) + 1
    return bins


def _bands(bins: np.ndarray) -> np.ndarray:
    keys = _BAND_KEYS.copy()
    for column in bins.reshape(BANDS, ROWS).T:
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def _signature(bins: np.ndarray) -> np.ndarray:
    """Four bits of each bin, sixteen bins to a number."""
    bits = np.zeros(_SIGNATURE_LONGS * 16, np.uint64)
    bits[:BINS] = bins & np.uint64(15)
    shifts = np.arange(0, 64, 4, dtype=np.uint64)
    return np.bitwise_or.reduce(bits.reshape(-1, 16) << shifts, axis=1).view(np.int64)


def _unlike(a: str, b: str) -> Column:
    """In how many bins two signatures differ."""
    ones = F.lit(0x1111111111111111)
    total: list[Column] = []
    for i in range(_SIGNATURE_LONGS):
        x = F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        total.append(F.bit_count(x.bitwiseAND(ones)))
    return reduce(lambda x, y: x + y, total)


def sketches(docs: DataFrame, shingle_words: int, text: str, key: str) -> DataFrame:
    """Per row: key, ``n_shingles``, the class ``c1``, ``c2``, its ``bands`` and ``signature``."""

    def make() -> TextFunction:
        shingles = Shingles(shingle_words)

        def of_texts(texts: list[str]) -> tuple[None, dict[str, list]]:
            out: dict[str, list] = {n: [] for n in ("n_shingles", "c1", "c2", "bands", "signature")}
            for t in texts:
                s = shingles(t)
                c = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                bins = sketch(s) if len(s) else None
                out["n_shingles"].append(len(s))
                out["c1"].append(int.from_bytes(c[:8], "little", signed=True))
                out["c2"].append(int.from_bytes(c[8:], "little", signed=True))
                out["bands"].append(None if bins is None else _bands(bins))
                out["signature"].append(None if bins is None else _signature(bins))
            return None, out

        return of_texts

    added = "n_shingles long, c1 long, c2 long, bands array<long>, signature array<long>"
    return map_texts(docs, make, added, text, [key])


def _sets(docs: DataFrame, nodes: DataFrame, shingle_words: int, text: str, key: str) -> DataFrame:
    """The full shingle set of each of ``nodes``, once."""

    def make() -> TextFunction:
        shingles = Shingles(shingle_words)
        return lambda texts: (None, {"shingles": [shingles(t).view(np.int64) for t in texts]})

    wanted = docs.select(F.col(key).alias("node"), F.col(text).alias("text")).join(
        broadcast_if_small(nodes), "node", "left_semi"
    )
    found = map_texts(wanted, make, "shingles array<long>", "text", ["node"])
    # Rows with equal ids are one node; the longest set stands for it.
    return stored(
        found.groupBy("node").agg(F.max(F.struct(F.size("shingles"), "shingles"))["shingles"].alias("shingles"))
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough. ``a`` may be a hot key."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", common.alias("common"), (F.size("of_a") + F.size("of_b")).alias("sizes"))
        .where(F.col("common") * (100 + percent) >= percent * F.col("sizes"))
        .select("a", "b")
    )


def _close_in_size(a: str, b: str, percent: int) -> Column:
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _apart_from_main(
    apart: DataFrame, weights: DataFrame, connected: DataFrame, details: DataFrame, percent: int
) -> DataFrame:
    """Links from members that are apart to any member of their leaders' components.

    Each node is met once per component, not once per shared bucket, and the full sets are compared
    inside the join, so only links leave it; a large component is split like any hot join key.
    """
    wanted = apart.select(F.col("node").alias("a"), "main").distinct()
    mine = wanted.join(
        details.select(
            F.col("node").alias("a"),
            F.col("n").alias("a_n"),
            F.col("signature").alias("a_signature"),
            F.col("shingles").alias("of_a"),
        ),
        "a",
    )
    members = (
        weights.select("node")
        .join(connected, "node", "left")
        .select("node", F.coalesce("component", "node").alias("main"))
        .join(wanted.select("main").distinct(), "main", "left_semi")
        .join(details, "node")
    )
    common = F.size(F.array_intersect("of_a", "shingles"))
    return (
        stored(mine)
        .join(stored(members), "main")
        .where(
            _close_in_size("n", "a_n", percent)
            & (_unlike("signature", "a_signature") <= MOST_UNLIKE)
            & (common * (100 + percent) >= percent * (F.col("n") + F.col("a_n")))
        )
        .select("a", F.col("node").alias("b"))
    )


def _apart_together(apart: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of members that are both apart from the same leader, each pair once."""
    rows = stored(
        apart.join(classes.select("node", F.col("n_shingles").alias("n"), "bands", "signature"), "node")
    )
    other = rows.select(*[F.col(c).alias(c if c == "bucket" else f"o_{c}") for c in rows.columns])
    first_shared = F.get(F.array_intersect("bands", "o_bands"), F.lit(0))
    return (
        rows.join(other, "bucket")
        .where(
            (F.col("node") < F.col("o_node"))
            & (F.col("component") != F.col("o_component"))
            & _close_in_size("n", "o_n", percent)
            & (_unlike("signature", "o_signature") <= MOST_UNLIKE)
            & (first_shared == F.col("bucket"))
        )
        .select(F.col("node").alias("a"), F.col("o_node").alias("b"))
    )


def _links(docs: DataFrame, classes: DataFrame, words: int, percent: int, text: str, key: str) -> DataFrame:
    """Components of the classes, each by its smallest id; classes without a link are left out."""
    members = classes.select(F.explode("bands").alias("bucket"), "node", F.col("n_shingles").alias("n"))
    shared = stored(
        members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    )
    dense = stored(members.join(shared, "bucket"))
    weights = stored(dense.groupBy("node").agg(F.sum("m").alias("weight")))
    leaders = stored(
        dense.join(weights, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("weight", F.struct("node", "n").alias("who")))["who"].alias("leader"))
        .select("bucket", F.col("leader.node").alias("leader"), F.col("leader.n").alias("leader_n"))
    )
    sets = _sets(docs, weights.select("node"), words, text, key)
    first = (
        dense.join(leaders, "bucket")
        .where((F.col("node") != F.col("leader")) & _close_in_size("n", "leader_n", percent))
        .select(F.col("leader").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    links = stored(_verified(first, sets, percent))
    connected = stored(components(links))
    of_leader = connected.select(F.col("node").alias("leader"), F.col("component").alias("main"))
    apart = stored(
        dense.join(leaders, "bucket")
        .where("node <> leader")
        .join(connected, "node", "left")
        .join(of_leader, "leader", "left")
        .select(
            "bucket",
            "node",
            F.coalesce("component", "node").alias("component"),
            F.coalesce("main", "leader").alias("main"),
        )
        .where("component <> main")
    )
    details = classes.select("node", F.col("n_shingles").alias("n"), "signature").join(sets, "node")
    near = stored(_apart_from_main(apart, weights, connected, details, percent))
    among = _apart_together(apart, classes, percent)
    more = stored(near.union(_verified(among, sets, percent)).distinct())
    if more.isEmpty():
        return connected
    # The later links only join whole components, so few nodes take part.
    lookup = lambda end: connected.select(F.col("node").alias(end), F.col("component").alias(f"{end}_of"))
    between = (
        more.join(lookup("a"), "a", "left")
        .join(lookup("b"), "b", "left")
        .select(F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b"))
        .distinct()
    )
    merged = stored(components(between)).withColumnRenamed("component", "final")
    moved = connected.join(
        merged.withColumnRenamed("node", "component"), "component", "left"
    ).select("node", F.coalesce("final", "component").alias("component"))
    alone = merged.join(connected, "node", "left_anti").select("node", F.col("final").alias("component"))
    return stored(moved.union(alone))


def find_near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 80,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Per row: key, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept``."""
    rows = stored(sketches(docs, shingle_words, text, key).withColumnRenamed(key, "node"))
    classes = stored(
        rows.where("n_shingles > 0 and node is not null")
        .groupBy("c1", "c2")
        .agg(F.min(F.struct("node", "n_shingles", "bands", "signature")).alias("of"))
        .select("c1", "c2", "of.*")
    )
    found = _links(docs, classes, shingle_words, percent, text, key)
    of_class = stored(
        classes.select("c1", "c2", "node")
        .join(found, "node", "left")
        .select("c1", "c2", F.coalesce("component", "node").alias("component_id"))
    )
    component = F.coalesce("component_id", "node")
    return rows.select("node", "n_shingles", "c1", "c2").join(of_class, ["c1", "c2"], "left").select(
        F.col("node").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component.isNull() | (F.col("node") == component), F.lit(False)).alias("kept"),
    )


def keep_one_each(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """The documents, all columns, with one left of every component: that with the smallest id.

    Rows are told apart by a stored number, so rows that share an id or have none are compared by their
    texts like all others. Rows with an id go before those without; of equal ids the earliest row stays.
    """
    row = "_near_row"
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    plain = numbered.select(F.col(row), F.col(text).alias("text"))
    found = find_near_duplicates(plain, shingle_words, percent, "text", row).select(row, "component_id")
    ids = numbered.select(row, F.col(key).alias("id"))
    order = F.struct(F.col("id").isNull().alias("missing"), "id", row)
    members = stored(found.join(ids, row))
    # Only rows of larger components can go.
    first = (
        members.groupBy("component_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order)[row].alias("stays"))
        .where("n > 1")
    )
    gone = stored(members.join(broadcast_if_small(stored(first)), "component_id").where(F.col(row) != F.col("stays")).select(row))
    return numbered.join(broadcast_if_small(gone), row, "left_anti").select(*docs.columns)
