"""K-d tree sharding by bytes, in DataFrame functions only.

A row is a point: the logarithm of its size, its source and its language (both as numbers from a
hash), each on a scale from 0 to 4095. Starting from one node that owns all shards, every node is cut
at the weighted quantile of its widest dimension that gives each half its share of the bytes, until
every node owns one shard, that is until leaves reach ``total bytes / shards``.

Ties along a dimension continue in the text's hash and then in the id's hash, so a row's place on a
dimension is one 60-bit number and equal texts are neighbours on every dimension (all copies of a
text take the source and language of one of them). A cut falls between groups of equal texts; only a
group that would shift the balance by more than ``GROUP_SHARE`` of a half is itself cut, by id.

The quantile of every node of a level is found at once, from histograms of 12 bits, each inside the
bin that the one before chose: at most 4096 rows a node and round, summed in the map tasks. Only
small numbers are kept per row, never the text, and the tables of nodes have at most ``shards`` rows.
Slots are ranks from one range-partitioned sort, which splits a large shard over many tasks.

Defined results: a null text weighs 8 bytes and has the checksum of an empty one; a null source,
language or id is a value like others. Repeated rows get slots of their own. An empty table gives an
empty result. Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import stored
from orderlens.operators.ordering import rows_before

DIMENSIONS = ("at_size", "at_source", "at_lang")
BITS = 12
# An id's hash is looked at only for groups heavier than this share of the lighter half.
GROUP_SHARE = 0.002
MOST_SHARDS = 10_000


def _points(docs: DataFrame, key: str, text: str, source: str, lang: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(body).cast("long") + 8
    scale = lambda c: F.pmod(F.xxhash64(F.coalesce(c, F.lit(""))), F.lit(1 << BITS))
    rows = stored(
        docs.select(
            F.col(key).alias("key"),
            size.alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("group"),
            F.least(F.floor(F.log2(size) * 100), F.lit(4095)).alias("at_size"),
            scale(F.col(source).cast("string")).alias("at_source"),
            scale(F.col(lang).cast("string")).alias("at_lang"),
        )
    )
    shared = stored(
        rows.groupBy("group")
        .agg(F.count(F.lit(1)).alias("n"), *[F.min(d).alias(f"of_{d}") for d in DIMENSIONS[1:]])
        .where("n > 1")
    )
    low = lambda c: c.bitwiseAND(F.lit((1 << 24) - 1))
    tie = F.shiftleft(low(F.col("group")), 24).bitwiseOR(low(F.xxhash64("key")))
    return rows.join(shared, "group", "left").select(
        "key",
        "size",
        "text_crc32",
        "at_size",
        *[F.coalesce(f"of_{d}", d).alias(d) for d in DIMENSIONS[1:]],
        tie.alias("tie"),
        F.lit(0).alias("node"),
    )


def _place(dimension: Column) -> Column:
    """A row's 60-bit place on the dimension with that index."""
    value = F.when(dimension == 0, F.col(DIMENSIONS[0]))
    for i, name in enumerate(DIMENSIONS[1:], 1):
        value = value.when(dimension == i, F.col(name))
    return F.shiftleft(value, 48).bitwiseOR(F.col("tie"))


def _nodes(points: DataFrame, owned: DataFrame) -> DataFrame:
    """Nodes to cut: their widest dimension and the bytes that belong to the left."""
    extent = points.agg(*[(F.max(d) - F.min(d)).alias(f"all_{d}") for d in DIMENSIONS])
    measured = (
        points.join(F.broadcast(owned.where("shards > 1")), "node")
        .groupBy("node", "shards")
        .agg(F.sum("size").alias("bytes"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS])
        .crossJoin(F.broadcast(extent))  # one row
    )
    width = [
        F.struct(
            (F.col(d) / F.greatest(F.col(f"all_{d}"), F.lit(1))).alias("width"),
            F.lit(-i).alias("first"),
        )
        for i, d in enumerate(DIMENSIONS)
    ]
    left = F.floor(F.col("shards") / 2)
    return stored(
        measured.select(
            "node",
            "shards",
            (-F.array_max(F.array(*width))["first"]).alias("dimension"),
            (F.col("bytes") * left / F.col("shards")).alias("goal"),
            left.cast("int").alias("left_shards"),
        )
    )


def _narrowed(placed: DataFrame, cuts: DataFrame, shift: int) -> DataFrame:
    """The 12-bit bin below each node's prefix in which the goal is reached."""
    bins = (
        placed.join(F.broadcast(cuts.where("not done")), "node")
        .where(F.shiftright("place", shift + BITS) == F.col("prefix"))
        .groupBy("node", "goal", "below", F.shiftright("place", shift).alias("bin"))
        .agg(F.sum("size").alias("bytes"))
    )
    so_far = Window.partitionBy("node").orderBy("bin")
    reached = bins.withColumn("upto", F.col("below") + F.sum("bytes").over(so_far))
    # The first bin that passes the goal; rounding may leave the last one.
    chosen = reached.groupBy("node", "goal").agg(
        F.coalesce(
            F.min(F.when(F.col("upto") > F.col("goal"), F.struct("bin", "upto", "bytes"))),
            F.max(F.struct("bin", "upto", "bytes")),
        ).alias("c")
    )
    return chosen.select(
        "node",
        "goal",
        F.col("c.bin").alias("prefix"),
        (F.col("c.upto") - F.col("c.bytes")).alias("below"),
        F.col("c.bytes").alias("inside"),
    )


def _cuts(points: DataFrame, nodes: DataFrame) -> DataFrame:
    """Per node the place at which its right half begins."""
    placed = points.join(F.broadcast(nodes.select("node", "dimension")), "node").select(
        "node", "size", _place(F.col("dimension")).alias("place")
    )
    # The bin goes to the side that leaves the smaller error.
    begin = F.when(
        F.col("goal") - F.col("below") < F.col("inside") / 2, F.col("prefix")
    ).otherwise(F.col("prefix") + 1)
    cuts = nodes.select(
        "node", "goal", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"),
        F.lit(False).alias("done"),
    )
    for shift in (48, 36, 24):
        cuts = _narrowed(placed, cuts, shift).withColumn("done", F.lit(False))
    cuts = stored(cuts.withColumn("done", F.col("inside") <= GROUP_SHARE * F.col("goal")))
    whole = cuts.where("done").select("node", F.shiftleft(begin, 24).alias("begin"))
    if cuts.where("not done").isEmpty():
        return whole
    for shift in (12, 0):
        cuts = _narrowed(placed, cuts, shift).withColumn("done", F.lit(False))
    return stored(whole.union(cuts.select("node", begin.alias("begin"))))


def assign(points: DataFrame, shards: int) -> DataFrame:
    """``points`` with ``node`` set to the shard, 0 to ``shards - 1``."""
    if not 0 < shards <= MOST_SHARDS:
        raise ValueError(f"shards must be from 1 to {MOST_SHARDS}")
    points = stored(points)
    owned = points.sparkSession.range(1).select(
        F.lit(0).alias("node"), F.lit(shards).alias("shards")
    )
    most = shards
    while most > 1:
        nodes = _nodes(points, owned)
        cut = nodes.join(F.broadcast(_cuts(points, nodes)), "node")
        cut = stored(cut.select("node", "shards", "dimension", "left_shards", "begin"))
        goes_right = _place(F.col("dimension")) >= F.col("begin")
        points = stored(
            points.join(F.broadcast(cut.drop("shards")), "node", "left").select(
                *[c for c in points.columns if c != "node"],
                F.when(F.coalesce(goes_right, F.lit(False)), F.col("node") + F.col("left_shards"))
                .otherwise(F.col("node"))
                .alias("node"),
            )
        )
        left = cut.select("node", F.col("left_shards").alias("shards"))
        right = cut.select(
            (F.col("node") + F.col("left_shards")).alias("node"),
            (F.col("shards") - F.col("left_shards")).alias("shards"),
        )
        owned = stored(left.union(right))
        most -= most // 2
    return points


def shard(
    docs: DataFrame,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
) -> DataFrame:
    """Per row: key, ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in a shard)."""
    points = assign(_points(docs, key, text, source, lang), shards)
    ranked = rows_before(
        points.select("key", "size", "text_crc32", F.col("node").alias("shard"), "tie"),
        ["shard", "tie", "key", "text_crc32"],
        name="rank",
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        points.groupBy(F.col("node").alias("shard"))
        .count()  # at most one row per shard
        .select("shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    )
    return ranked.join(F.broadcast(starts), "shard").select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        "shard",
        (F.col("rank") - F.col("start")).alias("slot"),
    )
