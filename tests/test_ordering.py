import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.operators import ordering
from orderlens.session import reliable

from conftest import rows


def frame(spark, n, seed, values=None):
    """Unique keys with values that tie a lot: a third of all rows share one value."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        hot = rng.random() < 0.34
        value = 7 if hot else rng.randrange(values or n)
        data.append((f"k{i:05d}", None if rng.random() < 0.02 else value, "ab"[rng.random() < 0.3]))
    rng.shuffle(data)
    return spark.createDataFrame(data, "key string, v int, grp string").repartition(5)


@pytest.mark.parametrize("n", [1, 3, 257])
def test_row_numbers(many_slices, n):
    df = frame(many_slices, n, n)
    expected = df.withColumn("rn", F.row_number().over(Window.orderBy("v", "key")))
    assert rows(ordering.row_numbers(df, ["v", "key"], "rn")) == rows(expected)


def test_the_order_spans_several_slices(many_slices):
    ordered = reliable(frame(many_slices, 500, 1).orderBy("v", "key"))
    assert ordered.select(F.spark_partition_id()).distinct().count() > 1


def test_weighted_rows_before(many_slices):
    df = frame(many_slices, 300, 2).groupBy("v").agg(F.count("*").alias("w"))
    before = F.coalesce(
        F.sum("w").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    expected = df.withColumn("rows_before", before)
    assert rows(ordering.rows_before(df, ["v"], "w")) == rows(expected)


def test_dense_ranks(many_slices):
    df = frame(many_slices, 120, 3, values=30)
    expected = df.withColumn("rank", F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert rows(ordering.dense_ranks(df, "v")) == rows(expected)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 103])
def test_ntiles(many_slices, n):
    df = reliable(frame(many_slices, n, n).withColumn("w", F.col("v") * 3 % 11))
    got = ordering.ntiles(df, "key", ["v", "w"], 4).select("key", "v_tile", "w_tile")
    expected = df.select(
        "key",
        *[F.ntile(4).over(Window.orderBy(c, "key")).alias(f"{c}_tile") for c in ("v", "w")],
    )
    assert rows(got) == rows(expected)


def test_ntile_of_one_value(many_slices):
    df = reliable(many_slices.range(10).select(F.col("id").alias("key"), F.lit(1).alias("v")))
    tiles = [r["v_tile"] for r in ordering.ntiles(df, "key", ["v"], 4).orderBy("key").collect()]
    assert tiles == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4]


@pytest.mark.parametrize("n", [1, 2, 40, 301])
def test_percent_rank_cuts(many_slices, n):
    df = frame(many_slices, n, n, values=25)
    cuts = ordering.percent_rank_cuts(df, "v", {"high": 0.8, "medium": 0.2})
    rank = F.percent_rank().over(Window.orderBy("v"))
    ranked = df.withColumn("pr", rank).withColumns(
        {"above_high": F.col("v") > cuts["high"], "above_medium": F.col("v") > cuts["medium"]}
    )
    wrong = ranked.where(
        (F.coalesce("above_high", F.lit(False)) != (F.col("pr") > 0.8))
        | (F.coalesce("above_medium", F.lit(False)) != (F.col("pr") > 0.2))
    )
    assert wrong.count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 200])
def test_quantiles(many_slices, n):
    df = frame(many_slices, n, n, values=60)
    wanted = {"p25": 25, "p50": 50, "p95": 95}
    got = ordering.quantiles(df, "v", wanted, ["grp"], extremes=True)
    expected = df.where("v is not null").groupBy("grp").agg(
        F.count("v"), F.min("v"),
        *[F.percentile("v", p / 100) for p in wanted.values()], F.max("v"),
    )
    def plain(df):
        return [tuple(x if isinstance(x, str) else round(float(x), 6) for x in r) for r in rows(df)]

    assert plain(got) == plain(expected)


def test_quantile_scalar_and_median(many_slices):
    df = many_slices.createDataFrame([(Decimal(x),) for x in ("1", "2", "3", "10")], "v decimal(18,2)")
    one = many_slices.range(1).select(ordering.median(df, "v"), ordering.quantile(df, "v", 95)).first()
    assert tuple(one) == (Decimal("2.5"), Decimal("8.95"))
    empty = many_slices.range(1).select(ordering.median(df.where("v > 99"), "v")).first()
    assert empty[0] is None


def test_box_stats(many_slices):
    df = many_slices.createDataFrame([("a", x) for x in (1, 2, 3, 4, 100)] + [("b", 5)], "g string, v int")
    got = {r["g"]: r for r in ordering.box_stats(df, "v", ["g"]).collect()}
    assert (got["a"]["q1"], got["a"]["median"], got["a"]["q3"]) == (2, 3, 4)
    assert (got["a"]["lower_fence"], got["a"]["upper_fence"], got["a"]["max"]) == (-1, 7, 100)
    assert got["b"]["n"] == 1 and got["b"]["q1"] == statistics.median([5])


@pytest.mark.parametrize("n", [1, 3, 40, 301])
def test_boxes_of_what_a_percentile_leaves(many_slices, n):
    """Cap over all groups, then quartiles by group, against a filter and the boxes of what is left."""
    df = frame(many_slices, n, n + 7, values=60)
    values = sorted(r["v"] for r in df.collect() if r["v"] is not None)
    if not values:
        return
    at = (len(values) - 1) * 0.8
    cap = values[int(at)] + (values[min(int(at) + 1, len(values) - 1)] - values[int(at)]) * (at - int(at))
    want = ordering.box_stats(df.where(F.col("v") <= cap), "v", ["grp"])
    got = ordering.box_stats(df, "v", ["grp"], cap_percent=80)
    assert rows(got) == rows(want)


def test_order_statistics_of_any_size_and_sign(spark):
    from decimal import Decimal

    from orderlens.operators import selection

    texts = ["-9e15", "-12345.6789", "-12345.6788", "-1", "-0.0001", "0", "0.0001", "0.5", "99999", "99999.5", "1e5", "9e15"]
    values = [Decimal(x) for x in texts]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(20,4)")
    places = {f"p{i}": (lambda n, i=i: F.lit(i)) for i in range(len(values))} | {"none": lambda n: n}
    found = selection.order_statistics(selection.fold(df, "v"), places).first()
    assert [found[f"p{i}"] for i in range(len(values))] == values
    assert found["none"] is None and found["_n"] == len(values)


def test_order_statistics_refuse_what_cannot_be_broadcast(spark, monkeypatch):
    from orderlens.operators import selection

    monkeypatch.setattr(selection, "MOST_BUCKETS", 5)
    df = spark.range(10).selectExpr("id AS g", "id AS v")
    with pytest.raises(Exception, match="too many groups"):
        ordering.quantiles(df, "v", {"q": 50}, ["g"]).collect()


def test_percentiles_sort_no_rows(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id AS v")
    for found in (ordering.box_stats(df, "v", ["g"], cap_percent=95), ordering.quantiles(df, "v", {"q": 50})):
        found.collect()
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in text and "Scan ExistingRDD" not in text


@pytest.mark.parametrize("descending", [True, False])
def test_dense_ranks_carry_on_over_slices(many_slices, descending):
    """Few values, so that each spans several slices; nulls, and no join back to the rows."""
    df = many_slices.range(400).selectExpr("id", "CASE WHEN id % 7 = 0 THEN NULL ELSE id % 3 END AS v")
    got = ordering.dense_ranks(df, "v", descending)
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    assert rows(got) == rows(df.withColumn("rank", F.dense_rank().over(Window.orderBy(order)).cast("int")))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Join") == 1


@pytest.mark.parametrize("values", [[], [5], [None], [3, 3], [1, 2, 2, None, 9]])
def test_percent_ranks(many_slices, values):
    df = many_slices.createDataFrame([(v,) for v in values], "v int")
    want = df.withColumn("percent_rank", F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_first())))
    assert rows(ordering.percent_ranks(df, "v")) == rows(want.distinct())
