"""Exact ratios against Python's decimals."""

from decimal import ROUND_HALF_UP, Decimal, localcontext

import random

from pyspark.sql import functions as F

from orderlens.functions.dates import parse_iso_timestamp
from orderlens.functions.numbers import percent, safe_ratio


def expected(n, d, places, factor=1):
    if d == 0:
        return None
    with localcontext() as c:
        c.prec = 60
        return (n * factor / d).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


def test_ratios_are_exact(spark):
    random.seed(4)
    cases = [
        (Decimal("12970645509157.2296"), Decimal("278639001270832")),
        (Decimal("246465821718623.5598"), Decimal("247617241893428")),
        (Decimal("123456789012345.6789"), Decimal(1)),
        (Decimal("-0.005"), Decimal(1)), (Decimal("0.005"), Decimal(-1)), (Decimal("2.505"), Decimal(1)),
        (Decimal(5), Decimal(0)), (Decimal(0), Decimal(7)),
    ]
    for _ in range(500):
        digits = random.randint(1, 20)
        n = Decimal(random.randint(-(10**digits), 10**digits)) / 10000
        d = Decimal(random.choice([1, 2, 8, 3, random.randint(1, 10**12)])) * random.choice([1, -1])
        cases.append((n, d))
    df = spark.createDataFrame(cases, "n decimal(24,4), d decimal(24,4)")
    got = df.select("n", "d", safe_ratio(F.col("n"), F.col("d"), 4).alias("r"), percent(F.col("n"), F.col("d")).alias("p"))
    for r in got.collect():
        assert r["r"] == expected(r["n"], r["d"], 4), r
        exact = expected(r["n"], r["d"], 2, 100)
        assert r["p"] == (exact if exact is None or abs(exact) < Decimal(10) ** 18 else None), r


def test_only_dates_are_timestamps(spark):
    texts = ["2024-03-05T10:00:00Z", "2024-03-05", " 2024-03-05 10:00:00.5", "12:30", "T10:00:00", "20230", "x", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_iso_timestamp(F.col("t")).alias("ts"))
    assert [r["ts"] is not None for r in df.collect()] == [True, True, True, False, False, False, False, False]


def test_deviation_is_exact_and_does_not_depend_on_partitions(spark):
    import math
    import random
    from fractions import Fraction

    from orderlens.functions.numbers import deviation

    random.seed(4)
    groups = {0: [5], 1: [3, 3, 3], 2: [0, 1], 3: [10**13, -(10**13)], 4: [1, 2]}
    groups |= {g: [random.randrange(-(10**g), 10**g) for _ in range(200)] for g in range(5, 13)}
    rows = [(g, Decimal(u) / 10_000) for g, units in groups.items() for u in units] + [(9, None)]
    df = spark.createDataFrame(rows, "g int, v decimal(18,4)")

    def exact(units):
        n = len(units)
        if n < 2:
            return None
        variance = (sum(u * u for u in units) - Fraction(sum(units) ** 2, n)) / (n - 1)
        # The largest whole s with s - 1/2 <= root.
        return Decimal((math.isqrt(math.floor(4 * variance)) + 1) // 2) / 10_000

    for parts in (1, 7):
        got = df.repartition(parts).groupBy("g").agg(deviation("v").alias("d")).collect()
        assert {r["g"]: r["d"] for r in got} == {g: exact(units) for g, units in groups.items()}
