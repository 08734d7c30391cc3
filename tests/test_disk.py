"""Steps must not leave on the disks what later steps no longer need."""

import os
import re
import time
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.config import Config
from orderlens.operators.tables import conform
from orderlens.plans import changes, pipeline, silver
from orderlens.schemas import DATE_DIM, ORDER_ITEM_OPTIONS, ORDER_ITEMS
from orderlens.session import leaving_no_shuffle_files, reliable
from orderlens.sources import files
from registry import queries
from registry.queries import Frames

from conftest import rows

BASE = "/root/testdata/sf0.001"
CFG = Config("T", calendar_start=date(2023, 1, 1), calendar_end=date(2023, 12, 31))


@pytest.fixture(scope="module")
def frames(spark):
    return Frames(spark, BASE)


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [str(f) for f in manager.localDirs()]
    return {x for folder in folders for _, _, names in os.walk(folder) for x in names if x.startswith("shuffle_")}


def left_behind(spark, before):
    """Shuffle files that are new and still there; they are removed in the background."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def moves_of(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def sources(spark):
    made = [("o1", "a", 5), ("o1", "a", 7), ("o1", None, 2), (None, "a", 3), (None, None, 4), ("o2", "b", 1)]
    columns = "app_name string, order_id string, lineitem_id string, item_quantity int, creation_time_utc string, item_price decimal(18,4)"
    items = [("Store", o, i, n, f"2023-{n:02d}-03T10:00:00Z", Decimal(n)) for o, i, n in made]
    items += [("T", "o3", "a", 1, "2023-01-03T10:00:00Z", Decimal(1)), ("Store", "o4", "a", 1, "soon", None)]
    options = [("o1", "a", "g", "x", Decimal("1.5"), 2)] * 2 + [("o1", "a", "g", "y", None, 1), (None, "a", "g", "x", Decimal(9), 1)]
    return {
        "order_items": conform(spark.createDataFrame(items, columns), ORDER_ITEMS),
        "order_item_options": spark.createDataFrame(options, ORDER_ITEM_OPTIONS),
        "date_dim": conform(spark.createDataFrame([("03-05-2023", True, "Day")], "date_key string, is_holiday boolean, holiday_name string"), DATE_DIM),
    }


def test_steps_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    counts = spark.range(100).groupBy((F.col("id") % 7).alias("year")).count()
    months = counts.withColumn("month", F.lit(1))
    counts.repartition(3, "count").write.parquet(str(tmp_path / "plain"))
    assert shuffle_files(spark) - before
    before = shuffle_files(spark)
    files.store(counts, str(tmp_path / "stored"))
    files.store_by_month(months, str(tmp_path / "by_month"))
    files.write_gold(counts, str(tmp_path), "gold")
    stored = reliable(counts)
    day = sources(spark)
    assert changes.touched_months(day, day) == []
    assert left_behind(spark, before) == set()
    assert rows(stored) == rows(counts)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    with pytest.raises(ValueError), leaving_no_shuffle_files(spark):
        raise ValueError
    assert spark.conf.get(key) == was


def test_silver_leaves_neither_shuffle_files_nor_stored_lines(spark, tmp_path, monkeypatch):
    day, kept = sources(spark), tmp_path / "kept"
    monkeypatch.setattr(pipeline, "scratch_folder", lambda spark: str(kept))
    for table, df in day.items():
        files.write_bronze(df, str(tmp_path / "bronze"), table, date(2024, 1, 1))
    before = shuffle_files(spark)
    done = pipeline.build_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), CFG)
    assert done["rows"] == 7 and not kept.exists()
    assert left_behind(spark, before) == set()
    plain = silver.orders_enriched(*day.values(), CFG)
    assert rows(files.read_silver(spark, str(tmp_path / "silver")), *plain.columns) == rows(plain)


def test_lines_to_be_written_meet_options_by_order_and_are_stored(spark, monkeypatch):
    stored = []
    store = silver.store
    monkeypatch.setattr(silver, "store", lambda df, folder: stored.append(moves_of(df)) or store(df, folder))
    written = Frames(spark, BASE).silver_by_month
    # Lines, their orders and options move by order once each, and nothing by order line.
    (moves,) = stored
    assert sum(m.startswith("order_id") for m in moves) == 3 and not any("lineitem_id" in m for m in moves)
    assert "lineitem.parquet" not in written._jdf.queryExecution().toString()


def test_baskets_are_folded_where_their_lines_lie(frames, monkeypatch):
    stored = []
    store = files.store
    monkeypatch.setattr(queries.files, "store", lambda df, folder: stored.append(moves_of(df)) or store(df, folder))
    baskets = Frames(frames.spark, BASE).baskets_table
    (moves,) = stored
    assert sum(m.startswith("order_id") for m in moves) == 3 and not any("lineitem_id" in m for m in moves)
    assert rows(baskets) == rows(frames.discounts, *baskets.columns)


def test_lines_move_to_their_orders_with_their_price_only(frames):
    utils = frames.spark.sparkContext._jvm.PythonSQLUtils
    text = utils.explainString(frames.items._jdf.queryExecution(), "formatted")
    moved = [x for x in re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(order_id", text) if "p_type" in x]
    assert len(moved) == 1 and "item_price" in moved[0]
    assert "discount" not in moved[0] and "p_partkey" not in moved[0] and " price" not in moved[0]
