from dataclasses import replace
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlens.config import Config
from orderlens.plans import pipeline
from orderlens.operators.tables import conform
from orderlens.schemas import GOLD, ORDER_ITEM_OPTIONS, ORDER_ITEMS, SOURCES
from orderlens.sources import files, jdbc, versions

from conftest import rows


def write_text(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


OPTIONS_CSV = """LINEITEM_ID,Order_ID,option_price,option_quantity,option_name
l1,o1,1.5,2,"ketchup, hot"
l2,007,,x,
"""


def test_csv_binds_by_name_whatever_the_order_and_case(spark, tmp_path):
    write_text(tmp_path / "order_item_options.csv", OPTIONS_CSV)
    raw = files.read_csv(spark, str(tmp_path), "order_item_options")
    assert raw.columns == ["lineitem_id", "order_id", "option_price", "option_quantity", "option_name"]
    typed = files.read_typed_csv(spark, str(tmp_path), "order_item_options")
    assert typed.schema == ORDER_ITEM_OPTIONS
    assert rows(typed) == [
        ("007", "l2", None, None, None, None),
        ("o1", "l1", None, "ketchup, hot", Decimal("1.5000"), 2),
    ]


def test_bronze_days_are_replaced_one_by_one_and_the_newest_is_read(spark, tmp_path):
    base = str(tmp_path)
    old = spark.range(3).withColumn("only_old", F.lit(1))
    files.write_bronze(old, base, "t", date(2024, 1, 9))
    assert files.write_bronze(spark.range(5), base, "t", date(2024, 1, 10)) == 5
    assert files.write_bronze(spark.range(2), base, "t", date(2024, 1, 10)) == 2
    assert files.latest_partition(spark, f"{base}/t") == "2024-01-10"
    assert rows(files.read_latest_bronze(spark, base, "t")) == [(0,), (1,)]
    assert files.write_bronze(spark.range(0), base, "t", date(2024, 1, 10)) == 0
    assert files.read_latest_bronze(spark, base, "t").count() == 0
    first_day = files.read_bronze_day(spark, base, "t", date(2024, 1, 9))
    assert first_day.count() == 3
    with pytest.raises(ValueError, match="no complete ingestion_date partition"):
        files.read_latest_bronze(spark, base, "absent")


def silver_rows(spark, months):
    return spark.createDataFrame(
        [(2024, m, Decimal(m), m > 1, 0) for m in months],
        "year int, month int, gross_revenue decimal(18,4), is_bulk_order_candidate boolean,"
        " option_row_count int",
    )


def test_silver_rebuild_drops_vanished_months_and_incremental_keeps_them(spark, tmp_path):
    base = str(tmp_path)
    seen = files.write_silver(silver_rows(spark, [1, 2, 3]), base)
    assert (seen["rows"], seen["total_revenue"], seen["bulk_rows"]) == (3, 6, 2)
    files.write_silver(silver_rows(spark, [2]), base, incremental=True)
    assert rows(files.read_silver(spark, base), "month") == [(1,), (2,), (3,)]
    files.write_silver(silver_rows(spark, [2]), base)
    assert rows(files.read_silver(spark, base), "month") == [(2,)]


def test_gold_round_trip_and_absent_table(spark, tmp_path):
    df = spark.createDataFrame([("u", date(2024, 1, 1))], "user_id string, snapshot_date date")
    assert files.write_gold(df, str(tmp_path), "t") == 1
    assert files.write_gold(df, str(tmp_path), "t") == 1
    assert rows(files.read_gold(spark, str(tmp_path), "t")) == rows(df)
    assert files.read_gold(spark, str(tmp_path), "absent", df.schema).count() == 0


ITEMS_CSV = """app_name,restaurant_id,creation_time_utc,order_id,user_id,printed_card_number,is_loyalty,currency,lineitem_id,item_category,item_name,item_price,item_quantity
Store,R1,2023-05-01T10:00:00.000Z,o1,u1,4111,true,USD,l1,Salads1,Greek,10.5,2
Store,R2,2023-05-02T10:00:00Z,o2,u2,,false,USD,l2,Salads,Greek,0.0,1
T,R2,2023-05-03T10:00:00Z,o3,u2,,false,USD,l3,Salads,Greek,9.0,1
"""
DATES_CSV = """date_key,day_of_week,week,month,year,is_weekend,is_holiday,holiday_name
01-05-2023,Monday,18,May,2023,false,true,May Day
"""


def test_whole_pipeline_from_csv(spark, tmp_path):
    source = tmp_path / "source"
    write_text(source / "order_items.csv", ITEMS_CSV)
    write_text(
        source / "order_item_options.csv",
        "order_id,lineitem_id,option_group_name,option_name,option_price,option_quantity\n"
        "o1,l1,g,n,1.0,1\no1,l1,g,n,1.0,1\n",
    )
    write_text(source / "date_dim.csv", DATES_CSV)
    places = [str(tmp_path / layer) for layer in ("bronze", "silver", "gold")]
    done = pipeline.run(
        spark, *places, Config(test_app_name="T"), "csv", date(2024, 1, 1), csv_base=str(source)
    )
    assert done["bronze"] == {"order_items": 3, "order_item_options": 2, "date_dim": 1}
    assert done["silver"]["rows"] == 2
    assert set(done["gold"]) == set(GOLD)
    for table, columns in GOLD.items():
        assert files.read_gold(spark, places[2], table).columns == columns
    clv = files.read_gold(spark, places[2], "customer_clv_daily")
    assert rows(clv, "user_id", "total_revenue_to_date") == [
        ("u1", Decimal("22.00")), ("u2", Decimal("0.00")),
    ]
    trends = files.read_gold(spark, places[2], "sales_trends")
    assert rows(trends, "order_date", "holiday_name", "item_category") == [
        (date(2023, 5, 1), "May Day", "Salads"), (date(2023, 5, 2), None, "Salads"),
    ]


def test_unknown_source_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        pipeline.read_source(spark, "xml", "order_items", csv_base="x")


@pytest.mark.parametrize(
    "sql", ["select 1", "SELECT created_at, updated FROM t", " select * from t ; "]
)
def test_read_only_queries_pass(sql):
    assert jdbc.check_read_only(sql).lower().startswith("select")


@pytest.mark.parametrize(
    "sql",
    ["", "selected", "UPDATE t SET a=1", "WITH x AS (SELECT 1) SELECT 1", "SELECT 1; SELECT 2",
     *[f"SELECT 1 {w.lower()} t" for w in jdbc.WRITE_WORDS]],
)
def test_other_statements_are_refused(sql):
    with pytest.raises(ValueError):
        jdbc.check_read_only(sql)


def test_guarded_spark_sql(spark):
    assert jdbc.run_select(spark, "SELECT 1 AS x").first()["x"] == 1
    assert "tableName" in jdbc.list_tables(spark).columns


def test_identifiers_and_table_map():
    assert jdbc.table_map("a, b = dbo.b ,") == {"a": "a", "b": "dbo.b"}
    for bad in ("1a", "a b", "a;drop", "a.b c", ""):
        with pytest.raises(ValueError):
            jdbc.check_table(bad)


def test_jdbc_options():
    connection = jdbc.Connection("jdbc:x", "me", "secret", "a.Driver")
    assert "secret" not in repr(connection)
    split = jdbc.Split("id", "0", "1000", 16)
    read = jdbc.read_options(connection, "dbo.order_items", split)
    assert (read["dbtable"], read["numPartitions"], read["partitionColumn"]) == (
        "dbo.order_items", "16", "id",
    )
    assert "numPartitions" not in jdbc.read_options(connection, "t", None)
    write = jdbc.write_options(connection, "order_items", "dbo", 4)
    assert (write["dbtable"], write["truncate"], write["numPartitions"]) == (
        "dbo.order_items", "true", "4",
    )
    with pytest.raises(ValueError):
        jdbc.write_options(connection, "x; drop table y", "dbo", 4)


@pytest.mark.parametrize("table", ["order_items", "order_item_options"])
def test_growing_tables_are_not_read_by_a_single_task(spark, table):
    connection = jdbc.Connection("jdbc:x", "me", "secret", "a.Driver")
    with pytest.raises(ValueError, match="needs a split"):
        pipeline.read_source(spark, "jdbc", table, connection=connection)


def test_schema_has_the_loader_columns():
    assert len(ORDER_ITEMS) == 13 and len(ORDER_ITEM_OPTIONS) == 6


def bronze_day(spark, base, day, items, options, holidays):
    item = "app_name string, creation_time_utc string, order_id string, lineitem_id string, item_price decimal(18,4), item_quantity int"
    option = "order_id string, lineitem_id string, option_name string, option_price decimal(18,4), option_quantity int"
    calendar = "date_key string, is_holiday boolean, holiday_name string"
    tables = {
        "order_items": spark.createDataFrame([("Store", t, o, "l", Decimal(p), 1) for o, t, p in items], item),
        "order_item_options": spark.createDataFrame([(o, "l", n, Decimal(p), 1) for o, n, p in options], option),
        "date_dim": spark.createDataFrame([(d, True, n) for d, n in holidays], calendar),
    }
    for name, df in tables.items():
        files.write_bronze(conform(df, SOURCES[name]), base, name, day)


def part_files(base):
    return {str(p.relative_to(base)) for p in Path(base).rglob("part-*.parquet")}


def test_only_touched_months_are_made_again_and_equal_a_full_rebuild(spark, tmp_path):
    bronze, silver, whole = (str(tmp_path / n) for n in ("bronze", "silver", "whole"))
    cfg = Config(test_app_name="T", calendar_start=date(2023, 1, 1), calendar_end=date(2023, 12, 31))
    items = [(f"o{m}", f"2023-{m:02d}-05T10:00:00Z", m) for m in range(1, 9)] + [("bad", "no time", 3)]
    options = [("o2", "a", 1), ("o2", "a", 1), ("o3", "b", 2)]
    bronze_day(spark, bronze, date(2024, 1, 1), items, options, [("05-08-2023", "Day")])
    first = pipeline.build_silver(spark, bronze, silver, cfg, incremental=True)
    assert first["rows"] == 9 and "months" not in first
    before = part_files(silver)

    # Of the next day: o1 moves to September, o4 goes, o5 costs more, o3 gets a late option, o2 loses a
    # copy of an option, the unreadable one goes, November is new, and the name of a holiday changes.
    items = [("o1", "2023-09-01T00:00:00Z", 1), ("o5", "2023-05-05T10:00:00Z", 50), ("o11", "2023-11-30T23:00:00Z", 7)]
    items += [(f"o{m}", f"2023-{m:02d}-05T10:00:00Z", m) for m in (2, 3, 6, 7, 8)]
    options = [("o3", "late", 4), ("o3", "b", 2), ("o2", "a", 1)]
    bronze_day(spark, bronze, date(2024, 1, 2), items, options, [("05-08-2023", "Feast")])
    done = pipeline.build_silver(spark, bronze, silver, cfg, incremental=True)
    assert done["months"] == 9  # all but June and July, with September, November and the null month
    pipeline.build_silver(spark, bronze, whole, cfg)
    assert rows(files.read_silver(spark, silver)) == rows(files.read_silver(spark, whole))
    assert files.read_silver(spark, silver).where("holiday_name = 'Feast'").count() == 1
    kept = before & part_files(silver)
    assert {p.split("month=")[1].split("/")[0] for p in kept if "month=" in p} == {"6", "7"}

    # Nothing new: nothing is made. Other parameters: everything is.
    now = part_files(f"{silver}/orders_enriched")
    assert pipeline.build_silver(spark, bronze, silver, cfg, incremental=True)["months"] == 0
    assert part_files(f"{silver}/orders_enriched") == now
    other = replace(cfg, bulk_quantity=1)
    assert pipeline.build_silver(spark, bronze, silver, other, incremental=True)["bulk_rows"] == 8


def test_a_reader_sees_the_old_content_until_a_write_ends(spark, tmp_path):
    base, day = str(tmp_path), date(2024, 1, 1)
    files.write_bronze(spark.range(3), base, "t", day)
    begun = files.read_latest_bronze(spark, base, "t")

    def look_and_fail(batches):
        raise RuntimeError("the source broke off")
        yield from batches

    broken = spark.range(9).mapInArrow(look_and_fail, "id long")
    with pytest.raises(Exception, match="broke off"):
        files.write_bronze(broken, base, "t", day)
    # The failed write has left a version that does not count.
    assert files.read_latest_bronze(spark, base, "t").count() == 3
    files.write_bronze(spark.range(5), base, "t", day)
    assert begun.count() == 3 and files.read_latest_bronze(spark, base, "t").count() == 5
    for n in (6, 7):
        files.write_bronze(spark.range(n), base, "t", day)
    assert files.read_latest_bronze(spark, base, "t").count() == 7
    counted = [p for p in (tmp_path / "t" / "ingestion_date=2024-01-01").iterdir() if (p / "_SUCCESS").exists()]
    assert len(counted) == versions.KEPT
    assert files.read_bronze_day(spark, base, "t", day).columns == ["id", "ingestion_date"]
    with pytest.raises(ValueError, match="no complete day"):
        files.read_bronze_day(spark, base, "t", date(2024, 1, 2))


def test_tables_written_without_versions_are_still_read(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/t")
    assert files.read_gold(spark, str(tmp_path), "t").count() == 4
    files.write_gold(spark.range(2), str(tmp_path), "t")
    assert files.read_gold(spark, str(tmp_path), "t").count() == 2


def test_incomplete_and_oddly_named_days_are_passed_over(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "n int")
    files.write_bronze(df, str(tmp_path), "t", date(2024, 1, 1))
    (tmp_path / "t" / "ingestion_date=2024-02-02").mkdir()
    (tmp_path / "t" / "ingestion_date=__HIVE_DEFAULT_PARTITION__").mkdir()
    assert files.latest_partition(spark, f"{tmp_path}/t") == "2024-01-01"
