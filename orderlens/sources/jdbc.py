"""Relational sources and sinks, and the read-only query utility."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators.tables import lower_columns

# Words a read-only query must not contain.
WRITE_WORDS = (
    "INSERT", "UPDATE", "DELETE", "MERGE", "DROP", "TRUNCATE", "ALTER", "CREATE", "EXEC",
    "EXECUTE",
)

# Fixed value: the default query of the utility.
LIST_TABLES = (
    "SELECT TABLE_SCHEMA, TABLE_NAME FROM INFORMATION_SCHEMA.TABLES "
    "WHERE TABLE_TYPE = 'BASE TABLE'"
)

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


@dataclass(frozen=True)
class Connection:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
        }


@dataclass(frozen=True)
class Split:
    """How a table is read in parallel: stride over a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": check_identifier(self.column),
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }


def check_identifier(name: str) -> str:
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain SQL identifier: {name!r}")
    return name


def check_table(name: str) -> str:
    """A table name, optionally with its schema."""
    for part in name.split("."):
        check_identifier(part)
    return name


def table_map(spec: str) -> dict[str, str]:
    """``"a, b=dbo.b"`` -> ``{"a": "a", "b": "dbo.b"}``: logical to physical names."""
    names = {}
    for entry in filter(None, (e.strip() for e in spec.split(","))):
        logical, _, physical = (p.strip() for p in entry.partition("="))
        names[logical] = check_table(physical or logical)
    return names


def check_read_only(sql: str) -> str:
    """A single SELECT without any write word; words inside longer names are fine."""
    text = sql.strip().rstrip(";").strip()
    if not re.match(r"(?i)select\b", text):
        raise ValueError("only SELECT queries are allowed")
    found = re.search(rf"(?i)\b({'|'.join(WRITE_WORDS)})\b", text)
    if found:
        raise ValueError(f"write keyword in a read-only query: {found.group(1).upper()}")
    if ";" in text:
        raise ValueError("only one statement is allowed")
    return text


def read_options(connection: Connection, table: str, split: Split | None) -> dict[str, str]:
    options = {**connection.options(), "dbtable": check_table(table)}
    return {**options, **split.options()} if split else options


def read_jdbc(
    spark: SparkSession, connection: Connection, table: str, split: Split | None = None
) -> DataFrame:
    """A whole table. Give a ``split`` for anything large: without one it is a single task."""
    options = read_options(connection, table, split)
    return lower_columns(spark.read.format("jdbc").options(**options).load())


def jdbc_query(spark: SparkSession, connection: Connection, sql: str = LIST_TABLES) -> DataFrame:
    """The result of a read-only query that the database runs."""
    options = {**connection.options(), "query": check_read_only(sql)}
    return spark.read.format("jdbc").options(**options).load()


def write_options(
    connection: Connection, table: str, schema: str | None, writers: int
) -> dict[str, str]:
    name = check_identifier(table)
    return {
        **connection.options(),
        "dbtable": f"{check_identifier(schema)}.{name}" if schema else name,
        "truncate": "true",
        "batchsize": "10000",
        "numPartitions": str(writers),
    }


def write_jdbc(
    df: DataFrame,
    connection: Connection,
    table: str,
    schema: str | None = "dbo",
    writers: int = 8,
) -> None:
    """Replace a table's rows over at most ``writers`` connections."""
    options = write_options(connection, table, schema, writers)
    df.write.format("jdbc").options(**options).mode("overwrite").save()


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables of the current Spark catalog database."""
    return spark.sql("SHOW TABLES")


def run_select(spark: SparkSession, sql: str) -> DataFrame:
    """The same guarded query on Spark's own tables."""
    return spark.sql(check_read_only(sql))
