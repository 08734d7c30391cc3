"""Folders whose content is replaced as a whole, in one step.

A folder holds versions, ``v-<time>-<random>``. A write makes a new one beside the others; it counts
from the moment its job commits, when Spark leaves the success marker in it. Readers take the newest
version that counts, so they see the old content until then, and a reader that has begun keeps what it
opened: the ``KEPT`` newest versions stay. Unfinished versions of failed writes are never read.
"""

from __future__ import annotations

import re
import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from orderlens.session import leaving_no_shuffle_files

KEPT = 2
# A quarter to a third smaller than Spark's default.
COMPRESSION = "zstd"
_VERSION = re.compile(r"v-\d{20}-[0-9a-f]{8}")


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, folder: str) -> bool:
    path, files = _file_system(spark, folder)
    return files.exists(path)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in ``folder``, sorted; nothing if it is absent. No data is read."""
    path, files = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def remove(spark: SparkSession, folder: str) -> None:
    path, files = _file_system(spark, folder)
    files.delete(path, True)


def _committed(spark: SparkSession, folder: str) -> list[str]:
    versions = [f"{folder}/{n}" for n in names_in(spark, folder) if _VERSION.fullmatch(n)]
    return [v for v in versions if exists(spark, f"{v}/_SUCCESS")]


def current(spark: SparkSession, folder: str) -> str | None:
    """The newest version that counts; ``folder`` itself if it was written without versions."""
    versions = _committed(spark, folder)
    if versions:
        return versions[-1]
    return folder if exists(spark, f"{folder}/_SUCCESS") else None


def replace(df: DataFrame, folder: str) -> str:
    """Write ``df`` as the new content of ``folder``; returns the version's own folder."""
    spark = df.sparkSession
    version = f"{folder}/v-{time.time_ns():020d}-{uuid4().hex[:8]}"
    with leaving_no_shuffle_files(spark):
        df.write.parquet(version, compression=COMPRESSION)
    for old in _committed(spark, folder)[:-KEPT]:
        remove(spark, old)
    return version
