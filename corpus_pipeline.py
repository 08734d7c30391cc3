"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again
as the next one's ``docs``. All but the last return the columns of ``documents``:

1. quality: documents that the quality rules reject go;
2. near_duplicates: one document of every group of near-duplicates stays (five-word shingles,
   similarity 0.8 or more);
3. decontaminate: documents that contain a benchmark item, verbatim or re-parameterised, go;
4. personal_data: spans of personal data are replaced by their kind, and ``n_chars`` follows;
5. pack: one row per piece, with its sequence and its offset there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import decontaminate, near_duplicates, packing, pii, quality_rules
from orderlens.llm.queries import public_tokenizer
from orderlens.session import scratch_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.keep_one_each(docs, shingle_words=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_contaminated(docs, benchmark)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("personal_data", personal_data_stage),
    ("pack", packing_stage),
]

# Sketches, learned weights and a tokenizer cannot be expressed in SQL; the tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = f"{scratch_folder(spark)}/{name}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
