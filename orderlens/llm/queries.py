"""One registered query per operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    decontaminate,
    language_spans,
    licenses,
    near_duplicates,
    packing,
    pii,
    quality_rules,
    sharding,
    token_alignment,
    token_counts,
    toxicity,
    vector_codes,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def public_tokenizer(name: str) -> Callable[[], str]:
    """The place of a public vocabulary file, looked up where it is opened."""

    def path() -> str:
        import public_tokenizers

        return public_tokenizers.path(name)

    return path


def op1_best_two_fit(spark: SparkSession, base: str) -> DataFrame:
    docs = _table(spark, base, "documents")
    return packing.pack_documents(docs, public_tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


def op2_template_decontamination(spark: SparkSession, base: str) -> DataFrame:
    return decontaminate.find_contaminated(_table(spark, base, "documents"), _table(spark, base, "benchmark"))


def op3_rank_merge_counts(spark: SparkSession, base: str) -> DataFrame:
    docs = _table(spark, base, "documents")
    return token_counts.count_tokens(docs, public_tokenizer("piece_bpe_32k.model"), limit=4096)


def op4_capture_index(spark: SparkSession, base: str) -> DataFrame:
    return warc.round_trip(_table(spark, base, "pages"), revisit_from=1000)


def op5_kd_tree_shards(spark: SparkSession, base: str) -> DataFrame:
    sharded = sharding.shard(_table(spark, base, "documents"), shards=24)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_subword_softmax(spark: SparkSession, base: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, base, "documents"), _table(spark, base, "labels"), 0.7)


def op7_fast_sketch(spark: SparkSession, base: str) -> DataFrame:
    docs = _table(spark, base, "documents")
    return near_duplicates.find_near_duplicates(docs, shingle_words=2, percent=80)


def op8_rare_token_licenses(spark: SparkSession, base: str) -> DataFrame:
    return licenses.scan(_table(spark, base, "documents"))


def op9_weak_supervision_pii(spark: SparkSession, base: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(_table(spark, base, "documents")))


def op10_quality_divergence(spark: SparkSession, base: str) -> DataFrame:
    return quality_rules.judge(_table(spark, base, "documents"))


def op11_integer_walsh_codes(spark: SparkSession, base: str) -> DataFrame:
    coded, books = vector_codes.compress(
        _table(spark, base, "embeddings"), parts=8, entries=16, rounds=6, scale=4096
    )
    return vector_codes.digest(coded, books)


def op12_viterbi_languages(spark: SparkSession, base: str) -> DataFrame:
    return language_spans.predict_languages(_table(spark, base, "documents"))


def op13_diagonal_alignment(spark: SparkSession, base: str) -> DataFrame:
    return token_alignment.align_corpus(
        _table(spark, base, "documents"),
        public_tokenizer("byte_bpe_50k.json"),
        public_tokenizer("piece_bpe_32k.model"),
        pieces=32_000,
    )


QUERIES: dict[str, Query] = {
    "op1_best_two_fit": op1_best_two_fit,
    "op2_template_decontamination": op2_template_decontamination,
    "op3_rank_merge_counts": op3_rank_merge_counts,
    "op4_capture_index": op4_capture_index,
    "op5_kd_tree_shards": op5_kd_tree_shards,
    "op6_subword_softmax": op6_subword_softmax,
    "op7_fast_sketch": op7_fast_sketch,
    "op8_rare_token_licenses": op8_rare_token_licenses,
    "op9_weak_supervision_pii": op9_weak_supervision_pii,
    "op10_quality_divergence": op10_quality_divergence,
    "op11_integer_walsh_codes": op11_integer_walsh_codes,
    "op12_viterbi_languages": op12_viterbi_languages,
    "op13_diagonal_alignment": op13_diagonal_alignment,
}


def _codes_sql(rounds: int) -> str:
    """The same codebooks by plain distances: a block of tables per round."""

    def assigned(name: str, book: str) -> str:
        gap = "list_sum([(t[1] - t[2]) * (t[1] - t[2]) FOR t IN list_zip(piece, entry)])"
        return f"""
        {name} AS MATERIALIZED (
            SELECT r, p, arg_min(e, gap * 16 + e) AS e, min(gap) AS gap, any_value(piece) AS piece
            FROM (SELECT r, p, piece, e, {gap}::BIGINT AS gap FROM pieces JOIN {book} USING (p))
            GROUP BY r, p
        )"""

    blocks = []
    for k in range(rounds):
        blocks.append(assigned(f"near{k}", f"book{k}"))
        blocks.append(f"""
        mean{k} AS (
            SELECT p, e, list(m ORDER BY place) AS entry FROM (
                SELECT p, e, place, ((sum(x)::HUGEINT - ((sum(x)::HUGEINT % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
                FROM (SELECT p, e, unnest(piece) AS x, unnest(range(len(piece))) AS place FROM near{k})
                GROUP BY p, e, place
            ) GROUP BY p, e
        ), book{k + 1} AS MATERIALIZED (
            SELECT p, e, coalesce(mean{k}.entry, book{k}.entry) AS entry FROM book{k} LEFT JOIN mean{k} USING (p, e)
        )""")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, label,
                   [floor(x::DOUBLE * 4096)::BIGINT FOR x IN embedding] AS whole
            FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), pieces AS MATERIALIZED (
            SELECT r, vec_id, p, whole[p * (len(whole) // 8) + 1 : (p + 1) * (len(whole) // 8)] AS piece
            FROM kept, (SELECT unnest(range(8)) AS p)
        ), first AS (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (SELECT DISTINCT vec_id FROM kept)
        ), book0 AS MATERIALIZED (
            SELECT p, e, min(piece) AS entry FROM pieces JOIN first USING (vec_id) WHERE e < 16 GROUP BY p, e
        ),{",".join([*blocks, assigned("final", f"book{rounds}")])}, coded AS (
            SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(gap)::BIGINT AS error
            FROM final GROUP BY r
        ), books AS (
            SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) AS hex FROM book{rounds}
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               hex AS codebooks_sha256
        FROM coded JOIN kept USING (r), books
    """


ORACLE: dict[str, str] = {
    "op4_capture_index": """
        WITH payload AS (
            SELECT page_id, coalesce(html, '') AS body FROM pages
        ), digest AS (
            SELECT page_id, octet_length(encode(body)) AS size, sha1(body) AS hex FROM payload
        ), newest AS (
            SELECT *, max(page_id) OVER (PARTITION BY hex) AS latest FROM digest
        )
        SELECT page_id,
               size::BIGINT AS payload_bytes,
               hex AS payload_digest,
               CASE WHEN size >= 1000 AND page_id <> latest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN size >= 1000 AND page_id <> latest THEN latest END AS refers_to
        FROM newest
    """,
    "op11_integer_walsh_codes": _codes_sql(rounds=6),
}
