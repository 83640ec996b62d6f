"""One registered query per operator, each over its whole table, and expected SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    extract,
    language,
    lm_scores,
    near_dedup,
    periodic_runs,
    suffix_dedup,
    token_counts,
    topk,
    warc,
    whitening,
)
from tidemark.session import work_dir


def vocabulary_path() -> str:
    """The public byte-level vocabulary; its place is the only thing taken from that package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), vocabulary_path())


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(_table(spark, sf_dir, "pages"), work_dir(spark, "warc"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.score(_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(_table(spark, sf_dir, "documents"))


def op6_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_table(spark, sf_dir, "pages"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), vocabulary_path())


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(whitening.scaled(_table(spark, sf_dir, "embeddings")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), fold=True)


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.scaled(_table(spark, sf_dir, "embeddings"))
    return topk.search(rows, is_query=F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe_encode_decode,
        op2_warc,
        op3_language,
        op4_lm_scores,
        op5_suffix_dedup,
        op6_extract,
        op7_exact_dedup,
        op8_decontamination,
        op9_token_counts,
        op10_near_dedup,
        op11_whitening,
        op12_periodic_runs,
        op13_topk_search,
    )
}

EXPECTED: dict[str, str] = {
    "op2_warc": r"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
        f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first_id FROM d)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM f
    """,
    "op7_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
        g AS (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text) AS keep_id,
                     count(*) OVER (PARTITION BY text) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM g
    """,
    "op13_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        p AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM p QUALIFY rank <= 5
    """,
}
