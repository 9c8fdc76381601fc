"""The registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versica.llm import exact_dedup, html_extract, line_dedup, media, mixing, packing, secret_scan, simhash, toxicity, warc
from versica.llm.common import documents, new_path, scratch, stored


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.component_ids(documents(spark, sf_dir))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"), F.col("_nearest").alias("nearest"))


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.encode(documents(spark, sf_dir)))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents go into an empty index in two batches; the index is dropped when the rows are written."""
    path = new_path(spark, "exact_dedup")
    with scratch(spark):
        index = exact_dedup.DigestIndex(spark, f"versica_digests_{uuid.uuid4().hex}")
        try:
            return stored(index.add(documents(spark, sf_dir).select("doc_id", "text"), batches=2), "exact_dedup", path)
        finally:
            index.drop()


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(documents(spark, sf_dir).select("doc_id", "text", "source"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_toxicity, op3_media, op4_line_dedup, op5_packing, op6_secret_scan, op7_exact_dedup, op8_html_extract, op9_warc, op10_mixing)}

ORACLE = {
    "op4_line_dedup": r"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeats AS (SELECT k, max(doc_id) AS keep_doc FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
decided AS (SELECT doc_id, i, line, keep_doc IS NOT NULL AND keep_doc <> doc_id AS gone FROM keyed LEFT JOIN repeats USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM decided GROUP BY doc_id""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op10_mixing": mixing.ORACLE,
}
