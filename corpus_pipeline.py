"""A corpus in five stages: toxic documents go, repeated lines go, near duplicates go, sources are mixed, sequences are packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet in the shared folder and reads
it again for the next. All but the last return the columns of documents. Before a stage, executors and driver give back the memory that
the one before has left; before the mixture is written, also what its plan has left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versica.llm import line_dedup, mixing, packing, simhash, toxicity
from versica.llm.common import documents, give_back, new_path, same_columns, scratch, stored
from versica.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    give_back(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model)
    return scored.where(F.col(scored.columns[-2]) == 0).select(*same_columns(docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars follows the text where lines went."""
    give_back(spark)
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        changed = F.when(F.col(out.columns[-1]) > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out.select(*same_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    give_back(spark)
    return simhash.keep_one(docs, similarity=0.8, shingle=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source once at least, and none more than twice as often as another."""
    give_back(spark)
    mixed = mixing.mix(docs, repeats=2.0)
    give_back(spark)
    return mixed


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    give_back(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("near dedup", drop_near_duplicates), ("mixing", mix_sources), ("packing", pack)]

#: Nearest neighbours, fingerprints and a tokenizer are beyond SQL. The tests hold each stage's operator against brute force; run() itself only against its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "_"))
        with scratch(spark):  # what a stage writes for itself goes when its result is written
            docs = stored(stage(spark, docs, sf_dir), name, path)
    return STAGES[-1][1](spark, docs, sf_dir)
