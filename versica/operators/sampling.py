"""Reproducible samples and shards. Order is by a hash of the key, so a sample does not depend on partitions or on other rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def hash_order(key: str, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))


def stratified(rows: DataFrame, by: list[str], n: int, key: str, seed: str, rich: Column | None = None) -> DataFrame:
    """n rows of each stratum, rich ones first. Spark cuts groups before the shuffle (WindowGroupLimit), so a huge stratum sends n rows a task."""
    order = ([F.desc(rich)] if rich is not None else []) + [hash_order(key, seed), F.col(key)]
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def top(rows: DataFrame, score: str, key: str, n: int) -> DataFrame:
    return rows.where(F.col(score) > 0).orderBy(F.desc(score), key).limit(n)


def sample(rows: DataFrame, by: list[str], n: int, top_n: int, key: str, score: str, must: Column, seed: str = "sample", rich: Column | None = None) -> DataFrame:
    """Stratified rows, the top ones and those that must be in; each once."""
    ids = stratified(rows, by, n, key, seed, rich).select(key).unionByName(top(rows, score, key, top_n).select(key)).unionByName(rows.where(must).select(key)).distinct()
    return rows.join(ids, key, "left_semi")


def closure(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Only parents that rows refer to."""
    return parents.join(rows.select(key).distinct(), key, "left_semi")


def sharded(rows: DataFrame, by: list[str], key: str, size: int) -> DataFrame:
    """rows with shard: `size` rows each, in key order, in each group of by."""
    return rows.withColumn("shard", F.floor((F.row_number().over(W.partitionBy(*by).orderBy(key)) - 1) / size).cast("long"))


def manifest(shards: DataFrame, by: list[str], key: str, line: Column) -> DataFrame:
    """A row for each shard: n, first and last key, a digest of its lines in order."""
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), line.alias("v")))), lambda x: x["v"]), "\n")
    return shards.groupBy(*by, "shard").agg(F.count("*").alias("n"), F.min(key).alias("first_id"), F.max(key).alias("last_id"), F.sha2(lines, 256).alias("sha256"))
