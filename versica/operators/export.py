"""Sinks: tables, sharded bundles with manifest and indexes, partial rewrites, checked round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versica.operators.sampling import manifest, sharded


def table(rows: DataFrame, path: str, by: list[str] | None = None, only: bool = False) -> None:
    """rows as Parquet; only=True rewrites just the partitions that rows have."""
    writer = rows.write.mode("overwrite").option("compression", "zstd")
    if only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def bundle(works: DataFrame, path: str, by: list[str], key: str = "id", size: int = 2000) -> DataFrame:
    """works as gzip JSON lines in shards of size rows, a manifest beside them, which is returned."""
    line = F.to_json(F.struct(*works.columns))
    shards = sharded(works, by, key, size)
    shards.select(*by, "shard", line.alias("value")).repartition(*by, "shard").sortWithinPartitions(*by, "shard", "value").write.mode("overwrite").partitionBy(*by, "shard").option("compression", "gzip").text(f"{path}/data")
    listed = manifest(shards, by, key, line)
    listed.write.mode("overwrite").json(f"{path}/manifest")
    return listed


def scores(rows: DataFrame, path: str, key: str = "uid") -> None:
    rows.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("overwrite").json(path)


def read_back_faults(rows: DataFrame, path: str) -> int:
    """How many rows differ between what was to be written and what is read again."""
    again = rows.sparkSession.read.schema(rows.schema).json(path)
    return rows.exceptAll(again).unionByName(again.exceptAll(rows)).count()


def flattened(nested: DataFrame, column: str, value: str = "map<string, int>") -> DataFrame:
    """key, score of a JSON object of scores; those out of range raise."""
    each = nested.select(F.explode(F.from_json(column, value)).alias("key", "score"))
    return each.withColumn("score", F.when(F.col("score").between(1, 100), F.col("score")).otherwise(F.raise_error(F.concat(F.lit("score out of range: "), F.coalesce(F.col("score").cast("string"), F.lit("null")))).cast("int")))


def fold_exceptions(rows: DataFrame, text: str, folded: str) -> DataFrame:
    return rows.where(F.char_length(text) != F.char_length(folded))
