"""Incremental ingestion: new files become works once, whatever arrives again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream(spark: SparkSession, path: str, schema: str, files_a_batch: int = 100, fmt: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_a_batch).load(path)


def unique_works(works: DataFrame, uid: str = "uid", at: str = "ts", delay: str = "1 day") -> DataFrame:
    """The first row of each uid; state is kept for as long as repeats may come late."""
    return works.withWatermark(at, delay).dropDuplicatesWithinWatermark([uid])


def windowed_counts(events: DataFrame, at: str, by: str, delay: str = "10 minutes", length: str = "1 hour") -> DataFrame:
    return events.withWatermark(at, delay).groupBy(F.window(at, length), by).agg(F.count("*").alias("n"))


def replay(batches: DataFrame, path: str, checkpoint: str, by: list[str], key: str, order: str | None = None) -> StreamingQuery:
    """Every batch upserts its rows into a partitioned table; only partitions that it touches are rewritten: those of its rows, and
    those that held its keys before. Of a batch's rows of one key the last by `order` counts (then by all columns, so a batch that
    is run again gives the same)."""

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        row = F.struct(*([F.col(order).alias("_order")] if order else []), *batch.columns)
        batch = batch.groupBy(key).agg(F.max(row).alias("_row")).select(*[F.col(f"_row.{c}").alias(c) for c in batch.columns]).persist()
        try:
            before = spark.read.schema(batch.schema).parquet(path)
            moved = before.join(batch.select(key), key, "left_semi").select(*by)
            touched = batch.select(*by).unionByName(moved).distinct().persist()
            kept = before.join(touched, by, "left_semi").join(batch.select(key), key, "left_anti")
            merged = kept.select(*batch.columns).unionByName(batch)
            emptied = touched.join(merged.select(*by).distinct(), by, "left_anti").collect()  # partition values
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            merged, emptied = batch, []
        staged = f"{checkpoint}/staged/{number}"
        merged.write.mode("overwrite").parquet(staged)  # a table can't be overwritten while it is read
        spark.read.schema(batch.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
        for r in emptied:  # a partition whose last row has moved away is not overwritten by the others
            gone = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *(f"{c}={r[c]}" for c in by)]))
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
        batch.unpersist()

    return batches.writeStream.foreachBatch(upsert).option("checkpointLocation", f"{checkpoint}/log").trigger(availableNow=True).start()
