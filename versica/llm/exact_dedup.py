"""Exact dedup against a persistent digest index, with DataFrame operations only.

The index is a table bucketed and sorted by SHA-256 digest, in the cluster's shared folder. A batch of documents is digested
once, grouped by digest (partial aggregation takes copies together before any shuffle) and sort-merge anti-joined with the
index; what is new is appended. Digests that the index has already go, as counts, to a second table with the same buckets. A
later batch thus never reads old texts, only digests in their buckets.

Defined cases: a null text counts as empty; empty texts are equal to each other; of equal texts the largest doc_id over all
batches stays, so a later batch may supersede what an earlier one kept; a null doc_id is smaller than any other; repeated rows
(same doc_id and text) all come out, with the same values, and all count in group_size; very long texts are digested whole; an
empty batch gives no rows; extra columns are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versica.llm.common import delete, id_text, new_path, stored

#: A digest is hot if more than 1 / HOT of the rows asked for have it; so there are fewer than HOT hot digests, whatever the input.
HOT = 2000


class DigestIndex:
    """Two bucketed, sorted tables (digest binary, keep_id long, group_size long): of new digests, and of counts of those seen before."""

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None, folder: str | None = None):
        self.spark, self.table, self.counts = spark, table, f"{table}_counts"
        self.buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.folder = folder or new_path(spark, table)
        if not spark.catalog.tableExists(table):
            none = spark.range(0).selectExpr("CAST(NULL AS binary) AS digest", "id AS keep_id", "id AS group_size")
            self._append(none, self.table)
            self._append(none, self.counts)

    def _append(self, groups: DataFrame, table: str) -> None:
        groups.write.mode("append").format("parquet").option("path", f"{self.folder}/{table}").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def drop(self) -> None:
        for table in (self.table, self.counts):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete(self.spark, self.folder)

    def fresh(self, groups: DataFrame) -> DataFrame:
        """Groups whose digest the index does not have."""
        return groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, docs: DataFrame, batches: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Deduplicate docs against themselves and the index, in so many batches one after another, and return rows() of them."""
        digests = stored(id_text(docs, id_col, text_col).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest")), "digests")
        for k in range(batches):
            batch = digests.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == k) if batches > 1 else digests
            groups = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            self._append(groups.join(self.read().select("digest").hint("merge"), "digest", "left_semi"), self.counts)
            self._append(self.fresh(groups), self.table)
        return self.rows(digests)

    def rows(self, digests: DataFrame) -> DataFrame:
        """A row for each of digests(doc_id, digest): doc_id, keep_id (largest doc_id of the text over all batches), group_size (rows of
        the text in all batches), kept, text_sha256."""
        more = self.spark.table(self.counts).groupBy("digest").agg(F.max("keep_id").alias("later"), F.sum("group_size").alias("more"))
        index = self.read().join(more.hint("merge"), "digest", "left").select("digest", F.greatest("keep_id", "later").alias("keep_id"), (F.col("group_size") + F.coalesce("more", F.lit(0))).alias("group_size"))
        # Rows of hot digests meet their group in a broadcast of fewer than HOT rows; the others in a merge join with the sorted buckets.
        total = digests.count()
        often = digests.groupBy("digest").count().where(F.col("count") * HOT > total).select("digest")
        hot = F.broadcast(stored(index.join(F.broadcast(often), "digest"), "hot"))
        calm = digests.join(hot.select("digest"), "digest", "left_anti").join(index.hint("merge"), "digest")
        out = calm.unionByName(digests.join(hot, "digest"))
        return out.select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
