"""Popularity of works and authors: snapshots, composites, shrunken means, ranks, tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from versica.functions import score
from versica.functions.ids import dynasty_of

# The five tiers and their scores, and scores that earlier rubrics wrote.
TIERS = {
    1: (100, "屈原 李白 杜甫 苏轼".split()),
    2: (98, "陶渊明 曹植 白居易 李商隐 辛弃疾 李清照 毛泽东".split()),
    3: (96, "王维 杜牧 陆游 李煜 马致远".split()),
    4: (94, "艾青 穆旦 胡适 北岛 海子 顾城 舒婷 戴望舒 卞之琳".split()),
    5: (92, "王勃 陈子昂 孟浩然 王昌龄 刘禹锡 郭沫若 闻一多 徐志摩 何其芳".split()),
}
LEGACY = (100, 98, 96, 94, 92, 90, 88, 86, 84)


def snapshot(raw: DataFrame, key: list[str], engines: tuple[str, ...] = score.ENGINES) -> DataFrame:
    """Each engine's largest count by key."""
    return raw.groupBy(*key).agg(*[F.max(F.coalesce(e, F.lit(0))).alias(e) for e in engines])


def scored(works: DataFrame, hits: DataFrame, key: Column) -> DataFrame:
    """works with hits by (author, key); works without are left out. key: tune or title, as the kind of work has it."""
    return works.withColumn("_key", key).join(hits.withColumnRenamed("key", "_key"), ["author", "_key"]).drop("_key")


def star_histogram(rows: DataFrame, column: str = "score") -> DataFrame:
    return rows.groupBy(score.stars(F.col(column)).alias("stars")).agg(F.count("*").alias("n"))


def dynasty_histogram(rows: DataFrame, packed: str = "id") -> DataFrame:
    return rows.groupBy(dynasty_of(F.col(packed)).cast("int").alias("dynasty")).agg(F.count("*").alias("n"))


def tiers(spark) -> DataFrame:
    """name, tier, score, place: the listed poets; place is the competition rank of the listed scores."""
    rows, place = [], 1
    for tier, (points, names) in TIERS.items():
        rows += [(n, tier, points, place) for n in names]
        place += len(names)
    return spark.createDataFrame(rows, "name string, tier int, score int, place int")


def overridden(authors: DataFrame, listed: DataFrame, known: DataFrame) -> DataFrame:
    """authors(author_id, name, score, n) with listed scores; known authors(author_id, name) that are listed but have no
    score of their own come in with n = 0."""
    points = listed.select("name", F.col("score").alias("_listed"))
    own = authors.join(points, "name", "left").withColumn("score", F.coalesce("_listed", "score")).drop("_listed")
    added = known.join(authors.select("author_id"), "author_id", "left_anti").join(points, "name").select("author_id", "name", F.col("_listed").cast("long").alias("score"), F.lit(0).cast("long").alias("n"))
    return own.select("author_id", "name", F.col("score").cast("long").alias("score"), "n").unionByName(added)


def drift(stored: DataFrame, expected: DataFrame) -> DataFrame:
    """Stored author scores that are neither expected nor left by an earlier rubric: changes by hand, which must not be overwritten."""
    return stored.join(expected.select("author_id", F.col("score").alias("expected")), "author_id").where((F.col("score") != F.col("expected")) & ~F.col("score").isin(*LEGACY))


def rank_faults(ranked: DataFrame) -> DataFrame:
    """name, n of rank rules broken: ids, range, ties and order. Compares scores, not authors: a row for each score."""
    by = ranked.groupBy("score").agg(F.count("*").alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    order = W.orderBy(F.desc("score"))
    steps = by.withColumn("due", F.coalesce(F.sum("n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + 1)
    found = steps.agg(F.count_if(F.col("lo") != F.col("hi")).alias("split_ties"), F.count_if(F.col("lo") != F.col("due")).alias("wrong_rank"), F.count_if(~F.col("score").between(1, 100)).alias("out_of_range"))
    double = ranked.groupBy("author_id").count().where("count > 1").agg(F.count("*").alias("double_ids"))
    every = found.join(F.broadcast(double))
    return every.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in every.columns]), F.array(*[F.col(c).cast("long") for c in every.columns]))).alias("name", "n"))
