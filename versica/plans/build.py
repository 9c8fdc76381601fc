"""The whole build as one plan: works, normal forms, copies dropped, popularity, tags, authors; tables and bundle at the end."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versica.functions import ids, script
from versica.operators import catalog, export, ranking
from versica.sources import corpus


def normalized(works: DataFrame) -> DataFrame:
    """works with normal forms and the content uid; works whose text becomes empty are left out."""
    w = works.withColumn("lines", script.norm_lines(F.col("lines"))).withColumn("author", script.norm_author(F.col("author")))
    w = w.withColumn("body", F.array_join("lines", "\n")).where(F.col("body") != "")
    w = w.withColumn("title", script.pick_title(script.norm_text(F.col("title")), F.lit(None).cast("string"), F.col("body")))
    return w.withColumn("uid", ids.content_uid(F.col("dynasty"), F.col("author"), F.col("title"), F.col("body")))


def read_works(spark: SparkSession, root: str, datasets: list[corpus.Dataset]) -> DataFrame:
    parts = [corpus.works(corpus.records(spark, root, d), d) for d in datasets]
    return corpus.numbered(functools.reduce(DataFrame.unionByName, parts))


def build(spark: SparkSession, root: str, datasets: list[corpus.Dataset], hits: DataFrame | None = None, tags: DataFrame | None = None) -> dict[str, DataFrame]:
    """poems, authors and dictionaries. Popularity comes after normal forms and deduplication: its keys are normal forms."""
    works = normalized(read_works(spark, root, datasets))
    works = catalog.keep_first(works, ["uid"], [F.col("work_id")])
    if hits is not None:
        works = works.join(hits.groupBy("uid").agg(F.max("score").alias("score")), "uid", "left").withColumn("score", F.coalesce("score", F.lit(0)))
    if tags is not None:
        works = catalog.overlay_tags(works.withColumn("first_line", F.get("lines", F.lit(0))), tags).drop("first_line")
    codes = works.withColumn("_d", F.coalesce(ids.code(F.col("dynasty"), ids.DYNASTIES), F.lit(0))).withColumn("_k", F.coalesce(ids.code(F.col("kind"), ids.KINDS), F.lit(0)))
    poems = catalog.sequence_in(codes, ["_d", "_k"], ["work_id"]).withColumn("id", ids.make_id(F.col("_d"), F.col("_k"), F.col("sequence"))).drop("_d", "_k", "sequence")
    poems = poems.withColumn("author_uid", F.when(F.col("author") != "", ids.author_uid(F.col("author"), F.col("dynasty"))).otherwise(""))
    authors = poems.where("author_uid <> ''").groupBy("author_uid", F.col("author").alias("name"), "dynasty").agg(F.count("*").alias("n_poems"))
    if hits is not None:
        shrunk = ranking.score.shrunk(poems.where("author_uid <> ''"), "author_uid", "score").select(F.col("author_id").alias("author_uid"), "score")
        authors = authors.join(shrunk, "author_uid", "left")
    return {"poems": poems, "authors": authors, "sources": catalog.dictionary(poems, "dataset", "work_id", "name")}


def write(tables: dict[str, DataFrame], path: str, only: bool = False) -> None:
    for name, rows in tables.items():
        export.table(rows, f"{path}/{name}", ["dataset"] if name == "poems" else None, only and name == "poems")
