"""Collections of JSON files as records, works, lines and authors."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from versica.functions import ids, script
from versica.sources import paths


@dataclass(frozen=True)
class Dataset:
    """A declared collection: a file or a folder of .json files, and paths to what a work needs."""

    key: str
    number: int
    path: str
    kind: str
    body: str
    dynasty: str | None = None
    title: str = "$.title"
    author: str = "$.author"
    external_id: str = "$.id"
    tags: str = "$.tags"
    root: str = "list"
    default_author: str | None = None
    excludes: tuple[str, ...] = ()
    rules: tuple[tuple[str, str], ...] = field(default=())  # (file glob, dynasty), the first that fits


def _glob(pattern: str) -> str:
    import fnmatch

    return fnmatch.translate(pattern).replace("(?s:", "(?:").replace("\\Z", "$").replace("\\z", "$")


def shard_number(file: Column) -> Column:
    """The last number in a file's name, for natural order."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(file, r"(\d+)\D*$", 1), F.lit("")), F.lit("999999999999")).cast("long"), F.lit(-1).cast("long"))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """file, size, modified, sha1 of every JSON file under path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha1("content").alias("sha1"))


def changed(now: DataFrame, before: DataFrame) -> DataFrame:
    return now.join(before, ["file", "size", "sha1"], "left_anti")


def records(spark: SparkSession, root: str, dataset: Dataset) -> DataFrame:
    """dataset, file, ordinal, record: JSON texts of a collection's records. A file of another root than declared raises."""
    raw = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(f"{root}/{dataset.path}").select(F.col("_metadata.file_name").alias("file"), F.regexp_replace("value", "^﻿", "").alias("value"))
    if dataset.excludes:
        raw = raw.where(~F.col("file").isin(*dataset.excludes))
    first = F.left(F.trim(F.regexp_replace("value", r"^\s+", "")), F.lit(1))
    listed, single = F.from_json("value", "array<string>"), F.array("value")
    wrong = F.raise_error(F.concat(F.lit("unexpected root in "), F.col("file"))).cast("array<string>")
    found = {"list": F.when(first == "[", listed).otherwise(wrong), "dict": F.when(first == "{", single).otherwise(wrong), "dict_or_list": F.when(first == "{", single).when(first == "[", listed).otherwise(wrong)}[dataset.root]
    each = raw.select("file", F.posexplode(found).alias("ordinal", "record"))
    return each.where(F.left(F.trim("record"), F.lit(1)) == "{").select(F.lit(dataset.key).alias("dataset"), F.lit(dataset.number).alias("dataset_no"), "file", "ordinal", "record")


def works(found: DataFrame, dataset: Dataset) -> DataFrame:
    """Works of a collection's records: external_id, title, author, dynasty, kind, tags, lines (folded). Works without lines are left out."""
    rec = F.col("record")
    dynasty, rule = paths.value(rec, "$.dynasty"), None
    for pattern, name in reversed(dataset.rules):
        ruled = F.when(F.col("file").rlike(_glob(pattern)), name)
        rule = ruled if rule is None else F.coalesce(ruled, rule)
    rule = F.lit(None).cast("string") if rule is None else rule
    body = F.filter(F.transform(paths.values(rec, dataset.body), F.trim), lambda x: x != "")
    out = found.select(
        "dataset", "dataset_no", "file", "ordinal", paths.value(rec, dataset.external_id).alias("external_id"), script.fold(paths.value(rec, dataset.title)).alias("title"),
        script.fold(F.coalesce(F.nullif(paths.value(rec, dataset.author), F.lit("")), F.lit(dataset.default_author))).alias("author"),
        F.coalesce(dynasty, rule, F.lit(dataset.dynasty)).alias("dynasty"), F.lit(dataset.kind).alias("kind"), paths.values(rec, dataset.tags).alias("tags"),
        F.transform(F.flatten(F.transform(body, lambda x: F.split(x, "\n"))), lambda x: script.fold(x)).alias("lines"))
    return out.where(F.size("lines") > 0)


def file_order(files: DataFrame) -> DataFrame:
    """Distinct (dataset_no, file) with place, from 0: by collection, by name without its numbers, by the last number, by name."""
    from pyspark.sql.window import Window as W

    order = W.orderBy("dataset_no", F.regexp_replace("file", r"\d+", ""), shard_number(F.col("file")), "file")  # one row a file
    return files.select("dataset_no", "file").distinct().withColumn("place", (F.row_number().over(order) - 1).cast("long"))


def numbered(all_works: DataFrame) -> DataFrame:
    """works with work_id, from 1, in order of collection, file (natural order: shard 2000 before 10000) and ordinal. Files are
    numbered from their counts; only those few rows are sorted."""
    from pyspark.sql.window import Window as W

    order = F.row_number().over(W.partitionBy("dataset_no", "file").orderBy("ordinal"))
    files = all_works.groupBy("dataset_no", "file").agg(F.count("*").alias("_n"))
    files = files.join(file_order(files), ["dataset_no", "file"])
    start = files.select("dataset_no", "file", F.coalesce(F.sum("_n").over(W.orderBy("place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return all_works.withColumn("_k", order).join(start, ["dataset_no", "file"]).withColumn("work_id", F.col("_start") + F.col("_k")).drop("_k", "_start")


def lines(all_works: DataFrame) -> DataFrame:
    return all_works.select("work_id", F.posexplode("lines").alias("idx", "text"))


def authors(all_works: DataFrame) -> DataFrame:
    named = all_works.where(F.coalesce("author", F.lit("")) != "").groupBy("author", "dynasty").agg(F.count("*").alias("works"))
    return named.select(F.col("author").alias("name"), "dynasty", "works", ids.author_uid(F.col("author"), F.col("dynasty")).alias("uid"))


def external(spark: SparkSession, path: str, dynasties: list[str], kinds: list[str]) -> DataFrame:
    """Items of self-describing files that are enabled; an unknown dynasty or kind raises."""
    item = "struct<title: string, author: string, lines: array<string>, rhythmic: string, tags: array<string>, notes: string, dynasty: string, kind: string>"
    schema = f"collection string, label string, dynasty string, kind string, default_author string, enabled boolean, items array<{item}>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).where(F.coalesce("enabled", F.lit(True)))
    each = rows.select("collection", "label", F.explode("items").alias("x"), "dynasty", "kind", "default_author")
    checked = lambda c, allowed: F.when(c.isin(*allowed), c).otherwise(F.raise_error(F.concat(F.lit("unknown value: "), F.coalesce(c, F.lit("null")))).cast("string"))
    return each.select("collection", "label", "x.title", F.coalesce("x.author", "default_author").alias("author"), "x.lines", "x.rhythmic", "x.tags", "x.notes", checked(F.coalesce("x.dynasty", "dynasty"), dynasties).alias("dynasty"), checked(F.coalesce("x.kind", "kind"), kinds).alias("kind"))


def json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines) of JSON lines; bad ones are kept apart, to be counted."""
    raw = spark.read.text(path).where(F.trim("value") != "")
    parsed = raw.withColumn("row", F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    good = parsed.where("row IS NOT NULL AND row._bad IS NULL").select("row.*").drop("_bad")
    return good, parsed.where("row IS NULL OR row._bad IS NOT NULL").select("value")


def csv_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def majority(found: DataFrame, is_work: Column, is_author: Column, least: float = 0.6) -> DataFrame:
    """file, kind (poem, author or skip) by what most of a file's records are."""
    by = found.groupBy("file").agg(F.avg(is_work.cast("int")).alias("p"), F.avg(is_author.cast("int")).alias("a"))
    return by.select("file", F.when(F.col("p") >= least, "poem").when(F.col("a") >= least, "author").otherwise("skip").alias("kind"))


@F.udtf(returnType=T.StructType().add("line", T.StringType()))
class FlattenBody:
    """Lines of a nested JSON body of any depth: strings, lists, and objects with content or paragraphs."""

    def eval(self, body: str):
        import json

        def walk(x):
            if isinstance(x, str):
                yield from (line.strip() for line in x.split("\n") if line.strip())
            elif isinstance(x, list):
                for y in x:
                    yield from walk(y)
            elif isinstance(x, dict):
                for k in ("content", "paragraphs", "chapter"):
                    if isinstance(x.get(k), (list, dict)):
                        yield from walk(x[k])

        try:
            parsed = json.loads(body) if body else []
        except ValueError:
            parsed = body
        for line in walk(parsed):
            yield (line,)
