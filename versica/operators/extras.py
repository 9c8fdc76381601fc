"""Side tables of works: sparse notes and images, their sources, licences, times and quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

# Short keys of the exchange form.
SHORT = {"i": "uid", "tr": "translation", "nt": "notes", "in": "introduction", "bg": "creative_background", "ap": "appreciation", "im": "images", "src": "source", "asrc": "more_sources", "lic": "licence", "u": "updated"}
TEXTS = ("translation", "notes", "introduction", "creative_background", "appreciation")


def long_names(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({k: v for k, v in SHORT.items() if k in rows.columns})


def sparse_json(columns: dict[str, Column]) -> Column:
    """A JSON object without empty fields."""
    return F.to_json(F.struct(*[F.nullif(c, F.lit("")).alias(k) for k, c in columns.items()]))


def to_epoch(text: Column) -> Column:
    """Seconds of a time in one of three forms, or of digits; 0 if it is none of them."""
    forms = [F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")]
    return F.coalesce(F.when(text.rlike("^[0-9]{1,12}$"), text.cast("long")), *[F.unix_seconds(t) for t in forms], F.lit(0))


def from_epoch(seconds: Column) -> Column:
    return F.when(seconds > 0, F.from_unixtime(seconds, "yyyy-MM-dd HH:mm:ss")).otherwise("")


def image_name(path: Column) -> Column:
    return F.element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), -1)


def safe_path(path: Column) -> Column:
    """Whether a relative path stays where it belongs."""
    return ~(path.rlike(r"(^|[/\\])\.\.([/\\]|$)") | path.rlike(r"^([/\\]|[A-Za-z]:)") | (path == ""))


def images(paths: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(paths, lambda x: image_name(F.trim(x))), lambda x: x != ""))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """By uid: new texts where they are not empty, all images, the first source, later ones beside it."""
    n = new.select("uid", *[F.col(c).alias(f"_{c}") for c in (*TEXTS, "images", "source")])
    met = old.join(n, "uid", "full_outer")
    none = F.expr("array()").cast("array<string>")
    texts = {c: F.coalesce(F.nullif(F.col(f"_{c}"), F.lit("")), F.col(c), F.lit("")) for c in TEXTS}
    more = F.array_except(F.array_compact(F.array("source", "_source")), F.array(F.coalesce("source", "_source")))
    return met.select("uid", *[v.alias(k) for k, v in texts.items()], F.array_union(F.coalesce("images", none), F.coalesce("_images", none)).alias("images"), more.alias("more_sources"), F.coalesce("source", "_source").alias("source"))


def fill_stats(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.agg(F.count("*").alias("n_rows"), *[F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "").alias(f"n_{c}") for c in columns])


def source_counts(rows: DataFrame) -> DataFrame:
    none = F.expr("array()").cast("array<string>")
    each = rows.select(F.explode(F.array_compact(F.array_union(F.array("source"), F.coalesce("more_sources", none)))).alias("source"))
    return each.groupBy("source").agg(F.count("*").alias("n"))


def attribution(rows: DataFrame, licences: DataFrame) -> DataFrame:
    """rows with a line that names source and licence; licences: source, label, licence, url."""
    return rows.join(licences, "source", "left").withColumn("attribution", F.when(F.col("label").isNotNull(), F.concat_ws(" · ", "label", "licence", F.nullif("url", F.lit("")))).otherwise(""))


def repaired(lines: DataFrame, repairs: DataFrame) -> DataFrame:
    """lines(file, idx, line, text) with characters put right by repairs(file, idx, line, offset, char), each at its place."""
    marks = repairs.groupBy("file", "idx", "line").agg(F.map_from_entries(F.collect_list(F.struct(F.col("offset").cast("int"), "char"))).alias("_at"))
    met = lines.join(marks, ["file", "idx", "line"], "left")
    text = F.when(F.col("_at").isNull(), F.col("text")).otherwise(F.array_join(F.transform(F.split("text", ""), lambda ch, i: F.coalesce(F.element_at("_at", i), ch)), ""))
    return met.withColumn("text", text).drop("_at")


def cost(usage: DataFrame, per_million_in: float, per_million_out: float) -> DataFrame:
    return usage.agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), ((F.sum("tokens_in") * per_million_in + F.sum("tokens_out") * per_million_out) / 1e6).alias("cost"))


def attached(works: DataFrame, side: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """works with a side table's value; of several the last by order counts (of equal ones the largest), works without any keep null."""
    last = side.groupBy(key).agg(F.max_by(value, F.struct(order, value)).alias(value))
    return works.join(last, key, "left")


def completeness(works: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """n_keys of the side table, and n_joined of them that are works."""
    there = works.select(key).distinct().withColumn("_there", F.lit(True))
    return side.select(key).distinct().join(there, key, "left").agg(F.count("*").alias("n_keys"), F.count("_there").alias("n_joined"))


def sized_shards(rows: DataFrame, key: str, size: Column, most: int, ranges: int = 64) -> DataFrame:
    """rows with shard, from 0: in order of key, a new one after each `most` bytes. Running sums are over ranges of keys (from
    their quantiles), then inside a range, so that no task sorts all rows."""
    cuts = sorted(set(rows.approxQuantile(key, [k / ranges for k in range(1, ranges)], 0.01)))
    at = F.lit(0)
    for c in cuts:
        at = at + (F.col(key) > c).cast("int")
    sized = rows.withColumn("_size", size.cast("long")).withColumn("_range", at)
    sums = sized.groupBy("_range").agg(F.sum("_size").alias("_sum"))  # `ranges` rows at most
    before = sums.select("_range", F.coalesce(F.sum("_sum").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inside = F.coalesce(F.sum("_size").over(W.partitionBy("_range").orderBy(key).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return sized.join(F.broadcast(before), "_range").withColumn("shard", F.floor((F.col("_base") + inside) / most)).drop("_range", "_size", "_base")
