"""Catalogue: dictionaries, identity, deduplication, authors and the biography ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def keep_first(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. Rows are compared by min_by, which aggregates before the shuffle; keys are no window groups."""
    every = F.struct(*[F.col(c) for c in rows.columns])
    best = rows.groupBy(*key).agg(F.min_by(every, F.struct(*order)).alias("_row"))
    return best.select(*[F.col("_row")[c].alias(c) for c in rows.columns])


def dictionary(rows: DataFrame, column: str, position: str, name: str) -> DataFrame:
    """name, id: values numbered by first appearance. Only distinct values are sorted."""
    first = rows.where(F.col(column).isNotNull() & (F.col(column) != "")).groupBy(F.col(column).alias(name)).agg(F.min(position).alias("_first"))
    return first.select(name, F.row_number().over(W.orderBy("_first", name)).cast("long").alias("id"))


def sequence_in(rows: DataFrame, by: list[str], order: list[str], name: str = "sequence") -> DataFrame:
    return rows.withColumn(name, (F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1).cast("long"))


def counts(works: DataFrame, by: list[str]) -> DataFrame:
    return works.groupBy(*by).agg(F.count("*").alias("n"))


def longest_text(rows: DataFrame, key: list[str], text: str, order: str) -> DataFrame:
    """The longest text of each key; of equally long ones, that of the smallest order."""
    return rows.groupBy(*key).agg(F.max_by(F.col(text), F.struct(F.char_length(text), -F.col(order))).alias(text))


def ladder(authors: DataFrame, biographies: DataFrame, aliases: DataFrame) -> DataFrame:
    """Biographies for authors(name, dynasty, works): rung exact (same name and dynasty), alias (a listed other name whose
    bearer has one), dynasty_gap (the name is one author's only, and has biographies of one dynasty, another one), or stub.

    biographies: name, dynasty, bio; aliases: alias, name, dynasty. Adds rung, bio, cause (of stubs: no_bio or ambiguous; of gaps: dynasty_gap).
    """
    own = biographies.select("name", "dynasty", F.col("bio").alias("exact_bio"))
    other = aliases.join(biographies, ["name", "dynasty"]).groupBy(F.col("alias").alias("name")).agg(F.min("bio").alias("alias_bio"))
    by_name = biographies.groupBy("name").agg(F.min("bio").alias("gap_bio"), F.count_distinct("dynasty").alias("n_dynasties"))
    bearers = authors.groupBy("name").agg(F.count("*").alias("n_bearers"))
    met = authors.join(own, ["name", "dynasty"], "left").join(other, "name", "left").join(by_name, "name", "left").join(bearers, "name", "left")
    gap = (F.col("n_bearers") == 1) & (F.col("n_dynasties") == 1)
    rung = F.when(F.col("exact_bio").isNotNull(), "exact").when(F.col("alias_bio").isNotNull(), "alias").when(gap, "dynasty_gap").otherwise("stub")
    met = met.withColumn("rung", rung)
    bio = F.when(F.col("rung") == "exact", F.col("exact_bio")).when(F.col("rung") == "alias", F.col("alias_bio")).when(F.col("rung") == "dynasty_gap", F.col("gap_bio"))
    cause = F.when(F.col("rung") == "dynasty_gap", "dynasty_gap").when((F.col("rung") == "stub") & F.col("gap_bio").isNull(), "no_bio").when(F.col("rung") == "stub", "ambiguous")
    return met.select(*authors.columns, "rung", bio.alias("bio"), cause.alias("cause"))


def ladder_stats(placed: DataFrame) -> DataFrame:
    return placed.groupBy("rung").agg(F.count("*").alias("n_authors"), F.sum("works").alias("n_works"))


def coverage(placed: DataFrame, by: str = "dynasty") -> DataFrame:
    return placed.groupBy(by).agg(F.count("*").alias("n_authors"), F.sum("works").alias("n_works"), F.count_if(F.col("bio").isNotNull()).alias("n_with_bio"))


def biography_drops(rows: DataFrame) -> DataFrame:
    """Biographies(name, desc) that are of no use, counted by reason."""
    reason = F.when(F.coalesce(F.trim("name"), F.lit("")) == "", "no_name").when(F.coalesce(F.trim("desc"), F.lit("")) == "", "no_text").when(F.col("desc").startswith("--"), "marker")
    return rows.select(reason.alias("reason")).where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def with_missing(authors: DataFrame, works: DataFrame, key: list[str]) -> DataFrame:
    """authors and those that only works have."""
    missing = works.select(*key).distinct().join(authors, key, "left_anti")
    return authors.select(*key).unionByName(missing)


def orphans(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).join(parents.select(key), key, "left_anti")


def main_author(authors: DataFrame, works: DataFrame) -> DataFrame:
    """Of authors(author_id, name) with one name, the one with most works, then the smallest id."""
    n = works.groupBy("author_id").agg(F.count("*").alias("n_works"))
    counted = authors.join(n, "author_id", "left").withColumn("n_works", F.coalesce("n_works", F.lit(0)))
    return counted.groupBy("name").agg(F.max_by("author_id", F.struct("n_works", -F.col("author_id"))).alias("author_id"), F.max("n_works").alias("n_works"))


def match_levels(external: DataFrame, works: DataFrame, prefix: int = 12) -> DataFrame:
    """ext_id, level, work_id: external rows (ext_id, title, author, body) by title and author, else by title and the body's
    beginning, else by title; the smallest work_id of the best level. Each level is pre-aggregated by its key, so a title
    that very many works have makes no pairs."""
    out = None
    for level, keys in enumerate((["title", "author"], ["title", "head"], ["title"]), 1):
        side = works.withColumn("head", F.left("body", F.lit(prefix))).groupBy(*keys).agg(F.min("work_id").alias("work_id"))
        own = external.withColumn("head", F.left("body", F.lit(prefix))).join(side, keys).select("ext_id", F.lit(level).alias("level"), "work_id")
        out = own if out is None else out.unionByName(own)
    return out.groupBy("ext_id").agg(F.min("level").alias("level"), F.min_by("work_id", "level").alias("work_id"))


def overlay_tags(works: DataFrame, tags: DataFrame, prefix: int = 20) -> DataFrame:
    """works(author, first_line, tags) with missing tags of tags(author, first_line, tag) added, by author and the first line's beginning."""
    more = tags.groupBy("author", F.left("first_line", F.lit(prefix)).alias("_head")).agg(F.sort_array(F.collect_set("tag")).alias("_more")).withColumnRenamed("author", "_author")
    met = works.join(more, (F.col("author") == F.col("_author")) & (F.left("first_line", F.lit(prefix)) == F.col("_head")), "left")
    return met.withColumn("tags", F.array_union(F.coalesce("tags", F.expr("array()").cast("array<string>")), F.coalesce("_more", F.expr("array()").cast("array<string>")))).drop("_head", "_author", "_more")


def inverted(works: DataFrame, column: str) -> DataFrame:
    return works.groupBy(column).agg(F.sort_array(F.collect_list("work_id")).alias("ids"))


def three_way(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """key and state of rows that differ: only_a, only_b or changed."""
    met = a.select(key, F.col(value).alias("a"), F.lit(True).alias("in_a")).join(b.select(key, F.col(value).alias("b"), F.lit(True).alias("in_b")), key, "full_outer")
    state = F.when(F.col("in_b").isNull(), "only_a").when(F.col("in_a").isNull(), "only_b").when(~F.col("a").eqNullSafe(F.col("b")), "changed")
    return met.select(key, state.alias("state")).where("state IS NOT NULL")


def reconcile(parents: DataFrame, rows: DataFrame, key: str, counter: str) -> DataFrame:
    """Parents whose counter is not the number of their rows."""
    n = rows.groupBy(key).agg(F.count("*").alias("n"))
    return parents.join(n, key, "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col(counter) != F.col("n")).select(key, counter, "n")
