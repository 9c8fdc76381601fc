"""Reports over what other operators make: each is a small DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from versica.operators.sampling import hash_order


def causes(placed: DataFrame) -> DataFrame:
    """cause, n_authors, n_works of authors without a certain biography."""
    return placed.where("cause IS NOT NULL").groupBy("cause").agg(F.count("*").alias("n_authors"), F.sum("works").alias("n_works"))


def unresolved(placed: DataFrame, n: int = 15) -> DataFrame:
    """The authors with most works among those without a biography."""
    return placed.where("rung = 'stub'").orderBy(F.desc("works"), "name", "dynasty").limit(n)


def shares(rows: DataFrame, by: str) -> DataFrame:
    """by, n and percent of all. Shares are of a count of each value, never of the rows."""
    counts = rows.groupBy(by).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))), 3))


def first_tie(ranked: DataFrame) -> DataFrame:
    """The authors of the best rank that more than one shares."""
    tied = ranked.groupBy("rank").agg(F.count("*").alias("_n")).where("_n > 1").orderBy("rank").limit(1)
    return ranked.join(tied.select("rank"), "rank", "left_semi")


def tune_frequency(works: DataFrame, tune: str, rare: int = 2) -> DataFrame:
    return works.where(F.coalesce(F.col(tune), F.lit("")) != "").groupBy(F.col(tune).alias("name")).agg(F.count("*").alias("n")).withColumn("rare", F.col("n") <= rare)


def samples(rows: DataFrame, by: list[str], key: str, n: int, seed: str = "report") -> DataFrame:
    """n rows of each group in hash order."""
    w = W.partitionBy(*by).orderBy(hash_order(key, seed), key)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def one_conflict_each(changes: DataFrame, order: str) -> DataFrame:
    """Conflicts with equal uid, field, old and new once, the first by order."""
    key = ["uid", "field", "old", "new"]
    return changes.groupBy(*key).agg(F.min(order).alias(order))


def first_difference(rows: DataFrame, a: str, b: str, width: int = 10) -> DataFrame:
    """Where two texts first differ, in steps of width: step, n."""
    n = F.least(F.char_length(a), F.char_length(b))
    at = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda done, i: F.when((done == 0) & (F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))), i).otherwise(done))
    place = F.when(F.col(a) == F.col(b), None).when(at > 0, at - 1).otherwise(n)
    return rows.select(F.floor(place / width).alias("step")).where("step IS NOT NULL").groupBy("step").agg(F.count("*").alias("n"))


def remapped(extras: DataFrame, works: DataFrame, old: Column, new: str = "uid") -> DataFrame:
    """old, new uid of works whose former uid is that of an orphan in extras: what an edit of a text left behind."""
    orphan = extras.select(F.col("uid").alias("old")).join(works.select(F.col(new).alias("old")), "old", "left_anti")
    return works.select(old.alias("old"), F.col(new).alias("new")).where("old <> new").join(orphan, "old", "left_semi")


def reference_coverage(works: DataFrame, authors: DataFrame, key: str) -> DataFrame:
    """n_works, n_matched: works whose author is known."""
    known = authors.select(key).distinct().withColumn("_known", F.lit(1))
    return works.join(known, key, "left").agg(F.count("*").alias("n_works"), F.count("_known").alias("n_matched"))


def enrichable(works: DataFrame, extras: DataFrame, field: str, least: int, n: int, seed: str) -> DataFrame:
    """n works in hash order that lack a field and whose text is long enough for one."""
    there = extras.where(F.coalesce(F.col(field), F.lit("")) != "").select("uid")
    lacking = works.where(F.char_length("body") >= least).join(there, "uid", "left_anti")
    return lacking.orderBy(hash_order("uid", seed), "uid").limit(n)


def same_body(rows: DataFrame, own: Column, page: Column) -> DataFrame:
    """rows with same: whether a page has the text; null if there is no page."""
    return rows.withColumn("same", F.when(F.coalesce(page, F.lit("")) != "", own == page))


def pager(total: Column, size: int, page: Column) -> Column:
    """struct(pages, page): at least one page, and the page that is asked for brought into range."""
    pages = F.greatest(F.lit(1), F.ceil(total / size)).cast("long")
    return F.struct(pages.alias("pages"), F.least(F.greatest(page.cast("long"), F.lit(1)), pages).alias("page"))


def search_summary(found: DataFrame, limit: int, offset: int) -> DataFrame:
    """lines, works and texts of search.found_in(), and which of the texts a page shows: from, to, remaining."""
    every = found.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0)).cast("long").alias("n_lines"), F.count("*").alias("n_works"), F.count_distinct("body_key").alias("n_texts"))
    last = F.least(F.lit(offset + limit), F.col("n_texts"))
    return every.select("*", F.least(F.lit(offset + 1), F.col("n_texts")).cast("long").alias("shown_from"), last.cast("long").alias("shown_to"), (F.col("n_texts") - last).cast("long").alias("remaining"))


def report_filter(rows: DataFrame, verdict: str | None = None, collection: str | None = None, text: str | None = None, columns: tuple[str, ...] = ()) -> DataFrame:
    """Report rows of a verdict (what stands before its first colon), of a collection, and with a text in any of the columns, whatever its case."""
    if verdict is not None:
        rows = rows.where(F.split("verdict", ":")[0] == verdict)
    if collection is not None:
        rows = rows.where(F.col("collection") == collection)
    return rows if not text else rows.where(F.lower(F.concat_ws(" ", *columns)).contains(text.lower()))


def split_kept(rows: DataFrame, there: DataFrame, key: list[str]) -> DataFrame:
    """rows with kept: whether their record is still there."""
    side = there.select(*key).distinct().withColumn("_there", F.lit(True))
    return rows.join(side, key, "left").withColumn("kept", F.col("_there").isNotNull()).drop("_there")


def status_line(works: DataFrame, added: Column, edited: Column, checked: Column) -> DataFrame:
    """One row: total, added, edited, checked, remaining."""
    return works.agg(F.count("*").alias("total"), F.count_if(added).alias("added"), F.count_if(edited).alias("edited"), F.count_if(checked).alias("checked"), F.count_if(~checked).alias("remaining"))


def anonymous_share(works: DataFrame, by: str, author: Column) -> DataFrame:
    return works.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.coalesce(author, F.lit("")) == "").alias("n_anonymous"))


def authors_by_works(works: DataFrame, author: str, key: str, samples: int = 3) -> DataFrame:
    """author, n_works and the smallest ids of works, so many; most works first when ordered by place."""
    few = works.withColumn("_k", F.row_number().over(W.partitionBy(author).orderBy(key))).where(F.col("_k") <= samples)
    few = few.groupBy(author).agg(F.sort_array(F.collect_list(key)).alias("samples"))  # `samples` each
    return works.groupBy(author).agg(F.count("*").alias("n_works")).join(few, author)


def first_source(fields: dict[str, list[tuple[str, Column]]]) -> list[Column]:
    """For each field its value from the first source that has one, and that source's name beside it."""
    out = []
    for name, sources in fields.items():
        there = [(tag, F.nullif(F.trim(c), F.lit(""))) for tag, c in sources]
        tag = F.lit(None).cast("string")
        for t, c in reversed(there):
            tag = F.when(c.isNotNull(), t).otherwise(tag)
        out += [F.coalesce(*[c for _, c in there]).alias(name), tag.alias(f"{name}_from")]
    return out


def gated(rows: DataFrame, rules: tuple[str, ...], rule: str = "rule", old: str = "old", new: str = "new") -> DataFrame:
    """rows with value: the new one where the change's rule is switched on and it is not empty, else the old one."""
    return rows.withColumn("value", F.when(F.col(rule).isin(*rules) & (F.coalesce(F.col(new), F.lit("")) != ""), F.col(new)).otherwise(F.col(old)))


def adapted(rows: DataFrame, wanted: dict[str, tuple[str, ...]]) -> DataFrame:
    """rows with each wanted column, from the names it has had, the first that is there and not empty; null where none is."""
    has = {c.lower() for c in rows.columns}
    columns = {name: [F.nullif(F.col(c).cast("string"), F.lit("")) for c in names if c.lower() in has] for name, names in wanted.items()}
    return rows.withColumns({name: F.coalesce(*found) if found else F.lit(None).cast("string") for name, found in columns.items()})
