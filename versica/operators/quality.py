"""Quality checks: each is a row (name, ok, bad) of one DataFrame; a frame's conditions are counted in one pass over it."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versica.functions import script

UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
SPACES = "[ \\t\\x{3000}\\x{00a0}\\x{2007}\\x{202f}]"


def conditions(rows: DataFrame, bad: dict[str, Column]) -> DataFrame:
    """Rows that break each condition; all in one aggregate."""
    found = rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in bad.items()])
    each = F.expr("inline(array(" + ", ".join(f"named_struct('name', '{k}', 'bad', `{k}`)" for k in bad) + "))")
    return found.select(each).select("name", (F.col("bad") == 0).alias("ok"), "bad")


def unique(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    found = rows.groupBy(*key).count().where("count > 1").agg(F.count("*").alias("bad"))
    return found.select(F.lit(name).alias("name"), (F.col("bad") == 0).alias("ok"), "bad")


def no_orphans(rows: DataFrame, parents: DataFrame, key: str, name: str, share: float = 0.0) -> DataFrame:
    """Rows without a parent, up to a share of all."""
    side = parents.select(F.col(key)).distinct().withColumn("_there", F.lit(True))
    found = rows.join(side, key, "left").agg(F.count_if(F.col("_there").isNull() & F.col(key).isNotNull()).alias("bad"), F.count("*").alias("n"))
    return found.select(F.lit(name).alias("name"), (F.col("bad") <= F.col("n") * share).alias("ok"), "bad")


def closed(rows: DataFrame, column: str, allowed: list, name: str) -> DataFrame:
    return conditions(rows, {name: F.col(column).isNull() | ~F.col(column).isin(*allowed)})


def suite(*parts: DataFrame) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def repetition(rows: DataFrame, columns: list[str]) -> DataFrame:
    """column, n, n_distinct, rate: how often a value comes on average."""
    each = rows.select(F.expr("inline(array(" + ", ".join(f"named_struct('column', '{c}', 'v', cast(`{c}` AS string))" for c in columns) + "))"))
    by = each.where("v IS NOT NULL").groupBy("column", "v").agg(F.count("*").alias("k")).groupBy("column").agg(F.sum("k").alias("n"), F.count("*").alias("n_distinct"))
    return by.withColumn("rate", F.round(F.col("n") / F.col("n_distinct"), 6))


def sizes(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.agg(*[f for c in columns for f in (F.sum(F.char_length(c)).alias(f"chars_{c}"), F.sum(F.octet_length(c)).alias(f"bytes_{c}"))])


def duplicates(rows: DataFrame, key: Column) -> DataFrame:
    groups = rows.groupBy(key.alias("k")).agg(F.count("*").alias("n")).where("n > 1")
    return groups.agg(F.count("*").alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def text_form(rows: DataFrame, columns: list[str]) -> DataFrame:
    """For each column: no traditional characters, no spaces between characters, no text of an anonymous author's name."""
    bad = {}
    for c in columns:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        bad |= {f"{c} folded": script.fold(text) != text, f"{c} without spaces": text.rlike(SPACES), f"{c} not anonymous": text.isin(*script.ANONYMOUS)}
    return conditions(rows, bad)


def dimension(rows: DataFrame, key: str, members: DataFrame, expected: list) -> DataFrame:
    """The members are the expected ones, no more and no fewer, and every row has one of them."""
    want = members.sparkSession.createDataFrame([(x,) for x in expected], members.select(key).schema)
    odd = members.select(key).exceptAll(want).unionByName(want.exceptAll(members.select(key))).agg(F.count("*").alias("bad"))
    named = odd.select(F.lit(f"{key} members").alias("name"), (F.col("bad") == 0).alias("ok"), "bad")
    return suite(named, closed(rows, key, expected, f"{key} of rows"))


def side_table(rows: DataFrame, owners: DataFrame, key: str, lists: list[str], times: list[str], names: list[str], share: float = 0.01) -> DataFrame:
    """A side table's keys are there, unique, and but for a share known; lists have no empty members, times are whole seconds, names no folders."""
    bad = {f"{key} there": F.coalesce(F.col(key).cast("string"), F.lit("")) == ""}
    bad |= {f"{c} members": F.exists(F.split(c, "\x1f"), lambda x: x == "") & (F.col(c) != "") for c in lists}
    bad |= {f"{c} seconds": ~F.col(c).cast("string").rlike("^[0-9]+$") for c in times}
    bad |= {f"{c} bare": F.col(c).rlike(r"[/\\]") for c in names}
    return suite(conditions(rows, bad), unique(rows, [key], f"{key} unique"), no_orphans(rows, owners, key, f"{key} known", share))


def file_faults(rows: DataFrame, text: str = "value") -> DataFrame:
    """rows with fault: null for a JSON object or list, else what is wrong."""
    start = F.left(F.ltrim(F.col(text)), F.lit(1))
    parsed = F.try_parse_json(F.col(text))
    return rows.withColumn("fault", F.when(F.trim(text) == "", "empty").when(parsed.isNull(), "no JSON").when(~start.isin("{", "["), "no list or object"))
