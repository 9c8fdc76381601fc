"""Search over lines: phrases, exact strings, filters, editions and pages. Every result is one lazy plan.

works: work_id, dataset, dynasty, author, title; lines: work_id, idx, text. A phrase is found by its tokens, so punctuation
between them does not matter; exact=True asks for the string itself as well.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versica.functions import script


def lines_of(works: DataFrame, body: str = "body") -> DataFrame:
    """work_id, idx, text: the lines of each work's text, blank ones left out, numbered from 0 as they stand."""
    each = works.select("work_id", F.posexplode(F.split(body, "\n")).alias("idx", "text"))
    return each.where(F.trim("text") != "")


def needle(text: str) -> str:
    """A query's tokens as the substring to look for; ValueError if it has none."""
    found = script.token_list(script.fold_text(text))
    if not found:
        raise ValueError("the query has nothing to search for")
    return f" {' '.join(found)} "


def _subject(text: Column, wanted: str) -> Column:
    """What a needle is looked for in. Folding changes Han characters only, so a needle without any needs none."""
    return F.lower(script.fold(text) if script.has_han(wanted) else text)


def pattern(wanted: str) -> str:
    """A needle as a regular expression over lower-case text: its tokens one after another on a line, what is between them no
    letter or digit; a run of letters and digits is a whole one, a Han character stands for itself."""
    inside = f"[\\p{{L}}\\p{{N}}&&[^{script.HAN}]]"
    tokens, out = wanted.split(), ""
    for k, t in enumerate(tokens):
        run = not script.has_han(t)
        if k:
            out += "[^\\p{L}\\p{N}\n]" + ("+" if run and not script.has_han(tokens[k - 1]) else "*")
        elif run:
            out += f"(?<!{inside})"
        out += re.escape(t)
    return out + ("" if script.has_han(tokens[-1]) else f"(?!{inside})")


def phrase(text: Column, query: str) -> Column:
    """The cheap test first: every token as a plain substring."""
    wanted = needle(query)
    subject = _subject(text, wanted)
    plain = [subject.contains(t) for t in dict.fromkeys(sorted(wanted.split(), key=len, reverse=True))]
    return functools.reduce(Column.__and__, plain) & subject.rlike(pattern(wanted))


def found_in(works: DataFrame, query: str, exact: bool = False, body: str = "body", **equal: str | None) -> DataFrame:
    """Matching works with lines (array<struct<idx, text>>, those that match) and body_key, where a work's text is one column:
    rows are tested and keyed where they lie, and nothing is shuffled. A phrase lies on one line, so whole texts are tested
    first, and only those that have it are split."""
    rows = filtered(works, **equal).where(phrase(F.col(body), query))
    hit = lambda x: phrase(x["text"], query)
    if exact:
        own = F.lower(F.lit(script.fold_text(query)))
        rows = rows.where(_subject(F.col(body), script.fold_text(query)).contains(own))
        hit = lambda x: _subject(x["text"], script.fold_text(query)).contains(own) & phrase(x["text"], query)
    rows = rows.withColumn("lines", F.filter(F.transform(F.split(body, "\n"), lambda x, i: F.struct(i.alias("idx"), x.alias("text"))), hit))
    rows = rows.where(F.size("lines") > 0) if exact else rows
    return rows.withColumn("body_key", row_key(F.col(body)))


def row_key(body: Column) -> Column:
    """A digest of a text's lines, folded, without blank ones."""
    return F.sha2(F.array_join(F.filter(F.split(script.fold_han(body), "\n"), lambda x: F.trim(x) != ""), "\x1f"), 256)


def grouped_rows(found: DataFrame) -> DataFrame:
    """One row for each text of found_in(): work_id (smallest), lines, editions."""
    by = found.groupBy("body_key").agg(F.min_by("lines", "work_id").alias("lines"), F.sort_array(F.collect_list("work_id")).alias("ids"))
    return by.select(F.col("ids")[0].alias("work_id"), "lines", F.expr("slice(ids, 2, size(ids))").alias("editions"))


def matches(lines: DataFrame, query: str, exact: bool = False, column: str = "text") -> DataFrame:
    """Lines that hold the phrase. The exact string goes first: it is cheap, and rules most lines out."""
    if exact:
        own = script.fold_text(query)
        lines = lines.where(_subject(F.col(column), own).contains(F.lower(F.lit(own))))
    return lines.where(phrase(F.col(column), query))


def filtered(works: DataFrame, **equal: str | None) -> DataFrame:
    for name, value in equal.items():
        if value is not None:
            works = works.where(F.col(name) == value)
    return works


def count(lines: DataFrame, works: DataFrame, query: str, exact: bool = False, **equal: str | None) -> DataFrame:
    """n_lines, n_works."""
    hit = matches(lines, query, exact).join(filtered(works, **equal).select("work_id"), "work_id")
    return hit.agg(F.count("*").alias("n_lines"), F.count_distinct("work_id").alias("n_works"))


def body_keys(lines: DataFrame) -> DataFrame:
    """work_id, body_key: a digest of all of a work's lines in order; works with equal keys are editions of one text."""
    ordered = F.sort_array(F.collect_list(F.struct("idx", script.fold(F.col("text")).alias("t"))))
    return lines.groupBy("work_id").agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["t"]), "\x1f"), 256).alias("body_key"))


def hits(lines: DataFrame, works: DataFrame, query: str, exact: bool = False, **equal: str | None) -> DataFrame:
    """work_id, lines (array<struct<idx, text>>): the matching lines of each work."""
    found = matches(lines, query, exact).join(filtered(works, **equal).select("work_id"), "work_id")
    return found.groupBy("work_id").agg(F.sort_array(F.collect_list(F.struct("idx", "text"))).alias("lines"))


def grouped(lines: DataFrame, works: DataFrame, query: str, exact: bool = False, **equal: str | None) -> DataFrame:
    """One row for each text: work_id (smallest), lines, editions (the other matching works' ids). Only matching works are keyed."""
    found = hits(lines, works, query, exact, **equal)
    keys = body_keys(lines.join(found.select("work_id"), "work_id", "left_semi"))
    by = found.join(keys, "work_id").groupBy("body_key").agg(F.min_by("lines", "work_id").alias("lines"), F.sort_array(F.collect_list("work_id")).alias("ids"))
    return by.select(F.col("ids")[0].alias("work_id"), "lines", F.expr("slice(ids, 2, size(ids))").alias("editions"))


def grouped_count(lines: DataFrame, works: DataFrame, query: str, exact: bool = False, **equal: str | None) -> DataFrame:
    found = hits(lines, works, query, exact, **equal)
    keys = body_keys(lines.join(found.select("work_id"), "work_id", "left_semi"))
    return keys.agg(F.count_distinct("body_key").alias("n_texts"))


def page(rows: DataFrame, order: list, limit: int | None, offset: int = 0) -> DataFrame:
    rows = rows.orderBy(*order)
    rows = rows.offset(offset) if offset else rows
    return rows if limit is None else rows.limit(limit)


def editions(lines: DataFrame, works: DataFrame) -> DataFrame:
    """work_id, editions: other works of the same text. A digest groups, no pairs are made."""
    return edition_groups(body_keys(lines))


def edition_groups(keys: DataFrame) -> DataFrame:
    """work_id, editions from (work_id, body_key)."""
    groups = keys.groupBy("body_key").agg(F.sort_array(F.collect_list("work_id")).alias("ids")).where(F.size("ids") > 1)
    return groups.select(F.explode("ids").alias("work_id"), "ids").select("work_id", F.expr("filter(ids, x -> x <> work_id)").alias("editions"))


def by_title(rows: DataFrame, title: str, column: str = "title") -> DataFrame:
    """Rows of that title, or else rows whose title holds it; one plan."""
    equal = F.col(column) == title
    some = rows.where(equal).limit(1).agg((F.count("*") > 0).alias("_some"))  # one row
    return rows.join(F.broadcast(some)).where(equal | (~F.col("_some") & F.col(column).contains(title))).drop("_some")


def substring(rows: DataFrame, text: str, column: str = "body") -> DataFrame:
    """LIKE '%text%' as SQLite has it: wildcards work, ASCII case does not matter."""
    return rows.where(F.lower(F.col(column)).like(f"%{text.lower()}%"))


def route(rows: DataFrame, tune: str | None = None, author: str | None = None, keyword: str | None = None) -> DataFrame:
    """A tune, else an author alone, else a keyword in the text, else in titles where no text has it."""
    if tune:
        return rows.where(F.col("tune") == tune)
    rows = rows.where(F.col("author") == author) if author else rows
    if not keyword:
        return rows
    found = substring(rows, keyword)
    return found if found.limit(1).count() else by_title(rows, keyword)


def by_author(authors: DataFrame, name: str) -> DataFrame:
    """Authors of that canonical name, or else of that published spelling: the better level wins."""
    level = F.when(F.col("name") == name, 1).when(F.col("published") == name, 2)
    found = authors.withColumn("level", level).where("level IS NOT NULL")
    best = found.agg(F.min("level").alias("_best"))
    return found.join(F.broadcast(best), F.col("level") == F.col("_best")).drop("_best")
