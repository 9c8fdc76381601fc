"""Edits as copy-on-write: every change is a new DataFrame; counters are always derived, never incremented."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from versica.functions import ids


def next_ids(works: DataFrame, packed: str = "id", checked: bool = True) -> DataFrame:
    """dynasty, kind, next_id: one past the largest sequence of each segment; a full segment raises. Unchecked: one past its largest id."""
    if not checked:
        return works.groupBy(ids.dynasty_of(F.col(packed)).alias("dynasty"), ids.kind_of(F.col(packed)).alias("kind")).agg((F.max(packed) + 1).alias("next_id"))
    seg = works.select(ids.dynasty_of(F.col(packed)).alias("dynasty"), ids.kind_of(F.col(packed)).alias("kind"), ids.sequence_of(F.col(packed)).alias("s"))
    return seg.groupBy("dynasty", "kind").agg(F.max("s").alias("last")).select("dynasty", "kind", ids.make_id(F.col("dynasty"), F.col("kind"), F.col("last") + 1).alias("next_id"))


def upsert(base: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """base with rows of edits in place of its own, and new ones."""
    return base.join(edits.select(key), key, "left_anti").unionByName(edits.select(*base.columns))


def update(base: DataFrame, edits: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """base with the given columns of edits where those are not null."""
    side = edits.select(F.col(key), *[F.col(c).alias(f"_{c}") for c in columns])
    met = base.join(side, key, "left").withColumns({c: F.coalesce(f"_{c}", c) for c in columns})
    return met.select(*base.columns)


def delete(base: DataFrame, gone: DataFrame, key: str, allowed: Column, force: bool = False) -> DataFrame:
    """base without rows of gone, but only such as may be deleted."""
    side = gone.select(key).distinct().withColumn("_gone", F.lit(True))
    met = base.join(side, key, "left")
    may = F.lit(True) if force else F.coalesce(allowed, F.lit(False))
    return met.where(F.col("_gone").isNull() | ~may).select(*base.columns)


def rekey(rows: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """rows with key replaced by mapping(old, new) where it is listed."""
    return rows.join(mapping.select(F.col("old").alias(key), F.col("new").alias("_new")), key, "left").withColumn(key, F.coalesce("_new", key)).drop("_new")


def unlisted(incoming: DataFrame, base: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows that base does not have, each key once (the smallest row)."""
    every = F.struct(*[F.col(c) for c in incoming.columns])
    once = incoming.groupBy(*key).agg(F.min(every).alias("_row")).select(*[F.col("_row")[c].alias(c) for c in incoming.columns])
    return once.join(base.select(*key), key, "left_anti")


def latest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """The newest row of each key."""
    every = F.struct(*[F.col(c) for c in rows.columns])
    best = rows.groupBy(key).agg(F.max_by(every, F.col(at)).alias("_row"))
    return best.select(*[F.col("_row")[c].alias(c) for c in rows.columns])


def set_notes(notes: DataFrame, edits: DataFrame, key: str = "uid", text: str = "notes") -> DataFrame:
    """Notes upserted; an empty text clears."""
    return upsert(notes, edits, key).where(F.coalesce(text, F.lit("")) != "")


def merge_notes(notes: DataFrame, more: DataFrame, key: str = "uid", text: str = "notes") -> DataFrame:
    """Texts appended on a new line where they are not in the notes yet; unknown keys come in."""
    side = more.select(F.col(key), F.col(text).alias("_more"))
    met = notes.join(side, key, "full_outer")
    had = F.coalesce(text, F.lit(""))
    joined = F.when(F.col("_more").isNull() | had.contains(F.col("_more")), had).when(had == "", F.col("_more")).otherwise(F.concat_ws("\n", had, F.col("_more")))
    return met.withColumn(text, joined).drop("_more")


def snapshot_restore(rebuilt: DataFrame, users: DataFrame, authors: DataFrame, key: str = "id") -> DataFrame:
    """A user's works put back on a rebuilt table: authors are matched by uid, else by name (the last id wins), rows upserted by id."""
    by_name = authors.groupBy(F.col("name").alias("author_name")).agg(F.max_by("uid", "id").alias("_by_name"))
    known = authors.select(F.col("uid").alias("author_uid"), F.lit(True).alias("_known"))
    met = users.join(known, "author_uid", "left").join(by_name, "author_name", "left").withColumn("author_uid", F.when(F.col("_known"), F.col("author_uid")).otherwise(F.col("_by_name")))
    return upsert(rebuilt, met.select(*rebuilt.columns), key)


def patch_faults(before: DataFrame, after: DataFrame, edits: DataFrame, key: str, column: str) -> DataFrame:
    """name, n of what a rewrite may not do: change what no edit names, miss an edit, meet another old value, lose or add rows.
    edits: key, old, new."""
    b = before.select(F.col(key), F.struct(*[c for c in before.columns if c != key]).alias("b"), F.col(column).alias("was"))
    a = after.select(F.col(key), F.struct(*[c for c in before.columns if c != key]).alias("a"), F.col(column).alias("now"))
    met = b.join(a, key, "full_outer").join(edits.select(key, "old", "new", F.lit(True).alias("edited")), key, "left")
    edited = F.coalesce("edited", F.lit(False))
    found = met.agg(
        F.count_if(~edited & ~F.col("b").eqNullSafe(F.col("a"))).alias("untouched_changed"), F.count_if(edited & ~F.col("was").eqNullSafe(F.col("old"))).alias("old_differs"),
        F.count_if(edited & ~F.col("now").eqNullSafe(F.col("new"))).alias("not_written"), F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("rows_lost_or_added"))
    return found.select(F.expr("inline(array(" + ", ".join(f"named_struct('name', '{c}', 'n', {c})" for c in found.columns) + "))"))


def running_offsets(lines: DataFrame, pattern: str = "pattern") -> DataFrame:
    """lines(work_id, idx, text) with the slice of the work's tonal pattern that is theirs, by the lengths of the lines before."""
    w = W.partitionBy("work_id").orderBy("idx")
    start = F.coalesce(F.sum(F.char_length("text")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return lines.withColumn("tones", F.substring(F.col(pattern), (start + 1).cast("int"), F.char_length("text")))
