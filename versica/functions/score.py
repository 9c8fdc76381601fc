"""Popularity scores: quantized, composite, banded and shrunk; column builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

# Fixed values of the scoring rubric.
ENGINES = ("baidu", "so360", "bing", "bing_en", "google")
STEPS = ((5.0, 5.0), (4.4, 4.5), (3.6, 4.0), (3.1, 3.0), (2.65, 2.0))
LOWEST_STEP = 1.5
SPAN = {"preqin": 5.0, "tang": 4.5, "song": 4.5, "han": 4.0, "wudai": 4.0, "weijin": 4.0, "nanbeichao": 4.0, "sui": 4.0, "jin": 3.5, "yuan": 3.5, "ming": 3.0, "qing": 3.0, "modern": 2.0, "unknown": 2.5, "custom": 2.5, "sango": 4.0, "jinchao": 4.0}
WEIGHTS = {"breadth": 0.30, "span": 0.20, "depth": 0.25, "now": 0.25}
STARS = ((90, 5), (75, 4), (55, 3), (35, 2))
MOST_HITS = 16_100_000
PRIOR = 20


def quantize(hits: Column) -> Column:
    """0 to 255 by logarithm."""
    scaled = F.floor(255.0 * F.log10(1 + hits.cast("double")) / F.log10(F.lit(1.0 + MOST_HITS)))
    return F.when(hits <= 0, 0).otherwise(F.greatest(F.lit(1), F.least(F.lit(255), scaled))).cast("int")


def step(log: Column) -> Column:
    out = F.when(log >= STEPS[0][0], STEPS[0][1])
    for least, value in STEPS[1:]:
        out = out.when(log >= least, value)
    return out.otherwise(LOWEST_STEP)


def stars(score: Column) -> Column:
    out = F.when(score >= STARS[0][0], STARS[0][1])
    for least, value in STARS[1:]:
        out = out.when(score >= least, value)
    return out.otherwise(1)


def evaluate(hits: dict[str, Column], span_base: Column, has: dict[str, Column]) -> Column:
    """struct(breadth, span, depth, now, composite, stars). has: translation, notes, appreciation, introduction, images (boolean)."""
    log = {e: F.log10(1.0 + hits[e]) for e in ENGINES}
    one = {k: F.coalesce(v, F.lit(False)).cast("int") for k, v in has.items()}
    wide = F.when((hits["google"] >= 1_000_000) & (hits["bing_en"] >= 100_000), 0.5).otherwise(0.0)
    mean = (log["baidu"] + log["so360"] + log["bing"] + log["bing_en"] + log["google"]) / 5
    breadth = F.least(F.lit(5.0), step(mean) + wide)
    now = step(0.6 * log["baidu"] + 0.4 * log["so360"])
    span = F.least(F.lit(5.0), span_base + 0.5 * one["translation"] * one["appreciation"])
    depth = F.least(F.lit(5.0), 1.5 + 0.75 * one["translation"] + 0.75 * one["notes"] + 1.0 * one["appreciation"] + 0.5 * one["introduction"] + 0.5 * one["images"])
    raw = 20 * (WEIGHTS["breadth"] * breadth + WEIGHTS["span"] * span + WEIGHTS["depth"] * depth + WEIGHTS["now"] * now)
    composite = F.greatest(F.lit(1), F.least(F.lit(100), F.bround(F.round(raw, 9)).cast("int")))  # ties to even
    return F.struct(F.bround(breadth, 2).alias("breadth"), F.bround(span, 2).alias("span"), F.bround(depth, 2).alias("depth"), F.bround(now, 2).alias("now"), composite.alias("composite"), stars(composite).alias("stars"))


def band(score: Column) -> Column:
    """1 from 90 up, then one more for every two points less, to 46; a score outside 0..100 raises."""
    return F.when(~score.between(0, 100) | score.isNull(), F.raise_error(F.concat(F.lit("score out of range: "), F.coalesce(score.cast("string"), F.lit("null")))).cast("int")).when(score >= 90, 1).otherwise(F.expr("2") + F.floor((89 - score) / 2).cast("int"))


def bands(df_range: DataFrame) -> DataFrame:
    """band, low, high, label of the 46 bands; df_range: any frame with one row."""
    at = df_range.select(F.explode(F.sequence(F.lit(1), F.lit(46))).alias("band"))
    low = F.when(F.col("band") == 1, 90).otherwise(90 - 2 * (F.col("band") - 1))
    at = at.withColumn("low", low).withColumn("high", F.when(F.col("band") == 1, 100).otherwise(F.col("low") + 1))
    return at.withColumn("label", F.format_string("第%d档（%d~%d）", "band", "low", "high"))


def shrunk(works: DataFrame, author: str, score: str, prior: int = PRIOR) -> DataFrame:
    """author_id, n, score: each author's mean, pulled to the mean of all by `prior` works, rounded half up."""
    valid = works.where((F.col(score) > 0) & F.col(author).isNotNull() & (F.col(author).cast("string") != "")).select(F.col(author).alias("author_id"), F.col(score).cast("long").alias("s"))
    by = valid.groupBy("author_id").agg(F.sum("s").alias("total"), F.count("*").alias("n"))
    every = by.agg((F.sum("total") / F.sum("n")).alias("mean"))  # one row
    shrunken = F.floor((F.col("total") + prior * F.col("mean")) / (F.col("n") + prior) + 0.5)
    return by.join(F.broadcast(every)).select("author_id", "n", shrunken.cast("long").alias("score"))


def competition_rank(authors: DataFrame, score: str = "score") -> DataFrame:
    """authors with rank: equal scores share one, the next is skipped. Scores are few (1 to 100), so the ranking is over a
    count of each score, and no task sorts all authors."""
    counts = authors.groupBy(F.col(score).alias("_s")).agg(F.count("*").alias("_n"))
    above = counts.select("_s", (F.coalesce(F.sum("_n").over(W.orderBy(F.desc("_s")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + 1).cast("long").alias("rank"))
    return authors.join(above, F.col(score) == F.col("_s")).drop("_s")
