"""Temperature mixing of sources, with DataFrame operations only.

Source s with T_s tokens gets the weight T_s^a / sum(T^a). The exponent a is found by bisection: for a repetition limit (no
source is repeated more than `repeats` times as often as the least repeated one) within [0, 1], from the largest and the
smallest source; for a target entropy of the weights, in nats, by cutting [0, ...) into SECTIONS parts again and again, each
time with one aggregation over the sources, which stay rows. The budget in tokens is what lets every source through once at
least (its default) or a given number.

Weights are realised as block permutations: a source's documents fall into blocks of about BLOCK documents by a hash, each
epoch permutes blocks and documents in blocks by another hash, and the last, partial epoch takes documents in that order up
to the source's budget. Running sums are over ranges of the permutation (RANGES of an epoch), then over the blocks of a range,
then over the documents of the one block where the budget ends; so no task ever sorts a whole source, or all its blocks.

Defined cases: a null source is the source '' ; a null text has no tokens; a source without tokens comes once, whole; rows of
one doc_id are one document (their tokens add up, the smallest source counts, and all come out in each epoch it is in); a null
doc_id is one more document; equal hashes go by block number and doc_id; an entropy that no exponent gives (over that of equal
weights, or under that of the largest sources alone) is a ValueError; very long texts are counted whole; without documents there
are no rows; extra columns are kept as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from versica.llm.common import quoted, same_columns, stored, unused

BLOCK = 1024
STEPS, SECTIONS = 40, 16
#: Hexadecimal digits of the hash of a block that name its range.
RANGES = 2
#: Sources whose shares may be sent to all tasks (some 60 bytes each).
BROADCAST = 50_000


def tokens(text: Column) -> Column:
    """Tokens, counted as runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _hash(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))


def for_repeats(ratio: Column, repeats: float) -> Column:
    """Bisection over [0, 1] inside one expression; ratio: tokens of the largest source over those of the smallest."""

    def fits(a: Column) -> Column:  # more repetition for a smaller exponent
        return F.pow(ratio, F.lit(1.0) - a) <= F.lit(float(repeats))

    def half(s: Column, _: Column) -> Column:
        mid = (s["lo"] + s["hi"]) / 2
        return F.when(fits(mid), F.struct(s["lo"].alias("lo"), mid.alias("hi"))).otherwise(F.struct(mid.alias("lo"), s["hi"].alias("hi")))

    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, half)["hi"]
    return F.when(fits(F.lit(0.0)), F.lit(0.0)).otherwise(F.ceil(found * 1e6) / 1e6)


def _entropies(sizes: DataFrame, most: float, exponents: list[float]) -> list[float]:
    """Entropy of the weights t^a of sizes(t), for each a."""
    x = F.col("t") / F.lit(most)
    sums = [F.struct(F.sum(F.pow(x, F.lit(a))).alias("z"), F.sum(F.pow(x, F.lit(a)) * F.log(x)).alias("s")).alias(f"a{i}") for i, a in enumerate(exponents)]
    row = sizes.agg(*sums).first()
    return [math.log(v.z) - a * v.s / v.z for a, v in zip(exponents, row, strict=True)]


def for_entropy(sizes: DataFrame, entropy: float) -> float:
    """The exponent that gives the weights of sizes(t) this entropy, to 1e-6."""
    most, n = sizes.agg(F.max("t"), F.count("*")).first()
    ties = sizes.where(F.col("t") == most).count()
    if not math.log(ties) <= entropy <= math.log(n):
        raise ValueError(f"no exponent gives the entropy {entropy}: {math.log(ties):.6f} to {math.log(n):.6f} can be met")
    if entropy == math.log(n):
        return 0.0
    lo, hi = 0.0, None
    above = [float(2**k) for k in range(SECTIONS)]
    for a, h in zip(above, _entropies(sizes, most, above), strict=True):  # entropy falls as the exponent grows
        if h <= entropy:
            hi = a
            break
        lo = a
    if hi is None:
        return lo
    while hi - lo > 1e-7 * max(1.0, hi):
        cuts = [lo + (hi - lo) * k / SECTIONS for k in range(1, SECTIONS)]
        for a, h in zip(cuts, _entropies(sizes, most, cuts), strict=True):
            if h <= entropy:
                hi = a
                break
            lo = a
    return math.ceil(hi * 1e6) / 1e6


def _placed(docs: DataFrame, repeats: float | None = 4.0, entropy: float | None = None, budget: int | None = None, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """plan() with the hash by which blocks are permuted."""
    if (repeats is None) == (entropy is None):
        raise ValueError("give either a repetition limit or a target entropy")
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.coalesce(F.col(quoted(source_col)).cast("string"), F.lit("")).alias("source"), tokens(F.col(quoted(text_col))).alias("n_tokens"))
    light = stored(rows.groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("n_tokens").alias("n_tokens")), "light")
    by = stored(light.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")), "sources")
    sizes = by.where("t > 0").select(F.col("t").cast("double").alias("t"))
    ends = sizes.agg(F.max("t").alias("most"), F.min("t").alias("least"))
    most = ends.first()["most"] or 1.0
    if repeats is not None:
        a = ends.select(F.coalesce(for_repeats(F.col("most") / F.col("least"), repeats), F.lit(1.0))).first()[0]
    else:
        a = for_entropy(sizes, entropy) if sizes.limit(1).count() else 1.0
    size = F.col("t").cast("double")
    if budget is None:
        times = F.pow(F.lit(most) / size, F.lit(1.0 - a)) if a <= 1 else F.pow(size / F.lit(sizes.agg(F.min("t")).first()[0]), F.lit(a - 1.0))
    else:
        norm = sizes.agg(F.sum(F.pow(F.col("t") / F.lit(most), F.lit(a)))).first()[0] or 1.0
        times = F.lit(float(budget)) * F.pow(size / F.lit(most), F.lit(a)) / F.lit(norm) / size
    shares = by.withColumn("times", F.round(F.when(F.col("t") > 0, times).otherwise(1.0), 6))
    shares = shares.select("source", F.floor("times").alias("full"), F.floor((F.col("times") - F.floor("times")) * F.col("t")).alias("part"), F.ceil(F.col("n") / BLOCK).alias("blocks"))
    shares = stored(shares.withColumn("epochs", F.col("full") + (F.col("part") > 0).cast("long")).where("epochs > 0"), "shares")
    shares = F.broadcast(shares) if shares.count() <= BROADCAST else shares

    number = F.conv(F.substring(_hash(seed, "block", F.col("doc_id")), 1, 8), 16, 10).cast("long")
    at = light.join(shares, "source").withColumn("block", F.pmod(number, F.col("blocks")))
    at = at.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
    blocks = at.groupBy("source", "epoch", "block", "full", "part").agg(F.sum("n_tokens").alias("bt"))
    blocks = blocks.withColumn("turn", _hash(seed, "order", F.col("epoch"), F.col("source"), F.col("block")))
    blocks = stored(blocks.withColumn("range", F.substring("turn", 1, RANGES)), "blocks")
    runs = W.partitionBy("source", "epoch").orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # 16^RANGES rows at most
    ranges = blocks.groupBy("source", "epoch", "range").agg(F.sum("bt").alias("rt"), F.count("*").alias("rn"))
    ranges = ranges.select("source", "epoch", "range", F.coalesce(F.sum("rt").over(runs), F.lit(0)).alias("range_before"), F.coalesce(F.sum("rn").over(runs), F.lit(0)).alias("range_rank"))
    order = W.partitionBy("source", "epoch", "range").orderBy("turn", "block")
    blocks = blocks.join(ranges, ["source", "epoch", "range"])
    blocks = blocks.withColumn("block_rank", (F.col("range_rank") + F.row_number().over(order)).cast("long")).withColumn("before", F.col("range_before") + F.coalesce(F.sum("bt").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    # what is left of the part for this block; a full epoch takes all
    left = F.when(F.col("epoch") >= F.col("full"), F.col("part") - F.col("before"))
    blocks = blocks.select("source", "epoch", "block", "turn", "block_rank", left.alias("left")).where("left IS NULL OR left > 0")
    inside = W.partitionBy("source", "epoch", "block").orderBy(_hash(seed, "doc", F.col("epoch"), F.col("doc_id")), "doc_id")
    out = at.select("doc_id", "source", "n_tokens", "epoch", "block").join(blocks, ["source", "epoch", "block"])
    out = out.withColumn("place", F.row_number().over(inside).cast("long")).withColumn("upto", F.sum("n_tokens").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    return out.where("left IS NULL OR upto <= left").select("doc_id", "source", "n_tokens", "epoch", "turn", "block_rank", "place")


def plan(docs: DataFrame, **parameters) -> DataFrame:
    """A row per document and epoch: doc_id, source, n_tokens, epoch (from 0), block_rank (the block's place in the source's epoch, from
    1), place (in the block, from 1)."""
    return _placed(docs, **parameters).drop("turn")


def mix(docs: DataFrame, id_col: str = "doc_id", **parameters) -> DataFrame:
    """docs as the mixture's rows: a document comes once for each epoch that it is in. Each task's rows are in the order of the
    permutation (epochs one after another, blocks of all sources by their hash, documents by their places), so files written
    from them are mixed."""
    key, epoch, turn, place = unused(docs, "_mixed", "_epoch", "_turn", "_place")
    chosen = _placed(docs, id_col=id_col, **parameters)
    chosen = chosen.select(F.col("doc_id").alias(key), F.col("epoch").alias(epoch), F.col("turn").alias(turn), F.col("place").alias(place))
    chosen = chosen.hint("shuffle_hash")  # short rows, one for each epoch of an id; sorting by id too would hold every text twice
    met = docs.join(chosen, F.col(quoted(id_col)).cast("long").eqNullSafe(F.col(key)))
    return met.sortWithinPartitions(epoch, turn, place).select(*same_columns(docs))


ORACLE = r"""
WITH RECURSIVE rows AS (SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS k FROM documents),
light AS MATERIALIZED (SELECT doc_id, min(source) AS source, CAST(sum(k) AS BIGINT) AS n_tokens FROM rows GROUP BY doc_id),
by_source AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS t, count(*) AS n FROM light GROUP BY source),
ends AS (SELECT CAST(max(t) AS DOUBLE) AS most, CAST(min(t) AS DOUBLE) AS least FROM by_source WHERE t > 0),
halves(i, lo, hi) AS (SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
  SELECT i + 1, CASE WHEN pow(most / least, 1 - (lo + hi) / 2) <= 4 THEN lo ELSE (lo + hi) / 2 END, CASE WHEN pow(most / least, 1 - (lo + hi) / 2) <= 4 THEN (lo + hi) / 2 ELSE hi END
  FROM halves, ends WHERE i < 40),
a AS (SELECT CASE WHEN most / least <= 4 THEN 0.0 ELSE ceil(hi * 1e6) / 1e6 END AS a FROM halves, ends WHERE i = 40),
times AS (SELECT source, t, n, round(CASE WHEN t > 0 THEN pow(most / t, 1 - a) ELSE 1 END, 6) AS times FROM by_source, ends, a),
shares AS (SELECT source, CAST(floor(times) AS BIGINT) AS full_epochs, CAST(floor((times - floor(times)) * t) AS BIGINT) AS part, CAST(ceil(n / 1024.0) AS BIGINT) AS blocks FROM times),
placed AS (SELECT doc_id, l.source, n_tokens, full_epochs, part, CAST('0x' || substr(md5('mix:block:' || doc_id), 1, 8) AS BIGINT) % blocks AS block,
  unnest(range(0, full_epochs + CASE WHEN part > 0 THEN 1 ELSE 0 END)) AS epoch FROM light l JOIN shares s ON l.source = s.source),
blocks AS (SELECT source, epoch, block, full_epochs, part, sum(n_tokens) AS bt FROM placed GROUP BY ALL),
ranked AS (SELECT source, epoch, block, full_epochs, row_number() OVER o AS block_rank, part - coalesce(sum(bt) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains
  FROM blocks WINDOW o AS (PARTITION BY source, epoch ORDER BY md5('mix:order:' || epoch || ':' || source || ':' || block), block)),
inside AS (SELECT p.doc_id, p.source, p.n_tokens, p.epoch, r.block_rank, r.full_epochs, r.remains, row_number() OVER d AS place, sum(p.n_tokens) OVER (d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM placed p JOIN ranked r ON p.source = r.source AND p.epoch = r.epoch AND p.block = r.block
  WINDOW d AS (PARTITION BY p.source, p.epoch, p.block ORDER BY md5('mix:doc:' || p.epoch || ':' || p.doc_id), p.doc_id))
SELECT doc_id, source, n_tokens, epoch, block_rank, place FROM inside WHERE epoch < full_epochs OR upto <= remains
"""
