"""SimHash near-dedup by multi-index hashing.

Fingerprints are votes of the XXH64 of word shingles. links() finds all pairs of different fingerprints within two bits:
each 32-bit half of one lies in the ball of radius one around the other's half, so the ball of each half (the half, and it
with one set bit cleared, on the side that has the bit) is looked up in the table of halves, and full distances are verified.
Table entries that more than CAP fingerprints share are left out of that and done exactly in another way: two fingerprints
are within two bits if and only if their full balls of radius one meet, and no ball point has more than 65 neighbours.

near_duplicates() is for similarity thresholds, where fingerprints differ in many bits. Its fingerprints are wider, cut into
segments whose number and width follow from the number of documents and the recall wanted. In buckets of segment balls all pairs
of up to CALM members are compared, and larger buckets chained (each member with the first and the one before); then all pairs of
a crowded bucket's members that are not in one group by that are compared, block by block. Fingerprints make candidates only:
these are verified by the Jaccard similarity of their shingles.

Only distinct fingerprints take part, or there distinct sets of shingles: copies are one class. Defined cases: a null or empty text has no words, and
fingerprint zero, linked like any other; a text of fewer words than a shingle is one shingle; a null doc_id takes part in
links but is no component's id unless it is alone with others like it (then null), and near_duplicates() never drops it;
repeated rows come out repeated; very long texts are taken whole, piece by piece; no documents, no rows; extra columns are not
looked at, whatever their names; a tie of votes (a bit set in exactly half of the hashes) is 0.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections import OrderedDict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from versica.llm.common import binary, components, driver_gives_back, id_text, in_arrow, merged, quoted, stored, unused

SEED, CAP = 42, 64
#: Fingerprint words for similarity thresholds: 1024 bits tell similarities to within about 0.03.
WORDS = 16
#: Standard deviations, of bits that differ, that candidates may be off; members of a crowded bucket that one task compares at a time.
LOOSE, BLOCK = 4, 1000
#: The same for the first 64 bits, or FEW_WORDS times as many, which are looked at before whole fingerprints meet.
LOOSE_FIRST, FEW_WORDS = 4, 4
#: Members of a bucket that are all compared at once; segments that are looked at before the others.
CALM, EARLY = 4, 3
#: Bytes of texts and hashes that a task keeps while it compares pairs; bytes that are split into words at a time.
HELD = 16 << 20
PIECE, SPACES = 1 << 20, frozenset(b" \t\n\v\f\r")
_BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.float64)


def shingle_hashes(text: bytes, n: int) -> np.ndarray:
    """XXH64 of each n-word shingle, repeats included. bytes.lower() changes A-Z only and bytes.split() splits at ASCII white space.

    A very long text is taken piece by piece, each with the last n - 1 words of the one before."""
    out: list[np.ndarray] = []
    words: list[bytes] = []
    at = 0
    while True:
        end = at + PIECE
        while end < len(text) and text[end] not in SPACES:
            end += 1
        words += text[at:end].lower().split()
        at = end
        if len(words) > n or (out and len(words) == n):
            joined = b" ".join(words)
            starts = [0, *(x + 1 for x in accumulate(map(len, words), lambda a, b: a + 1 + b))]
            out.append(np.array([xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[n:])], np.uint64))
            words = words[len(words) - n + 1 :] if n > 1 else []
        if at >= len(text):
            break
    if out:
        return np.concatenate(out)
    return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """Hash k made of hash 0, by a 64-bit finalizer."""
    if k == 0:
        return h
    h = h + np.uint64((0x9E3779B97F4A7C15 * k) % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def votes(hashes: list[np.ndarray], words: int) -> np.ndarray:
    """Fingerprints (documents, words) of documents' hashes: a bit is set if it is in more than half of them."""
    counts = np.array([len(h) for h in hashes])
    flat = np.concatenate([np.zeros(0, np.uint64), *hashes])
    of = np.repeat(np.arange(len(hashes)) * 256, counts)
    out = np.zeros((len(hashes), words), np.uint64)
    weights = np.uint64(1) << np.arange(8, dtype=np.uint64)
    for k in range(words if len(flat) else 0):
        octets = _mixed(flat, k).view(np.uint8).reshape(-1, 8)
        for i in range(8):
            ones = np.bincount(of + octets[:, i], minlength=256 * len(hashes)).reshape(-1, 256) @ _BITS
            out[:, k] |= ((2 * ones > counts[:, None]) @ weights) << np.uint64(8 * i)
    return out


def _cut(fp: np.ndarray, segments: int, width: int) -> np.ndarray:
    """Segment j: bits [j * width, (j + 1) * width) of the fingerprint."""
    bits = np.unpackbits(fp.view(np.uint8), axis=1, bitorder="little")[:, : segments * width].reshape(len(fp), segments, width)
    return bits @ (np.int64(1) << np.arange(width, dtype=np.int64))


def fingerprints(docs: DataFrame, shingle: int, words: int = 1, segments: int = 0, width: int = 0) -> DataFrame:
    """doc_id, fp0, fp1, ... for docs(doc_id, text); with segments, of distinct shingles, and also segs, an array of them, and class, a digest of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, held, n = [], [], 0

            def out() -> pa.RecordBatch:
                fp = votes(held, words)
                cols = [pa.array(ids, pa.int64()), *[pa.array(fp[:, k].copy().view(np.int64)) for k in range(words)]]
                if segments:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.arange(len(fp) + 1) * segments, pa.int32()), pa.array(_cut(fp, segments, width).ravel())))
                    cols.append(pa.array([hashlib.sha256(h).hexdigest() for h in held], pa.string()))
                return pa.RecordBatch.from_arrays(cols, names)

            for doc_id, text in zip(b.column("doc_id").to_pylist(), binary(b.column("text")), strict=True):
                ids.append(doc_id)
                hashes = shingle_hashes(text, shingle)
                held.append(np.unique(hashes) if segments else hashes)
                n += len(held[-1])
                if n > 200_000 or len(held) >= 256:
                    yield out()
                    ids, held, n = [], [], 0
            if held:
                yield out()

    names = ["doc_id", *[f"fp{k}" for k in range(words)], *["segs", "class"] * bool(segments)]
    schema = ", ".join(["doc_id long", *[f"fp{k} long" for k in range(words)], *["segs array<long>", "class string"] * bool(segments)])
    return in_arrow(docs, run, schema)


def _ball(value: str, width: int) -> str:
    """SQL: the value, and it with each of its set bits cleared."""
    return f"concat(array({value}), transform(filter(sequence(0, {width - 1}), i -> (shiftright({value}, i) & 1L) = 1L), i -> {value} - shiftleft(1L, i)))"


def links(fps: DataFrame, cap: int = CAP) -> DataFrame:
    """Edges (a, b) of distinct fingerprints fps(fp): all pairs within two bits are linked, directly or, in crowded buckets, through others that are."""
    halves = fps.select("fp", F.expr("inline(array(struct(0L AS part, shiftrightunsigned(fp, 32) AS half), struct(1L AS part, fp & 4294967295L AS half)))"))
    table = halves.select(F.expr("part * 4294967296L + half").alias("key"), "fp")
    probes = halves.select("fp", F.expr("part * 4294967296L").alias("base"), "half", F.expr(f"explode({_ball('half', 32)})").alias("point"))
    probes = probes.select(F.expr("base + point").alias("key"), F.col("fp").alias("of"), F.expr("point = half").alias("same"))
    crowded = stored(table.groupBy("key").count().where(F.col("count") > cap).select("key"), "crowded")
    some = crowded.limit(1).count() > 0
    calm = table.join(merged(crowded), "key", "left_anti") if some else table
    near = F.expr("bit_count(fp ^ of) <= 2 AND (NOT same OR of < fp)")
    edges = probes.join(merged(calm), (probes["key"] == calm["key"]) & near).select(F.col("of").alias("a"), F.col("fp").alias("b"))
    if not some:
        return edges
    within = probes.join(merged(crowded), "key", "left_semi").select(F.col("of").alias("fp")).distinct()
    points = within.select("fp", F.expr("explode(concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))))").alias("point"))
    meets = points.groupBy("point").agg(F.collect_set("fp").alias("met")).where(F.size("met") > 1)  # 65 at most
    stars = meets.select(F.array_min("met").alias("a"), F.explode("met").alias("b")).where("a <> b")
    return edges.unionByName(stars)


def component_ids(docs: DataFrame, shingle: int = 3, cap: int = CAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (long), component_id (smallest doc_id reachable over links of two bits or fewer)."""
    of = stored(fingerprints(id_text(docs, id_col, text_col), shingle).withColumnRenamed("fp0", "fp"), "fingerprints")
    classes = stored(of.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    labels = components(links(classes.select("fp"), cap))
    grouped = labels.join(merged(classes), labels.node == classes.fp)
    least = grouped.groupBy("label").agg(F.min("first").alias("least"))
    linked = stored(labels.join(merged(least), "label").select(F.col("node").alias("fp"), "least"), "linked")
    ids = classes.join(merged(linked), "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return of.join(merged(ids), "fp").select("doc_id", "fp", "component_id")


def differing(similarity: float) -> float:
    """Share of fingerprint bits that differ, on average, between sets of this Jaccard similarity and of equal size: the angle of their cosine 2J / (1 + J)."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def segment_plan(n: int, similarity: float, recall: float) -> tuple[int, int]:
    """(segments, width) for n documents. A bucket of a segment's ball holds few others by chance (width grows with log2 n); two
    segments meet if equal, if one bit differs, or, in half of the cases, if two do; the number of segments gives the recall."""
    p, width = differing(similarity), max(16, math.ceil(math.log2(max(2, n))) + 4)
    meet = sum(share * math.comb(width, k) * p**k * (1 - p) ** (width - k) for k, share in ((0, 1), (1, 1), (2, 0.5)))
    return math.ceil(math.log(1 - recall) / math.log(1 - meet)), width


def _alike(pairs: DataFrame, rows: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """Edges (a, b): the pairs(id, other) of rows(doc_id, text) whose sets of shingles have this Jaccard similarity or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[bytes, np.ndarray] = OrderedDict()
        size = 0

        def held(text: bytes) -> np.ndarray:
            """Hashes of a text's shingles; those of the last texts, HELD bytes together, are kept."""
            nonlocal size
            own = kept.pop(text, None)
            if own is None:
                own = np.unique(shingle_hashes(text, shingle))
                size += len(text) + own.nbytes
            kept[text] = own
            while size > HELD and len(kept) > 2:
                gone, hashes = kept.popitem(last=False)
                size -= len(gone) + hashes.nbytes
            return own

        for b in batches:
            keep = []
            for x, y in zip(binary(b.column("text")), binary(b.column("other_text")), strict=True):
                x, y = held(x), held(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                every = len(x) + len(y) - both
                keep.append(not every or both / every >= similarity)
            yield pa.RecordBatch.from_arrays([b.column("other"), b.column("id")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = pairs.select(F.col("id").alias("doc_id")).unionByName(pairs.select(F.col("other").alias("doc_id"))).distinct()
    texts = rows.join(ids, "doc_id", "left_semi").distinct()
    met = pairs.join(texts.select(F.col("doc_id").alias("other"), F.col("text").alias("other_text")), "other").join(texts.withColumnRenamed("doc_id", "id"), "id")
    return in_arrow(met.select("id", "other", "text", "other_text"), run, "a long, b long", 250)


def _met(points: DataFrame, few: int) -> DataFrame:
    """What meets in buckets: points(key, id, fp0, label) of buckets with several labels -> key, id, near, crowded.

    near: members with another label and a close fp0, as (bits that differ, id): in calm buckets (CALM members at most) all before
    this one by id, in crowded ones the first member and the one before."""
    bucket, whole = W.partitionBy("key").orderBy("id"), W.partitionBy("key")
    one = F.struct("id", "fp0", "label")
    before = {f"l{k}": F.lag(one, k).over(bucket) for k in range(1, CALM)}
    seen = points.select("key", "id", "fp0", "label", F.first(one).over(bucket).alias("head"), *[c.alias(n) for n, c in before.items()], F.count("*").over(whole).alias("size"), F.min("label").over(whole).alias("lo"), F.max("label").over(whole).alias("hi"))
    bits = lambda x: F.expr(f"bit_count(fp0 ^ {x}.fp0)")
    near = lambda names: F.array_compact(F.array(*[F.when((F.col(f"{x}.label") != F.col("label")) & (bits(x) <= few), F.struct(bits(x).alias("bits"), F.col(f"{x}.id").alias("other"))) for x in names]))
    seen = seen.where("lo <> hi").select("key", "id", (F.col("size") > CALM).alias("crowded"), near(before).alias("calm"), near(["head", "l1"]).alias("some"))
    return seen.select("key", "id", "crowded", F.when(F.col("crowded"), F.col("some")).otherwise(F.col("calm")).alias("near")).where("crowded OR size(near) > 0")


def _chained(met: DataFrame) -> DataFrame:
    """Pairs (id, other) to compare first: all of calm buckets; of crowded ones, for each id, the smallest and the closest."""
    calm = met.where("NOT crowded").select("id", F.expr("explode(near.other)").alias("other"))
    least = met.where("crowded").groupBy("id").agg(F.min(F.expr("array_min(near)")).alias("closest"), F.min(F.expr("array_min(near.other)")).alias("first"))
    return calm.unionByName(least.select("id", F.expr("explode(array_compact(array_distinct(array(closest.other, first))))").alias("other"))).distinct()


def near_duplicates(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, recall: float = 0.93, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, group_id for every document with an id; group_id is the smallest doc_id of its group of near duplicates.

    Two texts are linked if their fingerprints meet in a segment and their sets of shingles have this Jaccard similarity; recall
    is that of the segments, at exactly this similarity. Fingerprints only rule out pairs LOOSE standard deviations beyond it.
    The first segments alone link most of large groups; the others then leave out what is in one group already."""
    rows = id_text(docs, id_col, text_col).where("doc_id IS NOT NULL")
    n = rows.count()
    segments, width = segment_plan(n, similarity, recall)
    words = max(WORDS, -(-segments * width // 64))
    p = differing(similarity)
    at_most = lambda bits, loose: math.ceil(bits * (p + loose * math.sqrt(p * (1 - p) / bits)))
    of = stored(fingerprints(rows, shingle, words, segments, width), "fingerprints")
    print_ = [f"fp{k}" for k in range(words)]
    classes = stored(of.groupBy("class").agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in [*print_, "segs"]]), "classes")
    left, right = classes.select("id", *print_), classes.select(F.col("id").alias("other"), *[F.col(c).alias(f"o_{c}") for c in print_])
    differ = lambda names: F.expr(" + ".join(f"bit_count({c} ^ o_{c})" for c in names))
    close = differ(print_) <= at_most(64 * words, LOOSE)

    def points(labels: DataFrame | None, first: int, last: int) -> DataFrame:
        held = classes.select("id", "fp0", "segs", F.col("id").alias("label")) if labels is None else classes.select("id", "fp0", "segs").join(labels, F.col("id") == F.col("node"), "left").select("id", "fp0", "segs", F.coalesce("label", "id").alias("label"))
        at = held.select("id", "fp0", "label", F.posexplode(F.slice("segs", first + 1, last - first)).alias("part", "value"))
        at = at.select("id", "fp0", "label", F.expr(f"(part + {first}) * {1 << width}L").alias("base"), F.explode(F.expr(_ball("value", width))).alias("point"))
        return at.select((F.col("base") + F.col("point")).alias("key"), "id", "fp0", "label")

    def linked(pairs: DataFrame, labels: DataFrame | None, name: str, compared: bool = False) -> DataFrame:
        """Labels of the components when the pairs that are alike are links too. compared: whole fingerprints of the pairs are known to be close."""
        met = stored(pairs if compared else pairs.join(left, "id").join(right, "other").where(close).select("id", "other"), name)
        driver_gives_back(docs.sparkSession)  # plans of many small jobs pile up there
        edges = _alike(met, rows, similarity, shingle)
        if labels is None:
            return components(edges)
        over = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
        edges = edges.join(over("a"), "a", "left").join(over("b"), "b", "left").select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
        more = components(edges)
        driver_gives_back(docs.sparkSession)
        nodes = labels.select("node", "label").unionByName(more.join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("label")))
        joined = nodes.join(more.select(F.col("node").alias("was"), F.col("label").alias("now")), F.col("label") == F.col("was"), "left")
        return stored(joined.select("node", F.coalesce("now", "label").alias("label")), f"{name}_labels")

    labels, crowds = None, []
    for first, last in ((0, EARLY), (EARLY, segments)):
        if first < last and first < segments:
            met = stored(_met(points(labels, first, min(last, segments)), at_most(64, LOOSE_FIRST)), f"met{first}")
            labels = linked(_chained(met), labels, f"chained{first}")
            crowds.append(met.where("crowded").select("key", "id"))

    # What these leave: pairs of crowded buckets that are in different groups still, by BLOCK members at a time
    crowded = functools.reduce(DataFrame.unionByName, crowds).join(labels, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    mixed = crowded.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    some = print_[:FEW_WORDS]
    driver_gives_back(docs.sparkSession)
    members = stored(crowded.join(mixed, "key").withColumn("block", F.expr("pmod(xxhash64(id), blocks)")), "members")
    buckets = members.groupBy("id").agg(F.collect_set("key").alias("keys"))
    members = stored(members.join(buckets.join(left, "id"), "id"), "prints")
    mine = members.select("key", "keys", "id", "label", *print_, F.col("block").alias("own"), F.expr("explode(sequence(block, blocks - 1))").alias("block"))
    theirs = members.select("key", F.col("keys").alias("o_keys"), "block", F.col("id").alias("other"), F.col("label").alias("other_label"), *[F.col(c).alias(f"o_{c}") for c in print_])
    apart = (F.col("label") != F.col("other_label")) & ((F.col("own") < mine["block"]) | (F.col("id") < F.col("other"))) & (differ(some) <= at_most(64 * len(some), LOOSE_FIRST)) & close
    once = F.array_min(F.array_intersect("keys", "o_keys")) == mine["key"]  # a pair that meets in many buckets comes from the first
    rest = mine.join(theirs, (mine["key"] == theirs["key"]) & (mine["block"] == theirs["block"]) & apart & once)
    labels = linked(rest.select(F.greatest("id", "other").alias("id"), F.least("id", "other").alias("other")).distinct(), labels, "rest", compared=True)

    ids = classes.select("class", "id").join(labels, F.col("id") == F.col("node"), "left").select("class", F.coalesce("label", "id").alias("group_id"))
    return of.select("doc_id", "class").join(ids, "class").select("doc_id", "group_id")


#: Ids to drop that may be sent to all tasks (8 bytes each).
BROADCAST = 2_000_000


def keep_one(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", broadcast: int = BROADCAST) -> DataFrame:
    """docs without the near duplicates of a smaller doc_id; columns as they are."""
    name = unused(docs, "_gone")[0]
    gone = stored(near_duplicates(docs, similarity, shingle, id_col=id_col, text_col=text_col).where("doc_id <> group_id").select(F.col("doc_id").alias(name)).distinct(), "gone")
    side = F.broadcast(gone) if gone.count() <= broadcast else gone
    return docs.join(side, F.col(quoted(id_col)).cast("long") == F.col(name), "left_anti")
