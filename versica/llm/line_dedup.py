"""Line dedup: lines found in many documents stay only in one of them.

1. Every task hashes its documents' line keys; each distinct hash is stored once a task, as 8 bytes. Their number gives the
   number of slices of the hash space (PER_SLICE hashes each, so it grows with the input) and the size of the filters.
2. The owner of a slice streams its hashes through two Bloom filters, of BITS bits a hash: a hash that the once-seen filter
   already holds enters the twice-seen one, whose size follows from the number of such hashes. Only twice-seen filters leave it.
3. Lines whose hash is in the twice-seen filters are suspected repeats. Only these shuffle, with their whole key, and are
   counted exactly. Filters go to all tasks as long as they have FILTER_BYTES together; beyond that the texts are read once for
   each group of slices that has so much. A false hit lets a line through to the exact count; it never changes the result.
4. Repeats confirmed are dropped where they do not stay. Up to BROADCAST of them go to all tasks, as sorted arrays of 128-bit
   digests and keeping doc_ids (24 bytes each); beyond that, decisions meet their documents in a join on doc_id.

Defined cases: a null or empty text is one empty line; a line twice in a document counts once, and both go or stay; null
doc_ids never hold a line (they lose none and count for none); repeated rows of a doc_id are one document; a tie can't
occur, as the largest doc_id stays; a text whose lines are all dropped becomes empty; very long texts are split whole; an empty
table gives no rows; extra columns stay as they are, and new ones get underscores before their names where docs has such columns.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from versica.llm.common import binary, id_text, in_arrow, quoted, same_columns, stored, unused

#: Hashes of a slice, about; bits of a filter for each hash in it (false hits under 1 %); probes of a filter.
PER_SLICE, BITS, PROBES = 1 << 21, 12, 4
#: Bytes of twice-seen filters that may be sent to all tasks.
FILTER_BYTES = 256 << 20
#: Confirmed repeats that may be sent to all tasks (24 bytes each).
BROADCAST = 500_000
STRIP = bytes([0x20, *range(9, 14)])


def line_keys(text: bytes, least: int) -> list[tuple[bytes, int]]:
    """(key, xxh64) of the lines that are long enough; bytes.lower() changes A-Z only."""
    out = []
    for line in text.split(b"\n"):
        if len(line) >= least:
            key = line.strip(STRIP).lower()
            if len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least):
                out.append((key, xxhash.xxh64_intdigest(key)))
    return out


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit positions of each hash, by double hashing of its lower and its mixed upper half."""
    a = h & np.uint64(0xFFFFFFFF)
    b = (h >> np.uint64(29)) * np.uint64(0x9E3779B1) | np.uint64(1)
    return (a[:, None] + b[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(bits - 1)


def _has(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _put(filter_: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(filter_, at.ravel() >> np.uint64(3), np.left_shift(np.uint8(1), (at.ravel() & np.uint64(7)).astype(np.uint8)))


def _slice_of(h: np.ndarray, slices: int) -> np.ndarray:
    """Slice of a hash, of a power of two."""
    return (h >> np.uint64(64 - max(1, slices.bit_length() - 1))).astype(np.int32) if slices > 1 else np.zeros(len(h), np.int32)


def _power(n: float) -> int:
    """The smallest power of two that is n at least."""
    return 1 << max(0, int(np.ceil(np.log2(max(1, n)))))


def _hashes(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []

        def out() -> pa.RecordBatch:
            # a hash that this task holds twice is sent twice, so that the owner sees a repeat
            h, n = np.unique(np.array(held, np.uint64), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(h, np.minimum(n, 2)).view(np.int64))], ["h"])

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), binary(b.column("text")), strict=True):
                if doc_id is not None:
                    held.extend({h for _, h in line_keys(text, least)})
                if len(held) >= 1_000_000:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return run


def _filters(slices: int, once_bits: int, bits: int):
    """(slice, twice-seen filter, its size in bits) of a task's slices; a filter's size is a power of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, list[np.ndarray]] = {}
        for b in batches:
            h = b.column("h").to_numpy().view(np.uint64)
            s = _slice_of(h, slices)
            for k in np.unique(s).tolist():
                if k not in once:
                    once[k], twice[k] = np.zeros(max(1, once_bits // 8), np.uint8), []
                own, n = np.unique(h[s == k], return_counts=True)
                at = _positions(own, once_bits)
                again = (n > 1) | _has(once[k], at)
                _put(once[k], at)
                twice[k].append(own[again])
                if len(twice[k]) > 64:
                    twice[k] = [np.unique(np.concatenate(twice[k]))]
        for k, parts in twice.items():
            own = np.unique(np.concatenate(parts))
            if len(own):
                size = _power(max(8, bits * len(own)))
                filter_ = np.zeros(size // 8, np.uint8)
                _put(filter_, _positions(own, size))
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(filter_.tobytes(), 1)], pa.binary()), pa.array([size // 8], pa.int64())], ["slice", "bits", "n_bytes"])

    return run


def _suspects(least: int, filters, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {k: np.frombuffer(zlib.decompress(v), np.uint8) for k, v in filters.value.items()}
        for b in batches:
            ids, keys, hashes = [], [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), binary(b.column("text")), strict=True):
                if doc_id is not None:
                    for key, h in dict(line_keys(text, least)).items():
                        ids.append(doc_id)
                        keys.append(key)
                        hashes.append(h)
            if ids:
                h = np.array(hashes, np.uint64)
                hit, s = np.zeros(len(h), bool), _slice_of(h, slices)
                for k in np.unique(s).tolist():
                    if k in own:
                        hit[s == k] = _has(own[k], _positions(h[s == k], 8 * len(own[k])))
                at = np.flatnonzero(hit)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in at], pa.binary()), pa.array(np.array(ids, np.int64)[at])], ["key", "doc_id"])

    return run


def suspected(docs: DataFrame, least: int = 20, per_slice: int = PER_SLICE, bits: int = BITS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Lines (key, doc_id) of docs(doc_id, text) whose hash the filters take for one seen twice."""
    spark = docs.sparkSession
    hashes = stored(in_arrow(docs, _hashes(least), "h long"), "line_hashes")
    n = hashes.count()
    slices = _power(max(n / per_slice, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    once_bits = _power(max(8, bits * n / slices))
    dealt = hashes.repartition(slices, F.shiftrightunsigned("h", 64 - slices.bit_length() + 1) if slices > 1 else F.lit(0))
    filters = stored(in_arrow(dealt, _filters(slices, once_bits, bits), "slice int, bits binary, n_bytes long", 1 << 18), "filters")
    groups: list[list[int]] = [[]]
    size = 0
    for r in filters.select("slice", "n_bytes").orderBy("slice").toLocalIterator():  # a number for each PER_SLICE hashes
        if groups[-1] and size + r.n_bytes > filter_bytes:
            groups.append([])
            size = 0
        groups[-1].append(r.slice)
        size += r.n_bytes
    out = None
    for own in groups:
        held = filters.where(F.col("slice").between(own[0], own[-1])).collect() if own else []  # of filter_bytes at most
        sent = spark.sparkContext.broadcast({r.slice: bytes(r.bits) for r in held})
        part = in_arrow(docs, _suspects(least, sent, slices), "key binary, doc_id long")
        out = part if out is None else out.unionByName(part)
    return out


def confirmed(docs: DataFrame, least: int = 20, docs_least: int = 3, per_slice: int = PER_SLICE, bits: int = BITS, filter_bytes: int = FILTER_BYTES) -> tuple[DataFrame, DataFrame]:
    """(suspected lines (key, doc_id), confirmed repeats (key, keep_doc)) of docs(doc_id, text)."""
    lines = suspected(docs, least, per_slice, bits, filter_bytes)
    # a document may come as several equal rows: (key, doc_id) is made distinct before keys are counted
    repeats = lines.distinct().groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_doc")).where(F.col("n") >= docs_least)
    return lines, stored(repeats.select("key", "keep_doc"), "repeats")


def _rewrite(least: int, goes_of, schema: pa.Schema, text_at: int, id_at: int, drop_at: int | None):
    """Rewrites texts. goes_of() gives a function of (doc_ids, keys, sets of dropped keys or None) -> numbers of the lines that go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goes = goes_of()
        for b in batches:
            ids, every, keys, place = b.column(id_at).to_pylist(), [], [], []
            for i, text in enumerate(binary(b.column(text_at))):
                every.append((text or b"").split(b"\n"))
                if ids[i] is not None:
                    for j, line in enumerate(every[-1]):
                        if len(line) >= least:
                            key = line.strip(STRIP).lower()
                            if len(key) >= least:
                                keys.append(key)
                                place.append((i, j))
            drops = None if drop_at is None else [frozenset(x or ()) for x in b.column(drop_at).to_pylist()]
            gone: dict[int, set[int]] = {}
            for k in goes([ids[i] for i, _ in place], keys, drops and [drops[i] for i, _ in place]):
                gone.setdefault(place[k][0], set()).add(place[k][1])
            texts = [b"\n".join(lines if i not in gone else [x for j, x in enumerate(lines) if j not in gone[i]]).decode() for i, lines in enumerate(every)]
            new = {text_at: pa.array(texts, schema.field(text_at).type)}
            kept = [new.get(i, b.column(i)) for i in range(len(schema) - 2)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([len(x) for x in every], pa.int64()), pa.array([len(gone.get(i, ())) for i in range(len(every))], pa.int64())], schema=schema)

    return run


def _digests(keys: list[bytes]) -> np.ndarray:
    """MD5 of each key, as two numbers."""
    return np.frombuffer(b"".join(hashlib.md5(k).digest() for k in keys), "<u8").reshape(-1, 2)


def dedup_lines(docs: DataFrame, least: int = 20, docs_least: int = 3, id_col: str = "doc_id", text_col: str = "text", broadcast: int = BROADCAST, per_slice: int = PER_SLICE, bits: int = BITS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """docs with rewritten texts and two more columns at the end, _n_lines and _n_dropped; other columns stay as they are."""
    spark = docs.sparkSession
    lines, repeats = confirmed(id_text(docs, id_col, text_col), least, docs_least, per_slice, bits, filter_bytes)
    out = StructType([*docs.schema.fields, *[StructField(name, LongType()) for name in unused(docs, "_n_lines", "_n_dropped")]])
    schema, text_at, id_at = to_arrow_schema(out), docs.columns.index(text_col), docs.columns.index(id_col)
    if repeats.count() <= broadcast:
        held = repeats.select(F.unhex(F.md5("key")).alias("digest"), "keep_doc").toArrow()  # 24 bytes each
        digests = np.frombuffer(b"".join(held["digest"].to_pylist()), "<u8").reshape(-1, 2)
        order = np.lexsort((digests[:, 1], digests[:, 0]))
        table = spark.sparkContext.broadcast((digests[order, 0].copy(), digests[order, 1].copy(), held["keep_doc"].to_numpy()[order]))

        def found_of():
            high, low, keep = table.value

            def goes(ids: list[int], keys: list[bytes], _) -> list[int]:
                if not keys or not len(high):
                    return []
                own, ids_ = _digests(keys), np.array(ids, np.int64)
                at = np.searchsorted(high, own[:, 0])
                hit = np.zeros(len(keys), bool)
                while True:  # equal first halves are as good as never met, but each is looked at
                    live = (at < len(high)) & (high[np.minimum(at, len(high) - 1)] == own[:, 0])
                    if not live.any():
                        return np.flatnonzero(hit).tolist()
                    here = np.minimum(at, len(high) - 1)
                    hit |= live & (low[here] == own[:, 1]) & (keep[here] != ids_)
                    at = np.where(live, at + 1, len(high))

            return goes

        return in_arrow(docs, _rewrite(least, found_of, schema, text_at, id_at, None), out)
    doc, drop = unused(docs, "_doc", "_drop")
    gone = lines.distinct().join(repeats, "key").where("doc_id <> keep_doc").groupBy(F.col("doc_id").alias(doc)).agg(F.collect_set("key").alias(drop))  # of one document's lines
    met = docs.join(gone, F.col(quoted(id_col)).cast("long") == F.col(doc), "left").select(*same_columns(docs), drop)

    def listed_of():
        return lambda ids, keys, drops: [k for k, (key, own) in enumerate(zip(keys, drops, strict=True)) if key in own]

    return in_arrow(met, _rewrite(least, listed_of, schema, text_at, id_at, len(docs.columns)), out)
