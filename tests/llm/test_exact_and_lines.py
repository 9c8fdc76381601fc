import hashlib
import re
import uuid
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, rows_of
from versica.llm import exact_dedup, line_dedup
from versica.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    assert rows_of(QUERIES[name](spark, SF).toArrow()) == rows_of(duck.sql(ORACLE[name]).to_arrow_table())


@pytest.fixture
def index(spark):
    i = exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", 3)
    yield i
    i.drop()


def test_exact_dedup_of_odd_rows(index, odd):
    got = sorted((r.doc_id if r.doc_id is not None else -99, r.keep_id, r.group_size, r.kept) for r in index.add(odd).collect())
    assert got[0] == (-99, 2, 4, False) and [g for g in got if g[0] in (1, 2)] == [(1, 2, 4, False), (2, 2, 4, True), (2, 2, 4, True)]
    assert [g for g in got if g[0] in (3, 4)] == [(3, 4, 2, False), (4, 4, 2, True)] and len(got) == odd.count()


def test_exact_dedup_of_later_batches(spark, index):
    df = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.kept) for r in index.add(df([(1, "a"), (2, "a"), (3, "b")])).collect()} == {(1, False), (2, True), (3, True)}
    later = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in index.add(df([(0, "b"), (9, "a"), (10, "c"), (11, "c")])).collect()}
    assert later == {(0, 3, 2, False), (9, 9, 3, True), (10, 11, 2, False), (11, 11, 2, True)} and index.read().count() == 3


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_exact_dedup_in_batches_is_the_same(spark, index, duck, batches):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(index.add(docs, batches).toArrow()) == rows_of(duck.sql(ORACLE["op7_exact_dedup"]).to_arrow_table())


@pytest.mark.parametrize("hot", [1, 10**9])
def test_hot_digests_either_way(index, odd, monkeypatch, hot):
    monkeypatch.setattr(exact_dedup, "HOT", hot)
    got = {(r.doc_id, r.keep_id, r.group_size) for r in index.add(odd).collect()}
    assert {(1, 2, 4), (2, 2, 4), (None, 2, 4), (3, 4, 2), (4, 4, 2)} <= got


def test_new_digests_are_found_by_a_sort_merge_anti_join(spark, index):
    index.add(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 2)
    groups = spark.createDataFrame([(b"x" * 32, 1, 1)], "digest binary, keep_id long, group_size long").groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    plan = index.fresh(groups)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[digest[^\n]*LeftAnti", plan) and plan.count("Exchange hashpartitioning") == 1, plan


def test_exact_dedup_drops_its_index(spark):
    before = {t.name for t in spark.catalog.listTables()}
    QUERIES["op7_exact_dedup"](spark, SF).count()
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("name", ["op7_exact_dedup", "op10_mixing"])
def test_plans_are_native(spark, name):
    assert not re.search("Python|Arrow|Pandas", QUERIES[name](spark, SF)._jdf.queryExecution().toString())


def test_exact_dedup_of_nothing(index, empty):
    assert index.add(empty).count() == 0


def brute(rows, least=20, docs_least=3):
    strip = lambda s: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", s)
    key = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), strip(s))
    seen = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= least:
                seen[key(line)].add(i)
    keep = {k: max(v) for k, v in seen.items() if len(v) >= docs_least}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or keep.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_line_dedup_both_ways(odd, broadcast):
    got = line_dedup.dedup_lines(odd, broadcast=broadcast).collect()
    assert sorted(((r.doc_id, r[-2], r[-1], hashlib.sha256(r.text.encode()).hexdigest()) for r in got), key=repr) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert {(r.digest, r._drop, r._n_lines, r._doc) for r in got} == {("clash",) * 4} and len(got[0]) == len(odd.columns) + 2


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_line_dedup_of_documents(spark, broadcast):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = line_dedup.dedup_lines(docs, broadcast=broadcast).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(((r.doc_id, r[-2], r[-1], hashlib.sha256(r.text.encode()).hexdigest()) for r in got), key=repr) == want and sum(w[2] for w in want) > 0


@pytest.mark.parametrize("sizes", [{"per_slice": 10**9, "bits": 1}, {"per_slice": 1}, {"filter_bytes": 1}, {"per_slice": 3, "filter_bytes": 4}])
def test_sizes_of_filters_change_nothing(odd, sizes):
    """Full filters, many slices, and texts read once for each group of slices."""
    got = line_dedup.dedup_lines(odd, **sizes).collect()
    assert sorted(((r.doc_id, r[-1]) for r in got), key=repr) == sorted(((i, d) for i, _, d, _ in brute([(r.doc_id, r.text) for r in odd.collect()])), key=repr)


@pytest.mark.parametrize("n", [2_000, 20_000])
def test_filters_grow_with_the_lines(spark, n):
    """At ten times the lines there are as few false suspects."""
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(*[F.concat(F.sha1(F.concat(F.col("id").cast("string"), F.lit(f"-{k}"))), F.lit("\n")) for k in range(10)], F.sha1((F.col("id") % (n // 3)).cast("string"))).alias("text"))
    suspects = line_dedup.suspected(docs).count()
    assert n <= suspects <= n + 0.05 * 10 * n


def test_slices_and_positions():
    h = np.random.default_rng(1).integers(0, 1 << 64, 50_000, dtype=np.uint64)
    for slices in (1, 2, 64):
        s = line_dedup._slice_of(h, slices)
        assert s.min() >= 0 and s.max() < slices and len(set(s.tolist())) == slices


def test_line_dedup_of_nothing(empty):
    assert line_dedup.dedup_lines(empty).count() == 0
