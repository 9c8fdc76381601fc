import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from versica.llm import mixing, packing
from versica.llm.queries import QUERIES, tokenizer_path


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=200))
def test_best_fit(sizes):
    s = np.array(sizes, np.int64)
    bins, offsets, n = packing.best_fit(s, 100)
    places = defaultdict(list)
    for b, o, x in zip(bins, offsets, sizes, strict=True):
        places[b].append((o, x))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([x for _, x in own])[:-1]] and sum(x for _, x in own) <= 100
    assert n == len(places) and n <= max(1, -(-sum(sizes) // 100) * 2)


@pytest.fixture(scope="module")
def tokens():
    return packing.Tokens(tokenizer_path())


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" \n\t'\"sSdtLlabÀéß12.,-!¿¡·ñçŒœ<|>", max_size=60))
def test_words_give_the_tokenizers_ids(tokens, text):
    assert tokens.by_words and tokens.ids(text) == tokens._whole(text)


def check(rows, docs, sequence=4096):
    tok = packing.Tokens(tokenizer_path())
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([x for _, x in own])[:-1]] and sum(x for _, x in own) <= sequence
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    wanted = defaultdict(list)
    for i, text in docs:
        ids = tok._whole(text or "") + np.array([1], "<u4").tobytes()
        want = [(k, at // 4, len(ids[at : at + 4 * sequence]) // 4, zlib.crc32(ids[at : at + 4 * sequence])) for k, at in enumerate(range(0, len(ids), 4 * sequence))]
        wanted[i] += want
    assert {i: Counter(x) for i, x in pieces.items()} == {i: Counter(x) for i, x in wanted.items()}
    return len(by)


def test_packing_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op5_packing"](spark, SF).collect()
    n = check(rows, docs)
    assert n <= 1.01 * sum(r.length for r in rows) / 4096 + 1


def test_packing_of_odd_rows(spark, odd, empty):
    rows = packing.pack(odd.repartition(5), tokenizer_path(), sequence=64).collect()
    check(rows, [(r.doc_id, r.text) for r in odd.collect()], 64)
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_mixing_limits_repetition(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2500, "big").when(F.col("id") < 2950, "mid").otherwise("small").alias("source"), F.lit("one two three").alias("text"))
    got = mixing.plan(df, repeats=3.0)
    by = {r.source: r.t for r in got.groupBy("source").agg((F.sum("n_tokens") / 3).alias("t")).collect()}
    assert by["big"] == 2500 and abs(by["small"] / 50 - 3) < 0.05 and 1 < by["mid"] / 450 < 3
    assert got.groupBy("doc_id", "epoch").count().where("count > 1").count() == 0
    places = got.groupBy("source", "epoch", "block_rank").agg(F.count("*").alias("n"), F.max("place").alias("p")).collect()
    assert all(r.n == r.p for r in places)


def test_mixing_meets_entropy(spark):
    import math

    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2500, "big").when(F.col("id") < 2950, "mid").otherwise("small").alias("source"), F.lit("one two three").alias("text"))
    got = {r.source: r.t for r in mixing.plan(df, repeats=None, entropy=0.9).groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    total = sum(got.values())
    assert abs(-sum(t / total * math.log(t / total) for t in got.values()) - 0.9) < 0.01
    few = mixing.plan(df, budget=900).agg(F.sum("n_tokens")).first()[0]
    assert 880 <= few <= 900
    with pytest.raises(ValueError):
        mixing.plan(df, repeats=2.0, entropy=1.0)


def test_mixing_meets_entropies_on_both_sides_of_the_natural_one(spark):
    import math

    df = spark.range(700).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 400, "a").when(F.col("id") < 600, "b").otherwise("c").alias("source"), F.lit("one two three").alias("text"))
    for target in (0.6, 0.9, 1.05):
        got = {r.source: r.t for r in mixing.plan(df, repeats=None, entropy=target).groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
        total = sum(got.values())
        assert abs(-sum(t / total * math.log(t / total) for t in got.values()) - target) < 0.02
    even = df.withColumn("source", (F.col("doc_id") % 3).cast("string")).where("doc_id < 600")
    for bad in (0.3, 1.2):  # three equal sources have log 3 whatever the exponent
        with pytest.raises(ValueError, match="no exponent"):
            mixing.plan(even, repeats=None, entropy=bad)
    assert mixing.plan(even, repeats=None, entropy=math.log(3)).count() == 600


def test_ranges_give_the_order_of_one_window(spark):
    """Ranks and budgets by ranges are those of a window over the whole source and epoch."""
    from pyspark.sql.window import Window as W

    df = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 45_000, "big").otherwise("small").alias("source"), F.lit("one two").alias("text"))
    placed = mixing._placed(df, repeats=1.5)
    ranked = placed.select("source", "epoch", "turn", "block_rank").distinct().withColumn("want", F.row_number().over(W.partitionBy("source", "epoch").orderBy("turn")))
    assert ranked.count() > 60 and ranked.where("want <> block_rank").count() == 0


def test_mixed_rows_lie_in_the_order_of_the_permutation(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("source"), F.lit("one two").alias("text"))
    plan = mixing.mix(df, repeats=1.0)._jdf.queryExecution().executedPlan().toString()
    assert "Sort [_epoch" in plan and [r.doc_id for r in mixing.mix(df.coalesce(1), repeats=1.0).limit(50).collect()] != list(range(50))


def test_mixing_of_odd_rows(odd, empty):
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and {r.doc_id for r in mixed.collect()} == {r.doc_id for r in odd.collect()}
    assert mixing.mix(empty).count() == 0


def test_the_mixture_sorts_no_text_by_id(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * (i % 7 + 1), f"s{i % 3}") for i in range(50)], "doc_id long, text string, source string")
    mixed = mixing.mix(docs, repeats=2.0)
    mixed.collect()
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin [coalesce" not in plan
