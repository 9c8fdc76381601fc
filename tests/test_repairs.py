"""Scripts beside each other, JSON null, shard order, replays and search patterns."""

import random

import pytest
from pyspark.sql import functions as F

from versica.functions import script
from versica.functions.similarity import filled
from versica.operators import extras, matching, search
from versica.sources import corpus, paths
from versica.streaming import ingest

RECORD = "rec_id long, title string, author string, dynasty string, lines array<string>, ref_title string, ref_author string, ref_dynasty string, ref_lines array<string>"


@pytest.mark.parametrize(("own", "ref", "want"), [("壯士一去兮不復□", "壯士一去兮不復還", "壯士一去兮不復還"), ("壮士一去兮不复□", "壯士一去兮不復還", "壮士一去兮不复還"), ("壯士一去兮不復□", "壮士一去兮不复还", "壯士一去兮不復还"), ("風[缺]兮易水寒", "风萧萧兮易水寒", "風萧萧兮易水寒")])
def test_gaps_are_filled_across_scripts(spark, own, ref, want):
    rows = spark.createDataFrame([(1, "t", "a", "d", [own], "t", "a", "d", [ref])], RECORD)
    (got,) = matching.decide(rows).collect()
    (change,) = got.changes
    assert got.status == "corrected" and (change.field, change.new, change.confidence) == ("body", want, matching.CONFIDENCE["filled"])


def test_filled_keeps_the_line_around_the_gap():
    assert filled("a，□c [x] e", "abc, d e") == "a，bc d e" or filled("a，□c", "abc") == "a，bc"
    assert filled("a□c", "xyz") == "a□c" and filled("abc", "abd") == "abc" and filled("□", "ab") == "ab" and filled("a□", "A b", "a□", "a b") == "ab"


@pytest.mark.parametrize(("record", "want"), [('{"a": null, "b": "x"}', None), ('{"b": "x"}', "x"), ('{"a": "", "b": "x"}', ""), ('{"a": {"c": null}, "b": "x"}', '{"c":null}'), ("{}", None), (None, None)])
def test_json_null_that_is_there_counts(spark, record, want):
    df = spark.createDataFrame([(record,)], "r string")
    assert df.select(paths.value(F.col("r"), "$.a|$.b")).first()[0] == want


def test_json_null_inside(spark):
    df = spark.createDataFrame([('{"a": {"c": null}, "b": ["x", null]}',)], "r string")
    get = lambda path: df.select(paths.value(F.col("r"), path)).first()[0]
    assert get("$.a.c|$.b[0]") is None and get("$.a.d|$.b[0]") == "x" and get("$.b[1]|$.b[0]") is None and get("$.b[5]|$.b[0]") == "x"


def test_shards_come_in_natural_order(spark):
    rows = [(0, f, k) for f in ("poet.10000.json", "poet.2000.json", "poet.0.json", "other.5.json") for k in (0, 1)]
    got = corpus.numbered(spark.createDataFrame(rows, "dataset_no int, file string, ordinal int")).orderBy("work_id").collect()
    assert [(r.file, r.ordinal) for r in got] == [(f, k) for f in ("other.5.json", "poet.0.json", "poet.2000.json", "poet.10000.json") for k in (0, 1)]
    assert [r.work_id for r in got] == list(range(1, 9))


def test_replay_moves_keys_and_takes_the_last(spark, tmp_path):
    src, out, log = (str(tmp_path / x) for x in ("in", "out", "log"))
    schema = "uid string, g string, n int"

    def load(rows):
        spark.createDataFrame(rows, schema).write.mode("append").json(src)
        ingest.replay(ingest.stream(spark, src, schema), out, log, ["g"], "uid", "n").awaitTermination()
        return sorted((r.uid, r.g, r.n) for r in spark.read.schema(schema).parquet(out).collect())

    assert load([("a", "x", 1), ("a", "x", 5), ("a", "x", 3), ("b", "y", 2)]) == [("a", "x", 5), ("b", "y", 2)]
    assert load([("b", "z", 9), ("c", "x", 1)]) == [("a", "x", 5), ("b", "z", 9), ("c", "x", 1)]


def test_patterns_are_the_tokens(spark):
    """A phrase by its pattern is found where the token string holds it, on random texts of two scripts."""
    pick = random.Random(4)
    texts = ["".join(pick.choice("ab1 明月風，.-ÉZ") for _ in range(pick.randrange(14))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").cache()
    for q in ("a", "ab", "a b", "明", "明月", "a明", "明 a", "明月 1", "風", "1b", "É z", "ab 明 b"):
        own = f" {' '.join(script.token_list(script.fold_text(q)))} "
        want = sorted(t for t in texts if own in f" {' '.join(script.token_list(script.fold_text(t)))} ")
        assert sorted(r.t for r in df.where(search.phrase(F.col("t"), q)).collect()) == want, q


def test_search_folds_and_splits_once(spark):
    works = spark.createDataFrame([(1, "x\nof the", "d", "e")], "work_id long, body string, dataset string, dynasty string")
    plan = search.found_in(works, "of the").agg(F.sum(F.size("lines")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") <= 1 and plan.count("split(") == 1, plan


def test_shards_of_bytes(spark):
    rows = [(k, "x" * (k * 7 % 50)) for k in range(500)]
    got = {r.k: r.shard for r in extras.sized_shards(spark.createDataFrame(rows, "k long, t string"), "k", F.length("t"), 300).collect()}
    total = 0
    for k, t in rows:
        assert got[k] == total // 300
        total += len(t)
