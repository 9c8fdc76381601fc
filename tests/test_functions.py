import difflib
import uuid

import pytest
from pyspark.sql import functions as F

from versica.functions import ids, score, script, similarity


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def each(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_fold_keeps_length_and_phrases(spark):
    plain = ["春風", "靜夜思", "後宮", "乾燥", "乾隆", "頭髮", "一隻", "舃", "𠀀春", "", "abc"]
    folded = each(spark, plain, script.fold)
    assert folded[:9] == ["春风", "静夜思", "后宫", "干燥", "乾隆", "头发", "一只", "舄", "𠀀春"] and folded[10] == "abc"
    assert all(len(a) == len(b) for a, b in zip(plain, folded, strict=True))


def test_norm_text_is_a_fixed_point(spark):
    once = each(spark, ["春 風　不\t相識", None, "積善忻餘慶"], script.norm_text)
    assert once[0] == "春风不相识" and once[1] == ""
    assert each(spark, once, script.norm_text) == once


def test_anonymous_authors(spark):
    assert each(spark, ["無名氏", "不詳", "佚名", "王氏", "花蕊夫人徐氏", "南唐失名僧", None], script.norm_author) == ["", "", "", "王氏", "花蕊夫人徐氏", "", ""]


def test_segment_and_tokens(spark):
    assert each(spark, ["春风", "春abc风", "明，月", "abc 12"], script.segment) == ["春 风", "春 abc 风", "明， 月", "abc 12"]
    assert each(spark, ["明，月Abc 12x"], script.tokens) == [" 明 月 abc 12x "]


def test_sentences_and_verses(spark):
    assert each(spark, ["一二。三四", "x" * 200], script.first_sentence) == ["一二。", "x" * 120]
    assert each(spark, ["一。二！\n三<p>四</p>", None], script.split_verses) == [["一。", "二！", "三", "四"], []]


def test_ids(spark):
    packed = one(spark, ids.make_id(F.lit(5), F.lit(1), F.lit(77)))
    assert packed == (5 << 26) | (1 << 23) | 77
    assert one(spark, F.array(ids.dynasty_of(F.lit(packed)), ids.kind_of(F.lit(packed)), ids.sequence_of(F.lit(packed)))) == [5, 1, 77]
    with pytest.raises(Exception, match="out of range"):
        one(spark, ids.make_id(F.lit(5), F.lit(1), F.lit(1 << 23)))


def test_uids_are_version_five(spark):
    want = str(uuid.uuid5(uuid.UUID(ids.POEM_SPACE), "\x01".join(["tang", "李白", "静夜思", "床前"])))
    assert one(spark, ids.content_uid(F.lit("tang"), F.lit("李白"), F.lit("静夜思"), F.lit("床前"))) == want
    assert one(spark, ids.author_uid(F.lit("李白"), F.lit(None).cast("string"))) == str(uuid.uuid5(uuid.UUID(ids.AUTHOR_SPACE), "李白\x01"))


def test_tones(spark):
    for s in ("平仄，。○？通", "平", "平x仄7", ""):
        packed = one(spark, ids.pack_tones(F.lit(s)))
        assert len(packed) == -(-len(s) // 2)
        assert one(spark, ids.unpack_tones(F.lit(packed), F.lit(len(s)))) == s.replace("x", "?").replace("7", "?")


def test_bands(spark):
    got = each(spark, list(range(101)), score.band, "int")
    assert [got[s] for s in (100, 90, 89, 88, 1, 0)] == [1, 1, 2, 2, 46, 46] and got == sorted(got, reverse=True)
    table = {r.band: (r.low, r.high) for r in score.bands(spark.range(1)).collect()}
    assert sorted(x for lo, hi in table.values() for x in range(lo, hi + 1)) == list(range(101))
    for bad in (-1, 101, None):
        with pytest.raises(Exception, match="out of range"):
            each(spark, [bad], score.band, "int")


def test_shrunken_mean_and_rank(spark):
    df = spark.createDataFrame([("u1", 80), ("u1", 50), ("u2", 70), ("u3", 70), ("", 9), (None, 9), ("u4", 0)], "a string, s int")
    got = {r.author_id: (r.n, r.score, r["rank"]) for r in score.competition_rank(score.shrunk(df, "a", "s")).collect()}
    assert got == {"u1": (2, 67, 3), "u2": (1, 68, 1), "u3": (1, 68, 1)}


def test_evaluate_rounds_ties_to_even(spark):
    hits = {e: F.lit(10**6) for e in score.ENGINES}
    got = one(spark, score.evaluate(hits, F.lit(4.5), {k: F.lit(True) for k in ("translation", "notes", "appreciation", "introduction", "images")}))
    assert (got.breadth, got.span, got.depth, got.now, got.composite, got.stars) == (5.0, 5.0, 5.0, 5.0, 100, 5)


def test_ratio_and_gaps(spark):
    df = spark.createDataFrame([("abcdef", "abdef"), ("", ""), (None, "x")], "a string, b string")
    assert [r.x for r in df.select(similarity.ratio("a", "b").alias("x")).collect()] == [difflib.SequenceMatcher(None, "abcdef", "abdef").ratio(), 1.0, 0.0]
    assert similarity.filled("風蕭蕭兮，壯士不復□。", "風蕭蕭兮，壯士不復回。") == "風蕭蕭兮，壯士不復回。"
    assert similarity.filled("無□有", "別的") == "無□有"


def test_three_way_merge(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["a", "B", "c"], ["a", "b", "C"])], "b array<string>, x array<string>, y array<string>")
    assert df.select(similarity.merged_lines("b", "x", "y").alias("m")).first().m == ["a", "B", "C"]


def test_driver_side_forms_agree(spark):
    plain = ["明，月Abc 12x", "春風 乾隆 ²½ x_y", "ÉÀß İ", "", "—…", "𠀀春a"]
    assert each(spark, plain, script.fold) == [script.fold_text(s) for s in plain]
    assert [t.split() for t in each(spark, plain, script.tokens)] == [script.token_list(s) for s in plain]


@pytest.fixture(scope="module")
def large_keys(spark, tmp_path_factory):
    """Orders whose keys have more bits than a sequence, and one that fills it."""
    path = str(tmp_path_factory.mktemp("orders"))
    keys = [(1, 4, 1), (77, 4, 0), ((1 << 23) - 1, 4, 1), (1 << 23, 4, 0), ((1 << 23) + 5, 22, 1), ((1 << 26) + 9, 3, 0), ((1 << 31) + 3, 21, 2), (9_000_000, 17, 5)]
    spark.createDataFrame([(k, c, f"{p}-X") for k, c, p in keys], "o_orderkey long, o_custkey long, o_orderpriority string").coalesce(1).write.parquet(f"{path}/orders.parquet")
    return path


def same_as_sql(spark, path, name):
    import duckdb

    from versica.plans.queries import QUERIES, SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{path}/orders.parquet/*.parquet'")
    want = con.sql(SQL[name])
    got = QUERIES[name](spark, path).select(*want.columns)
    assert want.fetchall() and sorted(map(tuple, got.collect())) == sorted(con.sql(SQL[name]).fetchall())


@pytest.mark.parametrize("name", ["dynasty_histogram", "id_pack_parse", "id_range_filter"])
def test_keys_larger_than_a_sequence(spark, large_keys, name):
    same_as_sql(spark, large_keys, name)


def test_next_ids_of_full_segments(spark, large_keys):
    from versica.operators import store

    same_as_sql(spark, large_keys, "next_id")
    full = spark.createDataFrame([((4 << 26) | (1 << 23) | ids.SEQUENCE_MOST,)], "id long")
    with pytest.raises(Exception, match="sequence out of range"):
        store.next_ids(full).collect()
