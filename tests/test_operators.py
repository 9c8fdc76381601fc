import pytest
from pyspark.sql import functions as F

from versica.operators import export, extras, genre, matching, quality, ranking, sampling, store
from versica.sources import html, paths


def test_paths(spark):
    df = spark.createDataFrame([('{"a": {"b": [1, 2]}, "c": "x"}',)], "r string")
    got = df.select(paths.value(F.col("r"), "$.z|$.c").alias("c"), paths.values(F.col("r"), "$.a.b[*]").alias("b"), paths.values(F.col("r"), "$.c").alias("s"), paths.values(F.col("r"), "$.q").alias("q")).first()
    assert (got.c, got.b, got.s, got.q) == ("x", ["1", "2"], ["x"], [])
    for bad in ("a.b", "$..a", "$[x]"):
        with pytest.raises(ValueError):
            paths.parse(bad)
    assert paths.leaves("$.a.b|$.c") == {"b", "c"} and paths.validate({"path": "x", "kind": "shi", "body": "$.p", "root": "tree"}) == ["root 'tree'"]


def test_store_round_trips(spark):
    base = spark.createDataFrame([(1, "a", "user"), (2, "b", "built")], "id int, t string, origin string")
    assert {r.id for r in store.delete(base, base, "id", F.col("origin") == "user").collect()} == {2}
    assert store.delete(base, base, "id", F.lit(False), force=True).count() == 0
    more = spark.createDataFrame([(2, "B", "user"), (3, "c", "user")], "id int, t string, origin string")
    merged = store.upsert(base, more, "id")
    assert sorted((r.id, r.t) for r in merged.collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert store.unlisted(more, merged, ["t"]).count() == 0
    edits = spark.createDataFrame([(2, "b", "B")], "id int, old string, new string")
    after = base.withColumn("t", F.when(F.col("id") == 2, "B").otherwise(F.col("t")))
    assert all(r.n == 0 for r in store.patch_faults(base, after, edits, "id", "t").collect())
    worse = after.withColumn("t", F.upper("t"))
    assert {r.name: r.n for r in store.patch_faults(base, worse, edits, "id", "t").collect()}["untouched_changed"] == 1


def test_notes(spark):
    n = spark.createDataFrame([("a", "x"), ("b", "")], "uid string, notes string")
    got = {r.uid: r.notes for r in store.merge_notes(n, spark.createDataFrame([("a", "y"), ("b", "z"), ("c", "w")], "uid string, notes string")).collect()}
    assert got == {"a": "x\ny", "b": "z", "c": "w"}
    assert store.set_notes(n, spark.createDataFrame([("a", "")], "uid string, notes string")).count() == 0


def test_user_rows_survive_a_rebuild(spark):
    rebuilt = spark.createDataFrame([(1, "t", "u1")], "id int, title string, author_uid string")
    authors = spark.createDataFrame([("u1", "李白", 1), ("u2", "杜甫", 2), ("u3", "杜甫", 3)], "uid string, name string, id int")
    users = spark.createDataFrame([(9, "mine", "gone", "杜甫"), (10, "own", "u1", "李白")], "id int, title string, author_uid string, author_name string")
    assert {r.id: r.author_uid for r in store.snapshot_restore(rebuilt, users, authors).collect()} == {1: "u1", 9: "u3", 10: "u1"}


def test_tiers(spark):
    t = ranking.tiers(spark)
    assert [(r.tier, r.n, r.p) for r in t.groupBy("tier").agg(F.count("*").alias("n"), F.min("place").alias("p")).orderBy("tier").collect()] == [(1, 4, 1), (2, 7, 5), (3, 5, 12), (4, 9, 17), (5, 9, 26)]
    authors = spark.createDataFrame([("u1", "李白", 74, 5), ("u9", "某", 50, 2)], "author_id string, name string, score long, n long")
    known = spark.createDataFrame([("u1", "李白"), ("u2", "屈原")], "author_id string, name string")
    assert {r.author_id: (r.score, r.n) for r in ranking.overridden(authors, t, known).collect()} == {"u1": (100, 5), "u9": (50, 2), "u2": (100, 0)}
    stored = spark.createDataFrame([("u9", 999), ("u1", 88)], "author_id string, score long")
    assert [r.author_id for r in ranking.drift(stored, authors.select("author_id", "score")).collect()] == ["u9"]


def test_genres(spark):
    rows = [
        ("静夜思", ["床前明月光，疑是地上霜。", "举头望明月，低头思故乡。"], "唐", "诗"), ("水调歌头", ["明月几时有，把酒问青天。不知天上宫阙，今夕是何年。"], "宋词", "词"), ("离骚", ["帝高阳之苗裔兮，朕皇考曰伯庸。"], "先秦", "骚"),
        ("归去来兮辞", ["归去来兮，田园将芜胡不归兮，既自以心为形役兮，奚惆怅而独悲。"], "晋", "骚"), ("赤壁赋", ["壬戌之秋，七月既望，苏子与客泛舟游于赤壁之下。清风徐来，水波不兴。" * 3], "宋", "赋"), ("赋得古原草送别", ["离离原上草，一岁一枯荣。"], "唐", "诗"),
        ("岳阳楼记", ["庆历四年春，滕子京谪守巴陵郡。越明年，政通人和，百废具兴。"], "宋", "文"), ("某某长联", ["五百里滇池奔来眼底，披襟岸帻。"], "清", "联"), ("六言诗·给彭德怀同志", ["山高路远坑深，大军纵横驰奔。"], "近现代", "诗"), ("天净沙", ["枯藤老树昏鸦，小桥流水人家。"], "元曲", "曲"),
        ("再别", ["轻轻的我走了，正如我轻轻的来", *["我轻轻的招手，作别西天的云彩了吧"] * 10], "近现代", "新诗"), (None, None, "唐", "诗"),
    ]
    w = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, title string, lines array<string>, folder string, want string")
    tunes = spark.createDataFrame([("水调歌头", 700), ("归去来", 3), ("天净沙", 1)], "name string, n long")
    got = genre.classify(w, tunes, ["天净沙"], ["元曲"], ["唐", "先秦", "晋", "汉"], "近现代").orderBy("i").collect()
    assert [(r.title, r.genre) for r in got] == [(r[0], r[3]) for r in rows]


def test_decisions(spark):
    schema = "k string, title string, author string, dynasty string, lines array<string>, ref_title string, ref_author string, ref_dynasty string, ref_lines array<string>"
    poem = ["风萧萧兮易水寒，", "壮士一去兮不复还。"]
    rows = [
        ("same", "易水歌", "荆轲", "先秦", poem, "《易水歌》", "荆轲", "先秦", poem), ("marks", "易水歌", "荆轲", "先秦", poem, "易水歌", "荆轲", "先秦代", [p.replace("，", " ") for p in poem]),
        ("gap", "易水歌", "荆轲", "先秦", [poem[0], "壮士一去兮不复□。"], "易水歌", "荆轲", "先秦", poem), ("author", "易水歌", "某", "先秦", poem, "易水歌", "荆轲", "先秦", poem),
        ("missing", None, "荆轲", None, poem, "易水歌", "荆轲", "先秦", poem), ("other", "少年游", "周邦彦", "宋", ["并刀如水吴盐胜雪"], "少年游", "周邦彦", "宋", ["朝云漠漠散轻丝楼阁淡春姿"]),
        ("foreign", "少年游", "周邦彦", "宋", ["并刀如水吴盐胜雪", "纤手破新橙"], "少年游", "周邦彦", "宋", ["朝云漠漠散轻丝楼阁", "并刀如水吴盐胜雪", "纤手破新橙"]),
    ]
    decided = matching.decide(spark.createDataFrame(rows, schema)).cache()
    got = {r.k: (r.status, [(c.field, c.applied) for c in r.changes]) for r in decided.collect()}
    assert got == {"same": ("verified_ok", []), "marks": ("verified_ok", []), "gap": ("corrected", [("body", True)]), "author": ("conflict_needs_review", [("author", False)]), "missing": ("corrected", [("title", True), ("dynasty", True)]), "other": ("reference_mismatch", []), "foreign": ("reference_mismatch", [])}
    done = {r.k: r for r in matching.annotated(decided).collect()}
    assert done["gap"].lines[1] == poem[1] and done["missing"].title == "易水歌" and done["author"].author == "某"
    verdicts = spark.createDataFrame([("author", "author", True, 0.9)], "rec_id string, field string, accept boolean, confidence double")
    assert {r.rec_id: r.status for r in matching.refined(decided.withColumnRenamed("k", "rec_id"), verdicts).collect()}["author"] == "corrected"


def test_candidates(spark):
    rec = spark.createDataFrame([(1, "a", "静夜思"), (2, "a", "静夜思其二"), (3, "b", "无")], "rec_id int, author string, title string")
    ref = spark.createDataFrame([(10, "a", "《静夜思》"), (11, "a", "春晓")], "ref_id int, author string, title string")
    assert {(r.rec_id, r.ref_id) for r in matching.title_candidates(rec, ref).collect()} == {(1, 10), (2, 10)}
    c = spark.createDataFrame([(1, 10, "床前明月光", "床前明月光"), (1, 11, "床前明月光", "春眠不觉晓"), (2, 10, "床前明月光", "床前看月光"), (2, 12, "床前明月光", "床前明月亮")], "rec_id int, ref_id int, first_own string, first_ref string")
    assert [(r.rec_id, r.ref_id) for r in matching.disambiguated(c).collect()] == [(1, 10)]


def test_extras(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-01-02 03:04:05",), ("1700000000",), ("x",), (None,)], "t string")
    assert [r.x for r in df.select(extras.to_epoch(F.col("t")).alias("x")).collect()] == [1704153600, 1704164645, 1700000000, 0, 0]
    kinds = "uid string, translation string, notes string, introduction string, creative_background string, appreciation string, images array<string>, source string"
    old, new = spark.createDataFrame([("a", "t", "", "", "", "", ["1"], "s1")], kinds), spark.createDataFrame([("a", "", "n", "", "", "", ["2", "1"], "s2"), ("b", "x", "", "", "", "", None, "s2")], kinds)
    got = {r.uid: r for r in extras.merged(old, new).collect()}
    assert (got["a"].translation, got["a"].notes, got["a"].images, got["a"].source, got["a"].more_sources) == ("t", "n", ["1", "2"], "s1", ["s2"]) and got["b"].images == []
    lines = spark.createDataFrame([("f", 0, 0, "a□c")], "file string, idx int, line int, text string")
    assert extras.repaired(lines, spark.createDataFrame([("f", 0, 0, 1, "b")], "file string, idx int, line int, offset int, char string")).first().text == "abc"


def test_quality_and_samples(spark):
    df = spark.range(1000).withColumn("g", F.when(F.col("id") < 900, "big").otherwise("small"))
    s = sampling.stratified(df, ["g"], 10, "id", "x")
    assert s.groupBy("g").count().collect() == sampling.stratified(df.repartition(7), ["g"], 10, "id", "x").groupBy("g").count().collect() and s.count() == 20
    q = {r.name: (r.ok, r.bad) for r in quality.suite(quality.conditions(df, {"neg": F.col("id") < 0, "big": F.col("id") > 990}), quality.unique(df, ["g"], "g")).collect()}
    assert q == {"neg": (True, 0), "big": (False, 9), "g": (False, 2)}


def test_bundle(spark, tmp_path):
    df = spark.range(25).select("id", (F.col("id") % 2).alias("k"), F.lit("x").alias("t"))
    m = export.bundle(df, str(tmp_path / "b"), ["k"], size=5)
    assert m.agg(F.sum("n")).first()[0] == 25 and m.count() == 6
    assert spark.read.json(str(tmp_path / "b/data")).count() == 25
    export.scores(df, str(tmp_path / "s"), "id")
    assert export.read_back_faults(df, str(tmp_path / "s")) == 0


def test_html(spark):
    page = spark.createDataFrame([(1, "<title>A &amp; B</title><h1>x<b>y</b></h1><p>one\n two</p><a href=\"/q\">l&nbsp;m</a>")], "k int, h string")
    r = html.detail(page, "k", "h").first()
    assert (r.title, r.heading, r.n_paragraphs, r.first_paragraph) == ("A & B", "xy", 1, "one two")
    assert [(x.href, x.label) for x in html.links(page, "k", "h").collect()] == [("/q", "l m")]


def test_streams(spark, tmp_path):
    from versica.streaming import ingest

    src = str(tmp_path / "in")
    spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("b", "y", 2)], "uid string, g string, n int").write.json(src)
    ingest.replay(ingest.stream(spark, src, "uid string, g string, n int"), str(tmp_path / "out"), str(tmp_path / "cp"), ["g"], "uid").awaitTermination()
    spark.createDataFrame([("b", "y", 3), ("c", "y", 4)], "uid string, g string, n int").write.mode("append").json(src)
    ingest.replay(ingest.stream(spark, src, "uid string, g string, n int"), str(tmp_path / "out"), str(tmp_path / "cp"), ["g"], "uid").awaitTermination()
    assert sorted((r.uid, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", 1), ("b", 3), ("c", 4)]
