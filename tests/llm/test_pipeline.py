import corpus_pipeline
from tests.conftest import SF
from versica.llm.common import documents, stored


def test_stages_and_run(spark):
    docs, columns = documents(spark, SF), documents(spark, SF).columns
    before = docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, SF), name.replace(" ", "_"))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            assert name == "mixing" or docs.count() <= before, name
            before = docs.count()
    last = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in docs.collect()}
    again = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect()}
    assert last == again and last


def test_stages_of_odd_rows(spark, odd, empty, tmp_path):
    spark.createDataFrame([(1, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for first in (odd, empty):
        docs = first
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path)), "stage")
        assert (docs.count() > 0) == (first is odd)


def test_memory_is_given_back(spark):
    from versica.llm.common import give_back

    beans = spark._jvm.java.lang.management.ManagementFactory
    count = lambda: sum(b.getCollectionCount() for b in beans.getGarbageCollectorMXBeans())
    before = count()
    give_back(spark)
    assert count() > before + 4  # without it, none or one


def test_driver_gives_memory_back(spark, odd):
    from versica.llm.common import driver_gives_back
    from versica.llm.simhash import near_duplicates

    beans = spark._jvm.java.lang.management.ManagementFactory
    full = lambda: sum(b.getCollectionCount() for b in beans.getGarbageCollectorMXBeans() if not any(x in b.getName() for x in ("Young", "Concurrent")))
    assert "native heap" in driver_gives_back(spark)  # this image's JVM has the command
    before = full()
    near_duplicates(odd).count()
    assert full() >= before + 4  # none without it: what near dedup leaves stayed until the heap was full
