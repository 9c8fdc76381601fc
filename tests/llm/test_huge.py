"""One text of 50 MB among small ones, through every operator."""

import hashlib
import zlib

import pytest

from tests.conftest import SF
from versica.llm import exact_dedup, html_extract, line_dedup, media, mixing, packing, secret_scan, simhash, toxicity, warc
from versica.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def docs(spark, huge, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("huge") / "docs")
    line = "A line that is long enough to count"
    spark.createDataFrame([(1, huge, "a"), (2, f"{line}\nsmall", "a"), (3, f"x\n{line}", "b")], "doc_id long, text string, source string").repartition(2).write.parquet(path)
    return spark.read.parquet(path)


def test_simhash(docs):
    assert {r.doc_id: r.component_id for r in simhash.component_ids(docs).collect()} == {1: 1, 2: 2, 3: 3}


def test_near_duplicates(docs):
    assert {r.doc_id for r in simhash.keep_one(docs).select("doc_id").collect()} == {1, 2, 3}


def test_toxicity(spark, docs):
    some = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, some)).select("doc_id", "_score").count() == 3


def test_media(docs, huge):
    got = {r.doc_id: r for r in media.features(media.encode(docs)).collect()}
    n, padded = media.payload(huge.encode())
    assert (got[1].n_bytes, got[1].payload_sha256, got[1].tail_crc32) == (n, hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))


def test_line_dedup(docs, huge):
    got = {r[0]: (r[-2], r[-1]) for r in line_dedup.dedup_lines(docs).select("doc_id", "_n_lines", "_n_dropped").collect()}
    assert got == {1: (huge.count("\n") + 1, 1), 2: (2, 1), 3: (2, 0)}


def test_packing(docs):
    rows = packing.pack(docs, tokenizer_path()).where("doc_id = 1").collect()
    assert sorted(r.piece for r in rows) == list(range(len(rows))) and sum(r.length for r in rows) > 10_000_000


def test_cut_texts_have_the_ids_of_whole_ones(monkeypatch):
    tokens = packing.Tokens(tokenizer_path())
    text = "It's a test, naïve 12 words\n\tand “more” of 日本語 them. " * 60
    whole = tokens._whole(text)
    monkeypatch.setattr(packing, "LONG", 50)
    assert tokens.ids(text) == whole


def test_cut_texts_have_the_hashes_of_whole_ones(monkeypatch):
    text = ("Alpha  beta\tgamma\x1fdelta é\n" * 40).encode()
    for n in (1, 3, 5):
        whole = simhash.shingle_hashes(text, n).tolist()
        with monkeypatch.context() as m:
            m.setattr(simhash, "PIECE", 9)
            assert simhash.shingle_hashes(text, n).tolist() == whole
            assert simhash.shingle_hashes(b"one two", n).tolist() == simhash.shingle_hashes(b" one  TWO ", n).tolist()


def test_secrets(docs):
    assert [r.doc_id for r in secret_scan.scan(docs).where("is_secret").collect()] == [1]


def test_exact_dedup(spark, docs):
    index = exact_dedup.DigestIndex(spark, "digests_huge", 2)
    try:
        assert {r.doc_id: r.group_size for r in index.add(docs).collect()} == {1: 1, 2: 1, 3: 1}
    finally:
        index.drop()


def test_mixing(docs):
    assert {r.doc_id for r in mixing.mix(docs, repeats=2.0).select("doc_id").collect()} == {1, 2, 3}


def test_pages(docs, huge):
    pages = docs.selectExpr("doc_id AS page_id", "'u' AS url", "concat('<article><p>', replace(text, '\n', '<p>'), '</article>') AS html")
    assert {r.page_id: r.n_chars for r in html_extract.extract(pages).select("page_id", "n_chars").collect()}[1] > 49_000_000
    assert warc.derive(warc.responses(pages)).select("page_id", "n_bytes").count() == 6
