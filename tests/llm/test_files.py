import base64
import gzip
import hashlib
import os
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF
from versica.llm import html_extract, media, warc
from versica.llm.queries import QUERIES


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=3000))
def test_png_round_trip(data):
    n, padded = media.payload(data)
    stored = media.png(padded)
    assert media.read_png(stored).tobytes() == padded and padded[:n] == data and len(padded) % 64 == 0 and len(padded) >= 64


def _filtered(rows, kind, bpp):
    """Rows filtered by the PNG standard's definitions, byte by byte."""
    out = []
    for y, row in enumerate(rows):
        above = rows[y - 1] if y else bytes(len(row))
        line = [kind]
        for x, v in enumerate(row):
            a, b, c = row[x - bpp] if x >= bpp else 0, above[x], above[x - bpp] if x >= bpp else 0
            p = a + b - c
            paeth = min((a, b, c), key=lambda q: abs(p - q))
            line.append((v - (0, a, b, (a + b) // 2, paeth)[kind]) % 256)
        out.append(line)
    return np.array(out, np.uint8)


@pytest.mark.parametrize("bpp", [1, 3, 4])
@pytest.mark.parametrize("kind", range(5))
def test_unfilter(kind, bpp):
    rows = [os.urandom(5 * bpp) for _ in range(6)]
    assert media.unfilter(_filtered(rows, kind, bpp), bpp).tobytes() == b"".join(rows)


def test_damage_is_found():
    good = media.png(media.payload(b"text " * 50)[1])
    for bad in (b"x" + good[1:], good[:60] + bytes([good[60] ^ 1]) + good[61:], good[:-6], good[:30]):
        with pytest.raises(ValueError):
            media.read_png(bad)


def test_media_query(spark, odd, empty):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op3_media"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n, p = media.payload(docs[r.doc_id])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])) and len(r.feature) == 16
    rows = media.features(media.encode(odd)).collect()
    assert len(rows) == odd.count() and len({(r.media_sha256, r.feature) for r in rows if r.doc_id in (1, 2, None)}) == 1
    assert media.features(media.encode(empty)).count() == 0


PAGES = [
    ('<body><nav><a href="/">Home</a></nav><article><h1>T &amp; t</h1><p>One   two\n<b>three</b></p><p>&lt;x&gt;</p></article><footer>&copy; me</footer>', "T & t\nOne two three\n<x>"),
    ("<article><p>a<script>var x='<p>no</p>'</script> b<p>c<!-- <p>no</p> --></article>", "a b\nc"), ("", ""), (None, ""), ("plain text only", "plain text only"), ("<article><p>cut off <b", "cut off"),
    ('<main><p>Text of it.</p><div class="reader-comments"><p>I say so.</p></div><form><p>Mail?</p></form><aside><p>By the side.</p></aside></main>', "Text of it."),
    ('<div id="cookie-notice"><p>We use cookies here.</p></div><div class="story"><p>The story goes on and on.</p></div><div class="sidebar">Other</div>', "The story goes on and on."),
    ('<article><p>a<br>b</p><ul><li>one<li>two</ul><p hidden>no</p><div style="display: none">no</div></article>', "a b\none\ntwo"),
]


@pytest.mark.parametrize(("page", "want"), PAGES)
def test_main_text(page, want):
    assert html_extract.main_text(page) == want


def test_odd_markup_ends():
    for page in ("<" * 3000, "<a " * 3000, "<p a='" * 2000, "<div>" * 5000 + "x", "</p>" * 3000, '<p "' * 2000 + ">", "&" * 5000, "<!--" * 2000):
        html_extract.main_text(page)


PROBES = [
    ('<div class="has-sidebar"><article><p>One two three.</p></article></div>', "One two three."),
    ('<div class="legal-news"><p>The court decided yesterday that the plan may go on as agreed by both sides in May.</p><p>It is final.</p></div>', "The court decided yesterday that the plan may go on as agreed by both sides in May.\nIt is final."),
    ('<div class="x"><p>We use cookies to make this site work. Accept?</p></div><article><h1>T</h1><p>Text of the story.</p></article>', "T\nText of the story."),
    ('<form id="aspnetForm"><div class="menu"><a href="x">a</a></div><main><p>All of the text.</p></main></form>', "All of the text."),
    ("<article><p>Story.</p><p>All rights reserved.</p></article><footer>All rights reserved.</footer>", "Story.\nAll rights reserved."),
]


@pytest.mark.parametrize(("page", "want"), PROBES)
def test_names_do_not_decide_alone(page, want):
    assert html_extract.main_text(page) == want


STORIES = [
    ("Storm over the valley", ["The storm came over the hills late at night and took the roofs of nine houses with it before the rain began.", "No one was hurt.", "Repairs will take until the spring, said the mayor of the town on Monday morning, and money is short."]),
    ("A bridge reopens", ["After two years of work the old bridge near the station is open again for people on foot and on bicycles.", "Cars have to wait until the autumn, when the second half of the work is to be finished by the same builders."]),
    ("Die neue Bibliothek", ["Die neue Bibliothek am Markt hat gestern zum ersten Mal ihre Türen geöffnet und mehr als tausend Menschen kamen.", "Sie bleibt.", "Der Eintritt ist frei, und am Abend lesen Kinder aus den Schulen der Stadt ihre eigenen Geschichten vor."]),
    ("Le marché du samedi", ["Le marché du samedi revient sur la place après des mois de travaux et les marchands retrouvent leurs clients.", "On y vend des fruits, du pain et des fleurs, et les enfants regardent les musiciens jouer sous les arbres."]),
    ("On small engines", ["Small engines wear out sooner than large ones because they turn faster, and their oil gets hotter in summer.", "Change it often.", "A filter costs little.", "Whoever waits for a noise has waited too long, as every mechanic will tell you who has opened one of them."]),
]
LINKS = "".join(f'<a href="/{k}">Section {k} page</a> ' for k in range(6))


def annotated():
    """Pages, each with its main text: eleven layouts of five stories."""
    for title, paragraphs in STORIES:
        text, body = "\n".join([title, *paragraphs]), "".join(f"<p>{p}</p>" for p in paragraphs)
        half, rest = paragraphs[0], "".join(f"<p>{p}</p>" for p in paragraphs[1:])
        yield f"<nav>{LINKS}</nav><article><h1>{title}</h1>{body}</article><footer>© 2023 The Paper</footer>", text
        yield f"<header><a href='/'>The Paper</a></header><main><h1>{title}</h1>{body}</main><aside><p>Most read stories of the week in one place.</p></aside>", text
        yield f"<div>{LINKS}</div><div><h1>{title}</h1>{body}</div><div>{LINKS}</div><div>© 2023 The Paper. All rights reserved.</div>", text
        yield f"<div class='wrap has-menu'><ul><li>{LINKS}</li></ul><h2>{title}</h2>{body}<div>{LINKS}</div></div>", text
        yield f"<table><tr><td>{LINKS}</td><td><h1>{title}</h1>{body}</td></tr></table><div>Copyright by The Paper, all rights reserved.</div>", text
        yield f"<div id='cookie-banner'><p>We use cookies, please accept them all.</p></div><section><h1>{title}</h1>{body}</section><div class='comments'><p>First of the readers to say that this is well written!</p></div>", text
        yield f"<article class='post'><h1>{title}</h1><p>{half}</p><aside><p>Read our other story about the same thing.</p></aside>{rest}</article><div>{LINKS}</div>", text
        yield f"<p>Advertisement</p><h1>{title}</h1>{body}<p>Subscribe to our newsletter for offers.</p>", text
        yield f"<form><label>Search</label><input></form><div>{LINKS}</div><h1>{title}</h1>{body}<script>var a = '<p>no</p>';</script>", text
        yield f"<div role='navigation'>{LINKS}</div><div class='legal-news'><h1>{title}</h1>{body}</div><div class='related'><p>More about this from our desk.</p></div>", text
        yield f"<main><h1>{title}</h1><p>{half} <a href='/s'>Source</a></p>{rest}</main><div class='site-footer'>Contact us by mail</div>", text.replace(half, half + " Source")


def test_annotated_pages():
    pages = list(annotated())
    kept = wanted = right = whole = 0
    for page, text in pages:
        got = html_extract.main_text(page)
        a, b = Counter(got.split("\n") if got else []), Counter(text.split("\n"))
        kept, wanted, right, whole = kept + a.total(), wanted + b.total(), right + (a & b).total(), whole + (got == text)
    assert len(pages) >= 50 and right / kept > 0.95 and right / wanted > 0.95 and whole / len(pages) > 0.85, (right / kept, right / wanted, whole)


def test_the_tree_uses_words_links_and_neighbours():
    def used(tree):
        return set() if len(tree) == 1 else {html_extract.FEATURES[tree[0]]} | used(tree[2]) | used(tree[3])

    found = used(html_extract.model())
    assert {"words", "link density", "words before", "words after", "place", "element", "named"} <= found and found & {"link density before", "link density after"}


def test_half_of_the_labelled_pages_without_an_article():
    """Class names tell nothing there; the tree is right about nearly all of their blocks all the same."""
    right = n = 0
    for page in html_extract.labelled_pages(seed=99, each=4):
        found = html_extract.blocks(page)
        for b, row in zip(found, html_extract.described(found), strict=True):
            n, right = n + 1, right + ((html_extract.share(html_extract.model(), row) >= 0.5) == (b["label"] == "1"))
    assert right / n > 0.95


class _Article(HTMLParser):
    """What the synthetic pages hold inside their article, block by block."""

    def __init__(self, page):
        super().__init__()
        self.inside, self.out, self.held = False, [], []
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        if self.inside and (text := " ".join("".join(self.held).split())):
            self.out.append(text)
        self.held = []

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "div", "nav", "article", "footer", "title", "script", "style"):
            self.flush()
        self.held += [" "] if tag == "br" else []
        self.inside = self.inside or tag == "article"

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "div", "nav", "article", "footer", "title", "script", "style"):
            self.flush()
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        self.held.append(data)


def test_html_query(spark):
    pages = {r.page_id: (r.url, r.html or "") for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in QUERIES["op8_html_extract"](spark, SF).collect()}
    assert got.keys() == pages.keys()
    for i, (url, page) in pages.items():
        text = "\n".join(_Article(page).out)
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, text, len(text))


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://a/\nx", "<html><title>A &amp; b</title><body><p>One<p>Two &lt;3<script>no</script></html>"), (2, None, None), (2, None, None), (None, "u", "")], "page_id long, url string, html string")
    responses = warc.responses(pages)
    out = warc.derive(responses).collect()
    assert len(out) == 8 and {r.record_type for r in out} == {"metadata", "conversion"}
    first = [r for r in out if r.page_id == 1]
    source = next(warc.read_records(bytes(responses.where("page_id = 1").first().warc)))
    for r in first:
        ((fields, block),) = warc.read_records(bytes(r.warc))
        assert fields["warc-refers-to"] == source[0]["warc-record-id"] == r.refers_to and fields["warc-type"] == r.record_type and fields["warc-block-digest"] == r.block_digest == warc.digest(block)
        assert r.source_payload_digest == source[0]["warc-payload-digest"]
        if r.record_type == "conversion":
            assert block.decode() == "One\nTwo <3"
        else:
            assert b"title: A & b\r\n" in block and b"source-content-type: text/html; charset=utf-8\r\n" in block
    images = warc.segments(warc.derive(responses), most_bytes=600).collect()
    assert sum(r.n_records for r in images) == 8 and sum(1 for r in images for _ in warc.read_records(gzip.decompress(bytes(r.image)))) == 8


def test_damaged_warc():
    good = warc.response(1, "u", b"<p>x")
    for bad in (good[:-3], good[:40], good.replace(b"<p>x", b"<p>y"), b"junk"):
        with pytest.raises(ValueError):
            list(warc.read_records(bad))


def _tagless(page):
    """Visible text by the standard library's parser: blocks as lines."""

    class P(HTMLParser):
        out, skip = "", 0

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style", "noscript", "template", "title")
            self.out += "" if tag in ("a", "b", "i", "em", "strong", "span", "u") else "\n"

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style", "noscript", "template", "title")
            self.out += "" if tag in ("a", "b", "i", "em", "strong", "span", "u") else "\n"

        def handle_data(self, data):
            self.out += "" if self.skip else re.sub(r"\s+", " ", data)

    p = P()
    p.feed(page)
    p.close()
    return "\n".join(x for line in p.out.split("\n") if (x := " ".join(line.split())))


def test_warc_query_against_the_pages(spark):
    """Every record of every page, parsed again: links, digests, source headers, and the text by another parser."""
    pages = {r.page_id: (r.url or "", (r.html or "").encode()) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op9_warc"](spark, SF).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == sorted((i, k) for i in pages for k in ("conversion", "metadata")) and len({r.record_id for r in got}) == len(got)
    refers = {}
    sha1 = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    for r in got:
        url, page = pages[r.page_id]
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(page)
        ((fields, block),) = warc.read_records(bytes(r.warc))
        assert refers.setdefault(r.page_id, r.refers_to) == r.refers_to == fields["warc-refers-to"] and fields["warc-record-id"] == r.record_id and fields["warc-target-uri"] == r.target_uri == url
        assert (r.source_status, r.source_headers) == ("HTTP/1.1 200 OK", {"content-type": "text/html; charset=utf-8", "content-length": str(len(page))})
        assert (r.source_payload_digest, r.source_block_digest, r.block_digest, r.n_bytes) == (sha1(page), sha1(http + page), sha1(block), len(block))
        if r.record_type == "conversion":
            assert block.decode() == r.text == _tagless(page.decode())
        else:
            assert r.text is None and f"source-payload-digest: {sha1(page)}\r\n".encode() in block
    assert len(set(refers.values())) == len(pages)


def test_warc_dates(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x", "2023-05-06T07:08:09Z"), (2, "u", "<p>x", None)], "page_id long, url string, html string, at string")
    assert {(r.page_id, r.warc_date) for r in warc.derive(warc.responses(pages, "at")).collect()} == {(1, "2023-05-06T07:08:09Z"), (2, warc.DATE)}


def test_pages_that_are_empty_null_long_or_repeated(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, warc string, date string"
    none = spark.createDataFrame([], schema)
    assert html_extract.extract(none).count() == 0 and warc.derive(warc.responses(none)).count() == 0
    long = "<article>" + "<p>word " * 30_000 + "</article>"
    rows = [(1, "u", long, *["clash"] * 4), (2, *[None] * 6), (3, "v", *[""] * 5), (1, "u", long, *["clash"] * 4)]
    got = html_extract.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id, r.url or "", r.n_chars) for r in got) == [(1, "u", 30_000 * 5 - 1)] * 2 + [(2, "", 0), (3, "v", 0)]
    assert warc.derive(warc.responses(spark.createDataFrame(rows, schema))).count() == 8
