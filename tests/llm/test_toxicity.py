import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF
from versica.llm import toxicity
from versica.llm.queries import QUERIES


def unit(v):
    n = sum(x * x for x in v.values()) ** 0.5
    return {t: x / n for t, x in v.items()}


vectors = st.dictionaries(st.integers(0, 11), st.floats(0.125, 5), min_size=1, max_size=5).map(unit)


@settings(max_examples=150, deadline=None)
@given(st.lists(vectors, min_size=1, max_size=120), vectors, st.integers(1, 9))
def test_block_max_search_is_exact(examples, query, k):
    at, terms, weights = map(np.array, zip(*[(i, t, x) for i, v in enumerate(examples) for t, x in v.items()], strict=True))
    index = toxicity.Index(np.arange(len(examples)), np.zeros(len(examples), np.int64), at, terms, weights, 12, (1.0, 1.0))
    cosines = [round(sum(x * float(np.float32(v.get(t, 0))) for t, x in query.items()), 9) for v in examples]
    want = sorted(((c, i) for i, c in enumerate(cosines) if c > 0), key=lambda x: (-x[0], x[1]))[:k]
    got, places = index.nearest(np.array(list(query)), np.array(list(query.values())), k)
    assert np.allclose(got, [c for c, _ in want], atol=1e-8) and len(got) == len(want) == len(set(places.tolist()))


def brute(docs, labels, k=15):
    """{doc_id: (score, cosines of the nearest, largest first)} by dense vectors of all words."""
    tokens = {i: Counter(w for x in (t or "").lower().split() if (w := x.strip(toxicity.MARKS))) for i, t in docs.items()}
    ids = sorted(i for i in labels if i in docs and zlib.crc32(str(i).encode()) % 5)
    y = np.array([labels[i] for i in ids])
    words = sorted({w for i in ids for w in tokens[i]})
    of = {w: j for j, w in enumerate(words)}
    df = Counter(w for c in tokens.values() for w in c if w in of)
    idf = np.array([math.log((len(docs) + 1) / (df[w] + 1)) + 1 for w in words])

    def dense(rows):
        out = np.zeros((len(rows), len(words)))
        for r, i in enumerate(rows):
            for w, n in tokens[i].items():
                if w in of:
                    out[r, of[w]] = 1 + math.log(n)
        return out

    def entropy(p):
        return -sum(x * math.log2(x) for x in (p, 1 - p) if x > 0)

    tf, totals = dense(ids), np.bincount(y, minlength=2)

    def near(inside, rows):
        n, n1 = int(inside.sum()), int(y[inside].sum())
        weights = np.zeros(len(words))
        for j in np.flatnonzero((tf[inside] > 0).any(axis=0)):
            has = tf[inside, j] > 0
            a, e = int(y[inside][has].sum()), int(has.sum())
            rest = (1 - e / n) * entropy((n1 - a) / (n - e)) if e < n else 0
            weights[j] = idf[j] * max(1e-9, entropy(n1 / n) - e / n * entropy(a / e) - rest)
        a, q = tf[inside] * weights, rows * weights
        for m in (a, q):
            norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
            m /= np.where(norm > 0, norm, 1)
        cosines = np.round(q @ a.astype(np.float32).astype(float).T, 9)
        by = totals / np.bincount(y[inside], minlength=2)
        out = []
        for c in cosines:
            best = sorted((i for i in range(n) if c[i] > 0), key=lambda i: (-c[i], i))[:k]
            w = [c[i] * by[y[inside][i]] for i in best]
            out.append((sum(x for x, i in zip(w, best, strict=True) if y[inside][i]) / sum(w) if best else None, [float(c[i]) for i in best]))
        return out

    fold = np.array([zlib.crc32(f"fold {i}".encode()) % toxicity.FOLDS_OF for i in ids])
    votes = []
    for f in range(toxicity.FOLDS_OF):
        votes += [(v, y[i], 1.0) for (v, _), i in zip(near(fold != f, tf[fold == f]), np.flatnonzero(fold == f), strict=True) if v is not None]
    steps = toxicity.isotonic(*map(list, zip(*votes, strict=True)))
    share = totals[1] / (totals.sum() + 2)
    every = near(np.ones(len(ids), bool), dense(list(docs)))
    return {i: (share if v is None else float(np.interp(v, *steps)), c) for i, (v, c) in zip(docs, every, strict=True)}


def test_query_against_dense_vectors(spark):
    """The whole query on a whole table: the same nearest examples, and scores but for ties at the last place and rounding."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.toxic is not None}
    want = brute(docs, labels)
    got = {r.doc_id: (r.score, r.nearest) for r in QUERIES["op2_toxicity"](spark, SF).collect()}
    assert got.keys() == want.keys() and all(len(got[i][1]) == len(want[i][1]) for i in got)
    off = [i for i in got if abs(got[i][0] - want[i][0]) > 1e-6]
    assert len(off) <= 0.02 * len(got), [(got[i], want[i]) for i in off[:3]]


def test_isotonic():
    x, y = toxicity.isotonic([0.1, 0.2, 0.3, 0.4], [0, 1, 0, 1], [1, 1, 1, 1])
    assert y == [0, 0.5, 1] and x == pytest.approx([0.1, 0.25, 0.4])


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF.replace('0.001', '0.1')}/labels.parquet").collect()}
    got = QUERIES["op2_toxicity"](spark, SF.replace("0.001", "0.1")).collect()
    assert len(got) == 10_000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    c = Counter((labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels)
    assert c[1, 1] / (c[1, 1] + c[1, 0]) > 0.88 and c[0, 1] / (c[0, 0] + c[0, 1]) < 0.01


def test_no_labels_and_odd_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd, none)
    assert {r[-3] for r in toxicity.score(odd, model).collect()} == {0.0}
    some = spark.createDataFrame([(i, 1, int(i == 5)) for i in (1, 2, 3, 4, 5, 6, 7, 8)] + [(None, 1, 1), (6, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score(odd, toxicity.fit(odd, some))
    assert got.count() == odd.count() and got.columns == [*odd.columns, "__score", "__predicted", "__nearest"] and {r._score for r in got.collect()} == {"clash"}
    assert toxicity.score(empty, toxicity.fit(empty, some)).count() == 0


def test_words():
    rows, words = toxicity.words_of(pa.array(["Alpha, beta\n(ÉPSILON) 9.5!", None, "", "*** a-b"]))
    assert list(zip(rows.tolist(), words.to_pylist(), strict=True)) == [(0, "alpha"), (0, "beta"), (0, "épsilon"), (0, "9.5"), *[(1, "")] * rows.tolist().count(1), *[(2, "")] * rows.tolist().count(2), (3, ""), (3, "a-b")]
