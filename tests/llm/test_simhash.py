import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF
from versica.llm import common, simhash
from versica.llm.queries import QUERIES


def fingerprint(text, n=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """{doc_id: smallest doc_id reachable} of {doc_id: fingerprint}."""
    ids, up = sorted(prints), {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    values = np.array([prints[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[:k] ^ values[k]) <= 2):
            a, b = sorted((find(ids[j]), find(i)))
            up[b] = a
    return {i: find(i) for i in ids}


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: fingerprint(t) for i, t in docs.items()}
    want = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, SF).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in docs}


def test_odd_rows(odd, empty):
    got = {r.doc_id: r for r in simhash.component_ids(odd).collect()}
    assert simhash.component_ids(odd).count() == odd.count() and simhash.component_ids(empty).count() == 0
    assert got[3].fp == got[4].fp == got[9].fp == 0 and got[3].component_id == got[9].component_id == 3
    assert got[1].component_id == got[2].component_id == got[None].component_id == 1


@pytest.mark.parametrize("cap", [1, 2, 64])
def test_links_with_crowded_buckets(spark, cap):
    """Clusters around a few centres, one of them large; the crowded way must find the same components."""
    pick = random.Random(cap)
    prints = set()
    for size in (300, 40, 5, 5, 1, 1):
        centre = pick.getrandbits(64)
        for _ in range(size):
            prints.add(centre ^ sum({1 << pick.randrange(64) for _ in range(pick.choice((0, 1, 1, 2, 3)))}))
    prints |= {0, 1, 3, 1 << 63, (1 << 64) - 1}
    signed = {x: x - (1 << 64) if x >> 63 else x for x in prints}
    labels = {r.node: r.label for r in common.components(simhash.links(spark.createDataFrame([(v,) for v in signed.values()], "fp long"), cap)).collect()}
    want = brute_components(dict(zip(sorted(signed.values()), [v & ((1 << 64) - 1) for v in sorted(signed.values())], strict=True)))
    assert {v: labels.get(v, v) for v in signed.values()} == want


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(1000, 2000), (7, 7)], "a long, b long"))
    got = {r.node: r.label for r in common.components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 2000: 1000}


def jaccard(a, b, n=5):
    sets = []
    for t in (a, b):
        w = t.lower().split()
        sets.append({" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_duplicates_recall_and_clean_texts(spark):
    pick = random.Random(5)
    words = ["".join(pick.choice("abcdefghij") for _ in range(pick.randrange(2, 9))) for _ in range(4000)]
    texts, groups = [], []
    for g in range(120):
        base = [pick.choice(words) for _ in range(pick.randrange(60, 400))]
        for k in range(pick.choice((1, 1, 2, 4))):
            own = list(base)
            for _ in range(k and max(1, round(len(own) * pick.choice((0.005, 0.01, 0.018))))):
                own[pick.randrange(len(own))] = pick.choice(words)
            texts.append(" ".join(own))
            groups.append(g)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in simhash.near_duplicates(df).collect()}
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if groups[i] == groups[j] and jaccard(texts[i], texts[j]) >= 0.8]
    found = sum(got[i] == got[j] for i, j in pairs)
    assert len(pairs) > 60 and found / len(pairs) >= 0.9
    assert all(groups[i] == groups[g] for i, g in got.items())
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and {groups[r.doc_id] for r in kept.collect()} == set(groups)


def test_keep_one_of_odd_rows(odd, empty):
    kept = simhash.keep_one(odd)
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert kept.columns == odd.columns and None in ids and 1 in ids and 2 not in ids and 3 in ids and 4 not in ids and simhash.keep_one(empty).count() == 0


def test_near_duplicates_of_a_crowded_bucket(spark, monkeypatch):
    """All meet in one bucket, and each real pair stands far apart in id order: only comparing all members finds it."""
    monkeypatch.setattr(simhash, "segment_plan", lambda n, similarity, recall: (1, 1))
    monkeypatch.setattr(simhash, "BLOCK", 7)
    pick = random.Random(8)
    texts = [" ".join(f"w{pick.randrange(10**6)}" for _ in range(80)) for _ in range(40)]
    texts += [f"{t} end" for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.group_id for r in simhash.near_duplicates(df).collect()} == {i: i % 40 for i in range(80)}


def test_near_duplicates_on_both_sides_of_the_similarity(spark):
    """What is linked has 0.8 or more: shared shingles decide, not bits, and not equal fingerprints."""
    pick, texts = random.Random(3), []
    for k in range(60):
        base = [f"w{pick.randrange(10**6)}" for _ in range(204)]
        texts.append(" ".join(base))
        texts.append(" ".join(base[: (184, 178)[k % 2]] + [f"v{pick.randrange(10**6)}" for _ in range((20, 26)[k % 2])]))
    texts += ["spam " * 30, "spam " * 30 + "and eggs"]
    got = {r.doc_id: r.group_id for r in simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    linked = [got[2 * k] == got[2 * k + 1] for k in range(61)]
    alike = [jaccard(texts[2 * k], texts[2 * k + 1]) >= 0.8 for k in range(61)]
    assert not any(x and not y for x, y in zip(linked, alike, strict=True)) and sum(linked) >= 0.9 * sum(alike) > 20 and not alike[60]


def test_recall_on_documents(spark):
    """All pairs of documents with a similarity of 0.8 or more, by posting lists of shingles, against the groups found."""
    from collections import Counter, defaultdict

    docs = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/documents.parquet").select("doc_id", "text")
    sets = {r.doc_id: frozenset(simhash.shingle_hashes((r.text or "").encode(), 5).tolist()) for r in docs.collect()}
    first, posts = {}, defaultdict(list)
    for i in sorted(sets):
        if first.setdefault(sets[i], i) == i:  # copies are one class
            for h in sets[i]:
                posts[h].append(i)
    shared = Counter((i, j) for own in posts.values() for k, i in enumerate(own) for j in own[:k])
    pairs = [(i, j) for (i, j), n in shared.items() if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n)]
    got = {r.doc_id: r.group_id for r in simhash.near_duplicates(docs).collect()}
    assert len(pairs) > 30 and sum(got[i] == got[j] for i, j in pairs) >= 0.95 * len(pairs), (len(pairs), sum(got[i] == got[j] for i, j in pairs))
    assert all(got[i] == got[first[sets[i]]] for i in sets)
    linked = {x for p in pairs for x in p}
    assert all(got[i] == first[sets[i]] for i in sets if first[sets[i]] not in linked)  # nothing else is


@pytest.mark.parametrize("cap", [1, simhash.CAP])
def test_no_table_of_fingerprints_goes_through_the_driver(spark, monkeypatch, cap):
    """Broadcasts of these failed by driver memory at 0.6 GB: their compressed files are far smaller than what they are in memory."""
    plans, stored = [], common.stored

    def noted(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, *more)

    monkeypatch.setattr(common, "FEW_NODES", -1)
    monkeypatch.setattr(common, "stored", noted)
    monkeypatch.setattr(simhash, "stored", noted)
    noted(simhash.component_ids(spark.read.parquet(f"{SF}/documents.parquet"), cap=cap), "out")
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("BroadcastHashJoin" in p for p in plans)


def test_a_pair_of_many_crowded_buckets_is_a_candidate_once(spark, monkeypatch):
    """Near copies just under the similarity meet in many buckets, and no chain joins them."""
    made, write = {}, simhash.stored

    def seen(df, name, path=None):
        if name == "rest":
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            made["once"] = "array_intersect" in plan
        return write(df, name, path)

    monkeypatch.setattr(simhash, "stored", seen)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base[:k] + [f"x{j}"] + base[k + 1 :]) for j, k in enumerate(range(0, 120, 6))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = dict(simhash.near_duplicates(docs, 0.95).collect())
    sets = {i: jaccard_set(t) for i, t in enumerate(texts)}
    assert made["once"] and all(groups[i] == i for i in sets if all(len(sets[i] & o) / len(sets[i] | o) < 0.95 for k, o in sets.items() if k != i))


def jaccard_set(text, n=5):
    words = text.split()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def test_pairs_of_crowded_buckets_are_compared_once(spark, monkeypatch):
    """They have met with whole fingerprints: these are not joined to them again."""
    tops, write = [], simhash.stored

    def seen(df, name, path=None):
        if name == "rest":
            tops.append(df._jdf.queryExecution().optimizedPlan().nodeName())
        return write(df, name, path)

    monkeypatch.setattr(simhash, "stored", seen)
    docs = spark.createDataFrame([(i, "one two three four five six " * 3 + f"x{i % 2}") for i in range(6)], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 6 and tops == ["Aggregate"]
