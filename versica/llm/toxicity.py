"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes.

fit() learns from labelled rows only, at most EXAMPLES of each class (those first by a hash of doc_id), none held out; this
bound on labelled rows is the only one:
  - terms are all words of the examples (between white space, lower case, without marks at the ends); none is left out;
  - a term weighs (1 + log tf) x idf x gain. Document frequencies are counted over all documents; gain is the information, in
    bits, that the word's presence gives about the label among the examples, so that words of both classes, which are most of
    a text, don't hide the few that tell them apart;
  - examples are unit vectors, laid in blocks of BLOCK; the index has, for each term, the blocks that hold it with the term's
    largest weight there, and for each of those the examples and their weights;
  - votes are calibrated by isotonic regression on the examples' own votes, each by the examples of the other folds alone
    (FOLDS_OF folds; gains and weights anew without it), as an unseen text would get them.
score() finds every text's K nearest examples exactly: a block's largest possible cosine is bounded by its maxima (of the terms that most
blocks hold, the weights of each example are added instead); the most promising examples are scored first, then all that can
still reach the K-th cosine. Votes are weighted by cosine and by how many
labelled rows of its class an example stands for.

Labels, lang, source and doc_id are no inputs of a score. Defined cases: a text that shares no word with an example (null and
empty texts too) has no neighbours, and its score is the share of label 1 among the labelled rows; equal cosines (to nine
places): the smaller doc_id is nearer; several labels of a doc_id: the largest counts; null labels are no labels; several texts
of a labelled doc_id: the largest counts; without labels of both classes every score is the share of label 1, of two more labels
than there are (0 if none is 1); repeated rows come out repeated; a null doc_id is scored, and not held out; very long texts
are counted whole; empty tables give no rows; extra columns stay as they are, and new ones get underscores
before their names where docs has such columns.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from versica.llm.common import id_text, in_arrow, quoted, stored, unused

EXAMPLES, BLOCK, K = 2000, 8, 15
FOLDS, FOLDS_OF = 5, 4
#: Examples that are scored before a bound is known; share of blocks above which a term's weights are kept densely.
FIRST, FREQUENT = 48, 0.15
#: Share of examples above which a term has a say in the order of examples.
SHAPING = 0.02
#: What is cut off at both ends of a word.
MARKS = ".,;:!?\"'()[]{}<>*#$%&+-_=/\\|~^`@«»„“”‚‘’…–—¿¡·"


def held_out(doc_id: str):
    """SQL column: whether crc32 of the id as text is 0 mod FOLDS."""
    return F.coalesce(F.crc32(F.col(quoted(doc_id)).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def words_of(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row of each word, words) of a column of texts: what lies between white space, lower case, without MARKS at its ends; may be empty."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(column, "")))
    return pc.list_parent_indices(lists).to_numpy().astype(np.int64), pc.utf8_trim(pc.list_flatten(lists), characters=MARKS)


def counted(rows: np.ndarray, terms: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, how often) of each pair, in order; terms under 0 are left out."""
    kept = terms >= 0
    pairs, n = np.unique(rows[kept] * n_terms + terms[kept], return_counts=True)
    return pairs // max(1, n_terms), pairs % max(1, n_terms), n


def isotonic(x: list[float], y: list[float], w: list[float]) -> tuple[list[float], list[float]]:
    """Pool-adjacent-violators: (mean x of pools, their values), both ascending; what lies between is interpolated."""
    at: dict[float, np.ndarray] = {}
    for v, t, c in zip(x, y, w, strict=True):
        at[v] = at.get(v, 0) + np.array([v * c, t * c, c])
    out: list[np.ndarray] = []
    for v in sorted(at):
        out.append(at[v])
        while len(out) > 1 and out[-2][1] / out[-2][2] >= out[-1][1] / out[-1][2]:
            top = out.pop()
            out[-1] = out[-1] + top
    return [float(p[0] / p[2]) for p in out], [float(p[1] / p[2]) for p in out]


def gain(ones: np.ndarray, every: np.ndarray, n1: int, n: int) -> np.ndarray:
    """Bits that the presence of a word found in `every` of n examples, `ones` of them of the n1 with label 1, gives about the label."""

    def entropy(p: np.ndarray) -> np.ndarray:
        p = np.clip(p, 1e-15, 1 - 1e-15)
        return -(p * np.log2(p) + (1 - p) * np.log2(1 - p))

    without = np.maximum(1, n - every)
    left = every / n * entropy(ones / every) + (1 - every / n) * entropy((n1 - ones) / without)
    return np.maximum(entropy(np.array(n1 / n)) - left, 1e-9)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _alike(x: np.ndarray, size: int) -> np.ndarray:
    """An order of the rows in which similar ones lie together: halves along the direction of most variance, again and again."""
    done, todo = [], [np.arange(len(x))]
    while todo:
        own = todo.pop()
        if len(own) <= size:
            done.append(own)
            continue
        rows = x[own]
        rows -= rows.mean(axis=0)
        along = rows[np.argmax(np.einsum("ij,ij->i", rows, rows))]
        for _ in range(6):
            along = (rows @ along) @ rows
            along /= max(1e-30, float(np.sqrt(along @ along)))
        order = own[np.argsort(rows @ along, kind="stable")]
        half = size * max(1, len(own) // size // 2)
        todo += [order[half:], order[:half]]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


class Index:
    """Labelled examples as a block-max inverted index. ids and labels of the examples; (at, terms, weights): example at[i] has terms[i] with weights[i], of length 1.

    Terms found in most blocks have their weights in a dense array; all others have lists of blocks, and of the examples there."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, at: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int, class_weights: tuple[float, float], shaped: bool = True):
        # similar examples lie together, which keeps the blocks' bounds tight
        order = np.arange(len(ids))
        if shaped:
            common = np.flatnonzero(np.bincount(terms, minlength=n_terms) > max(1, len(ids) * SHAPING))
            column = np.full(n_terms, -1, np.int64)
            column[common] = np.arange(len(common))
            held = column[terms] >= 0
            shape = np.zeros((len(ids), len(common)), np.float32)
            shape[at[held], column[terms[held]]] = weights[held]
            order = _alike(shape, BLOCK)
            del shape, held
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.labels, self.class_weights = ids[order], labels[order], np.array(class_weights)[labels[order]]
        self.n_blocks = -(-len(ids) // BLOCK)
        at, weights = place[at], weights.astype(np.float32)
        order = np.lexsort((at, terms))
        example, weight, terms = at[order].astype(np.int32), weights[order], terms[order]
        block = example // BLOCK
        new = np.flatnonzero(np.r_[True, (np.diff(terms) != 0) | (np.diff(block) != 0)]) if len(terms) else np.zeros(0, np.int64)
        frequent = np.flatnonzero(np.bincount(terms[new], minlength=n_terms) > self.n_blocks * FREQUENT)
        self.slot = np.full(n_terms, -1, np.int32)  # of frequent terms: their row in the dense array
        self.slot[frequent] = np.arange(len(frequent))
        del order, block, new
        dense = self.slot[terms] >= 0
        self.dense = np.zeros((len(frequent), self.n_blocks * BLOCK), np.float32)
        self.dense[self.slot[terms[dense]], example[dense]] = weight[dense]
        self.example, self.weight, terms = example[~dense], weight[~dense], terms[~dense]
        block = self.example // BLOCK
        new = np.flatnonzero(np.r_[True, (np.diff(terms) != 0) | (np.diff(block) != 0)]) if len(terms) else np.zeros(0, np.int64)
        self.entry_at = np.r_[new, len(terms)].astype(np.int32)  # of each (term, block): where its examples begin
        self.entry_block = block[new]
        self.entry_most = np.maximum.reduceat(self.weight, new) if len(new) else np.zeros(0, np.float32)
        self.term_at = np.searchsorted(terms[new], np.arange(n_terms + 1)).astype(np.int32)  # of each term: where its entries begin

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """(cosines, places) of the k nearest examples with a cosine over 0."""
        slot = self.slot[terms]
        often = slot >= 0
        slot, often_weights, terms, weights = slot[often], weights[often], terms[~often], weights[~often]
        starts = self.term_at[terms]
        sizes = self.term_at[terms + 1] - starts
        entries = _ranges(starts, sizes)
        q, of = np.repeat(weights, sizes), self.entry_block[entries]
        blocks = np.bincount(of, q * self.entry_most[entries], self.n_blocks)
        bounds = ((often_weights.astype(np.float32) @ self.dense[slot]).reshape(-1, BLOCK) + blocks[:, None]).ravel()
        found, places = np.zeros(0), np.zeros(0, np.int64)
        now = np.argpartition(-bounds, FIRST)[:FIRST] if len(bounds) > FIRST else np.arange(len(bounds))
        for last in (False, True):
            if last:
                least = np.partition(found, len(found) - k)[len(found) - k] - 1e-5 if len(found) >= k else 0  # bounds are of single precision
                bounds[now] = 0
                now = np.flatnonzero((bounds >= least) & (bounds > 0))
            if not len(now):
                continue
            chosen = np.full(len(bounds), -1, np.int32)
            chosen[now] = np.arange(len(now))
            here = np.zeros(self.n_blocks, bool)
            here[now // BLOCK] = True
            own = np.flatnonzero(here[of])
            begin = self.entry_at[entries[own]]
            counts = self.entry_at[entries[own] + 1] - begin
            rows = _ranges(begin, counts)
            at = chosen[self.example[rows]]
            kept = at >= 0
            cosines = np.bincount(at[kept], (np.repeat(q[own], counts) * self.weight[rows])[kept], len(now))
            if len(slot):
                cosines = cosines + often_weights @ self.dense[slot[:, None], now]
            cosines = np.round(cosines, 9)
            some = np.flatnonzero(cosines)
            found, places = np.r_[found, cosines[some]], np.r_[places, now[some]]
        best = np.lexsort((self.ids[places], -found))[:k]
        return found[best], places[best]

    def vote(self, cosines: np.ndarray, places: np.ndarray) -> float:
        w = cosines * self.class_weights[places]
        return float(w @ self.labels[places] / w.sum())


class Model:
    """A dictionary of words, their weights, the index and the calibration."""

    def __init__(self, words: pa.Array, share: float):
        self.words, self.share = words, share
        self.weights, self.index, self.steps = np.zeros(len(words)), None, ([], [])

    def score(self, column: pa.Array) -> tuple[list[float], list[list[int]]]:
        """(scores, doc_ids of the nearest examples) of a column of texts."""
        scores, near = [self.share] * len(column), [[] for _ in range(len(column))]
        if self.index is not None:
            rows, terms, counts = counted(*_known(self.words, column), len(self.words))
            weights = (1 + np.log(counts)) * self.weights[terms]
            ends = np.searchsorted(rows, np.arange(len(column) + 1))
            for i in np.unique(rows).tolist():
                own = slice(ends[i], ends[i + 1])
                cosines, places = self.index.nearest(terms[own], _unit(weights[own]))
                if len(places):
                    scores[i] = float(np.interp(self.index.vote(cosines, places), *self.steps))
                    near[i] = self.index.ids[places].tolist()
        return scores, near


def _known(words: pa.Array, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) of each word of a column of texts; -1 for words that the dictionary lacks."""
    rows, own = words_of(column)
    return rows, pc.fill_null(pc.index_in(own, value_set=words), -1).to_numpy().astype(np.int64)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sampled texts -> doc_id, toxic, words and how often each occurs."""
    for b in batches:
        rows, own = words_of(b.column("text"))
        own = own.dictionary_encode()
        at, terms, n = counted(rows, own.indices.to_numpy().astype(np.int64), len(own.dictionary))
        ends = pa.array(np.searchsorted(at, np.arange(b.num_rows + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, x) for x in (own.dictionary.take(pa.array(terms)), pa.array(n))]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic").cast(pa.int32()), *lists], ["doc_id", "toxic", "word", "n"])


def _frequencies(sent):
    """Documents with each word of the dictionary, over a task's documents; term -1 counts documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = sent.value, 0
        counts = np.zeros(len(words), np.int64)
        for b in batches:
            _, terms, _ = counted(*_known(words, b.column("text")), len(words))
            counts += np.bincount(terms, minlength=len(words))
            n += b.num_rows
        if n:
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at], pa.int32()), pa.array(np.r_[n, counts[at]], pa.int64())], ["term", "n"])

    return run


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of docs and labels(doc_id, toxic). What comes to the driver is bounded by the words of 2 x examples texts."""
    spark, rows = docs.sparkSession, id_text(docs, id_col, text_col)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic")).where(~held_out("doc_id"))
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = totals.get(1, 0) / (sum(totals.values()) + 2)
    if len(totals) < 2:
        return Model(pa.array([], pa.string()), share)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 0").orderBy(*order).limit(examples).unionByName(known.where("toxic = 1").orderBy(*order).limit(examples))
    sampled = rows.join(F.broadcast(stored(chosen, "chosen")), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("text").alias("text"))  # 2 * examples rows at most
    sample = stored(in_arrow(sampled, _sampled, "doc_id long, toxic int, word array<string>, n array<long>"), "sample").toArrow().combine_chunks()
    ids, marks = sample["doc_id"].to_numpy(), sample["toxic"].to_numpy()
    if len(set(marks.tolist())) < 2:
        return Model(pa.array([], pa.string()), share)
    lists = sample["word"].combine_chunks()
    flat = pc.list_flatten(lists).dictionary_encode()
    at, terms = pc.list_parent_indices(lists).to_numpy().astype(np.int32), flat.indices.to_numpy()
    counts, words = pc.list_flatten(sample["n"].combine_chunks()).to_numpy().astype(np.int32), flat.dictionary
    named = words.to_numpy(zero_copy_only=False) != ""
    if not named.all():  # the empty word is no term
        kept = named[terms]
        at, counts, terms, words = at[kept], counts[kept], (np.cumsum(named) - 1).astype(np.int32)[terms[kept]], words.filter(pa.array(named))
    model = Model(words, share)
    del sample, lists, flat
    if not len(words):
        return model
    sent = spark.sparkContext.broadcast(model.words)
    found = in_arrow(rows.select("text"), _frequencies(sent), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    sent.destroy()
    df, place = np.zeros(len(model.words) + 1, np.int64), found["term"].to_numpy()
    df[place] = found["n"].to_numpy()  # term -1 is the last
    n_docs, df = int(df[-1]), df[:-1]
    idf = np.log((n_docs + 1) / (df + 1)) + 1
    totals = np.array([totals[0], totals[1]])
    fold = np.array([zlib.crc32(f"fold {i}".encode()) % FOLDS_OF for i in ids.tolist()])
    votes, truth, weight = [], [], []
    for k in range(FOLDS_OF):
        inside = fold != k
        if len(set(marks[inside].tolist())) < 2:
            continue
        weights, index = _indexed(ids, marks, at, terms, counts, idf, totals, inside)
        for i in np.flatnonzero(~inside).tolist():
            own = slice(*np.searchsorted(at, [i, i + 1]))
            cosines, near = index.nearest(terms[own], _unit((1 + np.log(counts[own])) * weights[terms[own]]))
            if len(near):
                votes.append(index.vote(cosines, near))
                truth.append(float(marks[i]))
                weight.append(totals[marks[i]] / int((marks == marks[i]).sum()))
    if votes:
        model.steps = isotonic(votes, truth, weight)
        model.weights, model.index = _indexed(ids, marks, at, terms, counts, idf, totals)
    return model


def _unit(w: np.ndarray) -> np.ndarray:
    return w / (math.sqrt(w @ w) or 1.0)


def _indexed(ids, marks, at, terms, counts, idf, totals, inside=None) -> tuple[np.ndarray, Index]:
    """(term weights, index) of the examples, or of those inside."""
    shaped = inside is None
    if inside is not None:
        kept = inside[at]
        at, terms, counts, ids, marks = (np.cumsum(inside) - 1)[at[kept]], terms[kept], counts[kept], ids[inside], marks[inside]
    ones, every = np.bincount(terms, marks[at], len(idf)), np.bincount(terms, None, len(idf))
    weights = idf * gain(ones, np.maximum(every, 1), int(marks.sum()), len(marks)) * (every > 0)
    own = (1 + np.log(counts)) * weights[terms]
    own /= np.sqrt(np.bincount(at, own * own, len(ids)))[at]
    return weights, Index(ids, marks, at, terms, own, len(idf), tuple(totals / np.bincount(marks, minlength=2)), shaped)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with three more columns at the end: _score (double), _predicted (int), _nearest (doc_ids of the examples that voted)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    new = zip(unused(docs, "_score", "_predicted", "_nearest"), (DoubleType(), IntegerType(), ArrayType(LongType())), strict=True)
    out = StructType([*docs.schema.fields, *[StructField(name, kind) for name, kind in new]])
    schema = to_arrow_schema(out)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            scores, near = own.score(b.column(at))
            more = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(near, schema.field(len(schema) - 1).type)]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], schema=schema)

    return in_arrow(docs, run, out)
