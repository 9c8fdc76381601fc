"""Best-fit packing of tokenized documents into sequences, by hierarchical residual packing.

1. Each task tokenizes its documents, ends each with an id, cuts what is longer than a sequence, and keeps only
   (doc_id, piece, start, length, crc of its ids): texts are not needed again.
2. Each task packs its pieces best-fit, longest first. Bins that are full to within a slack are emitted.
3. The underfull bins are the items of the next round, with fewer tasks (a tree merge), and so on. A task never gets more
   than ITEMS bins. The last round emits all; so do bins that a round could not join with any other.

Rounds end when one task is left, when nothing can be joined any more, or after `rounds`; what is underfull then is emitted as
it is, so these limits cost free places, never pieces.

Defined cases: a null or empty text is one piece of one id (the end); repeated rows are packed each on their own; a null
doc_id is kept; pieces of equal length go in the order in which their task reads them, and of bins with equal free places the
last one opened is filled; very long texts are tokenized piece by piece, whole; without documents there are no pieces; extra
columns are not looked at, whatever their names.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from versica.llm.common import id_text, in_arrow, stored

SEQUENCE, END = 4096, 1
#: Bins that a task of a later round packs at most, about; and free places that a bin emitted early may have.
ITEMS, SLACK, FAN_IN = 400_000, 8, 8
#: Words whose ids a worker keeps.
WORDS = 200_000

# Texts of these characters only are split into words here, as the tokenizer's own rules would; all others go to the tokenizer whole.
_LETTERS = "a-zß-öø-ÿœšž"
#: Characters that are tokenized at a time, and where a long text may be cut.
LONG, _GAP = 1 << 20, re.compile(r"[ \n](?=[A-Za-z])")
#: The description of the rules that are rebuilt here.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_PLAIN = re.compile(f"[\n\r\t\x20-\x7e{_LETTERS}À-ÖØ-ÞŒŠŽ¡-©«¬®-±´¶-¸»¿]*")
_SPLIT = re.compile(f"[{_LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\s{_LETTERS}0-9]+")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers give each byte: printable ones stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTER_OF = _byte_letters()


class Tokens:
    """Token ids of texts, as bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.by_words = self._splits_alike()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(_LETTER_OF)
        return np.array([t.id for t in self.tokenizer.model.tokenize(letters)], "<u4").tobytes()

    def _splits_alike(self) -> bool:
        """Whether the tokenizer normalizes and splits by the rules that are rebuilt here, by its own description and by a probe; else all texts go to the tokenizer whole."""
        rules = json.loads(self.tokenizer.to_str())
        if (rules["normalizer"], rules["pre_tokenizer"], rules["model"].get("dropout")) != (_NORMALIZER, _SPLITTER, None):
            return False
        plain = "".join(c for c in map(chr, range(0x20, 0x180)) if _PLAIN.fullmatch(c))
        probes = [plain, " ".join(plain), "It's we'll 'tis don't\n\tx'RE 12ab34 a--b, (c)\r\nÀÉß 'd\"'s", "".join(f"a{c}b {c}{c} 1{c}" for c in plain)]
        return all(self._words(p) == self._whole(p) for p in probes)

    def _words(self, text: str) -> bytes:
        words = _SPLIT.findall(text.lower())
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            new = [w for w in dict.fromkeys(words) if w not in self.known]
            if len(self.known) + len(new) > WORDS:
                own = {w: self._word(w) for w in new}
                return b"".join(self.known.get(w) or own[w] for w in words)
            for w in new:
                self.known[w] = self._word(w)
            return b"".join(map(self.known.__getitem__, words))

    def _piece(self, text: str) -> bytes:
        return self._words(text) if self.by_words and "<|" not in text and _PLAIN.fullmatch(text) else self._whole(text)

    def ids(self, text: str) -> bytes:
        """Of very long texts piece by piece, where the rules split words at white space anyhow."""
        if len(text) <= LONG or not self.by_words:
            return self._piece(text)
        out, at = [], 0
        while at < len(text):
            cut = _GAP.search(text, at + LONG)
            end = cut.end() if cut else len(text)
            out.append(self._piece(text[at:end]))
            at = end
        return b"".join(out)


@functools.cache
def _tokens(path: str) -> Tokens:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokens(path)


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for docs(doc_id, text)."""
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(tokenizer)
        for b in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = tokens.ids(text.as_py()) + last
                for k, at in enumerate(range(0, len(ids), 4 * sequence)):
                    own = ids[at : at + 4 * sequence]
                    doc.append(doc_id)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return in_arrow(docs, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best fit, longest first: (bin of each item, its offset there, number of bins).

    Open bins are stacked by free places; a bit mask of the free places in use finds the tightest that is large enough.
    """
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, n = 0, 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        above = mask >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            at = stacks[free].pop()
            if not stacks[free]:
                mask ^= 1 << free
        else:
            free, at, n = capacity, n, n + 1
        bins[i], offsets[i] = at, capacity - free
        if free > size:
            stacks[free - size].append(at)
            mask |= 1 << (free - size)
    return bins, offsets, n


_MEMBERS = ("doc_id", "piece", "start", "length", "ids_crc32", "offset")
_BIN = "bin long, fill long, done boolean, joined boolean, members array<struct<doc_id: long, piece: int, start: long, length: long, ids_crc32: long, offset: long>>"
_KIND = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), *[(n, pa.int64()) for n in _MEMBERS[2:]]])


def _round(number: int, sequence: int, first: bool, slack: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs a task's pieces (first) or bins; a row for each bin, done if it is not to be an item again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            if first:
                sizes, at = t["length"].to_numpy(), np.arange(t.num_rows)
                own = {n: t[n].combine_chunks() for n in _MEMBERS[:-1]}
                inner = np.zeros(t.num_rows, np.int64)
            else:
                sizes = t["fill"].to_numpy()
                lists = t["members"].combine_chunks()
                at, flat = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists)
                own = {n: flat.field(n) for n in _MEMBERS[:-1]}
                inner = flat.field("offset").to_numpy()
            bins, offsets, n = best_fit(sizes, sequence)
            of, place = bins[at], offsets[at] + inner
            order = np.lexsort((place, of))
            fill = np.bincount(bins, sizes, n).astype(np.int64)
            joined = np.bincount(bins, minlength=n) > 1
            members = pa.StructArray.from_arrays([*[own[k].take(pa.array(order)) for k in _MEMBERS[:-1]], pa.array(place[order])], fields=list(_KIND))
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32)
            task = TaskContext.get()
            ids = (number << 56) + ((task.partitionId() if task else 0) << 28) + started[0] + np.arange(n, dtype=np.int64)
            started[0] += n
            table = pa.Table.from_arrays([pa.array(ids), pa.array(fill), pa.array(fill >= sequence - slack), pa.array(joined), pa.ListArray.from_arrays(pa.array(ends), members)], ["bin", "fill", "done", "joined", "members"])
            yield from table.to_batches(max_chunksize=20_000)

        started = [0]
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= ITEMS:
                yield from out()
                held, rows = [], 0
        if rows:
            yield from out()

    return run


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end: int = END, id_col: str = "doc_id", text_col: str = "text", rounds: int = 12) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of docs."""
    spark = docs.sparkSession
    first = stored(pieces(id_text(docs, id_col, text_col), tokenizer, sequence, end), "pieces")
    tasks = max(1, first.rdd.getNumPartitions())
    bins = stored(in_arrow(first, _round(0, sequence, True, SLACK), _BIN, ITEMS), "bins0")
    finished: list[DataFrame] = []
    left = bins.where("NOT done").count()
    for k in range(1, rounds):
        finished.append(bins.where("done"))
        items = bins.where("NOT done")
        tasks = max(1, -(-tasks // FAN_IN), -(-left // ITEMS))
        packed = in_arrow(items.coalesce(tasks), _round(k, sequence, False, SLACK), _BIN, ITEMS)
        bins, was = stored(packed, f"bins{k}"), left
        left = bins.where("NOT done").count()
        if tasks == 1 or left == 0 or (left > 0.99 * was and tasks <= -(-left // ITEMS)):
            break
    finished.append(bins)
    every = functools.reduce(DataFrame.unionByName, finished)
    out = every.selectExpr("bin AS sequence_id", "inline(members)")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
