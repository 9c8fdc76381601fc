"""Media columns: payloads stored as PNG in binary columns, read back and hashed.

encode() turns bytes into an 8-bit grey PNG of WIDTH samples a row (zero padded), filtered per row and deflated. features()
reads any 8-bit, non-interlaced PNG: signature, chunk lengths and CRCs are checked, the IDAT stream is inflated, rows are
unfiltered with numpy, and the low frequencies of a cosine transform become a 64-bit hash.

Defined cases: a null or empty payload is one row of zeros; equal payloads give equal bytes and values (with one version of
zlib); of row filters with equal sums the first counts; repeated rows and null ids come out as they are; very long payloads are
stored whole; an empty table gives no rows; a damaged PNG raises ValueError naming what is wrong; extra columns are not looked
at, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from versica.llm.common import arrow_map, binary, id_text

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples a pixel by PNG colour type.
SAMPLES = {0: 1, 2: 3, 4: 2, 6: 4}
SIDE, LOW = 32, 8
_COS = np.cos(np.pi * (2 * np.arange(SIDE)[None, :] + 1) * np.arange(LOW)[:, None] / (2 * SIDE))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png(payload: bytes, width: int = WIDTH, level: int = 6) -> bytes:
    """A grey PNG of a payload whose length is a positive multiple of width."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    left, up = np.zeros_like(rows), np.zeros_like(rows)
    left[:, 1:], up[1:] = rows[:, :-1], rows[:-1]
    choices = np.stack([rows, rows - left, rows - up])  # filters 0 none, 1 sub, 2 up
    best = np.abs(choices.view(np.int8).astype(np.int16)).sum(axis=2).argmin(axis=0)
    lines = np.empty((len(rows), width + 1), np.uint8)
    lines[:, 0], lines[:, 1:] = best, choices[best, np.arange(len(rows))]
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def _average_or_paeth(line: np.ndarray, above: np.ndarray, bpp: int, paeth: bool) -> np.ndarray:
    out, up = bytearray(line.tobytes()), above.tobytes()
    for i in range(len(out)):
        a, b = out[i - bpp] if i >= bpp else 0, up[i]
        if paeth:
            c = up[i - bpp] if i >= bpp else 0
            pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            add = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
        else:
            add = (a + b) // 2
        out[i] = (out[i] + add) & 255
    return np.frombuffer(bytes(out), np.uint8)


def unfilter(lines: np.ndarray, bpp: int) -> np.ndarray:
    """Rows with a filter byte each -> samples. Runs of rows with one filter are undone together."""
    kinds, data = lines[:, 0], lines[:, 1:]
    out = np.empty_like(data)
    starts = [0, *(np.flatnonzero(np.diff(kinds)) + 1), len(kinds)]
    for i, j in zip(starts[:-1], starts[1:], strict=True):
        kind, above = kinds[i], out[i - 1] if i else np.zeros(data.shape[1], np.uint8)
        if kind == 0:
            out[i:j] = data[i:j]
        elif kind == 1:
            out[i:j] = np.add.accumulate(data[i:j].reshape(j - i, -1, bpp), axis=1, dtype=np.uint8).reshape(j - i, -1)
        elif kind == 2:
            out[i:j] = np.add.accumulate(data[i:j], axis=0, dtype=np.uint8) + above
        elif kind in (3, 4):
            for k in range(i, j):
                above = out[k] = _average_or_paeth(data[k], above, bpp, kind == 4)
        else:
            raise ValueError(f"row filter {kind}")
    return out


def read_png(stored: bytes) -> np.ndarray:
    """Samples (height, width, samples a pixel) of an 8-bit PNG; ValueError if it is damaged or of another kind."""
    if stored[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, head, idat, ended = 8, None, [], False
    while not ended:
        if at + 12 > len(stored):
            raise ValueError("PNG ends early")
        (n,), kind = struct.unpack_from(">I", stored, at), stored[at + 4 : at + 8]
        data = stored[at + 8 : at + 8 + n]
        if len(stored) < at + 12 + n or zlib.crc32(kind + data) != struct.unpack_from(">I", stored, at + 8 + n)[0]:
            raise ValueError(f"checksum of {kind!r}")
        head = struct.unpack(">IIBBBBB", data) if kind == b"IHDR" else head
        idat += [data] if kind == b"IDAT" else []
        ended, at = kind == b"IEND", at + 12 + n
    if head is None or head[2] != 8 or head[3] not in SAMPLES or head[4:] != (0, 0, 0):
        raise ValueError(f"header {head}")
    bpp = SAMPLES[head[3]]
    try:
        raw = zlib.decompress(b"".join(idat))
    except zlib.error as e:
        raise ValueError(f"IDAT: {e}") from e
    if len(raw) != head[1] * (head[0] * bpp + 1):
        raise ValueError("IDAT length")
    return unfilter(np.frombuffer(raw, np.uint8).reshape(head[1], -1), bpp).reshape(head[1], head[0], bpp)


def _boxes(n: int) -> tuple[np.ndarray, np.ndarray]:
    lo = np.arange(SIDE) * n // SIDE
    return lo, np.maximum(lo + 1, (np.arange(SIDE) + 1) * n // SIDE)


def cosine_hash(grey: np.ndarray) -> str:
    """Box averages on a 32 x 32 grid, 8 x 8 low frequencies of their cosine transform; a bit is 1 above the median of those but the first."""
    grid = grey.astype(np.int64)
    for axis in (0, 1):
        lo, hi = _boxes(grid.shape[axis])
        sums = np.concatenate([np.zeros_like(grid.take([0], axis)), grid.cumsum(axis)], axis)
        grid = (sums.take(hi, axis) - sums.take(lo, axis)) / (hi - lo).reshape((-1, 1) if axis == 0 else (1, -1))
    low = np.round(_COS @ grid @ _COS.T, 6).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return np.packbits(bits).tobytes().hex()


def payload(text: bytes | None) -> tuple[int, bytes]:
    text = text or b""
    return len(text), text + bytes(max(WIDTH, -(-len(text) // WIDTH) * WIDTH) - len(text))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each text's UTF-8 bytes as a PNG."""

    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        padded = [payload(t) for t in binary(b.column("text"))]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([n for n, _ in padded], pa.int64()), pa.array([png(p) for _, p in padded], pa.binary())], ["doc_id", "n_bytes", "media"])

    return arrow_map(id_text(docs, id_col, text_col), rows, "doc_id long, n_bytes long, media binary")


def features(media: DataFrame) -> DataFrame:
    """From (doc_id, n_bytes, media): what the stored bytes hold when read back."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for m in b.column("media").to_pylist():
            samples = read_png(m)
            p = samples.tobytes()
            out.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-WIDTH:]), len(m), hashlib.sha256(m).hexdigest(), cosine_hash(samples[:, :, 0])))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *[pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]], names)

    return arrow_map(media, rows, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
