"""WARC derivatives: response records become linked metadata and plain-text conversion records.

responses() writes a WARC/1.1 response record for each page; read_records() parses WARC bytes, plain or gzip members;
derive() makes of each response a metadata record (source headers, digests, title, counts) and a conversion record (plain
text), both with WARC-Refers-To the response; segments() joins records into file images of bounded size.

Defined cases: null html or url counts as empty; equal rows (page id, url, html) are one capture met more than once: their
records are equal, with equal identifiers; null page ids come out as they are; a cut-off record raises ValueError; records other
than responses have no derivatives; very long pages are converted whole; an empty table gives no records; a null date is DATE;
extra columns are not looked at, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from versica.llm.common import arrow_map, in_arrow, quoted

NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "https://versica.invalid/warc")
DATE = "2024-01-01T00:00:00Z"
_GONE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|section|article|header|footer|nav|aside|main|form|blockquote|pre|hr|dl|dt|dd|body|html|head)\b[^>]*>", re.I)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*(?:>|\Z)")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title|\Z)", re.S | re.I)
_LINK = re.compile(r"<a\s[^>]*\bhref\s*=", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(1).join(parts))}>"


def record(kind: str, block: bytes, fields: list[tuple[str, str]]) -> bytes:
    head = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _field(value: str) -> str:
    """A header value: control characters would end the line."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def response(page_id: int | None, url: str | None, page: bytes | None, date: str | None = None) -> bytes:
    page, url = page or b"", _field(url or "")
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(page)}\r\n\r\n".encode() + page
    payload = digest(page)
    return record("response", block, [("WARC-Record-ID", identifier("response", str(page_id), url, payload)), ("WARC-Date", _field(date or "") or DATE), ("WARC-Target-URI", url), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", payload)])


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record; ValueError where a record is cut off or its digest is wrong."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError("cut-off WARC header")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        n = int(fields.get("content-length", "-1"))
        block, at = data[end + 4 : end + 4 + n], end + 8 + n
        if n < 0 or len(block) < n or data[at - 4 : at] != b"\r\n\r\n":
            raise ValueError("cut-off WARC record")
        if fields.get("warc-block-digest", digest(block) if "warc-block-digest" in fields else "") not in ("", digest(block)):
            raise ValueError("WARC block digest")
        yield fields, block


def plain_text(page: str) -> str:
    """All text of a page: a line for each block, white space collapsed."""
    text = _TAG.sub("", _BREAK.sub("\n", _GONE.sub("\n", page).replace("\n", " ")))
    return "\n".join(x for line in html.unescape(text).split("\n") if (x := " ".join(line.split())))


def derivatives(fields: dict[str, str], block: bytes) -> list[tuple[str, str, bytes, int]]:
    """(type, record id, record, bytes of its block) of a response's metadata and conversion records."""
    source, url, date = fields["warc-record-id"], fields.get("warc-target-uri", ""), fields.get("warc-date", DATE)
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *http = head.decode("utf-8", "replace").split("\r\n")
    names = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in http))
    charset = re.search(r"charset=([\w-]+)", names.get("content-type", ""), re.I)
    try:
        page = payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    text = plain_text(page).encode()
    title = _TITLE.search(page)
    about = [("source-status", status), *[(f"source-{k}", v) for k, v in names.items()], ("source-payload-digest", digest(payload)), ("source-block-digest", fields.get("warc-block-digest", "")), ("title", _field(html.unescape(title[1])) if title else ""), ("outlinks", str(len(_LINK.findall(page)))), ("text-length", str(len(text)))]
    meta = "".join(f"{k}: {v}\r\n" for k, v in about).encode()
    own = {k: identifier(k, source) for k in ("metadata", "conversion")}
    links = [("WARC-Refers-To", source), ("WARC-Target-URI", url), ("WARC-Date", date)]
    return [
        ("metadata", own["metadata"], record("metadata", meta, [("WARC-Record-ID", own["metadata"]), *links, ("Content-Type", "application/warc-fields")]), len(meta)),
        ("conversion", own["conversion"], record("conversion", text, [("WARC-Record-ID", own["conversion"]), *links, ("WARC-Concurrent-To", own["metadata"]), ("Content-Type", "text/plain; charset=utf-8"), ("WARC-Payload-Digest", digest(text))]), len(text)),
    ]


def responses(pages: DataFrame, date_col: str | None = None) -> DataFrame:
    """page_id, warc: a response record for each row of pages(page_id, url, html); date_col: a column of capture dates, as text."""

    def rows(b: pa.RecordBatch) -> pa.RecordBatch:
        each = zip(*(b.column(n).to_pylist() for n in ("page_id", "url", "html", "date")), strict=True)
        out = [response(i, u, h.encode() if h is not None else None, d) for i, u, h, d in each]
        return pa.RecordBatch.from_arrays([b.column("page_id"), pa.array(out, pa.binary())], ["page_id", "warc"])

    date = F.col(quoted(date_col)).cast("string") if date_col else F.lit(None).cast("string")
    return arrow_map(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", date.alias("date")), rows, "page_id long, warc binary")


#: What derive() returns of each record.
RECORD = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, warc_date string, source_status string, source_headers map<string, string>, "
    "source_payload_digest string, source_block_digest string, block_digest string, n_bytes long, text string, warc binary"
)


def source_headers(block: bytes) -> tuple[str, dict[str, str]]:
    """Status line, and headers by lower-case name (the last of a name counts), of an HTTP response."""
    status, *lines = block.partition(b"\r\n\r\n")[0].decode("utf-8", "replace").split("\r\n")
    return status, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def derive(records: DataFrame) -> DataFrame:
    """From (page_id, warc), RECORD for each derived record: what it refers to, the source's status, headers and digests, its own
    digest and bytes, the text of a conversion (null for metadata), and the whole WARC record."""
    kinds = [pa.int64(), *[pa.string()] * 6, pa.map_(pa.string(), pa.string()), *[pa.string()] * 3, pa.int64(), pa.string(), pa.binary()]
    names = StructType.fromDDL(RECORD).names

    def rows(b: pa.RecordBatch) -> pa.RecordBatch | None:
        out = []
        for page_id, data in zip(b.column("page_id").to_pylist(), b.column("warc").to_pylist(), strict=True):
            for fields, block in read_records(data):
                if fields.get("warc-type") == "response":
                    status, headers = source_headers(block)
                    for kind, own, made, n in derivatives(fields, block):
                        body = made[-n - 4 : -4]
                        text = body.decode() if kind == "conversion" else None
                        about = (page_id, kind, own, fields["warc-record-id"], fields.get("warc-target-uri", ""), fields.get("warc-date", DATE), status, list(headers.items()))
                        out.append((*about, fields.get("warc-payload-digest", ""), fields.get("warc-block-digest", ""), digest(body), n, text, made))
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return arrow_map(records, rows, RECORD)


def segments(records: DataFrame, most_bytes: int = 1 << 27) -> DataFrame:
    """Each task's records as gzip members, joined into file images of about most_bytes: (image binary, n_records long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary()), pa.array([len(held)], pa.int64())], ["image", "n_records"])

        for b in batches:
            for data in b.column("warc").to_pylist():
                held.append(gzip.compress(data, 6, mtime=0))
                size += len(held[-1])
                if size >= most_bytes:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return in_arrow(records, run, "image binary, n_records long")
