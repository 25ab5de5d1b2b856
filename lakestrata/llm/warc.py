"""Operator 9: WARC derivative builder.

Every page becomes a response record (HTTP header block and body) and from it
two derived records: ``metadata`` (warc-fields: title, language, links out,
digest and length of the source) and ``conversion`` (the page's plain text).
Both carry the response's record id as WARC-Refers-To, its target URI and
date, the source record's block and payload digests, and their own digests.
Record ids are name-based, so a lost task that runs again writes the same
records.

``derivatives`` gives one row per record with its header and block;
``write_warc`` writes such rows as gzip members, one shard file per
partition under an attempt's own name, and returns the manifest of shards;
``read_warc`` reads the shards back.

Defined cases: null url and null html count as empty; equal rows and ids
give equal records; a null id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as html_entities
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .shared import columns, ship, stored

DATE = "2025-01-01T00:00:00Z"
SPACE_ID = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public namespace of URLs
SLICE_ROWS = 500
TYPES = ["response", "metadata", "conversion"]
FIELDS = [
    "page_id", "record_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "content_length",
    "block_digest", "payload_digest", "source_block_digest", "source_payload_digest", "source_header", "block",
]

_hidden = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)")
_head = re.compile(r"(?is)<head\b.*?(?:</head\s*>|(?=<body\b)|\Z)")
_title = re.compile(r"(?is)<title\b[^>]*>(.*?)(?:</title\s*>|\Z)")
_lang = re.compile(r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z0-9-]+)""")
_link = re.compile(r"""(?is)<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_block = re.compile(
    r"(?i)</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*(?:>|\Z)"
)
_tag = re.compile(r"<(?=[A-Za-z/!?])[^>]*(?:>|\Z)")
_blank = re.compile(r"[ \t\r\f\v\xa0]+")


def plain_text(html: str) -> str:
    """Text of a page: no scripts, styles, comments or head; a line per block."""
    text = _head.sub("", _hidden.sub("", html))
    text = html_entities.unescape(_tag.sub("", _block.sub("\n", text.replace("\n", " "))))
    lines = (_blank.sub(" ", x).strip() for x in text.split("\n"))
    return "\n".join(x for x in lines if x)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block, usedforsecurity=False).digest()).decode()


def records(page_id, url: str | None, html: str | None, date: str = DATE) -> list[dict]:
    """The response record of a page and its two derivatives."""
    url, html = url or "", html or ""
    body = html.encode()
    header = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
    source = digest(body)
    seed = f"{page_id}\n{url}\n{source}"

    def record(kind, content_type, block, payload, refers, extra=""):
        return {
            "page_id": page_id, "record_type": kind, "record_id": f"<urn:uuid:{uuid.uuid5(SPACE_ID, f'{kind}\n{seed}')}>",
            "refers_to": refers, "target_uri": url, "warc_date": date, "content_type": content_type, "content_length": len(block),
            "block_digest": digest(block), "payload_digest": payload, "source_header": extra, "block": block,
        }

    out = [record("response", "application/http; msgtype=response", header.encode() + body, source, None)]
    first = out[0]
    shown = _hidden.sub("", html)
    title, lang = _title.search(shown), _lang.search(shown)
    fields = [("title", " ".join(html_entities.unescape(title[1]).split()) if title else ""), ("lang", lang[1] if lang else "")]
    fields += [("source-digest", source), ("source-length", str(len(body)))]
    fields += [("outlink", " ".join(html_entities.unescape(a or b or c).split())) for a, b, c in _link.findall(shown)]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    out.append(record("metadata", "application/warc-fields", meta, digest(meta), first["record_id"], header))
    text = plain_text(html).encode()
    out.append(record("conversion", "text/plain; charset=utf-8", text, digest(text), first["record_id"], header))
    for r in out:
        r["source_block_digest"] = None if r is first else first["block_digest"]
        r["source_payload_digest"] = None if r is first else source
    return out


def _schema(id_type: str) -> str:
    return (
        f"page_id {id_type}, record_type string, record_id string, refers_to string, target_uri string, warc_date string, "
        "content_type string, content_length long, block_digest string, payload_digest string, source_block_digest string, "
        "source_payload_digest string, source_header string, block binary"
    )


def _build(types: list[str], date: str):
    def run(batches):
        kinds = [pa.string()] * 6 + [pa.int64()] + [pa.string()] * 5 + [pa.binary()]
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(a, SLICE_ROWS)
                rows = [
                    r
                    for p, u, h in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True)
                    for r in records(p, u, h, date)
                    if r["record_type"] in types
                ]
                if rows:
                    types_of = [batch.schema.field("page_id").type, *kinds]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[f] for r in rows], t) for f, t in zip(FIELDS, types_of, strict=True)], names=FIELDS
                    )

    return run


def derivatives(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    types: tuple[str, ...] = ("metadata", "conversion"), date: str = DATE,
) -> DataFrame:
    """One row per record (see FIELDS)."""
    ship(pages.sparkSession)
    pages = columns(pages, page_id=id_col, url=url_col, html=html_col)
    return pages.mapInArrow(_build(list(types), date), _schema(pages.schema["page_id"].dataType.simpleString()))


def _member(r: dict) -> bytes:
    head = [
        ("WARC-Type", r["record_type"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["warc_date"]),
        ("WARC-Target-URI", r["target_uri"]), ("WARC-Refers-To", r["refers_to"]), ("WARC-Block-Digest", r["block_digest"]),
        ("WARC-Payload-Digest", r["payload_digest"]), ("X-Source-Block-Digest", r["source_block_digest"]),
        ("X-Source-Payload-Digest", r["source_payload_digest"]), ("X-Page-ID", r["page_id"]), ("Content-Type", r["content_type"]),
        ("Content-Length", len(r["block"])),
    ]
    text = "".join(f"{k}: {' '.join(str(v).split())}\r\n" for k, v in head if v is not None)
    return gzip.compress(f"WARC/1.1\r\n{text}\r\n".encode() + r["block"] + b"\r\n\r\n", mtime=0)


def _write(folder: str):
    def run(batches):
        part, n, name, out = TaskContext.get().partitionId(), 0, None, None
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE_ROWS):
                for r in batch.slice(a, SLICE_ROWS).to_pylist():
                    if out is None:
                        store.create_dir(root, recursive=True)
                        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}.warc.gz"
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(_member(r))
                    n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "n_records"])

    return run


def write_warc(rows: DataFrame, folder: str) -> DataFrame:
    """Write record rows as WARC shards; the manifest (file, n_records)."""
    ship(rows.sparkSession)
    return stored(rows.select(*FIELDS).mapInArrow(_write(folder), "file string, n_records long"), "op9-manifest")


def parse_members(stream) -> list[tuple[dict, bytes]]:
    """(header fields, block) of each gzip member of a binary stream, one at a time."""
    buffer, z, raw = b"", zlib.decompressobj(31), b""
    while True:
        if not buffer:
            buffer = stream.read(1 << 20)
            if not buffer:
                return
        raw += z.decompress(buffer)
        buffer = z.unused_data if z.eof else b""
        if z.eof:
            head, _, rest = raw.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
            yield fields, rest[: int(fields["Content-Length"])]
            z, raw = zlib.decompressobj(31), b""


def _read(folder: str):
    def run(batches):
        store, root = pafs.FileSystem.from_uri(folder)
        names = ["record_type", "record_id", "refers_to", "target_uri", "block_digest", "block"]
        keys = ["WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Block-Digest"]
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                with store.open_input_stream(f"{root}/{file}", compression=None) as f:
                    for fields, block in parse_members(f):
                        rows.append([fields.get(k) for k in keys] + [block])
                        if len(rows) == SLICE_ROWS:
                            yield _batch(rows, names)
                            rows = []
                if rows:
                    yield _batch(rows, names)

    def _batch(rows, names):
        kinds = [pa.string()] * 5 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """Records of the manifest's shards."""
    ship(manifest.sparkSession)
    schema = "record_type string, record_id string, refers_to string, target_uri string, block_digest string, block binary"
    return manifest.select("file").repartition(max(1, manifest.count()), "file").mapInArrow(_read(folder), schema)
