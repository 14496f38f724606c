"""WARC derivatives: metadata and plain-text conversion records of response records.

Each response gives two records that name it in WARC-Refers-To and each other in
WARC-Concurrent-To. The metadata record carries the source's WARC and HTTP headers, its
digests, the title and the links; the conversion record carries the page's text. Record
ids are made from the source's, so that a repeated run makes the same records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from classmap.functions.names import col

TAG = re.compile(rb"<(/?)([a-zA-Z][^\s/>]*)")
TAG_STOP = re.compile(rb"[>\"']")
LINK = re.compile(rb"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
# Elements whose content is no text, and elements that end a line.
HIDDEN = {b"script", b"style", b"template", b"iframe", b"noembed", b"noframes"}
LINES = frozenset(
    b"address article aside blockquote body br caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    b"h5 h6 head header hr html legend li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split()
)
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"

RECORDS = (
    "source_id {id}, record_type string, record_id string, refers_to string, concurrent_to string, "
    "target_uri string, warc_date string, content_type string, content_length bigint, block_digest string, "
    "source_block_digest string, source_payload_digest string, source_headers string, block string"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_uri(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(names))}>"


def _tag_end(data: bytes, at: int) -> int:
    """Just after the ``>`` that ends the tag at ``at``; quoted values may hold one."""
    seek = at
    while m := TAG_STOP.search(data, seek):
        if m[0] == b">":
            return m.end()
        close = data.find(m[0], m.end())
        if close < 0:
            break
        seek = close + 1
    plain = data.find(b">", at)
    return plain + 1 if plain >= 0 else len(data)


def page_text(data: bytes) -> tuple[str, str, list[str]]:
    """Title, visible text and link targets of an HTML page, in one pass over it."""
    lower, parts, links, title, at = data.lower(), [], [], b"", 0
    while True:
        lt = data.find(b"<", at)
        parts.append(data[at : lt if lt >= 0 else len(data)].replace(b"\n", b" "))
        if lt < 0:
            break
        if data.startswith(b"<!--", lt):
            end = data.find(b"-->", lt + 4)
            if end < 0:
                break
            at = end + 3
            continue
        m = TAG.match(data, lt)
        if m is None:
            if data[lt + 1 : lt + 2] in (b"!", b"?", b"/"):
                at = _tag_end(data, lt)
            else:
                parts.append(b"<")
                at = lt + 1
            continue
        name, at = m[2].lower(), _tag_end(data, lt)
        if name in LINES:
            parts.append(b"\n")
        if m[1]:
            continue
        if name == b"a" and (link := LINK.search(data, lt, at)):
            links.append(html.unescape((link[1] or link[2] or link[3] or b"").decode("utf-8", "replace")))
        if name in HIDDEN or name == b"title":
            end = lower.find(b"</" + name, at)
            if end < 0:
                break
            if name == b"title":
                title = title or data[at:end]
                parts.append(data[at:end].replace(b"\n", b" "))
            at = end

    def clean(raw: bytes) -> list[str]:
        lines = html.unescape(raw.decode("utf-8", "replace")).split("\n")
        return [line for x in lines if (line := " ".join(x.split()))]

    return " ".join(clean(title)), "\n".join(clean(b"".join(parts))), links


def responses(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", body: str = "html", date: str) -> DataFrame:
    """Response records ``source_id, record_id, target_uri, warc_date, http_head, payload``
    of a table of fetched pages."""
    uri = col(url)
    name = F.concat_ws(" ", F.lit("response"), col(page_id).cast("string"), uri)
    hexed = F.sha1(name)
    parts = [F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(
        col(page_id).alias("source_id"),
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        uri.alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.lit(HTTP_HEAD).alias("http_head"),
        col(body).alias("payload"),
    )


def _http_fields(head: str) -> tuple[str, dict[str, str]]:
    first, *rest = head.strip().split("\r\n")
    return first, {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in rest) if k.strip()}


def derivatives(source: DataFrame) -> DataFrame:
    """Two records per response: its metadata and its text.

    ``source`` has the columns that ``responses`` makes. A null payload is an empty one,
    whose text is empty; null URIs, dates and HTTP heads stay null or empty in what is
    derived. A null record id gives null ``refers_to``; ids of the derived records then
    come from the source id. Rows that repeat a record id give the same record ids again.
    Other columns, of any name, are ignored. An empty table gives an empty result.
    """
    rows = source.select(
        "source_id", "record_id", "target_uri", "warc_date", F.coalesce("http_head", F.lit("")).alias("http_head"),
        F.coalesce("payload", F.lit("")).alias("payload"),
    )
    schema = RECORDS.format(id=rows.schema["source_id"].dataType.simpleString())
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def derived(record_id: str | None, source_id: object, uri: str | None, date: str | None, head: str, payload: bytes):
        title, text, links = page_text(payload)
        status, fields = _http_fields(head)
        block_digest, payload_digest = digest(head.encode() + payload), digest(payload)
        origin = record_id if record_id is not None else f"source {source_id}"
        ids = {kind: record_uri(kind, origin) for kind in ("metadata", "conversion")}
        warc = {
            "WARC-Type": "response", "WARC-Record-ID": record_id, "WARC-Target-URI": uri, "WARC-Date": date,
            "WARC-Block-Digest": block_digest, "WARC-Payload-Digest": payload_digest,
            "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(head.encode()) + len(payload)),
        }
        source_headers = json.dumps({"warc": warc, "status": status, "http": fields}, ensure_ascii=False)
        about = json.dumps({"title": title, "links": links, "source": json.loads(source_headers)}, ensure_ascii=False)
        for kind, other, content, block in (
            ("metadata", "conversion", "application/json", about),
            ("conversion", "metadata", "text/plain; charset=UTF-8", text),
        ):
            data = block.encode()
            yield (
                kind, ids[kind], record_id, ids[other], uri, date, content, len(data), digest(data),
                block_digest, payload_digest, source_headers, block,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                columns = [c.to_pylist() for c in part.columns[:5]]
                payloads = part.column("payload").cast(pa.large_binary()).to_pylist()
                made = [
                    (i, *record)
                    for i, (source_id, record_id, uri, date, head, payload) in enumerate(zip(*columns, payloads, strict=True))
                    for record in derived(record_id, source_id, uri, date, head, payload)
                ]
                of = part.column("source_id").take(pa.array([m[0] for m in made], pa.int64()))
                kinds = [pa.int64() if n == "content_length" else pa.string() for n in names[1:]]
                values = [pa.array([m[j + 1] for m in made], k) for j, k in enumerate(kinds)]
                yield pa.record_batch([of, *values], names)

    return rows.mapInArrow(run, schema)


def record_text(records: DataFrame) -> Column:
    """A record as it stands in a WARC file, but for the two line ends after it."""
    fields = [
        ("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
        ("WARC-Concurrent-To", "concurrent_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "warc_date"),
        ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"),
    ]
    lines = [F.concat(F.lit(f"{name}: "), records[c]) for name, c in fields]  # null ones are left out
    length = F.concat(F.lit("Content-Length: "), records["content_length"].cast("string"))
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines, length), F.lit("\r\n\r\n"), records["block"])


def write_warc(records: DataFrame, path: str) -> None:
    """One WARC file per partition."""
    records.select(record_text(records).alias("value")).write.option("lineSep", "\r\n\r\n").text(path)
