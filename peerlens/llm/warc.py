"""WARC derivatives: responses to linked metadata and plain-text conversion records.

A record is its serialised bytes (WARC/1.1: version line, named fields, empty
line, block, two empty lines), so records of a partition written one after
another are a WARC file.  ``derive`` reads responses and makes two records of
each: ``metadata`` (status, source header fields, title, outlinks) and
``conversion`` (the text of an HTML payload).  Both name their source in
WARC-Refers-To, keep its target, date and other source fields, and carry the
digest of their own block and the payload digest of the source.

Record ids are derived from what a record is made of: reruns and repeated
rows give the same ids.  A null page body is an empty payload, a null address
leaves the target out.  Chunked, gzip and deflate bodies are undone before they
are read; an unknown character set is read as UTF-8.  Passed over by ``derive``
and counted by ``unreadable`` are: what is not a whole WARC record, or not a
response, or has no record id to refer to; bodies of other or broken codings;
bodies above ``MOST_BODY`` bytes once unpacked.  Pages are read in one pass from
left to right, so tags that are never closed cost no more than others.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.llm.store import small_batches

VERSION = b"WARC/1.1"
# Source fields that derivatives keep.
KEPT = ("WARC-Target-URI", "WARC-Date", "WARC-IP-Address", "WARC-Warcinfo-ID")
Fields = list[tuple[str, str]]

# A packed body may unpack to this much; beyond it the record counts as unreadable.
MOST_BODY = 1 << 28
# Python codecs that are no character sets of pages.
NO_CHARSETS = {"idna", "undefined", "punycode", "unicode-escape", "raw-unicode-escape"}
UNSEEN = {"script", "style", "noscript", "template", "head"}
BLOCKS = set(
    "p div li ul ol table tr h1 h2 h3 h4 h5 h6 article section nav header footer main aside pre blockquote br".split()
)

_FIELD_BREAK = re.compile(r"[\r\n]+")
# No pattern below runs on to a closing mark: that one is looked for once, with ``find``.
_OPEN = re.compile(r"<(?:(!--)|(/?)([a-zA-Z]\w*)|[/!?])")
_TITLE = re.compile(r"<title\b", re.I)
_TITLE_END = re.compile(r"</title\s*>", re.I)
_ANCHOR = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"""\bhref\s*=\s*(["']|[^\s>"'])""", re.I)
_VALUE = re.compile(r"[^\s>]+")
_CHARSET = re.compile(r"charset\s*=\s*\"?([\w.:-]+)", re.I)
_LEADING_ZEROS = re.compile(r"&#0+(?=[0-9])")
_HUGE = re.compile(r"&#[0-9]{8,};?")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: bytes) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(len(p).to_bytes(8, "big") + p)
    return f"<urn:uuid:{uuid.UUID(bytes=h.digest()[:16], version=4)}>"


def serialise(fields: Fields, block: bytes) -> bytes:
    head = [VERSION, *(f"{k}: {_FIELD_BREAK.sub(' ', v)}".encode() for k, v in fields)]
    head.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _named_fields(head: bytes) -> Fields:
    out: list[tuple[str, list[str]]] = []
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1][1].append(line.strip())
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), [value.strip()]))
    return [(name, " ".join(values)) for name, values in out]


def _number(digits: str) -> int | None:
    return int(digits) if digits.isascii() and digits.isdigit() and len(digits) < 19 else None


def parse(record: bytes | None) -> tuple[Fields, bytes] | None:
    """Fields and block of one whole record, None if it is not one."""
    if not record or not record.startswith(b"WARC/1."):
        return None
    head, gap, rest = record.partition(b"\r\n\r\n")
    fields = _named_fields(head.partition(b"\r\n")[2])
    length = _number(value(fields, "Content-Length"))
    if not gap or length is None or len(rest) < length:
        return None
    return [f for f in fields if f[0].lower() != "content-length"], rest[:length]


def value(fields: Fields, name: str) -> str:
    return next((v for k, v in fields if k.lower() == name.lower()), "")


def response(page_id: int | None, url: str | None, body: str | None, date: str) -> bytes:
    """A response record of a fetched page."""
    payload = (body or "").encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload
    fields = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id(b"response", str(page_id).encode(), (url or "").encode(), payload)),
        *([("WARC-Target-URI", url)] if url else []),
        ("WARC-Date", date),
        ("WARC-Block-Digest", digest(block)),
        ("WARC-Payload-Digest", digest(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return serialise(fields, block)


def unescape(text: str) -> str:
    """Character references resolved, also numbers of any length."""
    return html.unescape(_HUGE.sub("\ufffd", _LEADING_ZEROS.sub("&#", text)))


class _Ends:
    """The next closing tag of a name from a place on; places may only rise."""

    def __init__(self, page: str):
        self.page, self.found = page, {}

    def after(self, name: str, place: int) -> int | None:
        """Where the tag that closes ``name`` ends, None if there is none."""
        if name not in self.found:
            self.found[name] = [re.finditer(rf"</{name}\s*>", self.page, re.I), None]
        state = self.found[name]
        while state[0] is not None and (state[1] is None or state[1].start() < place):
            state[1] = next(state[0], None)
            if state[1] is None:
                state[0] = None
        return state[1].end() if state[0] is not None else None


def plain_text(page: str) -> str:
    """What a reader sees: no scripts, styles, comments or head; a line for each block."""
    out, place, comments, ends = [], 0, True, _Ends(page)
    while tag := _OPEN.search(page, place):
        out.append(page[place : tag.start()])
        name = (tag.group(3) or "").lower()
        end = page.find("-->", tag.end()) if tag.group(1) and comments else -1
        if end >= 0:
            out.append(" ")
            place = end + 3
            continue
        comments = comments and not tag.group(1)  # none is closed from here on
        end = page.find(">", tag.end())
        if end < 0:  # nor is any tag: the rest is text
            place = tag.start()
            break
        place = end + 1
        if name in UNSEEN and not tag.group(2) and (closed := ends.after(name, place)):
            out.append(" ")
            place = closed
        elif name in BLOCKS:
            out.append("\n")
    out.append(page[place:])
    lines = (" ".join(line.split()) for line in unescape("".join(out)).split("\n"))
    return "\n".join(line for line in lines if line)


def title_of(page: str) -> str | None:
    """The text of the first whole title."""
    start = _TITLE.search(page)
    end = page.find(">", start.end()) if start else -1
    close = _TITLE_END.search(page, end + 1) if end >= 0 else None
    return unescape(page[end + 1 : close.start()]).strip() if close else None


def links_of(page: str) -> list[str]:
    """The addresses of all anchors, in order."""
    out, place, quotes = [], 0, {'"', "'"}
    while anchor := _ANCHOR.search(page, place):
        end = page.find(">", anchor.end())
        end = len(page) if end < 0 else end
        place = end
        if not (href := _HREF.search(page, anchor.end(), end)):
            continue
        close = page.find(href.group(1), href.end()) if href.group(1) in quotes else -1
        if close >= 0:  # a quoted address may hold ">"
            out.append(unescape(page[href.end() : close]))
            place = max(end, close)
        else:
            quotes.discard(href.group(1))  # none closes from here on
            out.append(unescape(_VALUE.match(page, href.start(1)).group()))
    return out


def _joined_chunks(body: bytes) -> bytes | None:
    """A chunked body in one piece, None if it is not made of chunks."""
    out, place = [], 0
    while True:
        end = body.find(b"\r\n", place, place + 4096)
        size = body[place:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", size):
            return None
        size = int(size, 16)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        if len(out[-1]) < size:
            return None
        place = end + 2 + size + 2


def _unpacked(body: bytes, window: int) -> bytes | None:
    """All members of a packed body, None if it is broken or too large."""
    out, size = [], 0
    while body:
        packed = zlib.decompressobj(window)
        try:
            out.append(packed.decompress(body, MOST_BODY - size + 1))
        except zlib.error:
            return b"".join(out) if size and window == 31 else None  # bytes behind the last member
        size += len(out[-1])
        if size > MOST_BODY or not packed.eof:
            return None
        body = packed.unused_data
    return b"".join(out)


def _plain_body(http: Fields, payload: bytes) -> tuple[bytes, bytes] | None:
    """``(payload without chunks, body that can be read)``; codings that the bytes do not show were undone by the crawler."""
    if "chunked" in value(http, "Transfer-Encoding").lower():
        joined = _joined_chunks(payload)
        payload = payload if joined is None else joined
    body: bytes | None = payload
    codings = [c.strip() for c in value(http, "Content-Encoding").lower().split(",")]
    for coding in reversed([c for c in codings if c not in ("", "identity")]):
        if coding in ("gzip", "x-gzip"):
            body = _unpacked(body, 31) if body[:2] == b"\x1f\x8b" else body
        elif coding == "deflate":
            wrapped = _unpacked(body, 15)
            body = _unpacked(body, -15) if wrapped is None else wrapped
        else:
            return None
        if body is None:
            return None
    return payload, body


def _decoded(body: bytes, content_type: str) -> str:
    named = _CHARSET.search(content_type)
    try:
        charset = codecs.lookup(named.group(1)).name.replace("_", "-") if named else "utf-8"
        page = body.decode("utf-8" if charset in NO_CHARSETS else charset, "replace")
    except (LookupError, ValueError):
        page = body.decode("utf-8", "replace")
    return page.encode("utf-8", "replace").decode()  # no lone surrogates


def derivatives(record: bytes | None) -> list[bytes]:
    """The metadata and the conversion record of a response; none for anything else."""
    read = parse(record)
    if read is None or value(read[0], "WARC-Type").lower() != "response":
        return []
    fields, block = read
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        head, payload = b"", block
    status, _, named = head.partition(b"\r\n")
    http = _named_fields(named)
    source = value(fields, "WARC-Record-ID")
    read_body = _plain_body(http, payload)
    if not source or read_body is None:
        return []
    page = _decoded(read_body[1], value(http, "Content-Type"))
    payload_digest = value(fields, "WARC-Payload-Digest") or digest(read_body[0])
    linked = [
        ("WARC-Refers-To", source),
        *((k, value(fields, k)) for k in KEPT if value(fields, k)),
        ("X-Source-Payload-Digest", payload_digest),
    ]
    title = title_of(page)
    notes: Fields = [("status", status.decode("latin-1"))] if status else []
    notes += [(f"source-{k.lower()}", v) for k, v in http]
    notes += [] if title is None else [("title", title)]
    notes += [("outlink", link) for link in links_of(page)]
    noted = "".join(f"{k}: {_FIELD_BREAK.sub(' ', v)}\r\n" for k, v in notes).encode()
    text = plain_text(page).encode("utf-8", "replace")
    out = []
    for kind, content, made in (("metadata", "application/warc-fields", noted), ("conversion", "text/plain; charset=utf-8", text)):
        out.append(
            serialise(
                [
                    ("WARC-Type", kind),
                    ("WARC-Record-ID", record_id(kind.encode(), source.encode(), made)),
                    *linked,
                    ("WARC-Block-Digest", digest(made)),
                    ("Content-Type", content),
                ],
                made,
            )
        )
    return out


def _each(make: Callable[[dict], list[bytes]], asked: list[str], passed: str):
    """Map function: the records that ``make`` returns for each row, with the row's key; some rows a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for low in range(0, len(given), 500):
                batch = given.slice(low, 500)
                rows = zip(*(batch.column(c).to_pylist() for c in asked))
                made = [make(dict(zip(asked, row))) for row in rows]
                take = pa.array([i for i, m in enumerate(made) for _ in m], pa.int64())
                records = pa.array([r for m in made for r in m], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(passed).take(take), records], names=[passed, "record"])

    return run


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``(page_id, record)``: a response record of each row of ``pages(page_id, url, html)``."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    make = lambda row: [response(row["page_id"], row["url"], row["html"], date)]
    return rows.mapInArrow(_each(make, ["page_id", "url", "html"], "page_id"), "page_id long, record binary")


def derive(records: DataFrame, key: str = "page_id") -> DataFrame:
    """``(key, record)``: two records of each response of ``records(key, record)``."""
    rows = records.select(key, F.col("record").cast("binary"))
    kind = rows.schema[key].dataType.simpleString()
    make = lambda row: derivatives(row["record"])
    return rows.mapInArrow(_each(make, ["record"], key), f"{key} {kind}, record binary")


FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "refers_to": "WARC-Refers-To",
    "target_uri": "WARC-Target-URI",
    "block_digest": "WARC-Block-Digest",
    "source_payload_digest": "X-Source-Payload-Digest",
}


def described(records: DataFrame, key: str = "page_id") -> DataFrame:
    """The main fields of each whole record, the length of its block, and the bytes of the record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [parse(r) for r in batch.column("record").to_pylist()]
            keep = pa.array([i for i, r in enumerate(read) if r], pa.int64())
            read = [r for r in read if r]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(keep),
                    *[pa.array([value(f, name) or None for f, _ in read], pa.string()) for name in FIELDS.values()],
                    pa.array([len(b) for _, b in read], pa.int64()),
                    pa.array([hashlib.md5(b).hexdigest() for _, b in read], pa.string()),
                ],
                names=[key, *FIELDS, "content_length", "block_md5"],
            )

    rows = records.select(key, F.col("record").cast("binary"))
    kind = rows.schema[key].dataType.simpleString()
    columns = ", ".join(f"{c} string" for c in FIELDS)
    return rows.mapInArrow(run, f"{key} {kind}, {columns}, content_length long, block_md5 string")


def unreadable(records: DataFrame) -> DataFrame:
    """One row: how many records ``derive`` passes over."""
    whole = F.coalesce(F.col("record").cast("binary"), F.lit(b""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = [not derivatives(r) for r in batch.column("record").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([sum(bad)], pa.int64())], names=["n"])

    counted = records.select(whole.alias("record")).mapInArrow(run, "n long")
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unreadable"))
