import base64
import gzip
import hashlib
import random
import time
import zlib

from pyspark.sql import functions as F

from peerlens.llm import warc

PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style></head><body><script>var x="</p>";</script>
<h1>Head</h1><p>One <b>two</b>&nbsp;three<br>four &lt;five&gt;<!-- six --></p><a class=x href="/seven?a=1&amp;b=2">8</a></body></html>"""


def test_serialised_records_read_back():
    fields = [("WARC-Type", "response"), ("X-Odd", "a: b")]
    for block in (b"", b"\r\n\r\n", "é\x00".encode(), b"x" * 10_000):
        assert warc.parse(warc.serialise(fields, block)) == (fields, block)
    whole = warc.serialise(fields, b"12345")
    for bad in (None, b"", b"WARC/1.1\r\n", whole[:-6], whole.replace(b"Content-Length: 5", b"Content-Length: x")):
        assert warc.parse(bad) is None
    assert warc.parse(warc.serialise([("A", "x\r\nInjected: y")], b""))[0] == [("A", "x Injected: y")]


def test_derivatives_link_to_their_source():
    source = warc.response(1, "http://a/b", PAGE, "2024-01-01T00:00:00Z")
    fields, block = warc.parse(source)
    (meta, noted), (conv, text) = map(warc.parse, warc.derivatives(source))
    for made, content, kind in ((meta, noted, "metadata"), (conv, text, "conversion")):
        assert warc.value(made, "WARC-Type") == kind
        assert warc.value(made, "WARC-Refers-To") == warc.value(fields, "WARC-Record-ID")
        assert warc.value(made, "WARC-Target-URI") == "http://a/b"
        assert warc.value(made, "WARC-Date") == "2024-01-01T00:00:00Z"
        assert warc.value(made, "X-Source-Payload-Digest") == warc.value(fields, "WARC-Payload-Digest")
        sha = base64.b32encode(hashlib.sha1(content).digest()).decode()
        assert warc.value(made, "WARC-Block-Digest") == f"sha1:{sha}"
    assert text.decode() == "Head\nOne two three\nfour <five>\n8"
    assert "title: A & B" in noted.decode() and "outlink: /seven?a=1&b=2" in noted.decode()
    assert "source-content-type: text/html; charset=utf-8" in noted.decode()
    assert block.endswith(PAGE.encode())


def test_other_charsets_and_blocks_without_a_header():
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n"
    for block, want in ((http + "<p>é".encode("latin-1"), "é"), (b"<p>plain", "plain"), (http.replace(b"latin-1", b"none") + b"x", "x")):
        record = warc.serialise([("WARC-Type", "response"), ("WARC-Record-ID", "<a>")], block)
        assert warc.parse(warc.derivatives(record)[1])[1].decode() == want
    assert warc.derivatives(warc.serialise([("WARC-Type", "request")], b"")) == []


def test_edges(spark):
    rows = [(1, "http://x", PAGE), (2, None, PAGE), (3, "http://y", None), (4, "http://z", ""), (None, "u\r\nv", "<p>a"), (1, "http://x", PAGE)]
    rows.append((5, "http://long", "<p>word " * 50_000))
    pages = spark.createDataFrame([(*r, b"x", "k") for r in rows], "page_id long, url string, html string, record binary, record_type string")
    made = warc.described(warc.derive(warc.responses(pages)))
    got = made.collect()
    assert len(got) == 2 * len(rows)
    assert {r.record_type for r in got} == {"metadata", "conversion"}
    assert [r.content_length for r in got if r.page_id == 3 and r.record_type == "conversion"] == [0]
    assert [r.target_uri for r in got if r.page_id == 2] == [None, None]
    assert len({r.record_id for r in got}) == 2 * (len(rows) - 1)  # the repeated row has the same ids
    assert warc.described(warc.derive(warc.responses(pages.limit(0)))).collect() == []


def test_unreadable_records_are_passed_over_and_counted(spark):
    good = warc.response(1, "u", PAGE, "d")
    records = spark.createDataFrame([(1, good), (2, None), (3, b""), (4, good[:50])], "page_id long, record binary")
    assert {r.page_id for r in warc.derive(records).collect()} == {1}
    assert warc.unreadable(records).first()[0] == 3


def test_every_page_has_its_two_records(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    sources = warc.described(warc.responses(pages)).select("page_id", F.col("record_id").alias("s"))
    made = warc.described(warc.derive(warc.responses(pages)))
    assert made.count() == 2 * pages.count()
    assert made.join(sources, "page_id").where("refers_to <> s OR refers_to IS NULL").count() == 0


def _record(block, **fields):
    return warc.serialise([("WARC-Type", "response"), ("WARC-Record-ID", "<a>"), *fields.items()], block)


def _text(block):
    made = warc.derivatives(_record(block))
    return warc.parse(made[1])[1].decode() if made else None


def test_no_record_ends_the_job(spark):
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset={}\r\n\r\n<title>a+2AA-\\ud800</title><p>x"
    records = [_record(head.format(c).encode()) for c in ("idna", "undefined", "punycode", "utf-7", "unicode_escape", "hex", "ſ", "utf_16_be")]
    digits = ("²", "9" * 5000, "-1", "1_0", "٣")
    broken = [_record(b"12345").replace(b"Content-Length: 5", f"Content-Length: {d}".encode()) for d in digits]
    broken.append(warc.serialise([("WARC-Type", "response")], b"no record id to refer to"))
    references = _record(("<p>&#" + "9" * 5000 + ";&#" + "0" * 5000 + "65;&#xD800;").encode())
    table = spark.createDataFrame(list(enumerate([*records, references, *broken])), "page_id long, record binary")
    assert warc.derive(table).count() == 2 * (len(records) + 1)
    assert warc.unreadable(table).first()[0] == len(broken)
    assert warc.parse(warc.derivatives(references)[1])[1].decode() == "�A�"


def test_packed_and_chunked_bodies():
    page = b"<p>" + b"word " * 1000
    raw = zlib.compressobj(wbits=-15)
    chunks = b"".join(b"%x;x=y\r\n%s\r\n" % (len(page[i : i + 999]), page[i : i + 999]) for i in range(0, len(page), 999)) + b"0\r\n\r\n"
    want = ("word " * 1000).strip()
    for field, body in (
        (b"Content-Encoding: gzip", gzip.compress(page)),
        (b"Content-Encoding: gzip", gzip.compress(page[:50]) + gzip.compress(page[50:])),
        (b"Content-Encoding: gzip", page),  # undone by the crawler, which left the field
        (b"Content-Encoding: deflate", zlib.compress(page)),
        (b"Content-Encoding: deflate", raw.compress(page) + raw.flush()),
        (b"Content-Encoding: identity", page),
        (b"Transfer-Encoding: chunked", chunks),
        (b"Transfer-Encoding: chunked", page),
        (b"Content-Encoding: deflate, gzip", gzip.compress(zlib.compress(page))),
    ):
        assert _text(b"HTTP/1.1 200 OK\r\n" + field + b"\r\n\r\n" + body) == want
    for field, body in ((b"br", b"\x8b\x02"), (b"gzip", gzip.compress(page)[:-20]), (b"deflate", b"\xff\xff\xff")):
        assert _text(b"HTTP/1.1 200 OK\r\nContent-Encoding: " + field + b"\r\n\r\n" + body) is None


def test_marks_that_are_never_closed_take_linear_time():
    start = time.perf_counter()
    for mark in ("<script>", "<script ", "<!--", "<a ", "<a href=", '<a href="', "<title>", "<title ", "<b", "<style></script>", "&#1", "<a href='>"):
        page = mark * (1_000_000 // len(mark))
        warc.plain_text(page), warc.title_of(page), warc.links_of(page)
    _record(b"HTTP/1.1 200 OK\r\nA: b" + b"\r\n c" * 300_000 + b"\r\n\r\n")
    assert time.perf_counter() - start < 12 * 2


def test_random_pages_against_a_second_version():
    """The second version is a parser of its own that is told each piece's meaning as the page is made."""
    pieces = [
        ("word ", "word "), ("<b>", ""), ("</b>", ""), ("<p class='x'>", "\n"), ("</DIV >", "\n"), ("<br/>", "\n"), ("&amp;", "&"), ("&lt;p&gt;", "<p>"),
        ("<script>var a='<p>x</p>';</Script >", " "), ("<!-- <p> - -- x -->", " "), ("<style\n>p{}</style>", " "), ("é　", "é　"),
        ("<head><title>t</title></head>", " "), ("<a href=\"u?a=1&amp;b='2\">", ""), ("<A x HREF = 'v\"w'>", ""), ("<a href=plain>", ""), ("\n", "\n"),
    ]
    links = {13: "u?a=1&b='2", 14: 'v"w', 15: "plain"}
    rng = random.Random(3)
    for _ in range(300):
        made = [rng.randrange(len(pieces)) for _ in range(rng.randrange(40))]
        page = "".join(pieces[i][0] for i in made)
        lines = [" ".join(line.split()) for line in "".join(pieces[i][1] for i in made).split("\n")]
        assert warc.plain_text(page) == "\n".join(line for line in lines if line)
        assert warc.links_of(page) == [links[i] for i in made if i in links]
        assert warc.title_of(page) == ("t" if 12 in made else None)
