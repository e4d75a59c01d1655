"""Derived records: links, digests, text, files, and the SQL on odd pages."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import warc

PAGES = [
    (1, "http://a.example/x", "<html><head><title> A &amp; B\n&#8364;</title><style>p{}</style></head><body><!-- no --><P class=x>One<br/>two"
     "<script>var t='<p>no</p>';</script><ul><li>a</li><LI>b</li></ul><a href='/l1'>x</a> <a class=\"k\" HREF=\"/l2\">y</a></body></html>"),
    (2, None, None), (3, "http://b.example/", ""), (None, "http://c.example/\r\nInjected: 1", "plain &lt;b&gt; &amp;lt; &#x1F600; &#0; &#xD800; &nope;"),
    (4, "http://d.example/", "<script>never closed <p>text"), (4, "http://d.example/", "<script>never closed <p>text"),
    (5, "http://e.example/", "<div>" + "<p>word &middot; more</p>\r\n" * 4000 + "</div>"), (6, "u", "a < b and c > d  <<x>> \t\n\n  end "),
]


@pytest.fixture
def pages(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return frame.selectExpr("*", *[f"'x' as `{c}`" for c in ("source", "record", "block", "payload", "date")])


def by_type(pages, page_id, kind):
    rows = warc.derive_records(warc.page_responses(pages, warc.DATE)).where(f"source <=> {page_id} AND warc_type = '{kind}'")
    return rows.collect()


def test_conversion_text(pages):
    row, = by_type(pages, 1, "conversion")
    assert row.block == "A & B €\nOne\ntwo\na\nb\nx y"
    assert by_type(pages, "null", "conversion")[0].block == "plain <b> &lt; 😀 � � &nope;"
    assert [r.block for r in by_type(pages, 2, "conversion")] == [""]
    assert by_type(pages, 6, "conversion")[0].block == "a d > end"


def test_metadata_links_to_the_source(pages):
    row, = by_type(pages, 1, "metadata")
    html = PAGES[0][2].encode()
    lines = row.block.split("\r\n")
    assert lines[0] == "title: A & B €"
    assert lines[1] == "sourcePayloadDigest: sha256:" + hashlib.sha256(html).hexdigest()
    assert [x for x in lines if x.startswith("http: ")] == [
        "http: HTTP/1.1 200 OK", "http: Content-Type: text/html; charset=utf-8", f"http: Content-Length: {len(html)}"]
    assert lines[-3:] == ["outlink: /l1", "outlink: /l2", ""]
    other, = by_type(pages, 1, "conversion")
    assert row.refers_to == other.refers_to and row.record_id != other.record_id
    assert row.payload_digest == other.payload_digest


def test_records_are_well_formed(pages):
    for row in warc.derive_records(warc.page_responses(pages, warc.DATE)).collect():
        head, block = row.record.split("\r\n\r\n", 1)
        assert block == row.block and row.n_bytes == len(block.encode())
        lines = head.split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block.encode()).hexdigest() == row.block_digest
        assert fields["WARC-Refers-To"] == f"<{row.refers_to}>" and "Injected" not in fields
        assert ("WARC-Target-URI" in fields) == (row.target_uri is not None)


def test_files_hold_the_records(pages, tmp_path):
    records = warc.derive_records(warc.page_responses(pages, warc.DATE))
    warc.write_records(records, str(tmp_path / "out"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert data.count(b"WARC/1.1\r\n") == 2 * len(PAGES)
    seen = 0
    while data:  # read by Content-Length
        head, rest = data.split(b"\r\n\r\n", 1)
        n = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        data, seen = rest[n + 4 :], seen + 1
    assert seen == 2 * len(PAGES)


def test_odd_pages_match_the_sql(spark, pages, tmp_path):
    pages.select("page_id", "url", "html").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    found = sorted(map(tuple, warc.op1_warc_derivatives(spark, str(tmp_path)).collect()), key=str)
    assert found == sorted(con.execute(warc.op1_sql()).fetchall(), key=str)
    assert warc.derive_records(warc.page_responses(pages.limit(0), warc.DATE)).count() == 0
    assert found[0] != found[1] and len(found) == 2 * len(PAGES)


def test_named_entities(spark):
    text = " ".join(f"&{name};" for name in warc.ENTITIES)
    row = spark.range(1).select(warc.decode_entities(F.lit(text)).alias("t")).first()
    assert row.t.split(" ")[:3] == ["<", ">", '"'] and row.t.endswith("&")
