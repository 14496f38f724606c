import base64
import hashlib
import json
import re
from html.parser import HTMLParser

from classmap.llm import warc
from tests.llm.tables import SF_DIR


class Reader(HTMLParser):
    """Text and links by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.parts, self.links, self.hidden = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag.encode() in warc.LINES:
            self.parts.append("\n")
        if tag in ("script", "style"):
            self.hidden += 1
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href"]

    def handle_endtag(self, tag):
        if tag.encode() in warc.LINES:
            self.parts.append("\n")
        if tag in ("script", "style"):
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(re.sub("\n", " ", data))


def brute(page):
    r = Reader()
    r.feed(page)
    r.close()
    lines = (" ".join(x.split()) for x in "".join(r.parts).split("\n"))
    return "\n".join(x for x in lines if x), r.links


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_given_pages_against_the_standard_parser(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    source = {r["page_id"]: r for r in pages.collect()}
    found = warc.derivatives(warc.responses(pages, date="2024-01-01T00:00:00Z")).collect()
    assert len(found) == 2 * len(source)
    by = {(r["source_id"], r["record_type"]): r for r in found}
    assert len({r["record_id"] for r in found}) == len(found)
    for i, page in source.items():
        meta, text = by[i, "metadata"], by[i, "conversion"]
        want, links = brute(page["html"])
        assert text["block"] == want
        about = json.loads(meta["block"])
        assert about["links"] == links
        origin = about["source"]["warc"]
        assert meta["refers_to"] == text["refers_to"] == origin["WARC-Record-ID"]
        assert (meta["concurrent_to"], text["concurrent_to"]) == (text["record_id"], meta["record_id"])
        assert origin["WARC-Payload-Digest"] == text["source_payload_digest"] == sha(page["html"].encode())
        assert text["source_block_digest"] == sha(warc.HTTP_HEAD.encode() + page["html"].encode())
        for r in (meta, text):
            data = r["block"].encode()
            assert (r["content_length"], r["block_digest"]) == (len(data), sha(data))
            assert r["target_uri"] == page["url"] and json.loads(r["source_headers"]) == about["source"]


def test_odd_markup():
    text = lambda s: warc.page_text(s.encode())[1]
    assert text("") == ""
    assert text("a < b <3 & c &amp; d") == "a < b <3 & c & d"
    assert text("<p>x<!-- > <b> --> y<script>if (a</b) '</p>'</script>z") == "x yz"
    assert text('<a title="1 > 0">one</a>') == "one"
    assert text("<a title='open>one</a>") == "one"
    assert text("x<script>never closed <p>y") == "x"
    assert text("x<!-- never closed <p>y") == "x"
    assert text("<TITLE>T &eacute;</TITLE><DIV>a<br/>b</DIV>c") == "T é\na\nb\nc"
    assert warc.page_text(b"<a href='x&amp;y'>1</a><a href=z>2</a><a>3</a>")[2] == ["x&y", "z"]
    assert len(text("<script>" * 100_000)) == 0
    assert text("<" * 200_000) == "<" * 200_000


def test_awkward_rows(spark):
    rows = [
        (1, "http://a/", "<p>x"), (1, "http://a/", "<p>x"), (2, None, None), (None, None, "<p>y"), (3, "http://b/", "é " * 200_000),
        (4, "", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as block", "2 as record_id", "3 as payload")
    source = warc.responses(pages, date="2024-01-01T00:00:00Z")
    found = warc.derivatives(source.selectExpr("*", "5 as block")).collect()
    assert len(found) == 2 * len(rows)
    assert len({r["record_id"] for r in found if r["source_id"] == 1}) == 2
    assert {r["block"] for r in found if r["record_type"] == "conversion" and r["source_id"] in (2, 4)} == {""}
    lost = warc.derivatives(source.selectExpr("source_id", "cast(null as string) as record_id", "target_uri", "cast(null as string) as warc_date", "cast(null as string) as http_head", "payload"))
    assert all(r["refers_to"] is None and r["record_id"] for r in lost.collect())
    assert warc.derivatives(source.limit(0)).count() == 0


def test_files_read_back(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "<title>T</title><p>é x\n\ny"), (2, "http://b/", "")], "page_id bigint, url string, html string")
    records = warc.derivatives(warc.responses(pages, date="2024-01-01T00:00:00Z"))
    warc.write_warc(records.coalesce(1), str(tmp_path / "out"))
    (data,) = (p.read_bytes() for p in (tmp_path / "out").glob("part-*"))
    want = {r["record_id"]: r for r in records.collect()}
    seen = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines)
        n = int(fields["Content-Length"])
        r = want[fields["WARC-Record-ID"]]
        assert first == "WARC/1.1" and rest[:n].decode() == r["block"] and fields["WARC-Refers-To"] == r["refers_to"]
        assert rest[n : n + 4] == b"\r\n\r\n"
        data, seen = rest[n + 4 :], seen + 1
    assert seen == 4
