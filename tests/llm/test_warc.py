"""The derivative builder: links between records, digests, round trips and odd records."""

import base64
import gzip
import hashlib
import html
import re
import time
import uuid
import zlib

import pytest

from pyspark.sql import functions as F

from tessera.llm import queries, warc

PAGE = "<html><head><title>A &amp; b</title><script>var x='<p>no</p>';</script></head><body><!-- no --><p>Über <b>bo</b>ld<br>two</p><a href='/x?a=1&amp;b=2'>l</a> <a class=q href=/y>m</a></body></html>"


def sha(b):
    return "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_links_headers_and_digests():
    raw = warc.response_of("http://a.example/é", PAGE)
    meta, text = warc.derive(raw)
    source, block = warc.parse(raw)
    assert source["warc-block-digest"] == sha(block) and source["warc-payload-digest"] == sha(PAGE.encode())
    for d, kind in ((meta, "metadata"), (text, "conversion")):
        fields, own = warc.parse(d["record"] + warc.END)
        assert d["record_type"] == fields["warc-type"] == kind
        assert d["refers_to"] == fields["warc-refers-to"] == source["warc-record-id"]
        assert fields["warc-target-uri"] == "http://a.example/é" and fields["warc-date"] == source["warc-date"]
        assert fields["warc-block-digest"] == d["block_digest"] == sha(own)
        assert d["source_digest"] == sha(PAGE.encode())
    said = warc.parse(meta["record"] + warc.END)[1].decode().split("\r\n")
    assert {"http-status: HTTP/1.1 200 OK", "http-header-content-type: text/html; charset=utf-8", "title: A & b", "outlink: /x?a=1&b=2", "outlink: /y", "payload-digest-agrees: true"} <= set(said)
    assert text["text"].split("\n") == ["A & b", "Über bold", "two", "l m"]
    assert meta["record_id"] != text["record_id"] and warc.derive(raw) == [meta, text]


def test_odd_records():
    for raw in (None, b"", b"junk", b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99" + warc.END + b"short", warc.record([("WARC-Type", "request")], b"GET")):
        (only,) = warc.derive(raw)
        assert only["record_type"] == "metadata" and b"error: " in only["record"]
    bad = warc.response_of("u", "x").replace(sha(b"x").encode(), sha(b"y").encode(), 1)
    assert b"payload-digest-agrees: false" in warc.derive(bad)[0]["record"]
    latin = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], b"HTTP/1.0 200\r\nContent-Type: text/html; charset=latin-1" + warc.END + "é".encode("latin-1"))
    assert warc.derive(latin)[1]["text"] == "é"


def test_tables_and_files(spark, tmp_path):
    rows = [(1, "http://a", PAGE, "r"), (1, "http://a", PAGE, "r"), (2, None, None, "r"), (None, "http://b", "", "r"), (3, "http://c", "a\r\n\r\nb" * 5000, "r")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record string")
    raw = df.withColumn("raw", warc.responses(F.col("url"), F.col("html")))
    got = warc.derivatives(raw, "raw")
    assert got.count() == 10 and set(got.select("row.*").columns) == set(df.columns)
    warc.write(got, str(tmp_path / "w"))
    back = sorted(bytes(r.record) for r in warc.read(spark, str(tmp_path / "w")).collect())
    assert back == sorted(bytes(r.record) for r in got.collect())
    assert warc.derivatives(raw.limit(0), "raw").count() == 0


@pytest.mark.parametrize("charset", ["undefined", "idna", "hex", "no-such"])
def test_charsets_that_do_not_decode(charset):
    page = f'<meta charset="{charset}"><p>caf\u00e9</p>'
    raw = warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], b"HTTP/1.0 200\r\nContent-Type: text/html" + warc.END + page.encode())
    assert warc.derive(raw)[1]["text"] == "caf\u00e9"


@pytest.mark.parametrize("piece", ["<!--", "<a ", "<script>", "<a href='x", '<a href="', "<title>", "</script ", "<p", "<script></scriptx", "&amp", "<a x='>"])
def test_unclosed_tags_in_linear_time(piece):
    began = time.process_time()
    warc.derive(warc.response_of("http://a", piece * ((1 << 20) // len(piece))))
    assert time.process_time() - began < 3


def test_unclosed_elements_are_text():
    page = warc.Page("a <b>bold</b> < 3 <!-- open <i>x</i> <script> y <title>t")
    assert page.text == "a bold < 3 x y\nt" and page.title is None
    page = warc.Page("<TITLE>\u0130 &lt;b&gt;</TITLE ><script>a</script ><A HREF=x>1</a><a name=n href = 'y z'>2</a><!-- <a href=no> -->")
    assert page.title == "\u0130 &lt;b&gt;" and page.links == ["x", "y z"] and page.text.endswith("12")


def test_gzip_members(spark, tmp_path):
    records = [warc.response_of(f"http://a/{i}", "x" * i) for i in (1, 5000, 0)]
    whole = b"".join(r + warc.END for r in records)
    (tmp_path / "members.warc.gz").write_bytes(b"".join(gzip.compress(r + warc.END) for r in records))
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(whole))
    (tmp_path / "plain.warc").write_bytes(whole)
    for name in ("members.warc.gz", "one.warc.gz", "plain.warc"):
        got = [bytes(r.record) for r in warc.read(spark, str(tmp_path), name).collect()]
        assert sorted(got) == sorted(records)
    assert list(warc.split_records([whole[:50], whole[50:51], whole[51:]])) == records
    with pytest.raises(ValueError):
        list(warc.split_records([whole[:-30]]))


def http(head, body, kind="Content-Type: text/html; charset=utf-8"):
    lines = "\r\n".join(x for x in ("HTTP/1.1 200 OK", kind, head) if x)
    return warc.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], lines.encode() + warc.END + body)


def chunks(body, n=7):
    return b"".join(b"%x;name=value\r\n%s\r\n" % (len(body[i : i + n]), body[i : i + n]) for i in range(0, len(body), n)) + b"0\r\nTrailer: x\r\n\r\n"


def fields_of(d):
    return dict(x.split(": ", 1) for x in warc.parse(d["record"] + warc.END)[1].decode().split("\r\n") if ": " in x)


BODY = "<p>Über</p><p>alles</p>".encode() * 40


def raw_deflate(body):
    z = zlib.compressobj(9, zlib.DEFLATED, -15)
    return z.compress(body) + z.flush()


@pytest.mark.parametrize(
    "head, body",
    [
        ("Content-Encoding: gzip", gzip.compress(BODY)),
        ("content-encoding:  X-GZIP ", gzip.compress(BODY[:50]) + gzip.compress(BODY[50:])),
        ("Content-Encoding: deflate", zlib.compress(BODY)),
        ("Content-Encoding: deflate", raw_deflate(BODY)),
        ("Content-Encoding: identity", BODY),
        ("Transfer-Encoding: chunked", chunks(BODY)),
        ("Transfer-Encoding: gzip, chunked", chunks(gzip.compress(BODY))),
        ("Transfer-Encoding: chunked\r\nContent-Encoding: gzip", chunks(gzip.compress(BODY))),
        ("Content-Encoding: deflate, gzip", gzip.compress(zlib.compress(BODY))),
    ],
)
def test_bodies_are_decoded(head, body):
    meta, text = warc.derive(http(head, body))
    assert text["text"] == "\n".join(["Über", "alles"] * 40) and not any("error" in k for k in fields_of(meta))
    assert meta["source_digest"] == sha(body)


def test_bodies_that_are_not_what_they_state():
    for head, body, field, said in (
        ("Content-Encoding: gzip", BODY, "content-encoding-error", "not gzip"),
        ("Content-Encoding: deflate", b"", None, None),
        ("Transfer-Encoding: chunked", BODY, "transfer-encoding-error", "not in chunks"),
        ("Transfer-Encoding: chunked", b"5\r\nabc", "transfer-encoding-error", "not in chunks"),
    ):
        meta, text = warc.derive(http(head, body))
        assert text["text"] == warc.text_of(body.decode()) and fields_of(meta).get(field) == said
    cut = gzip.compress(bytes(range(65, 91)) * 3000)[:-12]
    meta, text = warc.derive(http("Content-Encoding: gzip", cut))
    assert fields_of(meta)["content-encoding-error"] == "gzip breaks off" and text["text"].startswith("ABC")


def test_what_has_no_text_has_no_conversion(monkeypatch):
    monkeypatch.setattr(warc, "MOST", 100_000)
    for raw, reason in (
        (http("", b"\x89PNG\r\n\x1a\n", "Content-Type: image/png"), "content-type image/png"),
        (http("", b"<svg/>", "Content-Type: image/svg+xml"), "content-type image/svg+xml"),
        (http("", b"a\0b", ""), "content-type unknown"),
        (http("Content-Encoding: br", b"xyz"), "content-encoding br"),
        (http("Content-Encoding: gzip", gzip.compress(b"0" * 2_000_000)), "it unpacks to more than 100000 bytes"),
    ):
        (meta,) = warc.derive(raw)
        assert meta["record_type"] == "metadata" and fields_of(meta)["no-conversion"] == reason
    for kind, body, text in (("text/plain", b"a <b> \n c", "a <b> \n c"), ("application/ld+json", b'{"a": "<p>"}', '{"a": "<p>"}'), ("application/rss+xml", b"<x>a</x>", "a"), ("Text/HTML", b"<p>a</p>", "a")):
        assert warc.derive(http("", body, f"Content-Type: {kind}"))[1]["text"] == text
    assert warc.derive(http("", b"<p>a</p>", ""))[1]["text"] == "a"


def test_digests_of_chunks_and_of_what_they_hold_agree():
    body = chunks(BODY)
    for stated, agrees in ((sha(body), "true"), (sha(BODY), "true"), (sha(b""), "false")):
        raw = http("Transfer-Encoding: chunked", body).replace(b"WARC-Record-ID", b"WARC-Payload-Digest: " + stated.encode() + b"\r\nWARC-Record-ID", 1)
        assert fields_of(warc.derive(raw)[0])["payload-digest-agrees"] == agrees


def slow_page(page):
    """(title, links, lines) of a page, a character at a time."""
    low, out, links, title, i = page.lower(), "", [], None, 0
    ended = lambda name, at: re.compile(rf"</{name}\s*>").search(low, at)
    while i < len(page):
        name = re.match(r"<(/?[A-Za-z][A-Za-z0-9_]*|!)", page[i:])
        if page[i] != "<" or ">" not in page[i:] or not (name or page.startswith("<!--", i)):
            out, i = out + page[i], i + 1
        elif page.startswith("<!--", i):
            close = page.find("-->", i + 4)
            out, i = out + " " * (close >= 0), close + 3 if close >= 0 else page.find(">", i) + 1
        else:
            tag, start = name[1].lower(), i
            i = page.find(">", i + len(name[0])) + 1
            if tag in ("script", "style", "noscript", "template") and (close := ended(tag, i)):
                out, i = out + " ", close.end()
            elif tag == "a" and (href := re.search(r"\bhref\s*=\s*(.*)", page[start + 2 : i - 1], re.S | re.I)):
                at = start + 2 + href.start(1)
                quoted = page[at] in "'\"" and page.find(page[at], at + 1)
                links.append(page[at + 1 : quoted] if quoted and quoted > 0 else re.match(r"[^\s>]*", page[at:])[0])
            elif tag.lstrip("/") in warc._BLOCK:
                out += "\n"
                if tag == "title" and title is None and (close := ended(tag, i)):
                    title = page[i : close.start()]
    lines = (re.sub("[ \t\r\f\v\xa0]+", " ", x).strip() for x in html.unescape(out).split("\n"))
    return title, links, "\n".join(x for x in lines if x)


def test_query_against_a_slow_version(spark):
    """op1 over all pages of sf0.001: ids, references, digests, headers and text from scratch."""
    sf = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op1_warc_derivatives"](spark, sf).collect()
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    want = set()
    for p in pages:
        body = p.html.encode()
        source = f"<urn:uuid:{uuid.uuid5(uuid.UUID('6ba7b811-9dad-11d1-80b4-00c04fd430c8'), f'{p.url}\n{sha(body)}')}>"
        title, links, text = slow_page(p.html)
        said = ["http-status: HTTP/1.1 200 OK", "http-header-content-type: text/html; charset=utf-8", f"http-header-content-length: {len(body)}", f"payload-digest: {sha(body)}", "payload-digest-agrees: true"]
        fold = lambda s: " ".join(s.split())
        said += [f"title: {fold(slow_page(title)[2])}"] if title is not None else []
        said += [f"outlink: {fold(html.unescape(x))}" for x in links]
        for kind, block, own in (("metadata", "".join(f"{x}\r\n" for x in said), None), ("conversion", text, text)):
            ident = f"<urn:uuid:{uuid.uuid5(uuid.UUID('6ba7b811-9dad-11d1-80b4-00c04fd430c8'), f'{source}\n{kind}')}>"
            want.add((p.page_id, kind, ident, source, p.url, sha(block.encode()), sha(body), own))
    got = [(r.page_id, r.record_type, r.record_id, r.refers_to, r.target_uri, r.block_digest, r.source_digest, r.text) for r in rows]
    assert len(got) == 2 * len(pages) and set(got) == want
