"""op5: links, digests and round trips."""

import base64
import hashlib
import html
import random
import re
import time

import pytest

from barloom.llm import page_text as P
from barloom.llm import warc as W

PAGE = """<!DOCTYPE html><html lang="de"><head><title>A &amp; B
 c</title><style>p{}</style><script>var t="</p>";</script></head><body><!-- no <p>x</p> -->
<p title="a>b">One <b>two</b>&nbsp;&lt;three&gt;<br>four</p><div>fünf</div><a href="/x?a=1&amp;b=2">six</a>
<noscript>hidden</noscript> 1 < 2</body></html>"""


def pages(spark):
    data = [(1, "http://a/", PAGE), (1, "http://a/", PAGE), (2, None, None), (3, "http://b/", ""),
            (None, "http://c/", "plain"), (4, "http://d/", "<p>" + "long " * 200_000)]
    return spark.createDataFrame(data, "page_id bigint, url string, html string").selectExpr("*", "'x' as block")


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_text():
    assert P.page_text(PAGE) == "One two <three>\nfour\nfünf\nsix 1 < 2"
    assert P.page_text("") == "" and P.page_text("a < b > c") == "a < b > c"


def test_derivatives(spark):
    sources = W.responses(pages(spark), "page_id")
    found = W.derivatives(sources, "page_id").collect()
    assert len(found) == 12
    by_id = {r.record_id: r for r in sources.collect()}
    for r in found:
        source = by_id[r.refers_to]
        assert (r.target_uri, r.refers_to_target_uri, r.refers_to_date) == (
            source.target_uri, source.target_uri, source.date)
        assert r.page_id == source.page_id and r.record_id not in by_id
        assert r.content_length == len(r.block) and r.block_digest == sha1(bytes(r.block))
    meta = next(r for r in found if r.page_id == 1 and r.warc_type == "metadata")
    source = by_id[meta.refers_to]
    lines = bytes(meta.block).decode().split("\r\n")
    assert f"source-payload-digest: {source.payload_digest}" in lines
    assert f"computed-payload-digest: {sha1(PAGE.encode())}" in lines
    assert "source-content-type: text/html; charset=utf-8" in lines and "source-status: HTTP/1.1 200 OK" in lines
    assert "title: A & B c" in lines and "language: de" in lines and "outlink: /x?a=1&b=2 a" in lines
    texts = {r.page_id: bytes(r.block).decode() for r in found if r.warc_type == "conversion"}
    assert texts[1] == P.page_text(PAGE) and texts[2] == texts[3] == "" and texts[None] == "plain"
    assert len(texts[4]) == 200_000 * 5 - 1
    assert W.derivatives(sources.where("false"), "page_id").count() == 0
    again = W.derivatives(sources.unionByName(W.derivatives(sources, "page_id")), "page_id")
    assert again.count() == 12  # derived records are not derived from


def test_charset_and_broken_responses():
    head = b"HTTP/1.1 404 Not Found\r\nContent-Type: text/html; charset=latin-1\r\nX-A: b:c\r\n\r\n"
    record = {"block": head + "<p>é</p>".encode("latin-1"), "record_id": "<x>", "date": None,
              "target_uri": None, "block_digest": None, "payload_digest": "sha1:KEPT"}
    meta, text = W.derive(record)
    assert text["block"].decode() == "é"
    assert b"source-x-a: b:c\r\n" in meta["block"] and b"source-payload-digest: sha1:KEPT" in meta["block"]
    _, text = W.derive(record | {"block": b"no head \xff"})
    assert text["block"].decode() == "no head �"
    assert [r["content_length"] for r in W.derive(record | {"block": None})][1] == 0


def test_files_round_trip(spark, root):
    sources = W.responses(pages(spark), "page_id")
    records = sources.unionByName(W.derivatives(sources, "page_id")).drop("page_id")
    W.write_records(records, root + "/w")
    back = W.read_records(spark, root + "/w")
    assert back.where("intact").count() == back.count() == records.count() == 18
    plain = lambda df: sorted(str(r) for r in df.collect())
    # An empty address is written as an empty header and comes back as one.
    assert plain(back.drop("intact").fillna("")) == plain(records.fillna(""))
    with open(root + "/old.warc", "wb") as out:
        for k in range(3):
            out.write(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (k, b"x" * k))
    old = W.read_records(spark, root + "/old.warc").collect()
    assert sorted((r.warc_type, bytes(r.block), r.intact) for r in old) == [("resource", b"x" * k, True) for k in range(3)]
    with open(root + "/bad.warc", "wb") as out:
        out.write(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nshort\r\n\r\n")
    assert [r.intact for r in W.read_records(spark, root + "/bad.warc").collect()] == [False]


_REST = r"""(?:[^>"']|"[^"]*"|'[^']*')*>"""
_BREAKS = re.compile(r"</?(?:br|p|div|li)\b" + _REST, re.IGNORECASE)
_TAGS = re.compile("<[a-zA-Z/!?]" + _REST)
_HIDDEN = re.compile(r"<!--.*?-->|<(script|head)\b[^>]*>.*?</\1\s*>", re.DOTALL | re.IGNORECASE)


def brute_text(page):
    """The same by trying each pattern at each place."""
    body, out, k = " ".join(_HIDDEN.sub(" ", page).split()), "", 0
    while k < len(body):
        m = _BREAKS.match(body, k)
        if m:
            out, k = out + "\n", m.end()
        elif m := _TAGS.match(body, k):
            k = m.end()
        else:
            out, k = out + body[k], k + 1
    lines = (" ".join(x.split()) for x in html.unescape(out).split("\n"))
    return "\n".join(x for x in lines if x)


def test_broken_markup_against_brute_force():
    rnd = random.Random(4)
    parts = ["<", ">", '"', "'", "<p>", "</p ", "<a href='x'", "<a ", "<!--", "-->", "<script>", "</script>", "<SCRIPT x", "</script >",
             "<head>", "</head>", "word ", "&amp;", "<br/>", "< ", "<1", "<b", "\n", "=", "<div title=\"a>b\">", "é"]
    for _ in range(4000):
        page = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert P.page_text(page) == brute_text(page), page


def test_links_title_language():
    page = PAGE + "<IMG alt='>' src='i.png'><a name=x><link rel=y href = 'z'><a href='open"
    assert P.links(page) == [("a", "/x?a=1&amp;b=2"), ("img", "i.png"), ("link", "z")]
    assert P.title(page) == "A &amp; B\n c" and P.language(page) == "de"
    assert P.title("<title") is P.title("<title>x") is P.language("<html lang=de") is P.language("") is None


@pytest.mark.parametrize("piece", ["<script>", "<!--", "<a \"", "<a ", "<a '\"", "<title>", "<html ", "</script ", "<a href=", "<p", "<", "\"'", "<title "])
def test_a_megabyte_of_unclosed_markup(piece):
    page = piece * (1_000_000 // len(piece))
    for whole in (page, page + ">"):
        began = time.thread_time()
        P.page_text(whole), P.links(whole), P.title(whole), P.language(whole)
        assert time.thread_time() - began < 12
