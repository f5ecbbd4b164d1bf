"""Main texts and web archives."""

import gzip
import hashlib
import html
import io
import os
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import types as T

from surveysieve.llm import html_text, warc

SF_DIR = "/root/testdata/sf0.001"


def pages_frame(spark, rows, extra=()):
    fields = [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
    fields += [T.StructField(name, T.StringType()) for name in extra]
    return spark.createDataFrame([(*row, *("x" for _ in extra)) for row in rows], T.StructType(fields))


PAGES = [
    (1, "http://a.example/x y", "<html><body><p>Some words here.</p></body></html>"),
    (2, None, "<html><body><p>Some words here.</p></body></html>"),
    (3, "http://b.example/é?q=1#f", ""),
    (4, "http://c.example/", None),
    (5, "http://d.example/", "plain text\nwithout any tags"),
    (None, "http://e.example/", "<p>no id</p>"),
    (None, None, None),
    (6, "http://f.example/", "<article><p>" + "long words " * 30_000 + "</p></article>"),
    (7, "http://g.example/", "é́ 日本語 🤦 <p>x"),
    (8, "http://a.example/", "<html><body><p>Some words here.</p></body></html>"),
    (8, "http://a.example/", "<html><body><p>Some words here.</p></body></html>"),
    (9, "http://h.example/", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n"),
    (10, "http://i.example/", "<p"),
]


# Main text


def test_best_run_equals_trying_all():
    import random

    generator = random.Random(4)
    for _ in range(300):
        scores = [generator.choice([-3, -1, -0.5, 0, 1, 2]) for _ in range(generator.randrange(12))]
        start, end = html_text.best_run(scores)
        sums = {(a, b): sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
        best = max(sums.values(), default=0)
        assert sum(scores[start:end]) == max(best, 0)


def brute_text(source):
    article = source[source.index("<article>") + len("<article>") : source.index("</article>")]
    blocks = [re.sub(r"</?b>", "", block.replace("<br>", " ")) for block in re.split(r"</?(?:h1|p)>", article)]
    return "\n\n".join(filter(None, (" ".join(html.unescape(block).split()) for block in blocks)))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no generated tables")
def test_generated_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    weights = html_text.learn(pages)
    rows = html_text.extract(pages, weights).collect()
    sources = {row.page_id: row.html for row in pages.collect()}
    assert len(rows) == len(sources)
    for row in rows:
        assert row.text == brute_text(sources[row.page_id])
        assert row.n_chars == len(row.text)
        # The page's own mark of its main element is not needed.
        assert html_text.main_text(re.sub(r"</?article>", "", sources[row.page_id]), weights) == row.text


WHOLE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style></head><body class="has-sidebar">
<header><p>Site name and slogan of the site</p></header><nav class=menu><a href=x>Home</a> <a href=y>About us</a></nav>
<div id="cookie-notice">We use cookies on this site, accept them all or none</div>
<div class="post"><h1>A  title</h1><p>First <b>paragraph</b> with <a href=y>a link</a>, &eacute;&#233;&amp;&nbsp;more
words here.</p><div class="ad">buy this now, really, do it today</div><aside>Related: other texts</aside>
<ul><li>one item<li>another item</ul><script>if (a < b) document.write("<p>no</p>")</script>
<p>Second paragraph, 5 < 6, ends here.</p><!-- <p>hidden</p> --></div>
<section class="comments"><p>Great post, I love it so very much indeed, thank you</p></section>
<form><label>Your name</label><input></form><footer>&copy; 2020 Some company, all rights reserved</footer></body></html>"""


def test_parts_beside_the_text_are_left_out():
    expected = "A title\n\nFirst paragraph with a link, éé& more words here.\n\none item\n\nanother item\n\nSecond paragraph, 5 < 6, ends here."
    assert html_text.main_text(WHOLE, {}) == expected
    marked = WHOLE.replace('<div class="post">', "<main>").replace("</div>\n<section", "</main>\n<section")
    assert html_text.main_text(marked, {}) == expected

ARTICLE = "<h1>A heading of words</h1>" + "".join(
    f"<p>{' '.join(f'word{i}x{j}' for j in range(30))}</p>" for i in range(10)
)
ARTICLE_TEXT = "A heading of words\n\n" + "\n\n".join(" ".join(f"word{i}x{j}" for j in range(30)) for i in range(10))
REPLIES = "".join(f"<p>{' '.join(f'reply{i}x{j}' for j in range(30))}</p>" for i in range(30))
ADVERT = "<p>buy this now for less</p>"
# How pages may hold the article, plain or as the main element, and what may stand around or in it.
FRAMES = [
    "<body>{}</body>",
    '<body><form id="aspnetForm"><div class="menu">home news</div>{}</form></body>',
    '<body class="overflow hidden x"><div data-title="The hidden truth">{}</div></body>',
    '<body><div class="content has-comments">{}</div></body>',
    '<body><div class="wrapper with-sidebar" id=main-page>{}</div></body>',
    '<body><div id="page-no-nav">{}</div></body>',
    '<body><div class="post category-social tag-cookies" aria-hidden="false">{}</div></body>',
    "<body><div title=don't>{}</div></body>",
    f'<body>{{}}<div class="comments">{REPLIES}</div></body>',
    f'<body><div id="post">{{}}<section id="user-comments">{REPLIES}</section></div></body>',
    f'<body>{{}}<div class="comment-list"><form><textarea>say</textarea></form>{REPLIES}</div></body>',
    f'<body><div class=ad-slot>{ADVERT}</div>{{}}<div hidden>{REPLIES}</div><div style="color:red; display : none">{REPLIES}</div></body>',
    '<body>{}<form class="contact"><label>Your name</label><input><p>We answer soon</p></form></body>',
]


@pytest.mark.parametrize("frame", range(len(FRAMES)))
@pytest.mark.parametrize("element", ["article", "main", "div", 'div class="entry"'])
def test_article_in_pages_of_many_shapes(frame, element):
    name = element.split()[0]
    page = FRAMES[frame].format(f"<{element}>{ARTICLE}</{name}>")
    assert html_text.main_text(f"<html><head><title>Title</title></head>{page}</html>", {}) == ARTICLE_TEXT


def test_what_stands_beside_inside_the_article_is_left_out():
    for beside in (
        f'<div class="comment-list">{REPLIES}</div>',
        f'<div class="ad-slot">{ADVERT}</div>',
        f"<aside>{ADVERT}</aside>",
        "<form><label>Find</label><input><button>go</button></form>",
        "<select><option>one</select>",
    ):
        middle = ARTICLE.replace("</h1>", "</h1>" + beside)
        assert html_text.main_text(f"<body><article>{middle}</article></body>", {}) == ARTICLE_TEXT


def test_deep_nesting_takes_linear_time():
    page = "<div>" * 20_000 + "word " + "</span>" * 20_000
    started = time.perf_counter()
    assert html_text.main_text(page, {}) == "word"
    assert time.perf_counter() - started < 5


def test_attributes_are_read_as_browsers_read_them():
    read = html_text._attributes(""" class="a b" id=x'y hidden data-q='"' =odd style = "display:none" / alt=""")
    assert read[:5] == [("class", "a b"), ("id", "x'y"), ("hidden", ""), ("data-q", '"'), ("odd", "")]
    assert ("style", "display:none") in read




def test_learned_scores():
    counts = Counter()
    for _ in range(20):
        counts.update(html_text.counts_of(WHOLE.replace('<div class="post">', "<main>").replace("</div>\n<section", "</main>\n<section")))
    scores = html_text.weights_from(counts)
    assert scores["words:p"] > 0 > scores["words:aside"]
    assert all(score < 0 for kind, score in scores.items() if not kind.startswith("words:"))
    assert scores["tag:nav"] < scores["tag:h1"]
    assert not html_text.counts_of(WHOLE)
    assert html_text.main_text(WHOLE, scores).startswith("A title")


BODY = "<p>" + "</p><p>".join(["some words of a long text here"] * 20) + "</p>"


@pytest.mark.parametrize(
    "beside",
    [
        '<h1 class="article-title">A title</h1>',
        '<div class="article-header"><p>Who wrote this</p></div>',
        '<span class="main-date">on a day in May</span>',
        '<article class="card"><p>Read this other text next</p></article>',
        '<div role="main"><p>Skip to what you want</p></div>',
    ],
)
def test_a_small_mark_of_the_main_element_does_not_hide_the_text(beside):
    learned = {"words:p": 0.4, "words:h1": 0.4, "tag:p": -0.05, "end:p": -0.05}
    for weights in ({}, learned):
        for page in (f'{beside}<div class="post">{BODY}</div>', f'<div class="post">{BODY}</div>{beside}'):
            assert html_text.main_text(page, weights).count("some words of a long text here") == 20
    assert not html_text.counts_of(f'{beside}<div class="post">{BODY}</div>')


def test_exact_marks_of_the_main_element():
    for mark in ('role="main"', "itemprop=articleBody", "role='Main' class='x'"):
        assert html_text.counts_of(f"<div {mark}>{BODY}</div>")["words:p", True] == 140
    for mark in ('class="main"', 'id="article"', 'role="main-part"', 'itemprop="article"'):
        assert not html_text.counts_of(f"<div {mark}>{BODY}</div>")


@pytest.mark.parametrize(
    "page",
    [
        '<div class="wrapper with-sidebar">{}</div>',
        '<div class="content has-comments"><div class="post">{}</div></div>',
        '<div id="page-no-nav">{}</div>',
        '<article class="post category-social tag-cookies">{}</article>',
        '<article class="post social">{}</article>',
        '<div class="widget"><article>{}</article></div>',
        '<div class="modal"><div class="post">{}</div></div>',
    ],
)
def test_names_around_the_text_do_not_drop_it(page):
    menu = '<div class="menu"><p>Home and other places</p></div><p id="cookie-notice">We use cookies</p><div class="ad"><p>Buy</p></div>'
    for source in (menu + page.format(BODY), page.format(menu + BODY), page.format(BODY) + menu):
        text = html_text.main_text(source, {})
        assert text.split() == ["some", "words", "of", "a", "long", "text", "here"] * 20


def test_a_short_main_element_is_not_dropped_for_what_is_around_it():
    page = '<div class="related"><article><p>short but the main one</p></article></div><div class="related"><p>other</p></div>'
    items = html_text.read_page(f"<div>{BODY}</div>{page}").items
    assert [(item.text, item.dropped) for item in items if item.words][-2:] == [("short but the main one", False), ("other", True)]


@pytest.mark.parametrize("source", ["", "<", "<p", "<!--", "<script>", "</p></p>", "<p><b>x<p>y</b>z", "<a href='x>y", "<div></span></div>", "&am &amp &#xZZ;"])
def test_broken_sources(source):
    html_text.main_text(source, {})


def test_pages_of_all_kinds(spark):
    pages = pages_frame(spark, PAGES, ["text", "HTML", "n_chars"])
    weights = html_text.learn(pages)
    found = Counter((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(pages, weights).collect())
    assert sum(found.values()) == len(PAGES)
    texts = {page_id: text for page_id, _, text, _ in found}
    assert texts[3] == texts[4] == texts[10] == "" and texts[5] == "plain text without any tags"
    assert texts[6] == ("long words " * 30_000).strip()
    assert found[8, "http://a.example/", "Some words here.", 16] == 2
    empty = pages.limit(0)
    assert html_text.learn(empty) == {} and html_text.extract(empty, {}).count() == 0


# Archives


def brute_records(rows, least=0):
    """Of each payload's page ids, the smallest one responds."""
    payloads = [(page_id, (source or "").encode()) for page_id, _, source in rows]
    first = {}
    for page_id, payload in payloads:
        if page_id is not None and len(payload) >= least:
            first[payload] = min(first.get(payload, page_id), page_id)
    return payloads, first


@pytest.mark.parametrize("least", [0, 20])
def test_archived_pages(spark, least):
    pages = pages_frame(spark, PAGES, ["URL", "offset", "archive"]).repartition(3)
    rows = warc.archive_pages(pages, least_bytes=least).collect()
    payloads, first = brute_records(PAGES, least)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in rows) == Counter((i, len(p), warc.payload_digest(p)) for i, p in payloads)
    by_payload = {warc.payload_digest(p): p for _, p in payloads}
    responses = Counter()
    for row in rows:
        payload = by_payload[row.payload_digest]
        if row.payload_bytes < least:
            assert row.record_type == "response" and row.refers_to is None
        elif row.record_type == "response":
            responses[payload] += 1
            assert row.page_id == first.get(payload)
        else:
            assert row.record_type == "revisit" and row.refers_to == first.get(payload)
    assert set(responses.values()) == {1}
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_new_archives_begin_at_the_limit(spark, tmp_path, monkeypatch):
    pages = pages_frame(spark, [(i, f"http://a.example/{i}", "x" * 500) for i in range(20)]).coalesce(1)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1_500)
    index = warc.write_arc(pages, str(tmp_path)).collect()
    assert {row.page_id for row in index} == set(range(20))


def test_digest():
    payload = "é".encode()
    assert len(warc.payload_digest(payload)) == 32
    import base64

    assert base64.b32decode(warc.payload_digest(payload)) == hashlib.sha1(payload).digest()


def legacy(version, blocks):
    out, offset = [], 0
    for part in [warc.arc_opening("some.arc.gz", version, "20010203040506")]:
        out.append(warc.member(part))
    for number, block in enumerate(blocks):
        offset = sum(map(len, out))
        out.append(warc.member(warc.arc_record(version, "some.arc.gz", offset, f"http://a.example/{number} b", "20010203040506", block)))
    return b"".join(out)


@pytest.mark.parametrize("version", [1, 2])
def test_both_versions_are_read(version):
    blocks = [b"", b"HTTP/1.0 200 OK\r\n\r\n\n\nx\n", warc.http_block(b"y" * 200_000, 7)]
    data = legacy(version, blocks)
    records = list(warc.read_arc(io.BytesIO(data)))
    assert [record.block for record in records] == blocks
    assert [record.url for record in records] == [f"http://a.example/{i}%20b" for i in range(3)]
    assert {record.date for record in records} == {"20010203040506"}
    assert [record.code for record in records] == ["200" if version == 2 else ""] * 3
    assert len(data) > records[-1].offset and zlib.decompressobj(31).decompress(data[records[-1].offset :])
    # Uncompressed records in one member are read by their lengths, too.
    together = gzip.compress(gzip.decompress(data))
    assert [record.block for record in warc.read_arc(io.BytesIO(together))] == blocks


def test_damaged_archives_are_refused():
    data = legacy(1, [b"HTTP/1.0 200 OK\r\n\r\nabc"])
    with pytest.raises(ValueError, match="cut off"):
        list(warc.read_arc(io.BytesIO(data[:-12])))
    plain = gzip.decompress(data)
    with pytest.raises(ValueError, match="shorter"):
        list(warc.read_arc(io.BytesIO(gzip.compress(plain[:-5]))))
    with pytest.raises(ValueError, match="version"):
        list(warc.read_arc(io.BytesIO(gzip.compress(plain.replace(b"\n1 0 ", b"\n3 0 ")))))
    with pytest.raises(ValueError, match="fields"):
        list(warc.read_arc(io.BytesIO(gzip.compress(plain.replace(b"text/html ", b"text/html 200 ")))))
    with pytest.raises(ValueError, match="no archive"):
        list(warc.read_arc(io.BytesIO(gzip.compress(b"something else\n"))))


def test_new_records_follow_from_the_legacy_ones():
    blocks = [warc.http_block(b"one", 1), warc.http_block(b"one", 2)]
    first, second = warc.read_arc(io.BytesIO(legacy(1, blocks)))
    original = warc.Original(1, warc.record_id("some", first), first.url, warc.warc_date(first.date))
    data = b"".join(
        warc.member(part) for part in (warc.warcinfo("some", first.date), warc.warc_record("some", first, None), warc.warc_record("some", second, original))
    )
    info, response, revisit = warc.read_warc(io.BytesIO(data))
    assert info[0]["warc-type"] == "warcinfo"
    assert response[0]["warc-type"] == "response" and response[1] == blocks[0]
    assert response[0]["warc-date"] == "2001-02-03T04:05:06Z"
    assert revisit[0]["warc-refers-to"] == response[0]["warc-record-id"] != revisit[0]["warc-record-id"]
    assert revisit[0]["warc-payload-digest"] == response[0]["warc-payload-digest"] == "sha1:" + warc.payload_digest(b"one")
    assert revisit[1].endswith(b"\r\n\r\n") and revisit[0]["warc-profile"] == warc.IDENTICAL_PAYLOAD
    assert warc.warc_date("200102030405") == "2001-02-03T04:05:00Z"
    with pytest.raises(ValueError, match="length"):
        list(warc.read_warc(io.BytesIO(warc.member(warc.warc_record("some", first, None)[:-6]))))


def test_records_that_are_no_http_responses_and_responses_without_a_length():
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nX-Page-Id: 5\r\n\r\n3\r\none\r\n0\r\n\r\n"
    blocks = [("dns:example.org", "text/dns", b"20010203040506\nexample.org. 100 IN A 192.0.2.1\n"),
              ("http://example.org/", "text/html", chunked), ("ftp://example.org/a", "-", b"bytes"),
              ("http://example.org/old", "text/html", b"<html>an answer without headers</html>")]
    for version in (1, 2):
        records = [
            warc.ArcRecord(url, "192.0.2.9", "20010203040506", kind, block, 10 * n) for n, (url, kind, block) in enumerate(blocks)
        ]
        original = warc.Original(5, "<urn:uuid:x>", "http://example.org/", "2001-02-03T04:05:06Z")
        parts = [warc.warc_record("some", record, None) for record in records]
        parts += [warc.warc_record("some", records[1], original), warc.warc_record("some", records[0], original)]
        found = list(warc.read_warc(io.BytesIO(b"".join(map(warc.member, parts)))))
        assert [h["warc-type"] for h, _ in found] == ["resource", "response", "resource", "resource", "revisit", "resource"], version
        assert [h["content-type"].split(";")[0] for h, _ in found[:4]] == ["text/dns", "application/http", "application/octet-stream", "text/html"]
        assert found[0][1] == blocks[0][2] and found[0][0]["warc-payload-digest"] == "sha1:" + warc.payload_digest(blocks[0][2])
        rows = [row for batch in warc._found(found) for row in batch.to_pylist()]
        payload = b"3\r\none\r\n0\r\n\r\n"
        assert [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows] == [
            (5, len(payload), warc.payload_digest(payload), "response", None),
            (5, len(payload), warc.payload_digest(payload), "revisit", 5),
        ]
