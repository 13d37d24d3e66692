import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from hrflow.llm import html_text, warc
from hrflow.session import scratch_path

PAGES = [(1, "http://a/1", "<p>same é</p>"), (2, "http://a/2", "<p>same é</p>"), (3, None, None), (4, "http://a/4", ""),
         (5, "http://a/5\r\nX: y", "<p>own</p>"), (5, "http://a/5b", "<p>own</p>"), (None, "http://a/n", "<p>n</p>"),
         (6, "http://a/6", "x" * 300_000), (None, "http://a/m", "<p>same é</p>")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn(
        "offset", F.lit(1))


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def want(rows):
    last = {}
    for p, _, h in rows:
        if p is not None:
            last[h or ""] = max(p, last.get(h or "", p))
    return sorted(((p, len((h or "").encode()), sha(h), "response" if p == last.get(h or "") else "revisit",
                    None if p == last.get(h or "") else last.get(h or "")) for p, _, h in rows), key=str)


def test_round_trip(spark):
    got = warc.archive_round_trip(pages(spark)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want(PAGES)
    assert all(r.stored_digest == r.payload_digest for r in got if r.record_type == "response")


def test_index_names_members_of_valid_archives_and_reads_a_selection(spark, monkeypatch):
    folder = scratch_path(spark, "warc-test")
    index = warc.write_archives(pages(spark), folder)
    rows = index.collect()
    local = folder.removeprefix("file:")
    for name in {r.file for r in rows}:
        raw = open(os.path.join(local, name), "rb").read()
        assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == sum(r.file == name for r in rows)
        for r in rows:
            if r.file == name:
                head, _ = warc.parse_record(raw[r.offset:r.offset + r.length])
                assert head["warc-payload-digest"] == "sha1:" + r.payload_digest
    some = warc.read_records(index.where("page_id in (2, 6)"), folder).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in some) == [(2, "<p>same é</p>"), (6, "x" * 300_000)]


def test_archive_of_nothing(spark):
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


ARTICLE = """<!DOCTYPE html><html><head><title>t</title><script>var a="<p>no</p>"</script></head><body>
<div id="header">Site, with, commas, everywhere</div><ul class="main-menu"><li><a href=/>Home</a><li><a href=/b>Other</a></ul>
<div class="content"><h2>Heading &amp; more</h2><p>First paragraph, with commas, and many words that go on for quite some time.
<p>Second   &eacute;&#x41;<br>after<p>Third has <a href=x>a link</a>, and text that goes on, on, and on for a good while.
<ul><li>item one<li>item two</ul></div>
<div class="sidebar"><p>Side stuff, with commas, and a long sentence that looks like an article paragraph, really.</p></div>
<div id="comments"><p>I think, as a reader, that this is wrong, really wrong, and here are many words to say so.</p></div>
<form><p>Subscribe, please, give us your address so that we can send you things, many things.</p></form>
<div class="cookie-notice"><p>We use cookies, lots of them, for purposes, and more purposes than you can think of.</p></div>
<div class=ad>Buy, buy, buy this thing now, it is cheap, and good, and here</div><footer>Copyright</footer></body></html>"""


@pytest.mark.parametrize("page,text", [
    (ARTICLE, "Heading & more\nFirst paragraph, with commas, and many words that go on for quite some time.\nSecond éA\nafter\n"
              "Third has a link, and text that goes on, on, and on for a good while.\nitem one\nitem two"),
    (None, ""), ("", ""), ("<script>x</script>", ""), ("plain, no tags", "plain, no tags"), ("<p>Only</p>", "Only"),
    ("<article><h1>T</h1><p><b>T<br><p>x y</p></article><footer>f", "T\nT\nx y"), ("<div>a<div>b", "a\nb"), ("<p>1 < 2 & 3", "1 < 2 & 3"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_test_pages_give_the_article(spark):
    import html
    import re
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_text.extract(df).join(df.select("page_id", "html"), "page_id").collect():
        inner = re.split("</article>|<footer>", r.html.split("<article>", 1)[1])[0]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)[^>]*>", inner))
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def test_extract_edges(spark):
    df = spark.createDataFrame([(1, "u", None), (None, None, "<p>x"), (2, "u", "<div>" * 20_000 + "deep"), (2, "u", "<p>x")],
                               "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = sorted(((r.page_id, r.text, r.n_chars) for r in html_text.extract(df).collect()), key=str)
    assert got == sorted([(1, "", 0), (None, "x", 1), (2, "deep", 4), (2, "x", 1)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    '<div class="content with-sidebar"><article>{}</article></div>', '<div id="menu-page"><article>{}</article></div>',
    '<div class="has-share layout"><div>{}</div></div>',
    '<div class="has-comments"><article>{}</article></div>', '<form id=aspnetForm method=post><div>{}</div></form>',
    '<form id=aspnetForm><div class="has-share layout"><main>{}</main></div></form>',
    '<nav><a href="/">Home page of all</a><div>{}</div>'])
def test_wrappers_with_class_words_keep_their_article(page):
    from hrflow.llm.html_text import main_text
    body = "".join(f"<p>Paragraph {i} tells at some length, with commas, of what was seen.</p>" for i in range(8))
    side = '<div class="sidebar"><p>Read other things here.</p></div><div class="comments"><p>' + "So true, I say. " * 90 + "</p></div>"
    got = main_text(f"<html><body>{page.format(body + side)}</body></html>")
    assert all(f"Paragraph {i} tells" in got for i in range(8)) and "So true" not in got and "Read other" not in got


def paragraphs(n, name):
    return "".join(f"<p>{name} paragraph number {i}, which says something, and then something more.</p>" for i in range(n))


def test_parts_of_an_article_with_furniture_names_stay():
    from hrflow.llm.html_text import main_text
    page = (f"<body><nav><a href=x>Home</a></nav><article>{paragraphs(4, 'first')}<div class='share-wrapper'>{paragraphs(40, 'wrapped')}</div>"
            "<div class='share-buttons'><a href=a>Tweet</a> <a href=b>Post</a></div></article><footer>foot</footer></body>")
    assert main_text(page).split("\n")[-1].startswith("wrapped paragraph number 39") and main_text(page).count("\n") == 43
    page = f"<body><main>{paragraphs(20, 'plain')}<section class='social-history'>{paragraphs(20, 'history')}</section></main></body>"
    assert main_text(page).count("paragraph number") == 40


def test_sibling_articles_are_joined():
    from hrflow.llm.html_text import main_text
    page = (f"<body><article>{paragraphs(9, 'one')}</article><article>{paragraphs(8, 'two')}</article><article><a href=x>teaser</a></article>"
            f"<div class='newsletter'>{paragraphs(5, 'join')}</div></body>")
    text = main_text(page).split("\n")
    assert len(text) == 17 and text[0].startswith("one") and text[-1].startswith("two")


def test_archives_are_read_by_several_tasks(spark, monkeypatch):
    from hrflow.llm import warc
    monkeypatch.setattr(warc, "TASK_BYTES", 1000)
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "concat(uuid(), uuid(), uuid()) AS html").repartition(3)
    out = warc.archive_round_trip(pages)
    assert out.rdd.getNumPartitions() > 3 and out.count() == 40
