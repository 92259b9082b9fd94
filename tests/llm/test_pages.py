"""Operators 5 and 6: HTML extraction and WARC archives."""

from __future__ import annotations

import gzip
import hashlib
import io

import pytest

from churnlab.llm import template, warc

PAGES = "page_id long, url string, html string, text string, host string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", "h", "p") for i, u, h in rows], PAGES)


def site_page(k: int, body: str) -> str:
    """A page of a site without semantic elements: only its template tells the
    fixed lines from the text."""
    return (
        f"<html><head><title>Page {k}</title><style>p{{}}</style></head><body><div id=top>Our Site</div>"
        f"<ul class=nav><li>Link {k}</li><li>Other</li></ul>{body}<div class=end>All rights reserved</div></body></html>"
    )


ARTICLE = """<!DOCTYPE html><html><body><header>Site name</header><nav><a href=x>Menu</a></nav>
<aside>Side</aside><div class="cookie-notice">We use cookies</div><article><header><h1>Title &amp; more</h1></header>
<p>One   &eacute;<b>bold</b>
line</p><script>var x = "</p><article>";</script><p>Two<br>parts<p>Three &lt;b&gt;<!-- no --><form>Your mail<input></form>
<div class="ad">Buy</div><section id="comments"><p>First!</p></section><ul><li>a<li>b</ul></article><footer>End</footer>"""


def test_article_page(spark):
    got = template.extract_main_text(pages(spark, [(1, "http://a.org/x", ARTICLE)])).collect()[0]
    assert got["text"] == "Title & more\nOne ébold line\nTwo parts\nThree <b>\na\nb"
    assert (got["page_id"], got["url"], got["n_chars"]) == (1, "http://a.org/x", len(got["text"]))


def test_template_of_a_host(spark):
    bodies = [f"<p>Text {k} of its own</p><p>and {k * k} words</p>" for k in range(12)]
    rows = [(k, f"https://Plain.example.org/{k}", site_page(k, b)) for k, b in enumerate(bodies)]
    rows += [(100, "https://lone.example.org/", site_page(0, bodies[0]))]
    got = {r["page_id"]: r["text"] for r in template.extract_main_text(pages(spark, rows)).collect()}
    for k in range(12):
        assert got[k] == f"Text {k} of its own\nand {k * k} words"
    # one page has no template: its fixed lines can't be told from its text
    assert got[100] == "Our Site\nText 0 of its own\nand 0 words\nAll rights reserved"


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar'><p>Text</p></body>", "<body class='sidebar'><p>Text</p></body>",
    "<html class='no-search' id=notice><body><p>Text</p>", "<main class='search-page'><p>Text</p></main>",
    "<main class='search'><p>Text</p></main>", "<main role=search><article class='notice share'><p>Text</p></article></main>",
    "<article id='share-prices'><p>Text</p></article>", "<div class='post no-comments'><p>Text</p></div>",
    "<article class='comment'><p>Text</p></article>", "<div class='post has-sidebar'><p>Text</p></div>",
    "<div class='content'><p>Text</p></div><article class='comment'>No</article><article class='comment odd'>No</article>",
    "<div class='content'><p>Text</p></div><section class=related><article>No</article></section>",
    "<div class='content'><p>Text</p></div><aside><article>No</article></aside>",
    "<article><p>Text</p><article class='reply'>No</article></article><article class='comment'>No</article>",
    "<div class='cookie-notice'>No</div><div class='site sidebar'>No</div><div id=nav_menu>No</div><p>Text</p>",
    "<div role=main><p>Text</p></div><div class='ad'>No</div>",
])
def test_boilerplate_words(page):
    assert template.main_text(page, {}) == "Text"


def article_page(k: int, body: str) -> str:
    return (
        f"<html><head><title>Page {k}</title></head><body><nav>Menu</nav><article><h1>Title {k}</h1>{body}"
        f"<div>Printed by the site</div></article><footer>End {k}</footer></body></html>"
    )


@pytest.mark.parametrize("make", [site_page, article_page])
def test_copies_of_a_page_are_no_template(spark, make):
    bodies = [f"<p>Text {k} of its own</p><p>and {k * k} words</p>" for k in range(9)]
    long = "".join(f"<p>Paragraph {i} of a long article</p>" for i in range(60))
    rows = [(k, f"http://hot.org/{k}", make(k, b)) for k, b in enumerate(bodies)]
    rows += [(k, f"http://hot.org/{k}", make(99, long)) for k in range(100, 112)]
    got = {r["page_id"]: r["text"] for r in template.extract_main_text(pages(spark, rows)).collect()}
    title = ["Title 99"] if make is article_page else []
    for k in range(100, 112):
        assert got[k].split("\n") == title + [f"Paragraph {i} of a long article" for i in range(60)]
    for k in range(9):
        assert got[k].endswith(f"Text {k} of its own\nand {k * k} words")


@pytest.mark.parametrize("make", [site_page, article_page])
@pytest.mark.parametrize("head", ["", "<h2>A shared head</h2>"])
def test_a_shared_passage_is_no_template(spark, make, head):
    shared = head + "<p>A passage of one paragraph</p><p>and of one more</p>"
    bodies = [f"<p>Text {k} of its own</p>" + shared * (k < 8) + f"<p>and {k * k} words</p>" for k in range(12)]
    rows = [(k, f"http://passage.org/{k}", make(k, b)) for k, b in enumerate(bodies)]
    got = {r["page_id"]: r["text"] for r in template.extract_main_text(pages(spark, rows)).collect()}
    for k in range(12):
        want = [f"Title {k}"] * (make is article_page) + [f"Text {k} of its own"]
        want += (["A shared head"] * bool(head) + ["A passage of one paragraph", "and of one more"]) * (k < 8)
        assert got[k].split("\n") == want + [f"and {k * k} words"]


def nameless_page(k: int, body: str) -> str:
    """A page whose tags tell nothing: teasers and adverts differ from page to page."""
    return (
        f"<html><body><div><div>Our Site</div><div><a href=/{k}>Read {k} next</a><a href=/x>Home</a></div><div>Buy {k} now"
        f"</div><h1>Title {k}</h1><section>{body}</section><div>Seen by {k * 7}</div><div>All rights reserved</div></div></body></html>"
    )


def body_of(k: int) -> str:
    return "".join(f"<p>Paragraph {i} of text {k} in its own words</p>" for i in range(9 + k % 5))


@pytest.mark.parametrize("count", [2, 3, 12])
def test_region_of_a_host_without_names(spark, count):
    rows = [(k, f"http://nameless.org/{k}", nameless_page(k, body_of(k))) for k in range(count)]
    rows += [(100 + k, f"http://nameless.org/again/{k}", nameless_page(0, body_of(0))) for k in range(count)]  # copies
    rows += [(200, "http://nameless.org/other", "<html><body><p>A page of another make</p></body></html>")] * (count > 3)
    rows += [(300, "http://single.org/", nameless_page(0, body_of(0)))]
    got = {r["page_id"]: r["text"] for r in template.extract_main_text(pages(spark, rows)).collect()}
    for k in range(count):
        want = [f"Title {k}"] + [f"Paragraph {i} of text {k} in its own words" for i in range(9 + k % 5)]
        assert got[k].split("\n") == want
        assert got[100 + k] == got[0]
    if count > 3:
        assert got[200] == "A page of another make"
    # a host of one page has no template: all that its tags don't rule out stays
    assert got[300].startswith("Our Site") and got[300].endswith("All rights reserved")


@pytest.mark.parametrize("make", [nameless_page, article_page])
def test_articles_of_few_pages_keep_what_they_share(spark, make):
    shared = "".join(f"<p>Shared paragraph {i}</p>" for i in range(20))
    rows = [(k, f"http://two.org/{k}", make(k, f"<p>Own text {k} of this page</p>" + shared)) for k in (1, 2)]
    got = {r["page_id"]: r["text"] for r in template.extract_main_text(pages(spark, rows)).collect()}
    for k in (1, 2):
        want = [f"Title {k}", f"Own text {k} of this page"] + [f"Shared paragraph {i}" for i in range(20)]
        assert got[k].split("\n") == want + ["Printed by the site"] * (make is article_page)


def test_labelled_parts_are_no_region(spark):
    """Comments longer than the article don't draw the region to them."""
    rows = [
        (k, f"http://talk.org/{k}", f"<html><body><div>Site</div><div><div>{body_of(k)}</div></div>"
         f"<div class=comments><p>{f'Comment {k} ' * 200}</p></div><div>End</div></body></html>")
        for k in range(6)
    ]
    got = {r["page_id"]: r["text"] for r in template.extract_main_text(pages(spark, rows)).collect()}
    for k in range(6):
        assert got[k].split("\n") == [f"Paragraph {i} of text {k} in its own words" for i in range(9 + k % 5)]


def test_classes_match_brute_force(spark):
    """Classes by whole occurrence vectors over the different pages of a host."""
    sites = {"a.org": [site_page(k, body_of(k)) for k in range(9)], "b.org": [article_page(k, body_of(k)) for k in range(2)],
             "c.org": [nameless_page(k, body_of(k)) for k in range(5)] + [site_page(9, body_of(9))], "d.org": [article_page(1, "")]}
    rows = [(f"http://{h}/", p) for h, found in sites.items() for p in found + found[:2]]
    frame = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    got = {
        (r["h"], frozenset(c["code"] for c in r["classes"] if c["cls"] == k))
        for r in template.deduce_templates(frame.withColumn("host", template.host_of(frame.url))).collect()
        for k in {c["cls"] for c in r["classes"]}
    }
    want = set()
    for host, found in sites.items():
        counted = [[template.code_of(t) for t in template.tokens_of(p)] for p in found]
        by_vector = {}
        for code in {c for p in counted for c in p}:
            by_vector.setdefault(tuple(p.count(code) for p in counted), set()).add(code)
        for vector, members in by_vector.items():
            seen = sum(n > 0 for n in vector)
            if len(members) > 1 and seen >= 2 and 2 * seen >= len(found) + 2:
                want.add((host, frozenset(members)))
    assert got == want and {h for h, _ in want} == {"a.org", "b.org", "c.org"}


def test_classes_must_keep_their_order_and_slots():
    classes = {1: [10, 11, 12], 2: [20, 21]}
    assert template.template_codes([10, 20, 21, 20, 21, 11, 5, 12], classes) == {10, 11, 12, 20, 21}
    assert template.template_codes([11, 10, 12, 20, 21], classes) == {20, 21}  # out of order
    assert template.template_codes([10, 20, 11, 21, 12], classes) == {10, 11, 12}  # across slots
    assert template.template_codes([10, 11, 12, 20], classes) == {10, 11, 12}  # not whole


def test_odd_pages(spark):
    long = "<p>" + "word " * 200_000 + "</p>"
    rows = [(1, None, None), (2, "no url", ""), (3, "http://x/", "plain text"), (4, "", "<p>a" * 3),
            (None, "http://y/", "<article><p>kept</article>"), (5, "http://z/", long), (5, "http://z/", long),
            (6, "http://w/", "a < b and </ c <"), (7, "http://v/", "<article>one</article> x <article>two</article>")]
    got = [tuple(r)[0::2] for r in template.extract_main_text(pages(spark, rows)).collect()]
    texts = dict(got)
    assert len(got) == len(rows) and texts[1] == texts[2] == "" and texts[3] == "plain text"
    assert texts[4] == "a\na\na" and texts[None] == "kept" and len(texts[5].split()) == 200_000
    assert texts[6] == "a < b and </ c <" and texts[7] == "one\ntwo"
    assert template.extract_main_text(pages(spark, [])).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big, other, small = "x" * 1500 + "é", "y" * 2000, "z"
    rows = [(1, "http://a/ü\r\nX: y", big), (5, None, big), (3, "http://c", big), (4, "http://d", small),
            (6, "http://e", small), (7, "http://f", None), (8, "http://g", ""), (9, "http://h", other),
            (9, "http://h", other), (2, "http://i", other), (None, "http://j", other), (2**60, "http://k", "line\r\n\r\nend")]
    records = warc.decide_records(pages(spark, rows))
    manifest = warc.write_archives(records, f"file://{tmp_path}/w", roll_bytes=600)
    got = warc.read_archives(manifest, f"file://{tmp_path}/w").collect()
    assert sum(r["records"] for r in manifest.collect()) == len(got) == len(rows)
    last = {big: 5, other: 9}
    found = []
    for r in got:
        found.append((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]))
        if r["record_type"] == "response":
            assert hashlib.sha1(bytes(r["payload"])).hexdigest() == r["payload_digest"]
        else:
            assert len(r["payload"]) == 0
    want = []
    for i, _, h in rows:
        raw, response = (h or "").encode(), last.get(h)
        revisit = response is not None and response != i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", response if revisit else None))
    assert sorted(map(str, found)) == sorted(map(str, want))
    for path in (tmp_path / "w").iterdir():  # each archive is plain concatenated gzip
        assert gzip.decompress(path.read_bytes()).startswith(b"WARC/1.1\r\n")
    empty = warc.write_archives(warc.decide_records(pages(spark, [])), f"file://{tmp_path}/none")
    assert empty.count() == 0 and warc.read_archives(empty, f"file://{tmp_path}/none").count() == 0


def test_reader_streams_members_and_rejects_damage(monkeypatch):
    digest = hashlib.sha1(b"payload").hexdigest()
    one = warc.encode_record("1", "response", "http://a", b"payload", digest, None)
    two = warc.encode_record("2", "revisit", None, b"payload", digest, "1")
    monkeypatch.setattr(warc, "READ_BYTES", 7)
    records = [warc.decode_record(m) for m in warc.members(io.BytesIO(one + two))]
    assert [(r["record_id"], r["refers_to"], r["payload_bytes"]) for r in records] == [(1, None, 7), (2, 1, 7)]
    with pytest.raises(warc.WarcError):
        list(warc.members(io.BytesIO(one + two[:-4])))
    plain = gzip.decompress(one)
    for bad in (plain.replace(b"payload\r\n", b"paylord\r\n"), plain[:-1], plain.replace(b"WARC/1.1", b"WARC/9.9")):
        with pytest.raises(warc.WarcError):
            warc.decode_record(bad)
