import random
import time
from html.parser import HTMLParser as StdParser

import pytest
from pyspark.sql import functions as F

from corpusweave import session
from corpusweave.functions.elements import _scanner, nesting
from corpusweave.operators import extract as X
from corpusweave.operators import lookup as L
from corpusweave.plans.queries import QUERIES
from corpusweave.sources import tables as T

def frame(spark, *pages):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")


def one(spark, html, url="https://example.com/articles/page"):
    return X.page_records(frame(spark, (url, html))).first()


MANY = " ".join(f"data-n{i}='{i}>'" for i in range(1000))
PARTS = f"""<!doctype html><TITLE {MANY}>Harbour log</TITLE><meta content="tides, ropes" {MANY} name=keywords>
<meta name=description content="  Notes &lpar;draft&rpar; ">
<script {MANY}>document.write("<a href=/hidden>no</a>")</script>
<h2>Mooring<ruby>lines<rt>read so</rt></ruby></h2><dl><dt>knot<dd>bowline</dl>
<ol {MANY}><li>coil<li>splice<template>unseen</template></ol>
<a {MANY} href="quay?berth=4">berth</a><img {MANY} src=//img.example.net/rope.webp alt="Rope &amp; reel">
<table><tr><th>Tide<td>06&colon;40<tr><td>Ebb<td></table>"""


def test_parts_of_a_page_with_very_many_attributes(spark):
    r = one(spark, PARTS, "https://port.example/logs/today")
    assert (r.title, list(r.errors)) == ("Harbour log", [])
    assert (r.metadata.description, r.metadata.keywords) == ("Notes (draft)", "tides, ropes")
    assert list(r.links) == ["https://port.example/logs/quay?berth=4"]
    assert [tuple(i) for i in r.images] == [("https://img.example.net/rope.webp", "Rope & reel")]
    assert [tuple(h) for h in r.headings] == [("h2", "Mooring lines")]
    assert [tuple(x) for x in r.lists] == [("ol", ["coil", "splice"])]
    assert r.tables == [[["Tide", "06:40"], ["Ebb", ""]]]
    assert r.text == "Harbour log Mooring lines knot bowline coil splice berth Tide 06:40 Ebb"


@pytest.mark.parametrize(
    ("markup", "links"),
    [
        ("<a href=/s?" + "&".join(f"p{i}={i}" for i in range(600)) + ">", ["https://port.example/s?" + "&".join(f"p{i}={i}" for i in range(600))]),
        ("<a hreflang=fr title='href=/t' href=u href=v>", ["https://port.example/logs/u"]),
        ("<a\nhref\n=\n'w x'>", ["https://port.example/logs/w x"]),
        ("<a href='#here'><a href=' '><a href><a name=x><area href=/area>", []),
        ("<a href=tel:123><a href=ftp://port.example/f><a href=HTTPS://Port.Example/Q>", ["https://Port.Example/Q"]),
        ("<a href=k#one><a href=k#two><a href=./k>", ["https://port.example/logs/k"]),
        ("<a href='http://[2001:db8::1]:8080/six'>", ["http://[2001:db8::1]:8080/six"]),
    ],
)
def test_link_targets(spark, markup, links):
    r = one(spark, markup, "https://port.example/logs/today")
    assert (list(r.links), list(r.errors)) == (links, [])


def test_a_part_that_cannot_be_resolved_fails_alone(spark):
    r = one(spark, "<a href='/fine'></a><a href='http://[half'>x</a><img src='/i.png'><h1>Kept</h1>")
    assert (r.links, list(r.errors)) == ([], ["Failed to extract links: ValueError"])
    assert r.images[0].src == "https://example.com/i.png" and r.headings[0].text == "Kept"
    r = one(spark, "<a href='/fine'></a><img src='//half]/i.png'>")
    assert (list(r.links), r.images, list(r.errors)) == (["https://example.com/fine"], [], ["Failed to extract images: ValueError"])


def test_broken_pages_do_not_fail(spark):
    pages = [("u", "<title>Torn<title></head><h1>Still read"), ("u", ""), ("u", "<<<>>&#xFFFFFF;&#99999999999;<a href="),
             ("u", "<!-- never closed <b>"), ("u", "<script>no end"), ("u", "<ul><li>a<ul><li>b"), ("u", "</li></ul></table>x<li>y"), ("u", None)]
    rows = X.page_records(frame(spark, *pages)).orderBy("page_id").collect()
    assert rows[0].title == "Torn" and rows[0].headings[0].text == "Still read"
    assert [(x.type, x["items"]) for x in rows[5].lists] == [("ul", ["a b"]), ("ul", ["b"])]
    assert rows[6].text == "x y" and rows[6].lists == []
    assert rows[7].errors == ["Failed to parse HTML: TypeError"] and rows[7].metadata is None


def test_noscript_is_pruned_from_the_record_only(spark):
    page = frame(spark, ("https://e.com/", '<noscript><a href="/n">n</a></noscript><a href="/a">a</a>'))
    assert X.page_records(page).first().links == ["https://e.com/a"]
    assert [r.dst_url for r in X.link_table(page).orderBy("pos").collect()] == ["https://e.com/n", "https://e.com/a"]


def test_entities_and_whitespace(spark):
    r = one(spark, "<p>&nbsp;a&lt;b &#8217;&#x41;&amp;lt; &copy &ampx &bogus; </p><p> </p>")
    assert r.text == "a<b ’A&lt; © &x &bogus;"
    rare = one(spark, "<p>&AMP;&COPY;&ltimes;&NotEqual;&lbrace;&#150;&#x80;&#129;&#xD800;&#0x;</p>").text
    assert rare == "&©⋉≠{–€\x81\ufffd\ufffdx;"


@pytest.mark.parametrize(
    ("selector", "want"),
    [
        ("p", ["one two", "three"]), ("div", ["in side", "side"]), (".x", ["three"]), ("#d", ["in side"]), ("p.y", ["three"]), ("p.z", []),
    ],
)
def test_selectors(spark, selector, want):
    page = frame(spark, ("u", '<p>one<b>two<p class="x y">three<div id=d>in<div>side</div></div>tail'))
    assert [r.text for r in X.selector_matches(page, selector).orderBy("pos").collect()] == want
    assert X.text_by_selector(page, selector).first().text == " ".join(want)


def test_selector_syntax_is_checked(spark):
    with pytest.raises(ValueError):
        X.selector_matches(frame(spark, ("u", "")), "div > p")


class TreeModel(StdParser):
    """Sequential model of nested lists and tables in well-formed markup."""

    def __init__(self):
        super().__init__()
        self.stack, self.lists, self.tables = [], [], []

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "text": [], "children": [], "rows": [], "cells": []}
        if tag in ("ul", "ol"):
            self.lists.append(node)
        if tag == "table":
            self.tables.append(node)
        if tag == "li" and self.stack:
            self.stack[-1]["children"].append(node)
        for above in self.stack:
            if tag == "tr" and above["tag"] == "table":
                above["rows"].append(node)
            if tag in ("td", "th") and above["tag"] == "tr":
                above["cells"].append(node)
        self.stack.append(node)

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        if data.strip():
            for node in self.stack:
                node["text"].append(data.strip())


def grow(rng, depth, kind):
    word = lambda: rng.choice(["a", "b c", " ", "", "d<b>e</b>f".replace("<b>", "").replace("</b>", "")])
    if kind == "list":
        tag = rng.choice(["ul", "ol"])
        items = "".join(
            f"<li>{word()}{grow(rng, depth - 1, 'list') if depth and rng.random() < 0.4 else ''}{word()}</li>" for _ in range(rng.randint(0, 4))
        )
        return f"<{tag}>{items}</{tag}>"
    rows = "".join(
        "<tr>" + "".join(
            f"<td>{word()}{grow(rng, depth - 1, 'table') if depth and rng.random() < 0.3 else ''}</td>" for _ in range(rng.randint(0, 3))
        ) + "</tr>"
        for _ in range(rng.randint(0, 3))
    )
    return f"<table>{rows}</table>"


def test_nested_lists_and_tables_equal_a_sequential_model(spark):
    rng = random.Random(7)
    bodies = ["".join(grow(rng, 3, rng.choice(["list", "table"])) for _ in range(rng.randint(1, 5))) for _ in range(120)]
    rows = X.page_records(frame(spark, *(("u", b) for b in bodies))).orderBy("page_id").collect()
    for body, row in zip(bodies, rows, strict=True):
        model = TreeModel()
        model.feed(body)
        lists = [(n["tag"], [" ".join(c["text"]) for c in n["children"] if c["text"]]) for n in model.lists]
        assert [(x.type, list(x["items"])) for x in row.lists] == [x for x in lists if x[1]], body
        tables = [[[" ".join(c["text"]) for c in r["cells"]] for r in t["rows"] if r["cells"]] for t in model.tables]
        assert [[list(r) for r in t] for t in row.tables] == [t for t in tables if t], body


@pytest.mark.parametrize(
    ("markup", "lists"),
    [
        ("<ul><div><li>x</li></div></ul>", []),
        ("<ul><li>a</li><div><li>x</li></div><li>b</li></ul>", [("ul", ["a", "b"])]),
        ("<ul><li><div>a<span>b</span></div></li></ul>", [("ul", ["a b"])]),
        ("<div><ol><li>a<ul><li>b</ul></ol></div><section><li>no list</section>", [("ol", ["a b"]), ("ul", ["b"])]),
        *((f"<ul><{t}><li>x</{t}><li>y</ul>", [("ul", ["y"])]) for t in ("main", "center", "a", "div", "x-card", "b")),
        *((f"<ul><li>y</li><{t}><li>x</{t}></ul>", [("ul", ["y"])]) for t in ("main", "center", "a", "div", "x-card", "b")),
        ("<ul><li><b>open<li>next</ul><ol><li>other</ol>", [("ul", ["open", "next"]), ("ol", ["other"])]),
        ("<ul><br><p><li>a</ul></div><ul><ul><li>b</ul><li>c</ul>", [("ul", ["a"]), ("ul", ["c"]), ("ul", ["b"])]),
        ("<ul title='<li>'><li data-x='</ul>'>a<!-- <li> --></ul>", [("ul", ["a"])]),
    ],
)
def test_only_direct_children_are_items(spark, markup, lists):
    assert [(x.type, list(x["items"])) for x in one(spark, markup).lists] == lists


def test_long_flat_page(spark):
    n = 3500
    body = "<ul>" + "".join(f"<li>i{i}" for i in range(n)) + "</ul>"
    r = one(spark, body)
    assert len(r.lists[0]["items"]) == n and r.lists[0]["items"][-1] == f"i{n - 1}"


def _cost(marks):
    scan, best = _scanner(), float("inf")
    for _ in range(3):
        start = time.perf_counter()
        scan(marks)
        best = min(best, time.perf_counter() - start)
    return best


@pytest.mark.parametrize("shape", ["flat", "nested", "stray"])
def test_nesting_costs_in_proportion_to_a_page(shape):
    def page(n):
        return {"flat": "ul " + "+li " * n, "nested": "ul li " * n + "/li /ul " * n, "stray": "div " * n + "b /i +li " * n}[shape].strip()

    assert _cost(page(80_000)) <= 2.2 * _cost(page(40_000)) * 1.3  # room for a busy machine


def test_deep_lists_in_a_page(spark):
    n = 3000
    r = one(spark, "<ul><li>" * n + "x" + "</li></ul>" * n + "<table><tr><td>" * 40 + "y" + "</table>" * 40)
    assert len(r.lists) == n and {tuple(x["items"]) for x in r.lists} == {("x",)}
    assert len(r.tables) == 40 and r.tables[-1] == [["y"]] and [len(t) for t in r.tables[:3]] == [40, 39, 38]


def test_lookup_and_failed_record(spark):
    pages = frame(spark, ("https://e.com/ok", "<title>T</title>ok"), ("https://e.com/empty", ""), ("https://e.com/ok", "second"))
    urls = spark.createDataFrame([("https://e.com/ok",), ("https://e.com/missing",), ("https://e.com/ok",), ("https://e.com/empty",)], "url string")
    got = {r.url: (r.status, r.length) for r in L.fetch_status(urls, pages).collect()}
    assert got == {"https://e.com/ok": ("OK", 18), "https://e.com/missing": ("ERROR", 0), "https://e.com/empty": ("ERROR", 0)}
    records = {r.url: r for r in L.fetch_and_extract(urls, pages).collect()}
    bad = records["https://e.com/missing"]
    assert bad.errors == ["Failed to fetch HTML"] and bad.links == [] and bad.headings == [] and bad.metadata is None and bad.title == ""
    assert records["https://e.com/ok"].title == "T" and records["https://e.com/ok"].errors == []


def test_summary(spark):
    s = X.page_summary(X.page_records(frame(spark, ("https://port.example/logs/today", PARTS)))).first()
    assert (s.links_count, s.images_count, s.headings_count, s.tables_count, s.lists_count) == (1, 1, 1, 1, 1)
    assert s.first_links == ["https://port.example/logs/quay?berth=4"] and s.text_length == 71


def test_lookups_beyond_the_broadcast_bound(spark, monkeypatch):
    pages = frame(spark, *((f"https://e.com/{k % 40}", "x" * k) for k in range(120)))
    urls = spark.createDataFrame([(f"https://e.com/{k}",) for k in range(30, 50)], "url string")
    few = sorted(map(tuple, L.batch_lookup(urls, pages).collect()))
    monkeypatch.setattr(L, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, L.batch_lookup(urls, pages).collect())) == few
    assert few == sorted((f"https://e.com/{k}", "x" * k if k < 40 else "") for k in range(30, 50))
    records = {r.url: (r.text, list(r.errors)) for r in L.fetch_and_extract(urls, pages).collect()}
    assert records == {u: (h, [] if h else ["Failed to fetch HTML"]) for u, h in few}


def test_no_body_moves_unfiltered_beyond_the_broadcast_bound(spark, tmp_path, monkeypatch):
    frame(spark, *((f"https://e.com/{k}", f"<h1>{k}") for k in range(200))).write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    urls = spark.createDataFrame([(f"https://e.com/{k}",) for k in range(5)], "url string")
    monkeypatch.setattr(L, "BROADCAST_BYTES", 0)
    for job in (L.batch_lookup, L.fetch_status, L.fetch_and_extract):
        plan = job(urls, pages)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        scans = [k for k, line in enumerate(plan) if "Relation" in line and "html" in line]
        assert scans and all("Filter" in plan[k - 1] and "getbit" in plan[k - 1] for k in scans)


def test_bloom_filter_lets_wanted_ids_pass_and_few_others(spark):
    ids = spark.range(0, 40_000, 40).withColumnRenamed("id", "page_id")
    passed = {r.id for r in spark.range(40_000).where(L.bloom_filter(ids, "page_id")(F.col("id"))).collect()}
    assert passed >= set(range(0, 40_000, 40)) and len(passed) < 1000 + 400
    assert spark.range(100).where(L.bloom_filter(ids.where("false"), "page_id")(F.col("id"))).count() == 0


def test_every_copy_of_a_url_has_its_record(spark, tmp_path, monkeypatch):
    link = '<html><body><p>{}</p><ul><li>x</ul><a href="/a">a</a></body></html>'
    bodies = [("https://e.com/two", link.format("one")), ("https://e.com/two", link.format("two")), ("https://e.com/one", link.format("three"))]
    frame(spark, *bodies).write.parquet(str(tmp_path / "pages.parquet"))
    rows = QUERIES["fetch_extract"](spark, str(tmp_path)).collect()
    found = sorted((r.url, r.text.split()[0] if r.text else "", r.links_count) for r in rows)
    assert found == [("https://e.com/a", "", 0), ("https://e.com/one", "three", 1), ("https://e.com/two", "one", 2), ("https://e.com/two", "two", 2)]
    pages, urls = spark.read.parquet(str(tmp_path / "pages.parquet")), spark.createDataFrame([("https://e.com/two",)], "url string")
    monkeypatch.setattr(L, "BROADCAST_BYTES", 0)
    assert L.fetch_and_extract(urls, pages, every_copy=True).count() == 2 and L.fetch_and_extract(urls, pages).count() == 1
    frame(spark, *bodies[:1]).union(frame(spark, *bodies[:1])).write.parquet(str(tmp_path / "again" / "pages.parquet"))
    again = QUERIES["fetch_extract"](spark, str(tmp_path / "again")).where("url like '%two'").collect()
    assert [r.links_count for r in again] == [1, 1]


def test_selectors_share_a_token_table(spark):
    page = frame(spark, ("https://e.com/", '<p>a&amp;b<div class="x ad">c<p>d</div><div class=ad>e</div><p*q>f'))
    got = sorted((r.selector, r.pos, r.text) for r in X.matches_of_each(page, ("p", "div.ad", "p")).collect())
    assert got == [("div.ad", 0, "c d"), ("div.ad", 1, "e"), ("p", 0, "a&b"), ("p", 1, "d")]
    plan = X.matches_of_each(page, ("p", "div.ad"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_nesting_gives_the_wanted_kinds_alone(spark):
    found = spark.range(1).select(nesting(F.lit("ul +li +li /ul"), ["lists"]).alias("n"))
    assert found.schema["n"].dataType.fieldNames() == ["lists"]
    assert [(x.type, [tuple(s) for s in x["items"]]) for x in found.first().n.lists] == [("ul", [(0, 1), (1, 2)])]


def test_rows_are_dealt_out_before_pages_are_made(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "ROWS_A_TASK", 10)
    orders = spark.range(200).selectExpr("id as o_orderkey", "id as o_custkey", "'O' as o_orderstatus", "'x' as o_orderpriority")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    lines = spark.range(400).selectExpr("id div 2 as l_orderkey", "cast(id % 2 as int) as l_linenumber", "id as l_partkey")
    lines.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    shop, baskets = T.order_pages(spark, str(tmp_path)), T.basket_pages(spark, str(tmp_path))
    assert (shop.count(), baskets.count()) == (200, 200)
    assert shop.rdd.getNumPartitions() == 20 and baskets.rdd.getNumPartitions() == 40


ODD = ["<a href='/x?a=1&amp;copy=2'><IMG SRC=../i.png alt='&nbsp;A&#xFEFF;&#150;'><h2>One<br>&ltwo;</h2><title>T&AMP;T<b>u</title>",
       "<div title='<a href=/in><img src=/in.png>'>x</div><a href=\"http:/up\"><h3>a<h1>b<!-- c --->d</h1><meta name=description content=' d '>",
       "<template><h1>no</h1></template><a href='#t'><a href='mailto:x'><a href='../../y/./z;p?q#f'><h1\x01>k</h1><noscript>n", "", "<a href=", None]


def test_a_record_says_what_the_columns_say(spark):
    page = frame(spark, *(("https://e.com/a/b?c", h) for h in ODD if h is None or "noscript" not in h), (None, ODD[0]), ("rel", ODD[1]))
    rows = X.page_records(page).collect()
    facts = lambda table, *names: sorted((r.page_id, r.pos, *(r[n] for n in names)) for r in table.collect())
    each = lambda name, *fields: sorted((r.page_id, k, *(x[f] for f in fields)) for r in rows for k, x in enumerate(r[name]))
    assert sorted((r.page_id, k, x) for r in rows for k, x in enumerate(r.links)) == facts(X.link_table(page), "dst_url")
    assert each("images", "src", "alt") == facts(X.image_table(page), "src", "alt")
    assert each("headings", "level", "text") == facts(X.heading_table(page), "level", "text")
    metas = {r.page_id: (r.title, r.description, r.keywords) for r in X.metadata_table(page).collect() if r.title is not None}
    assert {r.page_id: tuple(r.metadata) for r in rows if r.metadata} == metas


@pytest.mark.parametrize("job", [X.page_records, X.cell_table, X.list_item_table, lambda p: X.matches_of_each(p, ("p", "div.ad"))])
def test_no_tag_costs_an_interpreted_expression(spark, job):
    plan = job(frame(spark, ("u", "<p>x")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp" not in plan


def test_a_selected_page_is_read_to_its_last_element(spark):
    page = frame(spark, ("u", "<div class=ad>a<p>b<div class='ad x'>c</div>d</div>e<p>f<table><tr><td><p>g</table>h<img class=ad>"))
    got = sorted((r.selector, r.pos, r.text) for r in X.matches_of_each(page, ("div.ad", "p", "img", ".x")).collect())
    assert got == [(".x", 0, "c"), ("div.ad", 0, "a b c d"), ("div.ad", 1, "c"), ("p", 0, "b"), ("p", 1, "f"), ("p", 2, "g")]


def test_a_large_filter_is_not_in_the_plan(spark, monkeypatch):
    ids = spark.range(0, 40_000, 40).withColumnRenamed("id", "page_id")
    few = {r.id for r in spark.range(40_000).where(L.bloom_filter(ids, "page_id")(F.col("id"))).collect()}
    monkeypatch.setattr(L, "PLAN_BITS", 0)
    found = spark.range(40_000).where(L.bloom_filter(ids, "page_id")(F.col("id")))
    assert {r.id for r in found.collect()} == few
    assert len(found._jdf.queryExecution().toString()) < 10_000


def test_answers_beyond_the_bound_are_not_broadcast(spark, monkeypatch):
    pages = frame(spark, *((f"https://e.com/{k}", f"<h1>{k}") for k in range(200)), (None, "<h1>x"))
    urls = spark.createDataFrame([(f"https://e.com/{k}",) for k in range(150, 250)], "url string")
    few = sorted(map(tuple, L.batch_lookup(urls, pages).collect()))
    monkeypatch.setattr(L, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(L, "PLAN_BITS", 0)
    job = L.batch_lookup(urls, pages)
    assert sorted(map(tuple, job.collect())) == few
    assert "Broadcast" not in job._jdf.queryExecution().executedPlan().toString()
    assert L.fetch_and_extract(urls, pages, every_copy=True).count() == 100
