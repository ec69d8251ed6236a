"""Archives, top-k search, HTML rendering and the pipeline."""

import hashlib
import random
import re
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import nra_topk, queries, warc_revisit
from cohortlens.llm.html_layout import render, rendered
from cohortlens.session import scratch_path

BIG = "<p>équal payload</p>" * 10
PAGES = [(5, "http://a/5", BIG), (2, "http://a/2\r\nWARC-Type: evil", BIG), (9, None, BIG), (1, "u", "short"), (3, "u", "short"), (4, "u", None), (7, "u", ""), (8, "u", "x" * 99 + "\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", BIG), (6, "u", "é" * 50), (10, "u", "é" * 50), (11, "u", "y" * 99), (12, "u", "y" * 99)]


def archived(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"payload": F.lit(1), "first": F.lit("x")})
    path = scratch_path(spark, "warc-test")
    warc_revisit.write_archives(warc_revisit.resolved(pages), path)
    return path, warc_revisit.resolve_revisits(warc_revisit.read_archives(spark, path))


def test_archives_round_trip(spark):
    path, out = archived(spark, PAGES)
    got = {r["source_id"]: r for r in out.collect()}
    assert len(got) == len(PAGES)
    for page, _, html in PAGES:
        data, r = (html or "").encode(), got[page]
        equal = [p for p, _, h in PAGES if (h or "").encode() == data and p is not None]
        revisit = len(data) >= 100 and page != min(equal)
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", min(equal)) if revisit else ("response", None))
        assert r["payload"] == (None if revisit else html or "")
    assert got[2]["url"] == "http://a/2%0D%0AWARC-Type:%20evil"


def test_archives_empty(spark):
    assert archived(spark, [])[1].count() == 0


def brute_top(rows, k=5):
    good = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("n", [0, 1, 4, 700])
def test_top_k_against_brute_force(spark, n):
    r = random.Random(n)
    rows = [(i, [r.gauss(0, 0.2) if i % 7 else 0.25 for _ in range(16)]) for i in range(n)]
    rows += [(1001, None), (1002, [None] * 16), (1003, [float("nan")] * 16), (1004, [float("inf")] * 16), (1050, [0.0] * 16), (1100, [1.0, 2.0]), (1101, [3.0, -2.0]), (1150, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"id": F.lit(0), "q": F.lit("x"), "dims": F.lit(1)})
    got = nra_topk.top_k(df, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top([(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows if v != []])


def test_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(nra_topk, "SHARD", 64)
    monkeypatch.setattr(nra_topk, "BLOCK", 3)
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 0.1) for _ in range(8)]) for i in range(600)]
    got = nra_topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top([(i, [np.float32(x) for x in v]) for i, v in rows])


CASES = [
    (None, ""),
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>a<p>b", "a\n\nb"),
    ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("<ul><li>x<li>y<ol start=3><li>q<li>r</ol><li>z</ul>", "- x\n- y\n  3. q\n  4. r\n- z"),
    ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
    ("<table><tr><td>a<td>bbbb<td>x<tr><td>ccccc<td>d<td>y</table>", "a      bbbb  x\nccccc  d     y"),
    ("<table><td>1<td>2</table>", "1  2"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table><tr><th colspan=2>head<tr><td>aa<td>b</table>", "head\naa  b"),
    ("<table><tr><td><p>a<p>b</td><td>c</td></tr></table>", "a  c\n\nb"),
    ("a<span hidden>no</span><i style='display : none'>no</i><b style='visibility:hidden'>no<u style='visibility:visible'>yes</u></b>", "ayes"),
    ("<style>.x, #y{display:none} p.z{visibility:hidden}</style><p class='a x'>no<p id=y>no<p class=z>no<div class=z>yes</div>", "yes"),
    ("<head><title>no</title><script>if (a<b) '</p>'</script><p>yes", "yes"),
    ("x &amp; y &lt;z&gt; &eacute;&nbsp;.", "x & y <z> é\xa0."),
    ("<pre>\n a\n  b\n\nc</pre>d", " a\n  b\n\nc\n\nd"),
    ("<details><summary>s</summary>no</details><details open>yes</details>", "s\nyes"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("a < b <3 <!-- no --> c <a title='>'>d</a> <a title=\"never closed>e", "a < b <3 c d e"),
    ("<select><option>a<option selected>b</select><input value=v><input type=hidden value=no><textarea> k\nl</textarea>", None),
    ("<blockquote>q<blockquote>r</blockquote></blockquote>", "  q\n\n    r"),
    ("</p></div><td>loose</td><li>item", None),
    ("if <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding=tex>no</annotation></semantics></math> then<annotation>!</annotation>", "if x=1 then!"),
    ("<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable><mphantom>no</mphantom></math>", "1 2"),
    ("<map name=m><p>links<area href=x></map>", "links"),
    ("<select multiple><option>a<option selected>b<optgroup label=g><option>c</select>", "a\nb\ng\nc"),
    ("<select size=3><option>a<option>b</select><select size=1><option>c<option>no</select>", None),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_rendering(page, text):
    assert render(page) == text if text is not None else render(page)


CASCADE = [
    ("@media print{.x{display:none}}", "<p class=x>yes", "yes"),
    ("@media (max-width:600px){.x{display:none}} @media (min-width:600px){.y{display:none}}", "<p class=x>yes<p class=y>no", "yes"),
    ("@media screen and (400px<=width<=900px), print{.x{display:none}} @media not print{.y{display:none}}", "<p class=x>yes<p class=y>no", "yes"),
    ("@media screen{@media print{.x{display:none}} .y{display:none}}", "<p class=x>yes<p class=y>no", "yes"),
    (".tab{display:none} .active{display:block}", "<p class='tab active'>yes<p class=tab>no", "yes"),
    (".active{display:block} .tab{display:none}", "<p class='tab active'>no<p>yes", "yes"),
    (".tab.active{display:block} .tab{display:none}", "<p class='tab active'>yes<p class=tab>no", "yes"),
    ("#a{display:block} .x{display:none} p{display:none!important}", "<div id=a class=x>yes</div><p style='display:block'>no", "yes"),
    (".x{display:none}", "<p class=x style='display:block'>yes<p class=x style='color:red'>no", "yes"),
    (".x{display:none} .x{display:block}", "<p class=x>yes", "yes"),
    ("nav .x, ul > .x, h1 + .x{display:none}", "<nav><p><b class=x>no</b></p></nav><p class=x>a<h1>b</h1><p class=x>no<p class=x>c", "a\n\nb\n\nc"),
    (".x:not(.y){display:none} [data-a='1'] i:first-child{display:none} u:hover, u::before{display:none}", "<p class=x>no<p class='x y'>a<p data-a=1><i>no</i><i>b</i><u>c</u>", "a\n\nbc"),
    (".x{display:none; &.y{display:block} @media print{visibility:hidden}} .z{.y{display:none}}", "<p class='x y'>yes<p class=x>no<p class=z><b class=y>no</b>", "yes"),
    ("@layer a{.x{display:block}} .x{display:none} @supports (display:grid){.y{display:none}}", "<p class=x>no<p class=y>no<p>yes", "yes"),
    ("i::after{content:'}.x{display:none}'} .y{display:none", "<p class=x>yes<p class=y>no", "yes"),
    (".x{visibility:hidden} .x{visibility:inherit} .y{display:block}", "<p class=x>a<p hidden class=y>b<p hidden>no", "a\n\nb"),
]


@pytest.mark.parametrize(("css", "body", "text"), CASCADE)
def test_rendering_by_the_winning_rule(css, body, text):
    assert render(f"<style>{css}</style>{body}") == text


def test_list_boxes_show_all_options():
    assert render("<select size=3><option>a<option>b</select><select size=1><option>c<option>no</select>").split() == ["a", "b", "c"]


def test_style_of_other_media_and_odd_sheets():
    assert render("<style media=print>p{display:none}</style><template><style>p{display:none}</style></template><p>yes") == "yes"
    for css in ("a{" * 5000 + "display:none", "p:is(" * 3000, "((" * 5000 + "{display:none}", ".x:not({display:none}", "@media{" * 3000 + "p{display:none}", "> p{display:none}"):
        render(f"<style>{css}</style><p class=x>text")
    assert render("<style>div p{display:none}</style>" + "<div>" * 3000 + "<p>no</p>yes") == "yes"


def test_rendering_deep_and_long():
    assert render("<div>" * 50_000 + "deep") == "deep"
    assert render("<table><tr><td>" * 1500 + "x") == "x"
    assert render("<ul><li>" * 3000 + "x").strip(" -") == "x"
    assert len(render("word " * 300_000)) == 5 * 300_000 - 1
    assert render("<a '" * 50_000) == ""
    assert render("<table><tr><td>" + "w" * 100_000 + "<td>x" + "<tr><td>a<td>b" * 50 + "</table>").count("\n") == 50


class Visible(HTMLParser):
    """The words outside invisible elements, without layout."""

    def __init__(self):
        super().__init__()
        self.words, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("head", "script", "style"):
            self.hidden += 1

    def handle_endtag(self, tag):
        if tag in ("head", "script", "style"):
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def test_all_visible_words_of_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in pages.select("html", rendered(F.col("html")).alias("text")).collect():
        parser = Visible()
        parser.feed(r["html"])
        got = [w for line in r["text"].split("\n") for w in re.sub(r"^\s*(- |\d+\. )", "", line).split()]
        assert "".join(got) == "".join(parser.words)


def test_queries_and_twins():
    assert {re.match(r"op\d+", n)[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_duckdb(spark, name):
    from cohortlens.plans.compare import duckdb_connection

    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    cols = sorted(df.columns)
    twin = duckdb_connection("/root/testdata/sf0.001").sql(f"SELECT {', '.join(cols)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect()))) == sorted(map(str, twin))


@pytest.mark.parametrize("big", [1e8, 1e17])
def test_top_k_refuses_scores_beyond_64_bits(spark, big):
    df = spark.createDataFrame([(i, [big * (i + 1)] * 16) for i in range(3)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large for 64-bit scores"):
        nra_topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
