from __future__ import annotations

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from panelprep.operators import contracts as ct, pages as pg


def pages(spark, *docs):
    return spark.createDataFrame([(i, f"https://x.org/a/{i}", h) for i, h in enumerate(docs)], "page_id int, url string, html string")


def test_links(spark, rows):
    df = pages(spark, '<a href="/d?doc_id=1">A &amp; B</a><a href="b"> </a><a href="c">C</a><a  href="d">D</a>'
                      '<a href="/d?doc_id=1">A &amp; B </a><a href="c"><b>E</b></a>', '<a href="https://y.org/c">C</a>', None, "")
    assert rows(pg.page_links(df)) == [
        (0, 0, "A & B", "https://x.org/d?doc_id=1"), (0, 2, "C", "https://x.org/a/c"), (1, 0, "C", "https://y.org/c")]
    assert rows(pg.page_links(df, "https://y.org/"), "title", "url")[1] == ("C", "https://y.org/c")
    assert rows(pg.page_links(df, "https://y.org/", scope="corpus"), "page_id", "title") == [(0, "A & B"), (0, "C")]
    with pytest.raises(ValueError):
        pg.page_links(df, scope="site")


def test_search(spark, rows):
    links = spark.createDataFrame([("A股日行情",), ("Fund (daily)",), ("ETF daily",)], "title string")
    assert rows(pg.search_titles(links, "a股|etf")) == [("A股日行情",), ("ETF daily",)]
    assert rows(pg.search_titles(links, "FUND (")) == [("Fund (daily)",)]
    assert rows(pg.search_titles(links, "(?P<x>d)aily$")) == [("ETF daily",)]


PAGE = """<html><head><STYLE a="b">p{}</style><script>var t="</p>";</script></head><body><h1>T&amp;C</h1>
<p>one<br/>two&nbsp; three<hr class=x>
<ul><li>a<li> b</ul><div></div><div></div><div></div><div></div><table><tr><td> x </td><th></th><td>y&lt;1</td></tr></table>
<noscript><p>no</p></noscript>end</body>"""


def test_html_to_text(spark):
    text = pg.html_to_text(pages(spark, PAGE, "", "   ")).orderBy("page_id").collect()
    assert text[0]["text"] == ("T&C\n\none\ntwo three\n" + "-" * 40 + "\n\n\n- a\n- b\n\n\nx\ty<1\n\n\nend\n")
    assert text[1]["text"] == "\n" and text[2]["text"] == "\n"


@pytest.mark.parametrize("pattern, context", [("b", 0), ("b", 1), ("^a|e$", 2), ("x", 100), (r"\bé", 1), ("nothing", 3)])
def test_grep_against_loops(spark, pattern, context):
    docs = [(1, "abc\nb\n\nc\nd\ne\nb"), (2, "x"), (3, ""), (4, "d é\néa\nq\nq\nq\nq\nbe\r\nb"), (5, "\n".join("abcdefgh" * 9))]
    out = pg.grep(spark.createDataFrame(docs, "doc_id int, text string"), pattern, context).collect()
    want = []
    for doc, text in docs:
        found = text.splitlines()
        hits = [i for i, x in enumerate(found) if re.search(pattern, x)]
        shown = sorted({j for i in hits for j in range(max(0, i - context), min(len(found), i + context + 1))})
        for n, j in enumerate(shown):
            want.append((doc, j + 1, found[j], j in hits, n > 0 and j != shown[n - 1] + 1))
    assert sorted(tuple(r) for r in out) == want


def test_grep_arguments(spark, rows):
    docs = spark.createDataFrame([(1, "a\nb\nc")], "doc_id int, text string")
    assert rows(pg.grep(docs, "b", 1).select(pg.grep_text(docs))) == [("1-a",), ("2:b",), ("3-c",)]
    for bad in ("(", "a**"):
        with pytest.raises(ValueError):
            pg.grep(docs, bad)
    with pytest.raises(ValueError):
        pg.grep(docs, "a", -1)


def test_lines(spark, rows):
    docs = spark.createDataFrame([(1, "a\n\nb\n"), (2, "")], "doc_id int, text string")
    numbered = pg.lines(docs, "doc_id")
    assert rows(numbered) == [(1, 1, "a"), (1, 2, ""), (1, 3, "b")]
    assert rows(pg.line_window(numbered, "2:9"), "line") == [("",), ("b",)]
    assert rows(pg.line_window(numbered, 1, 1), "line") == [("a",)]
    for bad in ("0:3", "3:2", "x", "1:", "-1:2"):
        with pytest.raises(ValueError):
            pg.line_window(numbered, bad)


CONTRACT = """<body><div class='nav'><h2>nav</h2></div><DIV class="x content"><h2> A股 <b>日行情</b>
</h2><div><p>接口：nested, 描述: no</p></div><p>intro</p><p>接口：daily<br>描述：quotes &amp; more<br>限量：单次最大5,000行</p>
<p>输入参数</p><p>not a table</p>
<p>输入参数</p><span>skip</span><table><thead><tr><th>名称</th><th>类型</th><th></th><th>必选</th><th>描述</th></tr></thead>
<tbody><tr><td>ts_code</td><td>str</td><td>z</td><td>y</td><td>the <i>code</i></td></tr><tr><td> </td><td></td></tr></tbody>
<tbody><tr><td>hidden</td></tr></tbody></table>
<p>输入参数</p><table><tr><td>again</td></tr></table>
<p><b>输出参数</b></p><table><tr><th>名称</th><th>名称</th><th>描述</th></tr><tr><td>a</td><td>open</td><td></td><td>more</td></tr>
<tr><td>b</td><td></td><td>x</td></tr></table><pre>plain</pre><pre>pro.daily(x)</pre><pre>pro_api()
pro.query('daily')</pre><pre>  </pre></div></body>"""


def test_contract(spark):
    df = pages(spark, CONTRACT, "<p>输入参数</p>", None)
    out = ct.contracts(df.withColumn("url", F.when(F.col("page_id") == 0, "10303").otherwise(F.col("url"))), "https://r").orderBy("page_id").collect()
    c = out[0]
    assert (c["doc_id"], c["url"], c["title"], c["api_name"]) == ("10303", "https://r?doc_id=10303", "A股 日行情", "daily")
    assert c["meta"] == {"接口": "daily", "描述": "quotes & more", "限量": "单次最大5,000行"}
    assert c["required_params"] == [{"名称": "ts_code", "类型": "str", "column_3": "z", "必选": "y", "描述": "the code"}]
    assert c["optional_params"] == [] and c["input_params"] == c["required_params"]
    assert c["output_params"] == [{"名称": "open", "描述": "", "column_4": "more"}, {"名称": "", "描述": "x"}]
    assert c["output_fields"] == ["open"] and c["table_info"] is None and c["error"] is None
    assert c["examples"] == ["pro_api()\npro.query('daily')", "pro.daily(x)", "plain"]
    assert [r["error"] for r in out[1:]] == ["no content container"] * 2


def test_contract_text(spark):
    text = ct.contract_text(ct.contracts(pages(spark, CONTRACT)), 1).first()["contract_text"]
    assert text == "\n".join([
        "Title: A股 日行情", "URL: https://x.org/a/0", "API: daily", "描述: quotes & more", "限量: 单次最大5,000行", "",
        "Required Params (1)", " - ts_code | type=str | the code", "", "Optional Params (0)", "", "Output Fields (2)",
        " - open", " -  | x", "", "Examples (1)", "```", "pro_api()", "pro.query('daily')", "```"])


def test_meta_falls_back_to_nested_paragraph(spark):
    page = "<div class=content><div><p>接口: w<br>限量: 1</p></div><p>接口 only</p></div>"
    c = ct.contracts(pages(spark, page)).first()
    assert c["api_name"] == "w" and c["title"] == "" and c["examples"] == []


BITS = (
    "<div>", "</div>", "<div class=", "'a b'", '"content x"', ">", "/>", "<", "&amp;", "&lt", "&", "<br/>", "<br />", "<script>", "</script>", "</ script>",
    "<SCRIPT src='x'>", "<style>", "</STYLE >", "<!--", "-->", "--", "-", "<!doctype html>", "<!DOCTYPE", "<?php ?>", "<![CDATA[", "]]>", "<title>", "</title>",
    "<textarea>", "</textarea>", "<p", "<p>", "</p>", "</p ", "a", "b c", "\n", "\x0b", "\xa0", "=", "/", "'", '"', "<a href=x/>", "<img src='x' alt=\"y>\" />",
    "<div CLASS=Z class=y>", "<div class>", "<div class=''>", "<div class='a&amp;b'>", "</>", "</ p>", "<1", "<my-el:a.b>", "</my-el:a.b>", "<é>", "<rt>", "</rt>",
    "<!x>", "<iframe>", "</iframe>", "<div a='1'b='2'>", "<div class = content >", "<p/ >", "<div / class=x>", "<div class=a`b>")


def test_plain_markup_is_read_as_the_parser_reads_it():
    class Standard(ct._Events):
        def _plain(self, html):
            return 0

    class Plain(ct._Events):
        def feed(self, data):
            raise AssertionError(f"the parser was needed for {data!r}")

    def read(kind, page):
        events = kind()
        try:
            events.page(page)
        except AssertionError as e:  # the standard parser's own, for broken marked sections
            return str(e)
        return events.columns, events.pieces

    draw = random.Random(7)
    for _ in range(20000):
        page = "".join(draw.choice(BITS) for _ in range(draw.randint(1, 12)))
        assert read(ct._Events, page) == read(Standard, page), page
    for page in (CONTRACT, "<!DOCTYPE html><html><head><title>a &amp; b</title><script>if (a < b) {}</script><STYLE>p{}</STYLE></head><body><!-- c - d -->"
                 "<div class='x content' id=y><img src=\"a>b\" /><a href=/q?a=1&b=2>t</a><br></div></body></html>"):
        assert read(Plain, page) == read(Standard, page)


def test_tables_of_bad_markup(spark, rows):
    page = """<table></table><table><tr><td>h<!-- c -->1<td>h2<tr><td>v1</td><td>v2</table>
    <table><thead><tr><td>k</td></tr></thead><tr><td>1</td></tr><tr><td>2</td></tr></table><script><table></script>"""
    out = ct.page_tables(ct.page_parts(pages(spark, page))).orderBy("table_no").collect()
    # Unclosed cells and rows nest, as they do for a parser that implies no end tags.
    outer, inner = "h 1 h2 v1 v2", "h2 v1 v2"
    assert [r["headers"] for r in out] == [[], [outer, inner, "v1", "v2"], ["k"]]
    assert [r["rows"] for r in out] == [[], [{outer: "v1", inner: "v2"}], [{"k": "1"}, {"k": "2"}]]


def test_sections_and_examples(spark, rows):
    parts = ct.page_parts(pages(spark, CONTRACT))
    assert rows(ct.page_sections(parts).select("section", F.size("rows"))) == [("输入参数", 1), ("输出参数", 2)]
    assert rows(ct.code_examples(parts), "rank", "score", "pos") == [(1, 4, 3), (2, 2, 2), (3, 0, 1)]


def test_undocumented_similar_mode(spark, rows):
    c = ct.contracts(pages(spark, CONTRACT, "<p>x</p>"))
    assert rows(ct.undocumented_fields(c), "api_name", "ask_for", "undocumented", "undocumented_ratio") == [
        ("", None, None, None), ("daily", ["open"], 1, 0.5)]
    made = spark.createDataFrame([
        ("one", "1", [{"名称": "code"}], ["open", "close"], [], None), ("two", "2", [{"名称": "a"}, {"名称": "b"}], ["open", "close"], [], None),
        ("three", "3", [], ["open"], [{"名称": "START_DT"}, {"名称": "end_dt"}], None), ("none", "4", [], ["x"], [{"名称": "start_date"}], None),
        ("bad", "5", [], ["open"], [], "broken"), ("series", "6", [], ["Trade_Date"], [{"名称": "code"}], None)],
        "api_name string, doc_id string, required_params array<map<string,string>>, output_fields array<string>, "
        "input_params array<map<string,string>>, error string")
    ranked = ct.similar_contracts(made, ["close", "open", "open"]).collect()
    assert [(r["api_name"], r["covered"], r["lacking"]) for r in ranked] == [
        ("one", 2, []), ("two", 2, []), ("three", 1, ["close"]), ("none", 0, ["close", "open"]), ("series", 0, ["close", "open"]), ("bad", None, None)]
    assert [r["api_name"] for r in ct.similar_contracts(made, ["open"], 2).collect()] == ["three", "one"]
    assert rows(ct.choose_scan_mode(made), "api_name", "scan_mode", "recommend_range_params") == [
        ("bad", None, None), ("none", "split", False), ("one", "split", False), ("series", "split", True), ("three", "interval", False), ("two", "split", False)]


def test_unescape_matches_python(spark):
    raw = "a&amp;b &lt; &#20013; &notanentity; &nbsp;x"
    got = spark.createDataFrame([(raw,)], "v string").select(pg.unescape("v").alias("r")).first()["r"]
    assert got == html.unescape(raw).replace("\xa0", " ")
