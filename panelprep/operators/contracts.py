"""Field contracts from dictionary pages.

The events of the standard HTML parser become flat element rows in one Arrow
pass: an element's tag, its parent, the end of its descendants and its text
pieces.  What tables, sections and code blocks are is said by Spark expressions
over these rows, as is what they mean.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from panelprep.functions.text import as_col, doc_id, doc_url, let, map_last_wins, meta_map, normalize_ws

# The wording of the dictionary pages.
SECTION_INPUT, SECTION_OUTPUT, SECTION_TABLE = "输入参数", "输出参数", "表信息"
META_API, META_WORDS = "接口", ("描述", "限量")
COL_NAME, COL_TYPE, COL_REQUIRED, COL_DEFAULT, COL_DESC = "名称", "类型", "必选", "默认显示", "描述"
REQUIRED_MARKS = ("Y", "YES", "TRUE", "1")
TABLE_NAME, TABLE_TITLE, TABLE_DESC = "表名", "表中文名", "说明"
META_SHOWN = ("描述", "限量", "更新", "数据更新频率", "数据更新时间", "积分")
# Example-code patterns and their points.
EXAMPLE_QUERY, EXAMPLE_CALL, EXAMPLE_API = "pro.query(", r"\bpro\.[a-zA-Z0-9_]+\(", "pro_api("

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(("script", "style", "template", "rt", "rp"))

# Plain markup, which every version of the standard parser reads alike; ``odd`` is the first character of anything else.
_SPACE, _NAME = r"[ \t\n\r\f]", r"[a-zA-Z][-.:a-zA-Z0-9_]*"
_ATTRIBUTE = rf"""{_SPACE}+({{0}}{_NAME})(?:{_SPACE}*={_SPACE}*({{0}}"[^"]*"|'[^']*'|[^\s"'<>=`][^\s"'<>`]*))?"""
_ATTRIBUTES = f"(?:{_ATTRIBUTE.format('?:')})*"
_WITH_TEXT_ONLY = "".join(rf"(?!(?i:{tag})\b(?![^<>]*>[^<]*</(?i:{tag}){_SPACE}*>))" for tag in ("title", "textarea"))
_TOKENS = re.compile(
    rf"(?P<text>[^<]+)|</(?P<close>{_NAME}){_SPACE}*>"
    rf"|<(?!(?i:script|style|xmp|iframe|noembed|noframes|noscript|plaintext)\b){_WITH_TEXT_ONLY}(?P<name>{_NAME})(?P<attributes>{_ATTRIBUTES}){_SPACE}*(?P<open>/?)>"
    rf"|<(?P<raw>(?i:script|style)){_ATTRIBUTES}{_SPACE}*>[^<]*(?:<(?!/\s*(?i:script|style)|!--)[^<]*)*</(?i:(?P=raw))>"
    r"|(?P<aside><!--(?!-?>)[^-]*(?:-(?!-)[^-]*)*-->|<!(?i:doctype)\b[^<>]*>)|(?P<odd><)")
_ATTRIBUTE_PARTS = re.compile(_ATTRIBUTE.format(""))

_ELEMENT = T.StructType([T.StructField(name, T.StringType() if name in ("tag", "classes") else T.IntegerType())
                         for name in ("no", "tag", "classes", "parent", "end", "text_from", "text_to")])
_ELEMENTS = T.StructType([T.StructField("elements", T.ArrayType(_ELEMENT)), T.StructField("pieces", T.ArrayType(T.StringType()))])


class _Events(HTMLParser):
    """Writes elements and text pieces of page after page to flat columns.

    Element ``i`` has the descendants ``i+1 .. end-1`` and the trimmed text pieces
    ``text_from .. text_to-1``.  A stray end tag is ignored, a skipped one is implied.
    Plain markup is cut by one regular expression, which takes a fraction of the
    parser's time; from the first odd character on, the parser reads the rest.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.columns: dict[str, list] = {name: [] for name in _ELEMENT.names}
        self.pieces: list[str] = []
        self.element_ends, self.piece_ends = [0], [0]

    def page(self, html: str) -> None:
        self.reset()
        self.first, self.first_piece = self.element_ends[-1], self.piece_ends[-1]
        self.open: list[int] = []
        self.open_tags: list[str] = []
        self.silent, self.joined = 0, False
        odd = self._plain(html)
        if odd is not None:
            self.feed(html[odd:])
            self.close()
        while self.open:
            self._end()
        self.pieces[self.first_piece :] = [piece.strip() for piece in self.pieces[self.first_piece :]]
        self.element_ends.append(len(self.columns["tag"]))
        self.piece_ends.append(len(self.pieces))

    def _plain(self, html: str) -> int | None:
        """Reads plain markup; where it ends, if it does."""
        for token in _TOKENS.finditer(html):
            kind = token.lastgroup
            if kind == "text":
                text = token[0]
                self.handle_data(unescape(text) if "&" in text else text)
            elif kind == "close":
                self.handle_endtag(token["close"].lower())
            elif kind == "open":
                tag, classes = token["name"].lower(), None
                if tag == "div":
                    for name, value in _ATTRIBUTE_PARTS.findall(token["attributes"]):
                        if name.lower() == "class":
                            classes = value[1:-1] if value[:1] in ("'", '"') else value or None
                    if classes and "&" in classes:
                        return token.start()
                self._start(tag, classes)
                if token["open"]:
                    self.handle_endtag(tag)
            elif kind == "raw":
                self._start(token["raw"].lower(), None)
                self._end()
            elif kind == "aside":
                self.joined = False
            else:
                return token.start()
        return None

    def handle_starttag(self, tag, attrs):
        self._start(tag, dict(attrs).get("class") if tag == "div" else None)

    def _start(self, tag: str, classes: str | None) -> None:
        column, at, piece = self.columns, len(self.columns["tag"]) - self.first, len(self.pieces) - self.first_piece
        column["no"].append(at)
        column["tag"].append(tag)
        column["classes"].append(classes)
        column["parent"].append(self.open[-1] if self.open else -1)
        column["end"].append(at + 1)
        column["text_from"].append(piece)
        column["text_to"].append(piece)
        if tag not in _VOID:
            self.open.append(at)
            self.open_tags.append(tag)
            self.silent += tag in _SILENT
        self.joined = False

    def _end(self) -> str:
        at, tag = self.open.pop(), self.open_tags.pop()
        self.columns["end"][self.first + at] = len(self.columns["tag"]) - self.first
        self.columns["text_to"][self.first + at] = len(self.pieces) - self.first_piece
        self.silent -= tag in _SILENT
        return tag

    def handle_endtag(self, tag):
        if tag in self.open_tags:
            while self._end() != tag:
                pass
        self.joined = False

    def handle_data(self, data):
        if not self.silent:
            if self.joined:
                self.pieces[-1] += data
            else:
                self.pieces.append(data)
            self.joined = True

    def handle_comment(self, data):
        self.joined = False

    handle_decl = handle_pi = unknown_decl = handle_comment


@F.arrow_udf(_ELEMENTS)
def _read_elements(html: pa.Array) -> pa.Array:
    events = _Events()
    for page in html.to_pylist():
        events.page(page or "")
    kinds = to_arrow_type(_ELEMENT)
    flat = pa.StructArray.from_arrays([pa.array(events.columns[f.name], f.type) for f in kinds], fields=list(kinds))
    lists = [pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), values)
             for ends, values in ((events.element_ends, flat), (events.piece_ends, pa.array(events.pieces, pa.string())))]
    return pa.StructArray.from_arrays(lists, names=["elements", "pieces"])


# A filter on the result would else be pushed below it and parse every page twice.
_read_elements = _read_elements.asNondeterministic()


def page_elements(pages: DataFrame, page_id: str = "page_id", html_col: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """The one Python pass: ``page_id, keep…, elements, pieces``; a null page has none.

    Pages are dealt to ``spark.sql.shuffle.partitions`` tasks before it.  Parsing a
    page costs many times what moving it does, and pages pack so well that partitions
    sized by their bytes would leave the parsing of a table to very few tasks.
    """
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pages.select(page_id, *keep, html_col).repartition(tasks, F.xxhash64(F.monotonically_increasing_id()))
    return dealt.select(page_id, *keep, _read_elements(html_col).alias("_read")).select(page_id, *keep, "_read.elements", "_read.pieces")


def _inside(element: Column) -> Column:
    """An element's descendants, in document order."""
    return F.slice("elements", element["no"] + 2, element["end"] - element["no"] - 1)


def _tagged(elements: Column, *tags: str) -> Column:
    return F.filter(elements, lambda e: e["tag"].isin(*tags))


def _text(element: Column, sep: str) -> Column:
    """The element's text pieces that aren't blank, joined."""
    pieces = F.slice("pieces", element["text_from"] + 1, element["text_to"] - element["text_from"])
    return F.array_join(F.filter(pieces, lambda p: p != ""), sep)


def _cells(row: Column, *tags: str) -> Column:
    return F.transform(_tagged(_inside(row), *tags), lambda c: normalize_ws(_text(c, " ")))


def _table(table: Column) -> Column:
    """Header cells and body rows: ``thead`` names the header, else the first row."""
    def of(found: Column) -> Column:
        rows, head, body = found["rows"], F.get(found["heads"], F.lit(0)), F.get(found["bodies"], F.lit(0))
        first = F.get(rows, F.lit(0))
        headers = F.when(head.isNotNull(), _cells(head, "th", "td")).when(first.isNotNull(), _cells(first, "th", "td")).otherwise(F.array().cast("array<string>"))
        later = F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))
        own = F.filter(_tagged(_inside(body), "tr"), lambda r: r["parent"] == body["no"])
        filled = F.transform(F.when(head.isNotNull() & body.isNotNull(), own).otherwise(later), lambda r: _cells(r, "td", "th"))
        return F.struct(headers.alias("headers"), F.filter(filled, lambda r: F.exists(r, lambda c: c != "")).alias("rows"))

    within = _inside(table)
    return let(F.struct(*(_tagged(within, tag).alias(name) for tag, name in (("tr", "rows"), ("thead", "heads"), ("tbody", "bodies")))), of)


def _next_table(element: Column) -> Column:
    """Number of the sibling table that follows, unless a paragraph or heading comes first."""
    up = F.get("elements", element["parent"])
    stop = F.when(element["parent"] >= 0, up["end"]).otherwise(F.size("elements"))
    later = F.filter(F.slice("elements", element["end"] + 1, stop - element["end"]), lambda e: (e["parent"] == element["parent"]) & e["tag"].isin("table", "p", "h2", "h3"))
    return let(F.get(later, F.lit(0)), lambda e: F.when(e["tag"] == "table", e["no"]))


def page_parts(pages: DataFrame, page_id: str = "page_id", html_col: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """Plain parts of each page: ``page_id, keep…, has_content, title, paragraphs, tables, code``.

    ``paragraphs`` are those of the first container with the class ``content``, with
    their text, whether they're its children, and the place in ``tables`` of the
    table that directly follows; ``tables`` are all of the page.
    """
    read = page_elements(pages, page_id, html_col, keep)
    is_content = lambda e: (e["tag"] == "div") & F.array_contains(F.split(e["classes"], r"\s+"), "content")
    staged = read.select("*", F.get(F.filter("elements", is_content), F.lit(0)).alias("_content"), _tagged(F.col("elements"), "table").alias("_tables"))
    content = F.col("_content")
    staged = staged.withColumn("_held", F.when(content.isNotNull(), _tagged(_inside(content), "h2", "p", "pre")))
    held = lambda tag: F.filter("_held", lambda e: e["tag"] == tag)
    heading = F.get(held("h2"), F.lit(0))
    numbers = F.transform("_tables", lambda t: t["no"])
    paragraphs = F.transform(held("p"), lambda p: F.struct(
        _text(p, "\n").alias("text"), (p["parent"] == content["no"]).alias("direct"),
        (F.array_position(numbers, _next_table(p)) - 1).cast("int").alias("table")))
    blocks = F.transform(held("pre"), lambda b: _text(b, "\n"))
    nothing = F.array().cast("array<string>")
    title = F.when(content.isNotNull(), F.coalesce(normalize_ws(_text(heading, " ")), F.lit("")))
    return staged.select(
        page_id, *keep, content.isNotNull().alias("has_content"), title.alias("title"),
        F.coalesce(paragraphs, F.array().cast("array<struct<text: string, direct: boolean, table: int>>")).alias("paragraphs"),
        F.transform("_tables", _table).alias("tables"),
        F.coalesce(F.filter(blocks, lambda c: c != ""), nothing).alias("code"))


def _named_rows(table: Column) -> Column:
    """Rows as maps from header to cell: ``column_{i}`` for a cell that has no header."""
    def of(t: Column) -> Column:
        def named(row: Column) -> Column:
            return map_last_wins(F.transform(row, lambda cell, i: F.struct(
                F.coalesce(F.nullif(F.get(t["headers"], i), F.lit("")),
                           F.concat(F.lit("column_"), i + 1)).alias("key"),
                cell.alias("value"))))

        return F.transform(t["rows"], named)

    return let(table, of)


def page_tables(parts: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Every table of every page: ``(page_id, table_no, headers, rows)``."""
    each = parts.select(page_id, F.posexplode("tables").alias("_pos", "_table"))
    return each.select(
        page_id, (F.col("_pos") + 1).alias("table_no"), F.col("_table.headers").alias("headers"),
        _named_rows(F.col("_table")).alias("rows"))


def _section(title: str) -> Column:
    """Rows of the first table that directly follows a paragraph of this title, or NULL."""
    hit = F.filter("paragraphs", lambda p: p["table"].isNotNull() & (normalize_ws(p["text"]) == title))
    return _named_rows(F.get("tables", F.get(hit, F.lit(0))["table"]))


def page_sections(
    parts: DataFrame, titles: Sequence[str] = (SECTION_INPUT, SECTION_OUTPUT, SECTION_TABLE), page_id: str = "page_id"
) -> DataFrame:
    """Titled table sections ``(page_id, section, rows)``; untitled tables are left out."""
    sections = F.array(*[F.struct(F.lit(t).alias("section"), _section(t).alias("rows")) for t in titles])
    return parts.select(page_id, F.inline(sections)).where(F.col("rows").isNotNull())


def _ranked_code() -> Column:
    def score(code: Column) -> Column:
        names_api = F.contains(code, F.lit("pro_api"))
        return (
            F.when(F.contains(code, F.lit(EXAMPLE_QUERY)), 3).otherwise(0)
            + F.when(code.rlike(EXAMPLE_CALL) & ~names_api, 2).otherwise(0)
            + F.when(F.contains(code, F.lit(EXAMPLE_API)), 1).otherwise(0)
        )

    # Best score first, then position: sorting (-score, position) ascending.
    return F.array_sort(F.transform("code", lambda c, i: F.struct(
        (-score(c)).alias("neg"), i.alias("pos"), c.alias("code"))))


def code_examples(parts: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Code blocks ranked by how much they look like a query: ``(page_id, rank, score, pos, code)``."""
    each = parts.select(page_id, F.posexplode(_ranked_code()).alias("_rank", "_e"))
    return each.select(
        page_id, (F.col("_rank") + 1).alias("rank"), (-F.col("_e.neg")).alias("score"),
        (F.col("_e.pos") + 1).alias("pos"), F.col("_e.code").alias("code"))


def contracts(
    pages: DataFrame, root: str = "", page_id: str = "page_id", html_col: str = "html", target: str = "url"
) -> DataFrame:
    """One contract per page; a page without content gives an ``error`` row and the job goes on.

    ``target`` is a page id or URL, as in ``doc_id`` and ``doc_url``.
    """
    parts = page_parts(pages, page_id, html_col, keep=[c for c in (target,) if c != page_id])
    is_meta = lambda p: F.contains(p["text"], F.lit(META_API)) & (
        F.contains(p["text"], F.lit(META_WORDS[0])) | F.contains(p["text"], F.lit(META_WORDS[1])))
    direct = F.get(F.filter("paragraphs", lambda p: is_meta(p) & p["direct"]), F.lit(0))
    anywhere = F.get(F.filter("paragraphs", is_meta), F.lit(0))
    empty_rows = F.array().cast("array<map<string,string>>")
    meta_text = F.coalesce(direct["text"], anywhere["text"]).alias("_meta_text")
    staged = parts.select("*", meta_text).select(
        page_id, as_col(target).cast("string").alias("_target"),
        F.when(~F.col("has_content"), "no content container").alias("error"),
        "title",
        F.coalesce(meta_map("_meta_text"), F.create_map().cast("map<string,string>")).alias("meta"),
        F.coalesce(_section(SECTION_INPUT), empty_rows).alias("input_params"),
        F.coalesce(_section(SECTION_OUTPUT), empty_rows).alias("output_params"),
        _section(SECTION_TABLE).alias("table_info"),
        F.transform(_ranked_code(), lambda e: e["code"]).alias("examples"),
    )
    is_required = lambda row: F.coalesce(F.upper(row[COL_REQUIRED]).isin(*REQUIRED_MARKS), F.lit(False))
    names = F.transform("output_params", lambda row: row[COL_NAME])
    return staged.select(
        page_id, doc_id("_target").alias("doc_id"), doc_url("_target", root).alias("url"), "title",
        F.coalesce(F.col("meta")[META_API], F.lit("")).alias("api_name"), "meta",
        F.filter("input_params", is_required).alias("required_params"),
        F.filter("input_params", lambda row: ~is_required(row)).alias("optional_params"),
        "input_params", "output_params",
        F.filter(names, lambda n: n.isNotNull() & (n != "")).alias("output_fields"),
        "examples", "table_info", "error",
    )


def _param_line(row: Column, show_default: bool) -> Column:
    def tagged(label: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(label), value))

    bits = [F.coalesce(row[COL_NAME], F.lit("<unknown>")), tagged("type=", row[COL_TYPE])]
    if show_default:
        bits.append(tagged("default=", row[COL_DEFAULT]))
    bits.append(tagged("", row[COL_DESC]))
    return F.concat(F.lit(" - "), F.concat_ws(" | ", *bits))


def contract_text(contracts_df: DataFrame, example_limit: int = 3, name: str = "contract_text") -> DataFrame:
    """Adds the contract as text, in a fixed order of headings; null for a page that gave none."""
    def one(label: str, value: Column) -> Column:
        return F.when(F.coalesce(value, F.lit("")) != "", F.array(F.concat(F.lit(label), value)))

    def counted(heading: str, rows: str, show_default: bool = False) -> Column:
        return F.concat(
            F.array(F.lit(""), F.concat(F.lit(f"{heading} ("), F.size(rows).cast("string"), F.lit(")"))),
            F.transform(rows, lambda row: _param_line(row, show_default)))

    table_lines = F.transform("table_info", lambda row: F.concat(F.lit(" - "), F.concat_ws(
        " | ", *[F.nullif(row[c], F.lit("")) for c in (TABLE_TITLE, TABLE_NAME, TABLE_DESC)])))
    shown = F.slice("examples", 1, example_limit) if example_limit > 0 else F.array().cast("array<string>")
    fence = F.lit("```")
    blocks = [
        F.array(F.concat(F.lit("Title: "), F.coalesce("title", F.lit("")))),
        one("Doc ID: ", F.col("doc_id")),
        F.array(F.concat(F.lit("URL: "), F.col("url"))),
        one("API: ", F.col("api_name")),
        *[one(f"{key}: ", F.col("meta")[key]) for key in META_SHOWN],
        counted("Required Params", "required_params"),
        counted("Optional Params", "optional_params"),
        counted("Output Fields", "output_params", show_default=True),
        F.when(F.size("table_info") > 0, F.concat(F.array(F.lit(""), F.lit("Table Info")), table_lines)),
        F.when(F.size("examples") > 0, F.concat(
            F.array(F.lit(""), F.concat(F.lit("Examples ("), F.size(shown).cast("string"), F.lit(")"))),
            F.flatten(F.transform(shown, lambda e: F.array(fence, e, fence))))),
    ]
    none = F.array().cast("array<string>")
    text = F.array_join(F.concat(*[F.coalesce(b, none) for b in blocks]), "\n")
    return contracts_df.withColumn(name, F.when(F.col("error").isNull(), text))


def undocumented_fields(contracts_df: DataFrame) -> DataFrame:
    """Per API: output fields with no description, to be asked for in the source dictionary.

    A page that gave no contract keeps its row, with its ``error`` and nulls.
    """
    blank = F.filter("output_params", lambda r: F.coalesce(r[COL_DESC], F.lit("")) == "")
    n, total = F.size(blank), F.size("output_params")
    good = F.col("error").isNull()
    ask = F.transform(blank, lambda r: F.coalesce(r[COL_NAME], F.lit("<unknown>")))
    return contracts_df.select(
        "api_name", "doc_id", F.when(good, ask).alias("ask_for"), F.when(good, n).alias("undocumented"),
        F.when(good, total).alias("n_fields"), F.when(good, F.try_divide(n, total)).alias("undocumented_ratio"), "error")


def similar_contracts(contracts_df: DataFrame, wanted_fields: Sequence[str], k: int | None = None) -> DataFrame:
    """APIs ranked: most wanted fields covered first, then fewest required filters.

    Those that cover none come after, pages that gave no contract last, with their ``error``.
    Without ``k`` this is a distributed sort; with it, a top-k.
    """
    wanted = F.array(*[F.lit(w) for w in dict.fromkeys(wanted_fields)]).cast("array<string>")
    good = F.col("error").isNull()
    scored = contracts_df.select(
        "api_name", "doc_id",
        F.when(good, F.size(F.array_intersect(wanted, "output_fields"))).alias("covered"),
        F.when(good, F.array_except(wanted, "output_fields")).alias("lacking"),
        F.when(good, F.size("required_params")).alias("required_filters"), "error")
    # A sort reads its rows twice, first for its ranges: both times from an exchange of these narrow rows, so pages are parsed once.
    ranked = scored.hint("rebalance").orderBy(
        F.col("covered").desc_nulls_last(), F.col("required_filters"), F.col("api_name"), F.col("doc_id"))
    return ranked.limit(k) if k is not None else ranked


# Parameter names that bound a range, lower case.
RANGE_PARAMS = (
    ("start_date", "end_date"), ("start_dt", "end_dt"), ("start_end_date", "stop_end_date"),
)
# Output columns that make a table a time series, lower case.
DATE_FIELDS = ("trade_date", "trade_dt", "date", "ann_dt", "ann_date", "report_period", "end_date")


def choose_scan_mode(contracts_df: DataFrame, range_params=RANGE_PARAMS, date_fields=DATE_FIELDS) -> DataFrame:
    """``interval`` when the API takes a range, else ``split``.

    A time-series table without range parameters also gets
    ``recommend_range_params``.  A page that gave no contract has its ``error`` and
    no mode.
    """
    names = F.transform("input_params", lambda r: F.lower(r[COL_NAME]))
    ranged = F.lit(False)
    for lo, hi in range_params:
        ranged = ranged | (F.array_contains("_names", lo) & F.array_contains("_names", hi))
    series = F.exists("output_fields", lambda f: F.lower(f).isin(*date_fields))
    good = F.col("error").isNull()
    return contracts_df.withColumn("_names", names).select(
        "api_name", "doc_id", F.when(good, F.when(ranged, "interval").otherwise("split")).alias("scan_mode"),
        F.when(good, series & ~ranged).alias("recommend_range_params"), "error")
