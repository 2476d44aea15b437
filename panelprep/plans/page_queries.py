"""Pages, contracts and notes over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelprep.operators import contracts as ct, notes as nt, pages as pg, quality
from panelprep.plans.oracle_parts import WS
from panelprep.plans.tables import table

DOC_ROOT = "https://docs.example.org/document/2"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def page_links_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.page_links(_pages(spark, sf_dir), DOC_ROOT)


def page_links_corpus_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.page_links(_pages(spark, sf_dir), DOC_ROOT, scope="corpus")


def search_titles_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.search_titles(page_links_query(spark, sf_dir), "^TH|tion$")


def search_titles_literal_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # "(TH" is no regular expression, so it's looked for as it stands.
    links = page_links_query(spark, sf_dir).withColumn("title", F.concat(F.lit("x ("), "title", F.lit(")")))
    return pg.search_titles(links, "(TH")


def html_to_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.html_to_text(_pages(spark, sf_dir)).select("page_id", "text")


def lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.lines(_documents(spark, sf_dir), "doc_id")


def line_window_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.line_window(lines_query(spark, sf_dir), "3:5")


def grep_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.grep(_documents(spark, sf_dir), r"tion\b", 1)


def dictionary_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary page per part, with what the extractor has to cope with.

    Every size-7 part's page has no content container; pages differ in header
    style, missing descriptions, range parameters and code blocks.
    """
    part = table(spark, sf_dir, "part").withColumn("id", F.col("p_partkey").cast("string"))

    def row(*cells: str) -> str:
        return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"

    head = "<thead><tr><th>名称</th><th> 类型</th><th>必选 </th><th>描述</th></tr></thead>"
    required = F.when(F.col("p_size") % 2 == 0, "y").otherwise("N")
    ranged = F.when(F.col("p_size") % 3 == 0, row("START_DATE", "str", "N", "from") + row("end_date", "str", "", "to")).otherwise("")
    inputs = F.concat(
        F.lit("<p><strong>输入参数</strong></p>\n<table>" + head + "<tbody><tr><td>ts_code</td><td>str</td><td>"), required,
        F.lit("</td><td>code &amp; market</td></tr>"), ranged, F.lit(row("", "", "", "") + "</tbody></table>"))
    describe = F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_type"))
    outputs = F.concat(
        F.lit("<p>输出参数</p><div>note</div><table><tr><td>名称</td><td>类型</td><td>默认显示</td><td>描述</td></tr>"
              + row("trade_date", "str", "Y", "day") + "<tr><td>brand</td><td>str</td><td>Y</td><td>"), describe,
        F.lit("</td><td>extra</td></tr>"), F.lit(row("", "float", "N", "unnamed") + "</table>"))
    info = F.when(F.col("p_size") % 4 == 0, F.concat(
        F.lit("<p>表信息</p><table><tr><th>表名</th><th>表中文名</th><th>说明</th></tr><tr><td>t_"), "id",
        F.lit("</td><td>零件</td><td></td></tr></table>"))).otherwise(F.lit("<p>表信息</p><p>none</p><table></table>"))
    code = F.concat(
        F.lit("<pre>print(1)</pre><pre><code>pro = pro_api()\npro.query('part_"), "id",
        F.lit("')</code></pre><pre>pro.part_"), "id", F.lit("(x)</pre><pre> </pre>"))
    css = F.when(F.col("p_size") == 7, "other").otherwise("doc content wide")
    html = F.concat(
        F.lit("<html><body><div class='menu'><a href=\"/x\">x</a><h2>menu</h2></div><div class='"), css, F.lit("'><h2> Part\n"),
        "p_name", F.lit("</h2><section><p>接口 first, no meta words</p></section><p>接口：part_"), "id", F.lit("<br>描述: "), "p_type",
        F.lit("<br/>限量：单次最大"), F.col("p_size").cast("string"), F.lit(",000行</p>"), inputs, outputs, info, code,
        F.lit("</div></body></html>"))
    return part.select(F.col("p_partkey").alias("page_id"), F.col("id").alias("target"), html.alias("html"))


def _contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ct.contracts(dictionary_pages(spark, sf_dir), DOC_ROOT, target="target")


def page_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ct.page_parts(dictionary_pages(spark, sf_dir))
    cells = ct.page_tables(parts).select(
        "page_id", F.col("table_no").cast("long").alias("table_no"), F.size("headers").cast("long").alias("n_headers"),
        F.posexplode_outer("rows").alias("row_no", "row")).where(F.col("row_no").isNotNull())
    # A plain explode would put a filter on the size of "rows" below it, for which Spark makes them twice.
    return cells.select("page_id", "table_no", "n_headers", F.col("row_no").cast("long").alias("row_no"),
                        F.explode("row").alias("key", "value"))


def page_sections_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ct.page_parts(dictionary_pages(spark, sf_dir))
    return ct.page_sections(parts).select("page_id", "section", F.size("rows").cast("long").alias("n_rows"))


def code_examples_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ct.code_examples(ct.page_parts(dictionary_pages(spark, sf_dir)))
    return out.select("page_id", *[F.col(c).cast("long").alias(c) for c in ("rank", "score", "pos")], "code")


def contracts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda rows: F.array_join(F.transform(rows, lambda r: r["名称"]), ",")
    return _contracts(spark, sf_dir).select(
        "page_id", "doc_id", "url", "title", "api_name", F.col("meta")["描述"].alias("about"),
        F.col("meta")["限量"].alias("limit_text"), name("required_params").alias("required"),
        name("optional_params").alias("optional"), F.array_join("output_fields", ",").alias("fields"),
        F.size("examples").cast("long").alias("n_examples"),
        F.get("table_info", F.lit(0))["表名"].alias("table_name"), "error")


def contracts_pages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts of the given pages: raw web pages, so most give their error."""
    return ct.contracts(_pages(spark, sf_dir)).select("page_id", "doc_id", "url", F.size("examples").cast("long").alias("n_examples"), "error")


def page_elements_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each page has each element."""
    elements = ct.page_elements(_pages(spark, sf_dir)).select("page_id", F.explode("elements").alias("e"))
    return elements.groupBy("page_id", F.col("e.tag").alias("tag")).agg(F.count(F.lit(1)).alias("n"))


def contract_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ct.contract_text(_contracts(spark, sf_dir), 2).select("page_id", "contract_text")


def undocumented_fields_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ct.undocumented_fields(_contracts(spark, sf_dir))
    return out.select("api_name", "doc_id", "error", F.array_join("ask_for", ",").alias("ask_for"), F.col("undocumented").cast("long").alias(
        "undocumented"), F.col("n_fields").cast("long").alias("n_fields"), F.round("undocumented_ratio", 6).alias("ratio"))


def similar_contracts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ct.similar_contracts(_contracts(spark, sf_dir), ["brand", "trade_date", "close"])
    return out.select("api_name", "doc_id", "error", F.col("covered").cast("long").alias("covered"),
                      F.array_join("lacking", ",").alias("lacking"), F.col("required_filters").cast("long").alias("required_filters"))


def choose_scan_mode_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ct.choose_scan_mode(_contracts(spark, sf_dir))


def contract_diff_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrived = table(spark, sf_dir, "part").select(F.col("p_brand").alias("Brand"), F.col("p_size").alias("size"))
    return quality.contract_diff(_contracts(spark, sf_dir), arrived)


def event_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A note per event; many share their hour and topic."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("note_id"), F.date_trunc("hour", F.col("ts")).alias("noted_at"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("task"), F.concat(F.lit("ETF "), "event_type").alias("topic"),
        F.concat(F.lit("gap in k "), k).alias("summary"),
        F.when(F.col("value") < 5, F.array().cast("array<string>")).otherwise(
            F.array(F.col("props"), F.col("event_type"))).alias("evidence"),
        F.when(F.col("value") >= 10, F.col("event_type")).otherwise(" ").alias("impact"),
        F.when(k != "7", F.concat(F.lit("api_"), k)).alias("api_name"),
        F.when(F.col("value") > 20, F.col("event_id").cast("string")).alias("doc_id"),
        F.when(F.col("value") > 60, F.lit(DOC_ROOT)).alias("page_url"),
        F.when(F.col("value") > 40, F.create_map(F.lit("k"), k)).otherwise(
            F.create_map().cast("map<string,string>")).alias("params"),
        F.when(F.col("event_type") == "error", "tentative").otherwise("durable").alias("status"))


def note_names_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nt.note_names(event_notes(spark, sf_dir)).select("note_id", "note_name")


def note_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nt.note_text(event_notes(spark, sf_dir)).select("note_id", "note_text")


def promotable_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nt.promotable(event_notes(spark, sf_dir), 18).select("note_id", "tasks_seen", "promote", "reject_reason")


def recurring_gaps_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nt.recurring_gaps(event_notes(spark, sf_dir), min_tasks=20)


QUERIES = {
    "page_links": page_links_query,
    "page_links_corpus": page_links_corpus_query,
    "search_titles": search_titles_query,
    "search_titles_literal": search_titles_literal_query,
    "html_to_text": html_to_text_query,
    "lines": lines_query,
    "line_window": line_window_query,
    "grep": grep_query,
    "page_tables": page_tables_query,
    "page_sections": page_sections_query,
    "code_examples": code_examples_query,
    "contracts": contracts_query,
    "contracts_pages": contracts_pages_query,
    "page_elements": page_elements_query,
    "contract_text": contract_text_query,
    "undocumented_fields": undocumented_fields_query,
    "similar_contracts": similar_contracts_query,
    "choose_scan_mode": choose_scan_mode_query,
    "contract_diff": contract_diff_query,
    "note_names": note_names_query,
    "note_text": note_text_query,
    "promotable": promotable_query,
    "recurring_gaps": recurring_gaps_query,
}

_LINK = r'<a href="([^"]+)">([^<]+)</a>'
_LINKS = f"""hits AS (SELECT page_id, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS href,
        unnest(regexp_extract_all(html, '{_LINK}', 2)) AS title,
        unnest(range(len(regexp_extract_all(html, '{_LINK}', 1)))) AS pos FROM pages),
    links AS (SELECT page_id, CAST(pos AS INTEGER) AS pos, trim(title) AS title,
        'https://docs.example.org' || href AS url FROM hits WHERE trim(title) <> ''
        QUALIFY row_number() OVER (PARTITION BY page_id, trim(title), href ORDER BY pos) = 1)"""


def _html_to_text_sql() -> str:
    # The markup rules of the text rendering.
    body = "html"
    for tag in ("script", "style", "noscript"):
        body = f"regexp_replace({body}, '(?is)<{tag}.*?>.*?</{tag}>', '', 'g')"
    steps = (
        (r"(?i)<br\s*/?>", "chr(10)"), (r"(?i)<hr[^>]*>", "chr(10) || '----------------------------------------' || chr(10)"),
        (r"(?i)<li[^>]*>", "chr(10) || '- '"),
        (r"(?i)</(p|div|section|article|header|footer|aside|main|ul|ol|li|table|thead|tbody|tfoot|tr|h1|h2|h3|h4|h5|h6|pre)>",
         "chr(10)"),
        (r"(?i)</(td|th)>", "chr(9)"), (r"(?s)<[^>]+>", "''"),
    )
    for pattern, replacement in steps:
        body = f"regexp_replace({body}, '{pattern}', {replacement}, 'g')"
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        body = f"replace({body}, '{entity}', '{char}')"
    tidy = (f"trim(regexp_replace(x, '{WS}+', ' ', 'g'))")
    joined = f"array_to_string(list_transform(string_split({body}, chr(10)), lambda x: {tidy}), chr(10))"
    squeezed = rf"regexp_replace({joined}, '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')"
    return f"SELECT page_id, regexp_replace({squeezed}, '^{WS}+|{WS}+$', '', 'g') || chr(10) AS text FROM pages"


_LINES = r"""lines AS (SELECT doc_id, unnest(l) AS line, CAST(unnest(range(1, len(l) + 1)) AS INTEGER) AS line_no FROM (
        SELECT doc_id, string_split(regexp_replace(text, '\n$', ''), chr(10)) AS l FROM documents WHERE text <> ''))"""

_OK, _BAD = "part WHERE p_size <> 7", "part WHERE p_size = 7"
_INPUT_ROWS = "1 + CASE WHEN p_size % 3 = 0 THEN 2 ELSE 0 END"
_ABOUT = "CASE WHEN p_size % 5 = 0 THEN '' ELSE p_type END"
_CELLS = f"""cells AS (
        SELECT p_partkey AS page_id, 1 AS table_no, 4 AS n_headers, unnest(list_concat(
            [{{r: 0, k: '名称', v: 'ts_code'}}, {{r: 0, k: '类型', v: 'str'}},
             {{r: 0, k: '必选', v: CASE WHEN p_size % 2 = 0 THEN 'y' ELSE 'N' END}}, {{r: 0, k: '描述', v: 'code & market'}}],
            CASE WHEN p_size % 3 = 0 THEN [
                {{r: 1, k: '名称', v: 'START_DATE'}}, {{r: 1, k: '类型', v: 'str'}}, {{r: 1, k: '必选', v: 'N'}},
                {{r: 1, k: '描述', v: 'from'}}, {{r: 2, k: '名称', v: 'end_date'}}, {{r: 2, k: '类型', v: 'str'}},
                {{r: 2, k: '必选', v: ''}}, {{r: 2, k: '描述', v: 'to'}}] ELSE [] END)) AS c FROM part
        UNION ALL SELECT p_partkey, 2, 4, unnest([
            {{r: 0, k: '名称', v: 'trade_date'}}, {{r: 0, k: '类型', v: 'str'}}, {{r: 0, k: '默认显示', v: 'Y'}},
            {{r: 0, k: '描述', v: 'day'}}, {{r: 1, k: '名称', v: 'brand'}}, {{r: 1, k: '类型', v: 'str'}},
            {{r: 1, k: '默认显示', v: 'Y'}}, {{r: 1, k: '描述', v: {_ABOUT}}}, {{r: 1, k: 'column_5', v: 'extra'}},
            {{r: 2, k: '名称', v: ''}}, {{r: 2, k: '类型', v: 'float'}}, {{r: 2, k: '默认显示', v: 'N'}},
            {{r: 2, k: '描述', v: 'unnamed'}}]) FROM part
        UNION ALL SELECT p_partkey, 3, 3, unnest([{{r: 0, k: '表名', v: 't_' || p_partkey}}, {{r: 0, k: '表中文名', v: '零件'}},
            {{r: 0, k: '说明', v: ''}}]) FROM part WHERE p_size % 4 = 0)"""

_NOTES = f"""notes AS (SELECT event_id AS note_id, date_trunc('hour', ts) AS noted_at, 'user ' || user_id AS task,
        'ETF ' || event_type AS topic, json_extract_string(props, '$.k') AS k,
        CASE WHEN value < 5 THEN [] ELSE [props, event_type] END AS evidence,
        CASE WHEN value >= 10 THEN event_type ELSE ' ' END AS impact,
        CASE WHEN json_extract_string(props, '$.k') <> '7' THEN 'api_' || json_extract_string(props, '$.k') END AS api_name,
        CASE WHEN value > 20 THEN CAST(event_id AS VARCHAR) END AS doc_id,
        CASE WHEN value > 60 THEN '{DOC_ROOT}' END AS page_url, value > 40 AS has_params,
        CASE WHEN event_type = 'error' THEN 'tentative' ELSE 'durable' END AS status FROM events)"""

ORACLES = {
    "page_links": f"WITH {_LINKS} SELECT * FROM links",
    "page_links_corpus": f"""WITH {_LINKS} SELECT * FROM links
        QUALIFY row_number() OVER (PARTITION BY title, url ORDER BY page_id, pos) = 1""",
    "search_titles": f"WITH {_LINKS} SELECT * FROM links WHERE regexp_matches(title, '(?i)^TH|tion$')",
    "search_titles_literal": f"""WITH {_LINKS} SELECT page_id, pos, 'x (' || title || ')' AS title, url FROM links
        WHERE lower(title) LIKE 'th%'""",
    "html_to_text": _html_to_text_sql(),
    "lines": f"WITH {_LINES} SELECT doc_id, line_no, line FROM lines",
    "line_window": f"WITH {_LINES} SELECT doc_id, line_no, line FROM lines WHERE line_no BETWEEN 3 AND 5",
    "grep": rf"""WITH {_LINES}, m AS (SELECT *, regexp_matches(line, 'tion(?:[^\p{{L}}\p{{N}}_]|$)') AS is_match FROM lines),
        c AS (SELECT *, bool_or(is_match) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
              AS shown FROM m)
        SELECT doc_id, line_no, line, is_match, coalesce(line_no <> lag(line_no) OVER (PARTITION BY doc_id
            ORDER BY line_no) + 1, false) AS gap_before FROM c WHERE shown""",
    "page_tables": f"""WITH {_CELLS} SELECT page_id, CAST(table_no AS BIGINT) AS table_no, CAST(n_headers AS BIGINT) AS n_headers,
        CAST(c.r AS BIGINT) AS row_no, c.k AS key, c.v AS value FROM cells""",
    "page_sections": f"""SELECT p_partkey AS page_id, '输入参数' AS section, CAST({_INPUT_ROWS} AS BIGINT) AS n_rows FROM {_OK}
        UNION ALL SELECT p_partkey, '输出参数', 3 FROM {_OK}
        UNION ALL SELECT p_partkey, '表信息', 1 FROM {_OK} AND p_size % 4 = 0""",
    "code_examples": f"""SELECT p_partkey AS page_id, unnest([1, 2, 3])::BIGINT AS rank, unnest([4, 2, 0])::BIGINT AS score,
        unnest([2, 3, 1])::BIGINT AS pos, unnest(['pro = pro_api()' || chr(10) || 'pro.query(''part_' || p_partkey || ''')',
        'pro.part_' || p_partkey || '(x)', 'print(1)']) AS code FROM {_OK}""",
    "contracts": f"""SELECT p_partkey AS page_id, CAST(p_partkey AS VARCHAR) AS doc_id, '{DOC_ROOT}?doc_id=' || p_partkey AS url,
        'Part ' || p_name AS title, 'part_' || p_partkey AS api_name, p_type AS about,
        '单次最大' || p_size || ',000行' AS limit_text, CASE WHEN p_size % 2 = 0 THEN 'ts_code' ELSE '' END AS required,
        array_to_string(list_concat(CASE WHEN p_size % 2 = 1 THEN ['ts_code'] ELSE [] END,
            CASE WHEN p_size % 3 = 0 THEN ['START_DATE', 'end_date'] ELSE [] END), ',') AS optional,
        'trade_date,brand' AS fields, CAST(3 AS BIGINT) AS n_examples,
        CASE WHEN p_size % 4 = 0 THEN 't_' || p_partkey END AS table_name, CAST(NULL AS VARCHAR) AS error FROM {_OK}
        UNION ALL SELECT p_partkey, CAST(p_partkey AS VARCHAR), '{DOC_ROOT}?doc_id=' || p_partkey, NULL, '', NULL, NULL,
        '', '', '', 0, NULL, 'no content container' FROM part WHERE p_size = 7""",
    "contracts_pages": f"""SELECT page_id, CAST(NULL AS VARCHAR) AS doc_id, url, CAST(0 AS BIGINT) AS n_examples,
        'no content container' AS error FROM pages WHERE NOT regexp_matches(html, '<div class="[^"]*\\bcontent\\b')""",
    "page_elements": """WITH p AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '<script>', 'g'),
            '(?is)<style[^>]*>.*?</style>', '<style>', 'g') AS h FROM pages),
        t AS (SELECT page_id, unnest(regexp_extract_all(h, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM p)
        SELECT page_id, lower(tag) AS tag, count(*) AS n FROM t GROUP BY 1, 2""",
    "contract_text": f"""SELECT p_partkey AS page_id, array_to_string(list_concat(
        ['Title: Part ' || p_name, 'Doc ID: ' || p_partkey, 'URL: {DOC_ROOT}?doc_id=' || p_partkey, 'API: part_' || p_partkey,
         '描述: ' || p_type, '限量: 单次最大' || p_size || ',000行', ''],
        CASE WHEN p_size % 2 = 0 THEN ['Required Params (1)', ' - ts_code | type=str | code & market']
             ELSE ['Required Params (0)'] END, [''],
        ['Optional Params (' || (CASE WHEN p_size % 2 = 1 THEN 1 ELSE 0 END + CASE WHEN p_size % 3 = 0 THEN 2 ELSE 0 END) || ')'],
        CASE WHEN p_size % 2 = 1 THEN [' - ts_code | type=str | code & market'] ELSE [] END,
        CASE WHEN p_size % 3 = 0 THEN [' - START_DATE | type=str | from', ' - end_date | type=str | to'] ELSE [] END,
        ['', 'Output Fields (3)', ' - trade_date | type=str | default=Y | day',
         ' - brand | type=str | default=Y' || CASE WHEN p_size % 5 = 0 THEN '' ELSE ' | ' || p_type END,
         ' -  | type=float | default=N | unnamed'],
        CASE WHEN p_size % 4 = 0 THEN ['', 'Table Info', ' - 零件 | t_' || p_partkey] ELSE [] END,
        ['', 'Examples (2)', '```', 'pro = pro_api()', 'pro.query(''part_' || p_partkey || ''')', '```',
         '```', 'pro.part_' || p_partkey || '(x)', '```']), chr(10)) AS contract_text FROM {_OK}
        UNION ALL SELECT p_partkey, NULL FROM {_BAD}""",
    "undocumented_fields": f"""SELECT 'part_' || p_partkey AS api_name, CAST(p_partkey AS VARCHAR) AS doc_id,
        CASE WHEN p_size % 5 = 0 THEN 'brand' ELSE '' END AS ask_for,
        CAST(CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) AS undocumented, CAST(3 AS BIGINT) AS n_fields,
        CASE WHEN p_size % 5 = 0 THEN round(1 / 3, 6) ELSE 0.0 END AS ratio, CAST(NULL AS VARCHAR) AS error FROM {_OK}
        UNION ALL SELECT '', CAST(p_partkey AS VARCHAR), NULL, NULL, NULL, NULL, 'no content container' FROM {_BAD}""",
    "similar_contracts": f"""SELECT 'part_' || p_partkey AS api_name, CAST(p_partkey AS VARCHAR) AS doc_id, CAST(2 AS BIGINT) AS covered,
        'close' AS lacking, CAST(CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS required_filters, CAST(NULL AS VARCHAR) AS error FROM {_OK}
        UNION ALL SELECT '', CAST(p_partkey AS VARCHAR), NULL, NULL, NULL, 'no content container' FROM {_BAD}""",
    "choose_scan_mode": f"""SELECT 'part_' || p_partkey AS api_name, CAST(p_partkey AS VARCHAR) AS doc_id,
        CASE WHEN p_size % 3 = 0 THEN 'interval' ELSE 'split' END AS scan_mode,
        p_size % 3 <> 0 AS recommend_range_params, CAST(NULL AS VARCHAR) AS error FROM {_OK}
        UNION ALL SELECT '', CAST(p_partkey AS VARCHAR), NULL, NULL, 'no content container' FROM {_BAD}""",
    "contract_diff": f"""SELECT 'part_' || p_partkey AS api_name, unnest(['trade_date', 'brand', NULL]) AS documented,
        unnest([NULL, 'Brand', 'size']) AS present,
        unnest(['documented_absent', 'case_only', 'present_undocumented']) AS status FROM {_OK}
        UNION ALL SELECT '', NULL, NULL, 'no_contract' FROM {_BAD}""",
    "note_names": f"""WITH {_NOTES}, b AS (SELECT note_id, strftime(noted_at, '%Y%m%d-%H%M%S') || '-'
            || replace(lower(topic), ' ', '-') AS base FROM notes),
        r AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY note_id) AS nth FROM b)
        SELECT note_id, CASE WHEN nth = 1 THEN base ELSE base || '-' || nth END AS note_name FROM r""",
    "note_text": f"""WITH {_NOTES} SELECT note_id, array_to_string(list_concat(
        ['# Runtime Note: ' || task, '', '- Date: `' || strftime(noted_at, '%Y-%m-%d %H:%M:%S') || '`', '- Topic: `' || topic || '`',
         '- Status: `' || status || '`', '- API Name: `' || coalesce(api_name, 'unknown') || '`', '', '## Source'],
        CASE WHEN doc_id IS NULL THEN ['- none recorded'] ELSE ['- `doc_id`: `' || doc_id || '`'] END,
        CASE WHEN page_url IS NULL THEN [] ELSE ['- page: `' || page_url || '`'] END,
        ['', '## Key Params', CASE WHEN has_params THEN '- `k` = `' || k || '`' ELSE '- none recorded' END, '',
         '## Observed Behavior', 'gap in k ' || k, '', '## Evidence'],
        CASE WHEN len(evidence) = 0 THEN [''] ELSE list_transform(evidence, lambda e: '- ' || e) END,
        ['', '## Decision Impact', impact, '']), chr(10)) AS note_text FROM notes""",
    "promotable": f"""WITH {_NOTES}, t AS (SELECT topic, coalesce(api_name, '') AS api, count(DISTINCT task) AS tasks_seen
            FROM notes GROUP BY 1, 2),
        j AS (SELECT note_id, tasks_seen, CASE WHEN len(evidence) = 0 THEN 'no evidence' WHEN trim(impact) = '' THEN 'changes no decision'
            WHEN status <> 'durable' THEN 'not durable' WHEN tasks_seen < 18 THEN 'seen in too few tasks' END AS reject_reason
            FROM notes JOIN t ON t.topic = notes.topic AND t.api = coalesce(api_name, ''))
        SELECT note_id, tasks_seen, reject_reason IS NULL AS promote, reject_reason FROM j""",
    "recurring_gaps": f"""WITH {_NOTES} SELECT topic, api_name, 'gap in k ' || k AS summary, count(DISTINCT task) AS tasks_seen,
        count(*) AS n_notes FROM notes GROUP BY 1, 2, 3 HAVING count(DISTINCT task) >= 20""",
}
