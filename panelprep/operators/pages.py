"""Dictionary pages as a corpus: links, title search, text, lines, grep.

Each page is one row, so all of this is row-local: no shuffle.  Python is used
for the two things Spark has no function for, HTML entities and URL resolution,
in Arrow batches.
"""

from __future__ import annotations

import html
import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from panelprep.functions.text import normalize_ws, split_lines
from panelprep.operators.sets import dedupe_first

# The link form that is recognised, and the markup rules of the
# text rendering in the order they apply.
_LINK = r'<a href="([^"]+)">([^<]+)</a>'
_MARKUP = (
    (r"(?is)<(script|style|noscript).*?>.*?</\1>", ""),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)<hr[^>]*>", "\n----------------------------------------\n"),
    (r"(?i)<li[^>]*>", "\n- "),
    (r"(?i)</(p|div|section|article|header|footer|aside|main|ul|ol|li|table|thead|tbody|tfoot|tr|h1|h2|h3|h4|h5|h6|pre)>", "\n"),
    (r"(?i)</(td|th)>", "\t"),
    (r"(?s)<[^>]+>", ""),
)


@F.pandas_udf(T.StringType())
def unescape(text: pd.Series) -> pd.Series:
    """HTML entities to characters, no-break spaces to plain ones."""
    return text.map(lambda t: html.unescape(t).replace("\u00a0", " "), na_action="ignore")


_LINKS = T.StructType([
    T.StructField("pos", T.ArrayType(T.IntegerType())), T.StructField("title", T.ArrayType(T.StringType())),
    T.StructField("url", T.ArrayType(T.StringType())),
])


@F.pandas_udf(_LINKS)
def _resolve_links(base: pd.Series, hrefs: pd.Series, titles: pd.Series) -> pd.DataFrame:
    """Absolute targets and plain titles; of equal pairs within a page the first stays."""
    rows = []
    for root, refs, names in zip(base, hrefs, titles):
        first: dict[tuple[str, str], int] = {}
        for pos, (ref, name) in enumerate(zip(refs if refs is not None else (), names if names is not None else ())):
            title = html.unescape(name).strip()
            if title:
                try:
                    target = urljoin(root or "", ref)
                except ValueError:
                    target = ref
                first.setdefault((title, target), pos)
        rows.append((list(first.values()), [t for t, _ in first], [u for _, u in first]))
    return pd.DataFrame(rows, columns=_LINKS.names)


# A filter on a result would else be pushed below it and run the Python twice.
unescape = unescape.asNondeterministic()
_resolve_links = _resolve_links.asNondeterministic()


def page_links(
    pages: DataFrame, root: str | Column | None = None, page_id: str = "page_id", html_col: str = "html",
    url: str = "url", scope: str = "page",
) -> DataFrame:
    """Links ``(page_id, pos, title, url)``: the first of each (title, url).

    Targets are resolved against ``root``, or the page's own URL without it.
    ``scope`` says whether repeats are dropped within a page (no shuffle) or
    over the whole corpus.
    """
    if scope not in ("page", "corpus"):
        raise ValueError("scope must be 'page' or 'corpus'")
    base = F.col(url) if root is None else (F.lit(root) if isinstance(root, str) else root)
    # a page is searched once; a match is cut at its fixed delimiters: 9 characters, the target, 2, the title, 4
    whole = pages.select(page_id, base.alias("_base"), F.regexp_extract_all(html_col, F.lit(_LINK), 0).alias("_whole"))
    target = lambda link: F.substring_index(F.substring(link, F.lit(10), F.length(link)), '"', 1)
    hrefs = F.transform("_whole", target)
    titles = F.zip_with("_whole", "_hrefs", lambda link, href: F.substring(link, F.length(href) + 12, F.length(link) - F.length(href) - 15))
    found = whole.withColumn("_hrefs", hrefs).select(page_id, "_base", "_hrefs", titles.alias("_titles"))
    links = found.select(page_id, _resolve_links("_base", "_hrefs", "_titles").alias("_l"))
    rows = links.select(page_id, F.inline(F.arrays_zip("_l.pos", "_l.title", "_l.url")))
    return dedupe_first(rows, ["title", "url"], [page_id, "pos"]) if scope == "corpus" else rows


def java_pattern(spark: SparkSession, pattern: str) -> str:
    """The regex in the dialect Spark evaluates; ValueError if it isn't one.

    Classes and word borders are Unicode ones, as they are in Python.
    """
    try:
        re.compile(pattern)
    except re.error as exc:
        raise ValueError(f"not a regular expression: {exc}") from exc
    out = "(?U)" + re.sub(r"\(\?P<([A-Za-z][A-Za-z0-9]*)>", r"(?<\1>", pattern)
    out = re.sub(r"\(\?P=([A-Za-z][A-Za-z0-9]*)\)", r"\\k<\1>", out)
    try:
        spark.range(1).select(F.lit("x").rlike(out)).collect()
    except PySparkException as exc:
        raise ValueError(f"not a regular expression: {pattern}") from exc
    return out


def search_titles(links: DataFrame, query: str, title: str = "title") -> DataFrame:
    """Links whose title matches, ignoring case; a bad regex is searched literally."""
    try:
        pattern = java_pattern(links.sparkSession, query)
    except ValueError:
        pattern = r"\Q" + query.replace(r"\E", r"\E\\E\Q") + r"\E"
    return links.where(F.col(title).rlike(f"(?iu){pattern}"))


def html_to_text(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """Plain text of each page: markup to line breaks, cells to tabs, blank runs cut to two."""
    body = F.col(html_col)
    for pattern, replacement in _MARKUP:
        body = F.regexp_replace(body, pattern, replacement)
    staged = pages.withColumn("_body", unescape(body))

    def tidy(line: Column) -> Column:
        cells = F.filter(F.transform(F.split(line, "\t"), normalize_ws), lambda c: c != "")
        return F.when(F.contains(line, F.lit("\t")), F.array_join(cells, "\t")).otherwise(normalize_ws(line))

    joined = F.array_join(F.transform(split_lines("_body"), tidy), "\n")
    squeezed = F.regexp_replace(joined, r"\n{4,}", "\n\n\n")
    # Lines are trimmed already, so only line breaks can be left at the ends.
    text = F.concat(F.trim(squeezed, F.lit("\n")), F.lit("\n"))
    return staged.withColumn(name, text).drop("_body")


def lines(text_df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """Numbered lines ``(id, line_no, line)``, from 1."""
    return text_df.select(id_col, F.posexplode(split_lines(text_col)).alias("_pos", "line")).select(
        id_col, (F.col("_pos") + 1).alias("line_no"), "line")


def parse_line_spec(spec: str) -> tuple[int, int]:
    """``A:B`` to the pair, both inclusive, ``1 <= A <= B``."""
    found = re.fullmatch(r"(\d+):(\d+)", spec)
    if not found:
        raise ValueError(f"expected A:B, got {spec!r}")
    start, end = int(found[1]), int(found[2])
    if not 1 <= start <= end:
        raise ValueError(f"expected 1 <= A <= B, got {spec!r}")
    return start, end


def line_window(lines_df: DataFrame, start: int | str, end: int | None = None) -> DataFrame:
    """Lines ``start`` to ``end`` of each text, or the ``A:B`` that ``start`` spells."""
    start, end = parse_line_spec(start) if isinstance(start, str) else parse_line_spec(f"{start}:{end}")
    return lines_df.where(F.col("line_no").between(start, end))


def grep(text_df: DataFrame, pattern: str, context: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Matching lines with ``context`` lines around them, each once, in order.

    Gives ``(id, line_no, line, is_match, gap_before)``; a gap marks a new group
    after the first.  All of it happens inside the text's own row, in time that
    grows with the number of lines, so there's no shuffle by document.
    """
    if context < 0:
        raise ValueError("context can't be negative")
    java = java_pattern(text_df.sparkSession, pattern)
    numbered = text_df.select(id_col, split_lines(text_col).alias("_lines"))
    hits = F.filter(
        F.transform("_lines", lambda x, i: F.when(x.rlike(java), i + 1)), lambda i: i.isNotNull())
    # No filter on the hits: Spark would push it below and search every text twice.
    found = numbered.withColumn("_hits", hits).withColumn("_n", F.size("_lines"))
    width = F.lit(context)

    def block(hit: Column, i: Column) -> Column:
        # From a hit, the lines that the hit before it hasn't taken already.
        previous_end = F.when(i > 0, F.get("_hits", i - 1) + width).otherwise(0)
        lo = F.greatest(F.lit(1), hit - width, previous_end + 1)
        hi = F.least(F.col("_n"), hit + width)
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    shown = found.withColumn("_shown", F.flatten(F.transform("_hits", block)))
    # The line goes into the exploded struct: an output row carries no whole text.
    rows = shown.select(id_col, F.inline(F.transform("_shown", lambda n, i: F.struct(
        n.alias("line_no"), F.get("_lines", n - 1).alias("line"),
        F.when(i > 0, n != F.get("_shown", i - 1) + 1).otherwise(False).alias("gap_before")))))
    return rows.select(id_col, "line_no", "line", F.col("line").rlike(java).alias("is_match"), "gap_before")


def grep_text(hits: DataFrame) -> Column:
    """A hit as printed: ``12:text`` for a match, ``12-text`` for context."""
    return F.concat(F.col("line_no"), F.when(F.col("is_match"), ":").otherwise("-"), F.col("line"))

