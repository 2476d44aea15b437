"""Column expressions over text: literals, key=value pairs, ids, slugs, metadata.

Everything here stays on the JVM.  Whitespace means what ``str.isspace`` means
in Python, i.e. Unicode white space plus the four separators ``\\x1c-\\x1f``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Character classes.
_WS = r"[\s\x1c-\x1f]"
_WS_RUN = rf"(?U){_WS}+"
_WS_CHARS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAK = r"\R|[\x1c-\x1e]"
_JSON_INT = r"^-?(0|[1-9]\d*)$"
_JSON_NUMBER = r"^-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?$"
_JSON_SPECIAL = ("NaN", "Infinity", "-Infinity")


def as_col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Trim white space of any kind from both ends."""
    return F.trim(as_col(col), F.lit(_WS_CHARS))


def normalize_ws(col: Column | str) -> Column:
    """Runs of white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(as_col(col), _WS_RUN, " "))


def split_lines(col: Column | str) -> Column:
    """Text to an array of lines; a final line break adds no empty line."""
    text = as_col(col)
    size = F.length(text)
    cut = (
        F.when(F.endswith(text, F.lit("\r\n")), size - 2)
        .when(F.substring(text, -1, 1).rlike(LINE_BREAK), size - 1)
        .otherwise(size)
    )
    lines = F.split(F.substring(text, F.lit(1), cut), LINE_BREAK)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(lines)


def literal_type(col: Column | str) -> Column:
    """``struct<text, kind>`` of a literal: JSON if it parses, else the raw string.

    ``kind`` is one of int, float, bool, null, string, array, object.  A quoted
    JSON string gives its content; ``000300`` isn't JSON and stays a string.
    """
    return let(as_col(col), _literal)


def _literal(raw: Column) -> Column:
    body = F.trim(raw, F.lit(" \t\n\r"))

    def typed(text: Column, kind: str) -> Column:
        return F.struct(text.alias("text"), F.lit(kind).alias("kind"))

    def if_json(text: Callable[[Column], Column], kind: str) -> Column:
        # The parser runs only on text that starts like a quoted or nested value.
        return let(F.try_parse_json(body), lambda v: F.when(v.isNotNull(), typed(text(v), kind)).otherwise(
            typed(raw, "string")))

    first = F.substring(body, 1, 1)
    return (
        F.when(raw.isNull(), F.lit(None))
        .when(first == '"', if_json(lambda v: F.try_variant_get(v, "$", "string"), "string"))
        .when(first == "[", if_json(lambda v: body, "array"))
        .when(first == "{", if_json(lambda v: body, "object"))
        .when(body.rlike(_JSON_INT), typed(body, "int"))
        .when(body.rlike(_JSON_NUMBER) | body.isin(*_JSON_SPECIAL), typed(body, "float"))
        .when(body.isin("true", "false"), typed(body, "bool"))
        .when(body == "null", typed(body, "null"))
        .otherwise(typed(raw, "string"))
    )


def key_value(col: Column | str, strict: bool = False) -> Column:
    """``struct<key, value, valid>`` from ``key=value``, split at the first ``=``.

    Loose: the key is trimmed and must not be blank, the value is left alone.
    Strict: both are trimmed and neither may be blank.
    """
    raw = as_col(col)
    has_sign = F.contains(raw, F.lit("="))
    parts = F.split(raw, "=", 2)
    key = F.when(has_sign, strip(parts[0]))
    value = F.when(has_sign, strip(parts[1]) if strict else parts[1])
    valid = has_sign & (key != "")
    if strict:
        valid = valid & (value != "")
    return F.struct(key.alias("key"), value.alias("value"), F.coalesce(valid, F.lit(False)).alias("valid"))


def _is_digits(col: Column) -> Column:
    return col.rlike(r"(?U)^\d+\z")


def _url_decode(col: Column) -> Column:
    return F.coalesce(F.try_url_decode(col), col)


def doc_id(col: Column | str) -> Column:
    """All digits: itself; absolute URL: first ``doc_id`` query value; else NULL."""
    raw = as_col(col)
    query = F.regexp_extract(raw, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+[^?#]*\?([^#]*)", 1)
    pairs = F.transform(F.split(query, "&"), lambda pair: F.split(pair, "=", 2))
    hits = F.filter(
        pairs,
        lambda kv: (F.size(kv) == 2)
        & (_url_decode(F.get(kv, F.lit(0))) == "doc_id")
        & (F.get(kv, F.lit(1)) != ""),
    )
    return F.when(_is_digits(raw), raw).otherwise(_url_decode(F.get(F.get(hits, F.lit(0)), F.lit(1))))


def doc_url(col: Column | str, root: str) -> Column:
    """Page URL of a numeric id under ``root``; anything else is already a URL."""
    raw = as_col(col)
    return F.when(_is_digits(raw), F.concat(F.lit(f"{root}?doc_id="), raw)).otherwise(raw)


def slug(col: Column | str, default: str = "runtime-note") -> Column:
    """Lower case, runs outside ``[a-zA-Z0-9._-]`` to ``-``, no ``-`` at the ends."""
    cleaned = F.regexp_replace(F.lower(strip(col)), r"[^a-zA-Z0-9._\-]+", "-")
    cleaned = F.regexp_replace(cleaned, r"^-+|-+$", "")
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(default))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it.

    Spark evaluates an expression anew wherever it's named inside a lambda, so a
    column that a lambda runs over many times is bound to a lambda variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def map_last_wins(entries: Column, key: str = "key", value: str = "value") -> Column:
    """Array of structs to a map; of equal keys the last value stays.

    Doesn't lean on ``spark.sql.mapKeyDedupPolicy``, which is the caller's.
    """
    def build(rows: Column) -> Column:
        keys = F.array_distinct(F.transform(rows, lambda e: e[key]))
        values = F.transform(keys, lambda k: F.element_at(F.filter(rows, lambda e: e[key] == k), -1)[value])
        return F.map_from_arrays(keys, values)

    return let(entries, build)


def meta_map(col: Column | str) -> Column:
    """``map<string,string>`` from ``key: value`` lines; a full-width colon wins."""
    lines = F.filter(F.transform(split_lines(col), normalize_ws), lambda x: x.rlike("[：:]"))
    pairs = F.transform(
        lines,
        lambda x: F.when(F.contains(x, F.lit("：")), F.split(x, "：", 2)).otherwise(F.split(x, ":", 2)),
    )
    entries = F.transform(
        pairs,
        lambda p: F.struct(normalize_ws(p[0]).alias("key"), normalize_ws(p[1]).alias("value")),
    )
    return map_last_wins(entries)
