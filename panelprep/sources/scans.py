"""Scans: column and row narrowing, ranges, and many requests as one join."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from panelprep.functions.dates import as_date, date_between, is_date_like, parse_date
from panelprep.functions.text import key_value, literal_type


class Between(NamedTuple):
    """Inclusive range value of a scan parameter; either end may be None."""

    lo: Any = None
    hi: Any = None


_NATIVE = {"int": int, "float": float, "bool": lambda text: text == "true", "null": lambda text: None,
           "array": json.loads, "object": json.loads, "string": str}


def merge_params(base: Mapping[str, Any] | None = None, settings: DataFrame | None = None) -> dict[str, Any]:
    """``base`` overridden by a table ``(pos, text)`` of ``key=value`` settings, later ones last.

    The texts go through the library's own ``key_value`` and ``literal_type``.
    Settings are what a caller types in, so they're few.
    """
    merged = dict(base or {})
    if settings is None:
        return merged
    split = settings.select("pos", "text", key_value("text").alias("kv"))
    typed = split.select("pos", "text", "kv.key", "kv.valid", literal_type(F.col("kv.value")).alias("literal"))
    for row in typed.orderBy("pos").collect():
        if not row["valid"]:
            raise ValueError(f"not a key=value setting: {row['text']!r}")
        merged[row["key"]] = _NATIVE[row["literal"]["kind"]](row["literal"]["text"])
    return merged


def _param_condition(df: DataFrame, name: str, value: Any) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(value, Between):
        if is_date_like(dtype):
            return date_between(df, name, value.lo, value.hi)
        cond = F.col(name).isNotNull()
        if value.lo is not None:
            cond = cond & (F.col(name) >= F.lit(value.lo))
        if value.hi is not None:
            cond = cond & (F.col(name) <= F.lit(value.hi))
        return cond
    if value is None:
        return F.col(name).isNull()
    values = list(value) if isinstance(value, (list, tuple, set)) else [value]
    if isinstance(dtype, T.DateType):
        values = [parse_date(v) for v in values]
    elif is_date_like(dtype):
        days = [date_between(df, name, v, v) for v in values]
        cond = days[0] if days else F.lit(False)
        for day in days[1:]:
            cond = cond | day
        return cond
    elif isinstance(dtype, T.StringType):
        values = [str(v) for v in values]
    return F.col(name).isin(values) if len(values) != 1 else F.col(name) == F.lit(values[0])


def resolve_name(df: DataFrame, name: str) -> str:
    """Column of ``df`` called ``name``, exact case first, then any case."""
    if name in df.columns:
        return name
    found = [c for c in df.columns if c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"no column {name!r}; available: {', '.join(df.columns)}")
    return found[0]


def param_conditions(df: DataFrame, params: Mapping[str, Any]) -> dict[str, Column]:
    """Parameter name to predicate: a value, a list of values, or a ``Between``."""
    return {name: _param_condition(df, resolve_name(df, name), v) for name, v in params.items()}


def scan(df: DataFrame, params: Mapping[str, Any] | None = None, fields: str | Iterable[str] = "") -> DataFrame:
    """Rows that satisfy every parameter, narrowed to ``fields`` (empty: all)."""
    out = df
    for cond in param_conditions(df, params or {}).values():
        out = out.where(cond)
    names = fields.split(",") if isinstance(fields, str) else list(fields)
    names = [n.strip() for n in names if n.strip()]
    return out.select(*[resolve_name(df, n) for n in names]) if names else out


def _typed_requests(df: DataFrame, requests: DataFrame, by: str) -> DataFrame:
    """``(request_pos, requested, _asked)``: the request as it was given, and as a value of ``by`` (a day, if that holds times)."""
    dtype = df.schema[by].dataType
    value = F.col("value")
    if is_date_like(dtype):
        if isinstance(requests.schema["value"].dataType, T.StringType):
            value = F.coalesce(F.try_to_date(value, "yyyyMMdd"), value.try_cast("date"))
        dtype = T.DateType()
    return requests.select(F.col("pos").alias("request_pos"), F.col("value").cast("string").alias("requested"), value.try_cast(dtype).alias("_asked"))


def _asked(df: DataFrame, by: str) -> Column:
    return as_date(by, df.schema[by].dataType) if is_date_like(df.schema[by].dataType) else F.col(by)


def split_scan(
    df: DataFrame, requests: DataFrame, by: str, fixed_params: Mapping[str, Any] | None = None,
    fields: str | Iterable[str] = "",
) -> DataFrame:
    """One slice per requested value, all slices in one join.

    ``requests`` is ``(pos, value)``; a repeated value repeats its rows and
    ``request_pos`` keeps the order.  A column of times is split by day.  ``by``
    overrides a fixed parameter of the same name.  No broadcast is forced: a
    request list that is really small gets broadcast on its size, a long one is
    shuffled.
    """
    by = resolve_name(df, by)
    fixed = {k: v for k, v in (fixed_params or {}).items() if k.lower() != by.lower()}
    base = scan(df, fixed)
    narrowed = scan(base, None, fields)
    if by not in narrowed.columns:
        narrowed = base.select(*narrowed.columns, by)
    keyed = narrowed.withColumn("_asked", _asked(narrowed, by))
    wanted = _typed_requests(df, requests, by).drop("requested")
    return keyed.join(wanted, "_asked", "inner").select(*narrowed.columns, "request_pos")


def split_log(
    df: DataFrame, requests: DataFrame, by: str, fixed_params: Mapping[str, Any] | None = None
) -> DataFrame:
    """Rows per request, zero included: ``request_pos, requested, by, n_rows``.

    ``requested`` is the request's text, ``by`` the value or day it stands for
    (null if it's none).  Counts are taken before the join.
    """
    by = resolve_name(df, by)
    fixed = {k: v for k, v in (fixed_params or {}).items() if k.lower() != by.lower()}
    counts = scan(df, fixed).groupBy(_asked(df, by).alias("_asked")).agg(F.count(F.lit(1)).alias("n_rows"))
    return _typed_requests(df, requests, by).join(counts, "_asked", "left").select(
        "request_pos", "requested", F.col("_asked").alias(by), F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows")
    )


def split_summary(log: DataFrame) -> DataFrame:
    """One row over a split log: requests, requests with rows, rows in all."""
    return log.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("n_rows") > 0).alias("with_rows"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
    )


def interval_scan(df: DataFrame, date_col: str, start, end, keep: DataFrame | None = None) -> DataFrame:
    """One bounded date range; ``keep`` then filters locally on its columns.

    A ``keep`` of days is sent to all tasks (bounded by the date type); if ``df`` is
    partitioned by that column, its partitions are pruned by it as the query runs.
    """
    out = df.where(date_between(df, date_col, start, end))
    if keep is None:
        return out
    days = len(keep.columns) == 1 and isinstance(keep.schema[0].dataType, T.DateType)
    return out.join(F.broadcast(keep.distinct()) if days else keep, keep.columns, "left_semi")


def distinct_dates(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null days as ``(trade_date date)``.

    ``date`` has 3,652,059 values, so this frame is bounded by its type, whatever
    the size of ``df``.  It's the one kind of frame the library broadcasts by hint
    or puts under an unpartitioned window.
    """
    day = as_date(column, df.schema[column].dataType)
    return df.select(day.alias("trade_date")).where(F.col("trade_date").isNotNull()).distinct()


def calendar_index(calendar: DataFrame, column: str = "trade_date") -> DataFrame:
    """``(trade_date, idx)`` with 1-based position; bounded by the date type."""
    order = Window.orderBy("trade_date")
    return distinct_dates(calendar, column).select("trade_date", F.row_number().over(order).alias("idx"))


def values_to_intervals(
    dates: DataFrame, calendar: DataFrame, date_col: str = "trade_date", calendar_col: str = "trade_date"
) -> DataFrame:
    """Fewest contiguous ranges over the calendar that cover the given dates.

    A date that isn't on the calendar is a range of its own.
    """
    asked = distinct_dates(dates, date_col)
    days = calendar_index(calendar, calendar_col)
    wanted = days.join(F.broadcast(asked), "trade_date", "left_semi")
    island = F.col("idx") - F.row_number().over(Window.orderBy("trade_date"))
    ranges = wanted.withColumn("island", island).groupBy("island").agg(
        F.min("trade_date").alias("start_date"), F.max("trade_date").alias("end_date"), F.count(F.lit(1)).alias("n_dates")
    ).drop("island")
    off = asked.join(F.broadcast(days), "trade_date", "left_anti")
    return ranges.unionByName(off.select(
        F.col("trade_date").alias("start_date"), F.col("trade_date").alias("end_date"), F.lit(1).cast("long").alias("n_dates")))


def head(df: DataFrame, n: int, order: Iterable[Column | str] = ()) -> DataFrame:
    """First ``n`` rows as a preview; give ``order`` for a repeatable answer."""
    order = list(order)
    return (df.orderBy(*order) if order else df).limit(max(n, 0))


def read_pages(spark: SparkSession, path: str, columns: Iterable[str] = ("page_id", "url", "html")) -> DataFrame:
    """A corpus of dictionary pages stored as Parquet."""
    return spark.read.parquet(path).select(*columns)
