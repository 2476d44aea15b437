"""Date predicates that keep the column bare, so they reach the Parquet scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T


def parse_date(value) -> dt.date:
    """``date``, ``datetime``, ``yyyyMMdd`` (text or int) or ISO text to a date."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = str(value)
    if len(text) == 8 and text.isdigit():
        return dt.datetime.strptime(text, "%Y%m%d").date()
    return dt.date.fromisoformat(text)


def as_date(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """Column as ``date``; text is read as ``yyyyMMdd`` and bad text gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.StringType):
        return F.try_to_date(c, "yyyyMMdd")
    return c if isinstance(dtype, T.DateType) else c.cast("date")


def is_date_like(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def date_between(df: DataFrame, column: str, start=None, end=None) -> Column:
    """``start <= column <= end`` by day, either bound may be None.

    No cast touches the column: a timestamp is compared with midnight bounds, a
    ``yyyyMMdd`` text with text, so row groups and partitions can be skipped.
    """
    dtype = df.schema[column].dataType
    col = F.col(column)
    lo = parse_date(start) if start is not None else None
    hi = parse_date(end) if end is not None else None
    if isinstance(dtype, T.StringType):
        lo_lit, hi_lit, strict = (lo and F.lit(lo.strftime("%Y%m%d"))), (hi and F.lit(hi.strftime("%Y%m%d"))), False
    elif isinstance(dtype, T.DateType):
        lo_lit, hi_lit, strict = (lo and F.lit(lo)), (hi and F.lit(hi)), False
    elif is_date_like(dtype):
        after = hi and hi + dt.timedelta(days=1)
        lo_lit, hi_lit, strict = (lo and F.lit(lo).cast(dtype)), (after and F.lit(after).cast(dtype)), True
    else:
        raise TypeError(f"{column} is {dtype.simpleString()}, not a date")
    cond = col.isNotNull()
    if lo is not None:
        cond = cond & (col >= lo_lit)
    if hi is not None:
        cond = cond & ((col < hi_lit) if strict else (col <= hi_lit))
    return cond

