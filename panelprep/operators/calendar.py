"""Trading-calendar operators: month ends, snapshots, offsets and anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from panelprep.functions.dates import as_date, date_between, parse_date
from panelprep.operators.joins import interval_join
from panelprep.sources.scans import calendar_index, distinct_dates


def month_end_dates(calendar: DataFrame, column: str = "trade_date") -> DataFrame:
    """Last trading day of each month, which needn't be the last calendar day."""
    day = as_date(column, calendar.schema[column].dataType)
    return (
        calendar.select(day.alias("trade_date")).where(F.col("trade_date").isNotNull())
        .groupBy(F.trunc("trade_date", "MM").alias("month"))
        .agg(F.max("trade_date").alias("trade_date"))
    )


def snapshot_shape(
    df: DataFrame, date: str, calendar: DataFrame, calendar_col: str = "trade_date",
    snapshot_share: float = 0.95, daily_share: float = 0.5,
) -> DataFrame:
    """One row: how far the table's dates cluster on month ends, and its shape.

    ``monthly_snapshot`` when at least ``snapshot_share`` of the rows sit on month
    ends; ``daily`` when the table has at least ``daily_share`` of the calendar's
    days within its span; else ``mixed``.
    """
    day = as_date(date, df.schema[date].dataType)
    per_day = df.select(day.alias("trade_date")).where(F.col("trade_date").isNotNull()).groupBy("trade_date").agg(
        F.count(F.lit(1)).alias("n"))
    # From here on: one row per day.
    ends = month_end_dates(calendar, calendar_col).select("trade_date", F.lit(True).alias("is_end"))
    days = distinct_dates(calendar, calendar_col).select("trade_date", F.lit(True).alias("in_calendar"))
    flagged = (
        days.join(ends, "trade_date", "left").join(per_day, "trade_date", "full")
        .withColumn("is_end", F.coalesce("is_end", F.lit(False)))
    )
    present = F.col("n").isNotNull()
    span = Window.partitionBy()
    flagged = flagged.select(
        "*", F.min(F.when(present, F.col("trade_date"))).over(span).alias("lo"),
        F.max(F.when(present, F.col("trade_date"))).over(span).alias("hi"))
    in_span = F.col("trade_date").between(F.col("lo"), F.col("hi")) & F.col("in_calendar")
    row = flagged.agg(
        F.count_if(present).alias("n_dates"),
        F.count_if(present & F.col("is_end")).alias("n_month_end_dates"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("is_end"), F.col("n"))), F.lit(0)).alias("n_month_end_rows"),
        F.count_if(in_span).alias("n_calendar_dates"),
        F.count_if(in_span & present).alias("n_calendar_dates_present"),
    )
    row = row.select(
        "*",
        F.try_divide("n_month_end_dates", "n_dates").alias("date_share"),
        F.try_divide("n_month_end_rows", "n_rows").alias("row_share"),
        F.try_divide("n_calendar_dates_present", "n_calendar_dates").alias("calendar_share"),
    )
    shape = (
        F.when(F.col("row_share") >= snapshot_share, "monthly_snapshot")
        .when(F.col("calendar_share") >= daily_share, "daily")
        .otherwise("mixed")
    )
    return row.withColumn("shape", shape)


def keep_month_ends(df: DataFrame, date: str, calendar: DataFrame, calendar_col: str = "trade_date") -> DataFrame:
    """Rows on month-end trading days.

    The month ends are broadcast (bounded by the date type); on a table that is
    partitioned by ``date`` they also prune its partitions.
    """
    ends = month_end_dates(calendar, calendar_col)
    day = as_date(F.col(f"d.{date}"), df.schema[date].dataType)
    return df.alias("d").join(F.broadcast(ends.alias("e")), day == F.col("e.trade_date"), "left_semi")


def with_previous_anchor(snapshots: DataFrame, start, end, key: str = "index_code", date: str = "trade_date") -> DataFrame:
    """Snapshots from ``start`` to ``end`` and, per key, the last one before ``start``."""
    before = snapshots.where(date_between(snapshots, date, None, end) & (as_date(date, snapshots.schema[date].dataType) < F.lit(parse_date(start))))
    last = before.groupBy(key).agg(F.max(date).alias(date))
    previous = before.join(last, [key, date], "left_semi")
    return snapshots.where(date_between(snapshots, date, start, end)).unionByName(previous)


def trading_offset(calendar: DataFrame, n: int, column: str = "trade_date", name: str = "offset_date") -> DataFrame:
    """Each trading day with the one ``n`` trading days later (earlier if negative)."""
    order = Window.orderBy("trade_date")
    return distinct_dates(calendar, column).select(
        "trade_date", F.lead("trade_date", n).over(order).alias(name) if n >= 0
        else F.lag("trade_date", -n).over(order).alias(name)
    )


def day_positions(calendar: DataFrame, calendar_col: str, *days: DataFrame) -> DataFrame:
    """``(trade_date, pos, on_calendar)``: trading days up to each day of the calendar and of ``days``.

    One row per distinct day, so it's bounded by the date type.
    """
    marks = calendar_index(calendar, calendar_col)
    for frame in days:
        marks = marks.unionByName(distinct_dates(frame, "trade_date").withColumn("idx", F.lit(None).cast("int")))
    per_day = marks.groupBy("trade_date").agg(F.max("idx").alias("idx"))
    so_far = F.last("idx", ignorenulls=True).over(Window.orderBy("trade_date"))
    return per_day.select(
        "trade_date", F.coalesce(so_far, F.lit(0)).alias("pos"), F.col("idx").isNotNull().alias("on_calendar"))


def anchor_spans(
    anchors: DataFrame, calendar: DataFrame, key: str = "index_code", date: str = "trade_date",
    calendar_col: str = "trade_date",
) -> DataFrame:
    """Per key and anchor date: calendar positions ``anchor_idx`` up to ``next_idx``.

    ``first_idx`` is the first trading day in force: the anchor day itself, or
    the next trading day for an anchor off the calendar, whose ``anchor_idx`` is
    the last trading day before it.  ``next_idx`` is exclusive, one past the
    calendar's end for the last anchor.
    """
    last = calendar_index(calendar, calendar_col).select(F.max("idx")).scalar()
    days = anchors.select(key, F.col(date).alias("anchor_date")).distinct()
    placed = day_positions(calendar, calendar_col, days.select(F.col("anchor_date").alias("trade_date"))).select(
        F.col("trade_date").alias("anchor_date"), F.col("pos").alias("anchor_idx"), "on_calendar")
    spans = days.join(F.broadcast(placed), "anchor_date", "inner")
    following = Window.partitionBy(key).orderBy("anchor_date")
    first_day = F.col("anchor_idx") + F.when(F.col("on_calendar"), 0).otherwise(1)
    return spans.withColumn("first_idx", first_day).select(
        key, "anchor_date", "anchor_idx", "first_idx",
        F.coalesce(F.lead("first_idx").over(following), last + 1).alias("next_idx"),
        F.lead("anchor_date").over(following).alias("next_anchor_date"),
    )


def assign_anchor(
    dates: DataFrame, anchors: DataFrame, calendar: DataFrame, key: str = "index_code", date: str = "trade_date",
    anchor_date: str = "trade_date", calendar_col: str = "trade_date",
) -> DataFrame:
    """Each (key, day) with its latest anchor on or before that day.

    ``days_since_anchor`` counts the trading days after the anchor.  Days before
    the first anchor keep a null anchor.  An anchor holds until the next one, so
    this is an interval join by day bucket.
    """
    following = Window.partitionBy(key).orderBy("anchor_date")
    held = anchors.select(key, F.col(anchor_date).alias("anchor_date")).distinct().withColumn(
        "_until", F.lead("anchor_date").over(following))
    joined = interval_join(
        dates, held, key, date, "anchor_date", "_until", end_inclusive=False, how="left",
        last_start=anchors.select(F.max(anchor_date)).scalar()).drop("_until")
    pos = day_positions(
        calendar, calendar_col, dates.select(F.col(date).alias("trade_date")), held.select(F.col("anchor_date").alias("trade_date")))
    of_day = pos.select(F.col("trade_date").alias(date), F.col("pos").alias("_pos"))
    of_anchor = pos.select(F.col("trade_date").alias("anchor_date"), F.col("pos").alias("_anchor_pos"))
    return (
        joined.join(F.broadcast(of_day), date, "left").join(F.broadcast(of_anchor), "anchor_date", "left")
        .select(*dates.columns, "anchor_date", (F.col("_pos") - F.col("_anchor_pos")).alias("days_since_anchor"))
    )
