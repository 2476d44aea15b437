"""Anchor weights drifted to daily estimates, and flows aggregated with them.

Row growth is bounded by the output: a constituent gives one row per trading
day that its anchor holds for, and that is the last step: before, an anchor
period is a row with arrays.  Periods are shuffled per (index, constituent,
anchor), so a hot index is spread over its constituents and periods.  Everything
per (index, day) is a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from panelprep.functions.dates import parse_date
from panelprep.operators.calendar import anchor_spans, trading_offset
from panelprep.operators.sets import top_k
from panelprep.sources.scans import calendar_index, distinct_dates

BUCKET = 64  # trading days of a code in one array


def return_from_price(
    df: DataFrame, key: str = "con_code", date: str = "trade_date", price: str = "close",
    adj_price: str | None = None, name: str = "ret",
) -> DataFrame:
    """Return over the key's previous quoted day.

    Where both days have an adjusted price it's their ratio, else the ratio of the
    raw ones: a raw price is never divided by an adjusted one.  Needs one row per
    (key, date); the window is then at most one row per day.
    """
    by_key = Window.partitionBy(key).orderBy(date)
    change = F.try_divide(F.col(price), F.lag(price).over(by_key))
    if adj_price:
        change = F.coalesce(F.try_divide(F.col(adj_price), F.lag(adj_price).over(by_key)), change)
    return df.withColumn(name, change - 1)


def drift_weights(
    anchors: DataFrame, returns: DataFrame, calendar: DataFrame, index: str = "index_code", code: str = "con_code",
    date: str = "trade_date", weight: str = "weight", ret: str = "ret", calendar_col: str = "trade_date",
    through_next: bool = False, carry: DataFrame | None = None,
) -> DataFrame:
    """Raw daily weights ``w * prod(1 + r)`` from each anchor to the next.

    On the anchor day itself the raw weight is the official one.  A missing
    return counts as 0 on its day; ``has_quotes`` is false when the constituent
    has no row in ``returns`` after the anchor in the whole period.  With ``through_next`` a period also covers the
    day of the next anchor, which is what comparing with it needs.

    Anchors must be unique per (index, code, date), and returns and ``carry`` per
    (code, date); ``assert_unique`` checks that.  Equal anchors count once, a
    repeated return is an error.

    ``carry`` holds more measures per (code, date) for the output, such as the
    next day's flow.  They're merged with the returns into arrays of ``BUCKET``
    days per code.  What is shuffled is anchor periods with such arrays; products
    run inside the row, and the days become rows last.
    """
    idx = calendar_index(calendar, calendar_col)
    spans = anchor_spans(anchors, calendar, index, date, calendar_col).where("first_idx < next_idx")
    last = F.col("next_idx") - 1
    if through_next:
        last = F.when(F.col("next_anchor_date").isNotNull(), F.col("next_idx")).otherwise(last)
    extra = [c for c in anchors.columns if c not in (index, code, date, weight)]
    carried = [c for c in carry.columns if c not in (code, date)] if carry is not None else []
    held = anchors.withColumnRenamed(date, "anchor_date").join(
        spans.withColumn("_last", last), [index, "anchor_date"], "inner")
    held = held.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("first_idx") / BUCKET), F.floor(F.col("_last") / BUCKET))))
    slots = _slots(returns.select(code, date, F.col(ret).cast("double").alias("_ret")), carry, idx, code, date)

    # A row per anchor period and bucket: growth since the bucket's first day, day by day.
    begin = F.col("_bucket") * BUCKET
    day_type = "struct<growth: double" + "".join(f", `{c}`: {carry.schema[c].dataType.simpleString()}" for c in carried) + ">"
    start = F.struct(F.array().cast(f"array<{day_type}>").alias("days"), F.lit(1.0).alias("growth"), F.lit(False).alias("quoted"))

    def step(state, day):
        slot = F.get("_slots", day - begin)
        quoted = F.coalesce(slot["quoted"], F.lit(False)) & (day > F.col("anchor_idx"))
        growth = state["growth"] * F.when(quoted, 1 + F.coalesce(slot["ret"], F.lit(0.0))).otherwise(F.lit(1.0))
        value = F.struct(growth.alias("growth"), *(slot[c].alias(c) for c in carried))
        return F.struct(F.concat(state["days"], F.array(value)).alias("days"), growth.alias("growth"), (state["quoted"] | quoted).alias("quoted"))

    days = F.sequence(F.greatest(F.col("first_idx"), begin), F.least(F.col("_last"), begin + (BUCKET - 1)))
    parts = held.join(slots, [code, "_bucket"], "left").select(
        index, code, "anchor_date", F.col(weight).alias("anchor_weight"), *extra, "anchor_idx", "first_idx",
        F.struct("_bucket", F.aggregate(days, start, step).alias("part")).alias("_part"))

    # A row per anchor period; its days become rows last.
    period = parts.groupBy(index, code, "anchor_date", "anchor_weight", *extra, "anchor_idx", "first_idx").agg(
        F.transform(F.array_sort(F.array_distinct(F.collect_list("_part"))), lambda p: p["part"]).alias("_parts"))

    def grown(part, at):
        before = F.aggregate(F.slice("_parts", 1, at), F.lit(1.0), lambda growth, p: growth * p["growth"])
        return F.transform(part["days"], lambda d: F.struct((d["growth"] * before).alias("growth"), *(d[c].alias(c) for c in carried)))

    panel = period.select(
        index, code, "anchor_date", "anchor_weight", *extra, "anchor_idx", "first_idx",
        F.exists("_parts", lambda p: p["quoted"]).alias("has_quotes"),
        F.posexplode(F.flatten(F.transform("_parts", grown))).alias("_at", "_day"))
    return panel.withColumn("idx", F.col("first_idx") + F.col("_at")).join(
        F.broadcast(idx.withColumnRenamed("trade_date", date)), "idx").select(
        index, code, date, "anchor_date", "anchor_weight", *extra, *(F.col("_day")[c].alias(c) for c in carried),
        (F.col("idx") - F.col("anchor_idx")).cast("int").alias("days_since_anchor"),
        (F.col("anchor_weight") * F.col("_day")["growth"]).alias("raw_weight"), "has_quotes")


def _slots(returns: DataFrame, carry: DataFrame | None, idx: DataFrame, code: str, date: str) -> DataFrame:
    """Returns and carried measures of each code in arrays of ``BUCKET`` days, an entry per trading day: ``code, _bucket, _slots``."""
    carried = [c for c in carry.columns if c not in (code, date)] if carry is not None else []
    rows = returns.withColumn("_kind", F.lit("return"))
    if carry is not None:
        rows = rows.unionByName(carry.withColumn("_kind", F.lit("carry")), allowMissingColumns=True)
    dated = rows.join(F.broadcast(idx.withColumnRenamed("trade_date", date)), date)
    is_return, nothing = F.col("_kind") == "return", F.lit(None)
    entries = dated.groupBy(code, F.floor(F.col("idx") / BUCKET).alias("_bucket")).agg(
        F.map_from_entries(F.collect_list(F.when(is_return, F.struct("idx", F.struct(F.col("_ret").alias("ret")))))).alias("_returns"),
        (F.map_from_entries(F.collect_list(F.when(~is_return, F.struct("idx", F.struct(*carried))))) if carried else nothing).alias("_carried"))

    def slot(day):
        quote = F.try_element_at("_returns", day)
        more = [F.try_element_at("_carried", day)[c].alias(c) for c in carried]
        return F.struct(quote.isNotNull().alias("quoted"), quote["ret"].alias("ret"), *more)

    begin = (F.col("_bucket") * BUCKET).cast("int")
    return entries.select(code, "_bucket", F.transform(F.sequence(begin, begin + (BUCKET - 1)), slot).alias("_slots"))


def drop_unquoted(drifted: DataFrame) -> DataFrame:
    """Null raw weight for constituents that have no quote after their anchor.

    The anchor day keeps official weights.  Rows stay, so the loss can be counted.
    """
    live = F.col("has_quotes") | (F.col("days_since_anchor") == 0)
    return drifted.withColumn("raw_weight", F.when(live, F.col("raw_weight")))


def coverage_loss(drifted: DataFrame, index: str = "index_code", date: str = "trade_date") -> DataFrame:
    """Anchor weight lost to unquoted constituents, per index and day."""
    gone = ~F.col("has_quotes") & (F.col("days_since_anchor") > 0)
    return drifted.groupBy(index, date).agg(
        F.sum("anchor_weight").alias("total_weight"),
        F.coalesce(F.sum(F.when(gone, F.col("anchor_weight"))), F.lit(0.0)).alias("lost_weight"),
        F.count_if(gone).alias("lost_constituents"),
    ).withColumn("lost_share", F.try_divide("lost_weight", "total_weight"))


def normalize_weights(
    df: DataFrame, index: str = "index_code", date: str = "trade_date", raw: str = "raw_weight", name: str = "weight"
) -> DataFrame:
    """``raw / sum(raw)`` within the live universe of each index and day.

    The sums are a partial aggregate joined back, not a window: an (index, day)
    group of any size never has to sit in one task.  ``df`` is read twice, so
    pass an expensive plan through ``session.durable`` first; ``index_flow``
    needs no normalised rows at all.
    """
    totals = df.groupBy(index, date).agg(F.sum(raw).alias("_total"))
    return df.join(totals, [index, date], "left").withColumn(
        name, F.try_divide(raw, "_total")).drop("_total")


def next_day_flow(
    flow: DataFrame, calendar: DataFrame, code: str = "con_code", date: str = "trade_date", flow_col: str = "flow",
    calendar_col: str = "trade_date", name: str = "next_flow",
) -> DataFrame:
    """Flows moved to the trading day before, where the weights that apply to them stand."""
    back = F.broadcast(
        trading_offset(calendar, -1, calendar_col, "_previous").where(F.col("_previous").isNotNull())
        .withColumnRenamed("trade_date", date))
    return flow.join(back, date, "inner").select(code, F.col("_previous").alias(date), F.col(flow_col).alias(name))


def index_flow(
    weights: DataFrame, flow: DataFrame | None, calendar: DataFrame, index: str = "index_code", code: str = "con_code",
    date: str = "trade_date", raw: str = "raw_weight", flow_col: str = "flow", calendar_col: str = "trade_date",
    start=None, end=None, indices: DataFrame | None = None,
) -> DataFrame:
    """Index flow on day t with the weights of trading day t-1, and diagnostics.

    ``index_flow`` is ``sum(raw * flow) / sum(raw)``: normalising is folded into
    the aggregate, so only partial sums move after the flow join.  With ``flow``
    None the weights already carry ``next_flow`` (see ``drift_weights``) and
    nothing else of the panel's size is shuffled.

    Every trading day from an index's first day with weights has a row, within
    ``start`` to ``end``; a day without previous weights has ``weight_mode``
    ``missing`` and a null flow.
    ``days_since_anchor`` and ``weight_mode`` describe the weights, i.e. day t-1.
    ``indices`` lists the indices and days cheaply (the anchors, say) when
    ``weights`` is a plan that shouldn't run twice.
    """
    if flow is not None:
        moved = next_day_flow(flow, calendar, code, date, flow_col, calendar_col)
        weights = weights.join(moved, [code, date], "left")
    source = F.col("anchor_weight_source") if "anchor_weight_source" in weights.columns else F.lit(None).cast("string")
    w, f = F.col(raw), F.col("next_flow")
    # All sums in fixed-width buffers, so the panel is aggregated by hash, not sorted.
    partial = weights.groupBy(index, date, "anchor_date", source.alias("_source"), "days_since_anchor").agg(
        F.sum(w * f).alias("_num"), F.sum(w).alias("_den"),
        F.sum(F.when(f.isNotNull(), w)).alias("_covered"),
        F.count(F.lit(1)).alias("_rows"), F.count(w).alias("_weighted"),
    )
    # One row per (index, day) and anchor from here on.
    agg = partial.groupBy(index, date).agg(
        F.sum("_num").alias("_num"), F.sum("_den").alias("_den"), F.sum("_covered").alias("_covered"),
        F.max("anchor_date").alias("anchor_weight_date"),
        F.max_by("_source", "anchor_date").alias("anchor_weight_source"),
        F.max_by("days_since_anchor", "anchor_date").alias("days_since_anchor"),
        F.sum("_rows").alias("constituent_count"), F.sum("_weighted").alias("weighted_constituent_count"),
    )
    next_day = F.broadcast(
        trading_offset(calendar, 1, calendar_col, "_next").where(F.col("_next").isNotNull())
        .withColumnRenamed("trade_date", date))
    agg = agg.join(next_day, date, "inner").drop(date).withColumnRenamed("_next", date)
    asked = distinct_dates(calendar, calendar_col)
    if start is not None:
        asked = asked.where(F.col("trade_date") >= F.lit(parse_date(start)))
    if end is not None:
        asked = asked.where(F.col("trade_date") <= F.lit(parse_date(end)))
    all_days = asked.select(F.array_sort(F.collect_list("trade_date"))).scalar()
    first = (weights if indices is None else indices).groupBy(index).agg(F.min(date).alias("_first"))
    grid = first.withColumn("_days", all_days).select(index, F.explode(F.filter("_days", lambda d: d >= F.col("_first"))).alias(date))
    out = grid.join(agg, [index, date], "left")
    mode = (
        F.when(F.col("anchor_weight_date").isNull(), "missing")
        .when(F.col("days_since_anchor") == 0, "official")
        .otherwise("drifted")
    )
    return out.select(
        index, date, F.try_divide("_num", "_den").alias("index_flow"), mode.alias("weight_mode"),
        "anchor_weight_date", "anchor_weight_source", "days_since_anchor",
        F.coalesce("constituent_count", F.lit(0)).alias("constituent_count"),
        F.coalesce("weighted_constituent_count", F.lit(0)).alias("weighted_constituent_count"),
        F.try_divide(F.coalesce("_covered", F.when(F.col("_den").isNotNull(), F.lit(0.0))), "_den").alias(
            "moneyflow_weight_coverage_ratio"),
    )


def drift_error(
    estimated: DataFrame, official: DataFrame, top_n: int, index: str = "index_code", code: str = "con_code",
    date: str = "trade_date", weight: str = "weight", raw: bool = False,
) -> DataFrame:
    """Estimated against official weights on each official date that has estimates.

    ``mae_union`` averages the absolute error over the union of constituents, a
    missing side counting as 0.  ``top_overlap`` is the share of the official
    top ``top_n`` that the estimate's top ``top_n`` also names; ``coverage`` the
    share of official weight that has an estimate.  ``raw`` weights of either side
    are divided by their sum over the index and day first.

    Both sides' weights of a constituent meet in one map, made by one exchange per
    (index, day, constituent): sums, errors and both tops are read from it, so
    neither side's plan runs twice, and a hot (index, day) is never gathered.
    """
    group, whole = [index, date], [index, date, code]
    known = F.col(index).isNotNull() & F.col(date).isNotNull()
    days = official.where(known).select(*group).distinct()
    sides = [df.where(known).select(*whole, F.lit(side).alias("_side"), F.col(weight).cast("double").alias("_weight"))
             for side, df in (("e", estimated.join(days, group, "left_semi")), ("o", official))]
    pair = sides[0].unionByName(sides[1]).groupBy(*whole).agg(F.map_from_entries(F.collect_list(F.struct("_side", "_weight"))).alias("_of"))
    has = lambda side: F.map_contains_key("_of", side)
    value = lambda side: F.try_element_at("_of", F.lit(side))

    rows, est, off = pair, F.coalesce(value("e"), F.lit(0.0)), F.coalesce(value("o"), F.lit(0.0))
    if raw:
        sums = pair.groupBy(*group).agg(F.sum(value("e")).alias("_all_e"), F.sum(value("o")).alias("_all_o"))
        rows = pair.join(sums, group)
        est, off = (F.coalesce(F.try_divide(value(side), f"_all_{side}"), F.lit(0.0)) for side in "eo")
    error = F.abs(est - off)
    base = rows.groupBy(*group).agg(
        F.avg(error).alias("mae_union"), F.max(error).alias("max_abs_error"), F.count(F.lit(1)).alias("union_count"),
        F.count_if(has("e") & value("e").isNotNull()).alias("_n_est"), F.sum(F.when(value("e").isNotNull(), off)).alias("_seen"), F.sum(off).alias("_all"))
    tops = [top_k(pair.where(has(side)).select(*whole, value(side).alias("_weight")), group, [F.col("_weight").desc_nulls_last(), F.col(code)], top_n)
            .select(*whole, F.lit(side == "o").alias("_official")) for side in "eo"]
    named = tops[0].unionByName(tops[1]).groupBy(*whole).agg(F.count_if("_official").alias("_official"), F.count(F.lit(1)).alias("_n"))
    overlap = named.groupBy(*group).agg(F.try_divide(F.count_if(F.col("_n") > 1), F.sum("_official")).alias("top_overlap"))
    # One row per (index, day) on both sides.
    return base.where("_n_est > 0").join(overlap, group, "left").select(
        *group, "mae_union", "max_abs_error", "union_count", "top_overlap",
        F.try_divide(F.coalesce("_seen", F.lit(0.0)), "_all").alias("coverage"),
    )
