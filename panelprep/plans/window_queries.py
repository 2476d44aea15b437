"""Calendar, anchor and drift queries over orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelprep.operators import calendar, drift, joins
from panelprep.plans.oracle_parts import ANCHORS, CALENDAR, EVENT_CALENDAR, FLOWS, PRICES, SPANS, drift as drift_sql
from panelprep.plans.tables import (
    event_calendar, event_day, table, user_anchors, user_flows, user_prices, weekday_calendar,
)
from panelprep.session import durable


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def month_end_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.month_end_dates(weekday_calendar(table(spark, sf_dir, "orders")))


def snapshot_shape_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    out = calendar.snapshot_shape(orders, "o_orderdate", weekday_calendar(orders))
    return out.select(*[F.round(c, 6).alias(c) if c.endswith("share") else c for c in out.columns])


def keep_month_ends_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return calendar.keep_month_ends(orders, "o_orderdate", weekday_calendar(orders)).select(
        "o_orderkey", "o_orderdate", "o_totalprice")


def with_previous_anchor_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("index_code"), F.col("o_orderdate").cast("date").alias("trade_date")
    ).agg(F.round(F.sum("o_totalprice"), 2).alias("weight"))
    return calendar.with_previous_anchor(snapshots, "1998-01-01", "1998-06-30")


def trading_offset_query(n: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return calendar.trading_offset(weekday_calendar(table(spark, sf_dir, "orders")), n)

    return query


def assign_anchor_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    # Anchors per user this time: the user's days with a purchase above 60.
    days = events.select(F.col("user_id").alias("index_code"), event_day().alias("trade_date")).distinct()
    chosen = (F.col("event_type") == "purchase") & (F.col("value") > 60)
    anchors = events.select(F.col("user_id").alias("index_code"), F.when(chosen, event_day()).alias("trade_date"))
    return calendar.assign_anchor(days, anchors, event_calendar(events))


def return_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = user_prices(table(spark, sf_dir, "events"))
    return drift.return_from_price(prices).select(
        "con_code", "trade_date", F.round("close", 6).alias("close"), F.round("ret", 6).alias("ret"))


def return_adjusted_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third day has no adjusted price."""
    prices = user_prices(table(spark, sf_dir, "events")).withColumn(
        "adj", F.when(F.dayofmonth("trade_date") % 3 != 0, F.col("close") / (1 + F.pmod("con_code", F.lit(4)))))
    return drift.return_from_price(prices, adj_price="adj").select("con_code", "trade_date", F.round("ret", 6).alias("ret"))


def _returns(events: DataFrame) -> DataFrame:
    return drift.return_from_price(user_prices(events))


def _sparse_returns(events: DataFrame) -> DataFrame:
    """A user's day has a quote only if there's a purchase above 60, so many have none after an anchor."""
    quoted = F.when((F.col("event_type") == "purchase") & (F.col("value") > 60), F.col("value"))
    return drift.return_from_price(user_prices(events.withColumn("value", quoted)).where("close IS NOT NULL"))


def _drifted(events: DataFrame, through_next: bool = False) -> DataFrame:
    return drift.drift_weights(
        user_anchors(events), _returns(events), event_calendar(events), through_next=through_next)


def drift_weights_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _drifted(table(spark, sf_dir, "events"))
    return out.withColumn("raw_weight", F.round("raw_weight", 6))


def normalize_weights_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read twice, so written once to the shared checkpoint folder.
    drifted = durable(_drifted(table(spark, sf_dir, "events")).select("index_code", "con_code", "trade_date", "raw_weight"))
    out = drift.normalize_weights(drifted)
    return out.select("index_code", "con_code", "trade_date", F.round("weight", 6).alias("weight"))


def drop_unquoted_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    drifted = drift.drift_weights(user_anchors(events), _sparse_returns(events), event_calendar(events))
    return drift.drop_unquoted(drifted).select(
        "index_code", "con_code", "trade_date", "has_quotes", F.round("raw_weight", 6).alias("raw_weight"))


def coverage_loss_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    drifted = drift.drift_weights(user_anchors(events), _sparse_returns(events), event_calendar(events))
    out = drift.coverage_loss(drifted)
    return out.withColumn("lost_share", F.round("lost_share", 6))


def index_flow_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: anchor, drift, drop unquoted, lag by a trading day, aggregate flows, diagnose.

    The calendar and the anchors are small inputs with several readers, so each
    is written once; the panel itself is shuffled for the returns and flows, for
    the product window, and then only as partial sums.
    """
    events = table(spark, sf_dir, "events")
    days = durable(event_calendar(events))
    anchors = durable(user_anchors(events).withColumn("anchor_weight_source", F.lit("event_count")))
    flows = drift.next_day_flow(user_flows(events), days)
    drifted = drift.drop_unquoted(drift.drift_weights(anchors, _returns(events), days, carry=flows))
    return _rounded_flow(drift.index_flow(drifted, None, days, indices=anchors))


def index_flow_of_weights_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from weights and flows as separate inputs."""
    events = table(spark, sf_dir, "events")
    days = event_calendar(events)
    anchors = user_anchors(events).withColumn("anchor_weight_source", F.lit("event_count"))
    drifted = drift.drop_unquoted(drift.drift_weights(anchors, _returns(events), days))
    return _rounded_flow(drift.index_flow(drifted, user_flows(events), days, indices=anchors))


FLOW_START, FLOW_END = "2024-01-10", "2024-01-30"


def index_flow_by_source_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship by the book: weight sources by priority, the anchor before the range, drift, flow.

    Purchases are the better weights, but only three of the five indices have them.
    """
    events = table(spark, sf_dir, "events")
    days = durable(event_calendar(events))
    bought = F.when((F.col("event_type") == "purchase") & (F.col("user_id") % 5 < 3), F.col("user_id"))
    better = user_anchors(events.withColumn("user_id", bought)).where("con_code IS NOT NULL")
    sourced = joins.first_available([("purchase_count", better), ("event_count", user_anchors(events))], ["index_code", "trade_date"])
    anchors = durable(calendar.with_previous_anchor(sourced.withColumnRenamed("source", "anchor_weight_source"), FLOW_START, FLOW_END))
    flows = drift.next_day_flow(user_flows(events), days)
    drifted = drift.drop_unquoted(drift.drift_weights(anchors, _returns(events), days, carry=flows))
    return _rounded_flow(drift.index_flow(drifted, None, days, start=FLOW_START, end=FLOW_END, indices=anchors))


def _rounded_flow(out: DataFrame) -> DataFrame:
    return out.select(*[
        F.round(c, 6).alias(c) if c in ("index_flow", "moneyflow_weight_coverage_ratio") else c for c in out.columns])


def drift_error_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    estimated = _drifted(events, through_next=True).where("days_since_anchor > 0").select(
        "index_code", "con_code", "trade_date", F.col("raw_weight").alias("weight"))
    out = drift.drift_error(estimated, user_anchors(events), 10, raw=True)
    return out.select(*[
        F.round(c, 6).alias(c) if c not in ("index_code", "trade_date", "union_count") else c for c in out.columns])


QUERIES = {
    "month_end_dates": month_end_query,
    "snapshot_shape": snapshot_shape_query,
    "keep_month_ends": keep_month_ends_query,
    "with_previous_anchor": with_previous_anchor_query,
    "trading_offset_next": trading_offset_query(1),
    "trading_offset_back": trading_offset_query(-5),
    "assign_anchor": assign_anchor_query,
    "return_from_price": return_query,
    "return_from_adjusted_price": return_adjusted_query,
    "drift_weights": drift_weights_query,
    "normalize_weights": normalize_weights_query,
    "drop_unquoted": drop_unquoted_query,
    "coverage_loss": coverage_loss_query,
    "index_flow": index_flow_query,
    "index_flow_of_weights": index_flow_of_weights_query,
    "index_flow_by_source": index_flow_by_source_query,
    "drift_error": drift_error_query,
}

_ENDS = "ends AS (SELECT date_trunc('month', trade_date) AS m, max(trade_date) AS trade_date FROM cal GROUP BY 1)"
_DRIFTED = f"{EVENT_CALENDAR}, {PRICES}, {ANCHORS}, {SPANS}"
_SPARSE = """
spx AS (SELECT user_id AS con_code, CAST(ts AS DATE) AS trade_date, 100 + avg(value) AS close
        FROM events WHERE event_type = 'purchase' AND value > 60 GROUP BY 1, 2),
sret AS (SELECT con_code, trade_date, close / lag(close) OVER (PARTITION BY con_code ORDER BY trade_date) - 1 AS ret
         FROM spx)"""

ORACLES = {
    "month_end_dates": f"WITH {CALENDAR}, {_ENDS} SELECT CAST(m AS DATE) AS month, trade_date FROM ends",
    "snapshot_shape": f"""WITH {CALENDAR}, {_ENDS},
        d AS (SELECT CAST(o_orderdate AS DATE) AS trade_date, count(*) AS n FROM orders GROUP BY 1),
        f AS (SELECT d.*, trade_date IN (SELECT trade_date FROM ends) AS is_end,
                     trade_date IN (SELECT trade_date FROM cal) AS in_cal FROM d),
        span AS (SELECT count(*) AS n_cal FROM cal WHERE trade_date BETWEEN (SELECT min(trade_date) FROM d)
                 AND (SELECT max(trade_date) FROM d)),
        t AS (SELECT count(*) AS n_dates, count(*) FILTER (is_end) AS n_month_end_dates, CAST(sum(n) AS BIGINT) AS n_rows,
              CAST(coalesce(sum(n) FILTER (is_end), 0) AS BIGINT) AS n_month_end_rows,
              (SELECT n_cal FROM span) AS n_calendar_dates, count(*) FILTER (in_cal) AS n_calendar_dates_present FROM f)
        SELECT *, round(n_month_end_dates / n_dates, 6) AS date_share, round(n_month_end_rows / n_rows, 6) AS row_share,
            round(n_calendar_dates_present / n_calendar_dates, 6) AS calendar_share,
            CASE WHEN n_month_end_rows / n_rows >= 0.95 THEN 'monthly_snapshot'
                 WHEN n_calendar_dates_present / n_calendar_dates >= 0.5 THEN 'daily' ELSE 'mixed' END AS shape FROM t""",
    "keep_month_ends": f"""WITH {CALENDAR}, {_ENDS} SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice
        FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT trade_date FROM ends)""",
    "with_previous_anchor": """WITH s AS (SELECT o_custkey AS index_code, CAST(o_orderdate AS DATE) AS trade_date,
            round(sum(o_totalprice), 2) AS weight FROM orders GROUP BY 1, 2),
        p AS (SELECT index_code, max(trade_date) AS trade_date FROM s WHERE trade_date < DATE '1998-01-01' GROUP BY 1)
        SELECT * FROM s WHERE trade_date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'
        UNION ALL SELECT s.* FROM s JOIN p USING (index_code, trade_date)""",
    "trading_offset_next": f"""WITH {CALENDAR} SELECT trade_date,
        lead(trade_date) OVER (ORDER BY trade_date) AS offset_date FROM cal""",
    "trading_offset_back": f"""WITH {CALENDAR} SELECT trade_date,
        lag(trade_date, 5) OVER (ORDER BY trade_date) AS offset_date FROM cal""",
    "assign_anchor": f"""WITH {EVENT_CALENDAR}, d AS (SELECT DISTINCT user_id AS index_code, CAST(ts AS DATE) AS trade_date
            FROM events), a AS (SELECT DISTINCT user_id AS index_code, CAST(ts AS DATE) AS anchor_date FROM events
            WHERE event_type = 'purchase' AND value > 60),
        m AS (SELECT d.index_code, d.trade_date, max(anchor_date) AS anchor_date FROM d LEFT JOIN a
              ON a.index_code = d.index_code AND anchor_date <= trade_date GROUP BY 1, 2)
        SELECT index_code, m.trade_date, anchor_date, CAST(x.idx - y.idx AS INTEGER) AS days_since_anchor
        FROM m JOIN ecal x ON x.trade_date = m.trade_date LEFT JOIN ecal y ON y.trade_date = anchor_date""",
    "return_from_price": f"""WITH {PRICES} SELECT con_code, trade_date, round(close, 6) AS close, round(ret, 6) AS ret
        FROM ret JOIN px USING (con_code, trade_date)""",
    "return_from_adjusted_price": f"""WITH {PRICES}, a AS (SELECT *, CASE WHEN day(trade_date) % 3 <> 0 THEN close / (1 + con_code % 4) END AS adj FROM px)
        SELECT con_code, trade_date, round(coalesce(adj / lag(adj) OVER w, close / lag(close) OVER w) - 1, 6) AS ret
        FROM a WINDOW w AS (PARTITION BY con_code ORDER BY trade_date)""",
    "drift_weights": f"""WITH {_DRIFTED}, {drift_sql()} SELECT index_code, con_code, trade_date, anchor_date, anchor_weight,
        CAST(days_since_anchor AS INTEGER) AS days_since_anchor, round(raw_weight, 6) AS raw_weight, has_quotes FROM drifted""",
    "normalize_weights": f"""WITH {_DRIFTED}, {drift_sql()} SELECT index_code, con_code, trade_date,
        round(raw_weight / sum(raw_weight) OVER (PARTITION BY index_code, trade_date), 6) AS weight FROM drifted""",
    "drop_unquoted": f"""WITH {_DRIFTED}, {_SPARSE}, {drift_sql('sret')} SELECT index_code, con_code, trade_date, has_quotes,
        CASE WHEN has_quotes OR days_since_anchor = 0 THEN round(raw_weight, 6) END AS raw_weight FROM drifted""",
    "coverage_loss": f"""WITH {_DRIFTED}, {_SPARSE}, {drift_sql('sret')},
        t AS (SELECT index_code, trade_date, sum(anchor_weight) AS total_weight,
            coalesce(sum(anchor_weight) FILTER (NOT has_quotes AND days_since_anchor > 0), 0) AS lost_weight,
            count(*) FILTER (NOT has_quotes AND days_since_anchor > 0) AS lost_constituents FROM drifted GROUP BY 1, 2)
        SELECT *, round(lost_weight / total_weight, 6) AS lost_share FROM t""",
    "index_flow": f"""WITH {_DRIFTED}, {FLOWS}, {drift_sql()},
        live AS (SELECT * REPLACE (CASE WHEN has_quotes OR days_since_anchor = 0 THEN raw_weight END AS raw_weight)
                 FROM drifted),
        lagged AS (SELECT l.* REPLACE (n.trade_date AS trade_date), f.flow FROM live l
            JOIN ecal c ON c.trade_date = l.trade_date JOIN ecal n ON n.idx = c.idx + 1
            LEFT JOIN flow f ON f.con_code = l.con_code AND f.trade_date = n.trade_date),
        g AS (SELECT index_code, trade_date, sum(raw_weight * flow) / nullif(sum(raw_weight), 0) AS index_flow,
            max(anchor_date) AS anchor_weight_date, max(days_since_anchor) AS days_since_anchor, count(*) AS cc,
            count(raw_weight) AS wc,
            coalesce(sum(raw_weight) FILTER (flow IS NOT NULL), 0) / sum(raw_weight) AS ratio FROM lagged GROUP BY 1, 2)
        SELECT i.index_code, c.trade_date, round(index_flow, 6) AS index_flow,
            CASE WHEN anchor_weight_date IS NULL THEN 'missing' WHEN days_since_anchor = 0 THEN 'official'
                 ELSE 'drifted' END AS weight_mode, anchor_weight_date,
            CASE WHEN anchor_weight_date IS NOT NULL THEN 'event_count' END AS anchor_weight_source,
            CAST(days_since_anchor AS INTEGER) AS days_since_anchor, coalesce(cc, 0) AS constituent_count,
            coalesce(wc, 0) AS weighted_constituent_count, round(ratio, 6) AS moneyflow_weight_coverage_ratio
        FROM (SELECT DISTINCT index_code FROM anchors) i CROSS JOIN ecal c
        LEFT JOIN g ON g.index_code = i.index_code AND g.trade_date = c.trade_date""",
    "drift_error": f"""WITH {_DRIFTED}, {drift_sql(through_next=True)},
        est AS (SELECT index_code, trade_date, con_code,
                raw_weight / sum(raw_weight) OVER (PARTITION BY index_code, trade_date) AS w
                FROM drifted WHERE days_since_anchor > 0),
        off AS (SELECT index_code, trade_date, con_code,
                weight / sum(weight) OVER (PARTITION BY index_code, trade_date) AS w FROM anchors),
        days AS (SELECT DISTINCT index_code, trade_date FROM est JOIN (SELECT DISTINCT index_code, trade_date FROM off)
                 USING (index_code, trade_date)),
        p AS (SELECT index_code, trade_date, con_code, e.w AS ew, o.w AS ow
              FROM (SELECT est.* FROM est JOIN days USING (index_code, trade_date)) e
              FULL JOIN (SELECT off.* FROM off JOIN days USING (index_code, trade_date)) o
              USING (index_code, trade_date, con_code)),
        te AS (SELECT * FROM est QUALIFY row_number() OVER (PARTITION BY index_code, trade_date ORDER BY w DESC, con_code) <= 10),
        tof AS (SELECT * FROM off QUALIFY row_number() OVER (PARTITION BY index_code, trade_date ORDER BY w DESC, con_code) <= 10),
        ov AS (SELECT index_code, trade_date, count(te.con_code) / count(*) AS top_overlap FROM tof
               LEFT JOIN te USING (index_code, trade_date, con_code) GROUP BY 1, 2)
        SELECT index_code, trade_date, round(avg(abs(coalesce(ew, 0) - coalesce(ow, 0))), 6) AS mae_union,
            round(max(abs(coalesce(ew, 0) - coalesce(ow, 0))), 6) AS max_abs_error, count(*) AS union_count,
            round(any_value(top_overlap), 6) AS top_overlap,
            round(coalesce(sum(ow) FILTER (ew IS NOT NULL), 0) / sum(ow), 6) AS coverage
        FROM p LEFT JOIN ov USING (index_code, trade_date) GROUP BY 1, 2""",
}
ORACLES["index_flow_of_weights"] = ORACLES["index_flow"]
_SOURCED = """
counted AS (SELECT user_id % 5 AS index_code, user_id AS con_code, CAST(ts AS DATE) AS trade_date, CAST(count(*) AS DOUBLE) AS weight,
        CAST(count(*) FILTER (event_type = 'purchase' AND user_id % 5 < 3) AS DOUBLE) AS better
    FROM events WHERE day(ts) IN (1, 16) GROUP BY 1, 2, 3),
chosen AS (SELECT *, max(better) OVER (PARTITION BY index_code, trade_date) > 0 AS has_better FROM counted),
anchors AS (SELECT index_code, con_code, trade_date, CASE WHEN has_better THEN better ELSE weight END AS weight,
        CASE WHEN has_better THEN 'purchase_count' ELSE 'event_count' END AS source
    FROM chosen WHERE NOT has_better OR better > 0)"""
ORACLES["index_flow_by_source"] = ORACLES["index_flow"].replace(ANCHORS, _SOURCED).replace(
    "CASE WHEN anchor_weight_date IS NOT NULL THEN 'event_count' END",
    "(SELECT any_value(source) FROM anchors a WHERE a.index_code = i.index_code AND a.trade_date = anchor_weight_date)",
) + f" WHERE c.trade_date BETWEEN DATE '{FLOW_START}' AND DATE '{FLOW_END}'"
