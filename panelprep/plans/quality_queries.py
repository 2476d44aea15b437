"""Validation checks over the given tables and logs derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelprep.operators import quality
from panelprep.plans.oracle_parts import customer_code as code_sql, family
from panelprep.plans.tables import customer_code, event_day, table
from panelprep.sources import Between

WINDOW = Between("1995-01-01", "1997-12-31")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, with nulls where a discount or tax is zero."""
    zero_to_null = [F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in ("l_discount", "l_tax")]
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate", *zero_to_null)


def shape_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.shape(table(spark, sf_dir, "lineitem"))


def date_span_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.date_span(table(spark, sf_dir, "lineitem"), "l_shipdate")


def date_span_by_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.date_span(table(spark, sf_dir, "orders"), "o_orderdate", "o_custkey")


def duplicate_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def null_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(_lineitem(spark, sf_dir), 0.1).withColumn("null_ratio", F.round("null_ratio", 6))


def filter_violations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = {"l_shipdate": Between("1996-01-01", "1996-12-31"), "l_returnflag": ["A", "N", "R"], "l_discount": 0.05}
    return quality.filter_violations(_lineitem(spark, sf_dir), params)


def validation_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    spec = quality.ReportSpec(
        key=["l_orderkey", "l_linenumber"], date_col="l_shipdate", null_threshold=0.1,
        params={"l_shipdate": WINDOW, "l_returnflag": ["A", "N"]}, requested=asked, requested_key="l_orderkey",
        contract=["l_orderkey", "L_QUANTITY", "l_comment", "l_linenumber", "l_shipdate", "l_tax", "l_discount"])
    return quality.validation_report(_lineitem(spark, sf_dir), spec)


def code_coverage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "customer").select(customer_code(F.col("c_custkey")).alias("code"))
    # Only large orders name a code, so some customers have no row.
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_totalprice") > 400000, customer_code(F.col("o_custkey"))).alias("code"))
    return quality.code_coverage(asked, orders, "code")


def coverage_by_family_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.coverage_by_family(code_coverage_query(spark, sf_dir))
    return out.withColumn("coverage_ratio", F.round("coverage_ratio", 6))


def page_limit_check_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A request is a user's pull of one event type, a page is a day of it.
    pages = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("api_name"), F.col("user_id").alias("request"), event_day().alias("page")
    ).agg(F.count(F.lit(1)).alias("rows"))
    limits = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("api_name")).agg(
        F.concat(F.lit("单次最大"), F.dayofmonth(F.min("ts")).cast("string"), F.lit(",000行")).alias("limit_text"))
    return quality.page_limit_check(pages, limits)


def failure_verdict_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    error = (
        F.when(k < 10, "HTTP Error 503: busy").when(k < 15, "IncompleteRead(0 bytes read)")
        .when(k < 16, "接口不存在").when(k < 18, "bad field 5030"))
    attempts = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("api"), F.col("user_id").alias("request"), error.alias("error"),
        F.greatest(k.cast("long") - 85, F.lit(0).cast("long")).alias("rows"))
    return quality.failure_verdict(attempts)


def compare_sources_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    # A source is an event type; cheap purchases name no code.
    a = events.where("event_type = 'purchase'").withColumn("user_id", F.when(F.col("value") > 60, F.col("user_id")))
    b = events.where("event_type = 'click'")
    return quality.compare_sources(a, b, "user_id", "ts", ("purchase", "click"))


def latest_complete_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # From the 25th on only purchases have arrived with their user.
    arrived = (event_day() < F.lit("2024-01-25").cast("date")) | (F.col("event_type") == "purchase")
    late = table(spark, sf_dir, "events").withColumn("user_id", F.when(arrived, F.col("user_id")))
    return quality.latest_complete_date(late, "ts", "user_id", 0.95, 10)


QUERIES = {
    "shape": shape_query,
    "date_span": date_span_query,
    "date_span_by_code": date_span_by_query,
    "duplicate_keys": duplicate_keys_query,
    "null_profile": null_profile_query,
    "filter_violations": filter_violations_query,
    "validation_report": validation_report_query,
    "code_coverage": code_coverage_query,
    "coverage_by_family": coverage_by_family_query,
    "page_limit_check": page_limit_check_query,
    "failure_verdict": failure_verdict_query,
    "compare_sources": compare_sources_query,
    "latest_complete_date": latest_complete_date_query,
}

_LI = """li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate,
        nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem)"""
_LI_COLUMNS = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate", "l_discount", "l_tax")
_COVERAGE = f"""cov AS (SELECT a.code, {family('a.code')} AS code_family, count(o.code) AS n_rows,
        count(o.code) > 0 AS covered
    FROM (SELECT {code_sql('c_custkey')} AS code FROM customer) a
    LEFT JOIN (SELECT CASE WHEN o_totalprice > 400000 THEN {code_sql('o_custkey')} END AS code FROM orders) o ON a.code = o.code
    GROUP BY 1)"""


def _nulls_sql(select: str) -> str:
    return " UNION ALL ".join(select.format(c=c) for c in _LI_COLUMNS)


def _dense_report() -> str:
    parts = [
        "SELECT 'row_count' AS check_name, '*' AS subject, CAST(count(*) AS VARCHAR) AS value, 'ok' AS status FROM li",
        f"SELECT 'column_count', '*', '{len(_LI_COLUMNS)}', 'info'",
        _nulls_sql("""SELECT 'null_count', '{c}', CAST(count(*) - count({c}) AS VARCHAR),
            CASE WHEN (count(*) - count({c})) / count(*) < 0.1 THEN 'ok' ELSE 'warn' END FROM li"""),
        """SELECT 'filter_violations', 'l_shipdate', CAST(count(*) FILTER (l_shipdate NOT BETWEEN DATE '1995-01-01'
            AND DATE '1997-12-31') AS VARCHAR), 'warn' FROM li""",
        """SELECT 'filter_violations', 'l_returnflag', CAST(count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS VARCHAR),
            'warn' FROM li""",
        """SELECT 'contract_diff', f, s, CASE WHEN s = 'match' THEN 'ok' ELSE 'warn' END FROM (VALUES ('l_orderkey', 'match'),
            ('L_QUANTITY', 'case_only'), ('l_comment', 'documented_absent'), ('l_linenumber', 'match'), ('l_shipdate', 'match'),
            ('l_tax', 'match'), ('l_discount', 'match'), ('l_returnflag', 'present_undocumented')) AS d(f, s)""",
        "SELECT 'min_date', 'l_shipdate', CAST(min(l_shipdate) AS VARCHAR), 'info' FROM li",
        "SELECT 'max_date', 'l_shipdate', CAST(max(l_shipdate) AS VARCHAR), 'info' FROM li",
        "SELECT 'distinct_dates', 'l_shipdate', CAST(count(DISTINCT l_shipdate) AS VARCHAR), 'info' FROM li",
        "SELECT 'duplicate_keys', 'l_orderkey,l_linenumber', CAST(count(*) AS VARCHAR), 'warn' FROM dup",
        "SELECT 'excess_rows', 'l_orderkey,l_linenumber', CAST(CAST(sum(n - 1) AS BIGINT) AS VARCHAR), 'warn' FROM dup",
        "SELECT 'requested_codes', 'l_orderkey', CAST(count(*) AS VARCHAR), 'info' FROM orders",
        """SELECT 'zero_row_codes', 'l_orderkey', CAST(count(*) AS VARCHAR), 'warn' FROM orders
            WHERE o_orderkey NOT IN (SELECT l_orderkey FROM li)""",
    ]
    return f"""WITH {_LI}, dup AS (SELECT count(*) AS n FROM li GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
        {' UNION ALL '.join(parts)}"""


ORACLES = {
    "shape": """SELECT count(*) AS n_rows, 11 AS n_columns, 'l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate' AS column_names FROM lineitem""".replace(
            "\n        l_ext", " l_ext").replace("\n        l_extendedprice", " l_extendedprice"),
    "date_span": """SELECT CAST(min(l_shipdate) AS DATE) AS min_date, CAST(max(l_shipdate) AS DATE) AS max_date,
        count(DISTINCT CAST(l_shipdate AS DATE)) AS n_dates, count(*) AS n_rows FROM lineitem""",
    "date_span_by_code": """SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS min_date,
        CAST(max(o_orderdate) AS DATE) AS max_date, count(DISTINCT CAST(o_orderdate AS DATE)) AS n_dates,
        count(*) AS n_rows FROM orders GROUP BY 1""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(*) - 1 AS excess_rows
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "null_profile": f"WITH {_LI} " + _nulls_sql(
        """SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,
        round((count(*) - count({c})) / count(*), 6) AS null_ratio,
        (count(*) - count({c})) / count(*) >= 0.1 AS null_heavy FROM li"""),
    "filter_violations": f"""WITH {_LI}, v AS (SELECT count(*) AS n_rows,
            count(*) FILTER (year(l_shipdate) <> 1996) AS a, count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R')) AS b,
            count(*) FILTER (l_discount IS NULL OR l_discount <> 0.05) AS c FROM li)
        SELECT 'l_shipdate' AS param, n_rows, a AS violations, a = 0 AS honoured FROM v
        UNION ALL SELECT 'l_returnflag', n_rows, b, b = 0 FROM v UNION ALL SELECT 'l_discount', n_rows, c, c = 0 FROM v""",
    "validation_report": _dense_report(),
    "code_coverage": f"WITH {_COVERAGE} SELECT * FROM cov",
    "coverage_by_family": f"""WITH {_COVERAGE} SELECT code_family, count(*) AS requested,
        count(*) FILTER (covered) AS covered_codes, CAST(sum(n_rows) AS BIGINT) AS n_rows,
        round(count(*) FILTER (covered) / count(*), 6) AS coverage_ratio FROM cov GROUP BY 1""",
    "page_limit_check": """WITH pages_log AS (SELECT event_type AS api_name, user_id AS request, CAST(ts AS DATE) AS page,
            count(*) AS n FROM events GROUP BY 1, 2, 3),
        req AS (SELECT api_name, request, count(*) AS pages, max(n) AS most, min(n) AS least FROM pages_log GROUP BY 1, 2),
        api AS (SELECT api_name, CAST(sum(pages) AS BIGINT) AS n_pages, max(most) AS max_rows,
                max(most) FILTER (most = least AND pages > 1) AS flat FROM req GROUP BY 1),
        lim AS (SELECT event_type AS api_name, day(min(ts)) * 1000 AS documented_limit FROM events GROUP BY 1)
        SELECT api_name, n_pages, max_rows, documented_limit, max_rows = documented_limit AS limit_observed,
               max_rows > documented_limit AS limit_exceeded, coalesce(flat = max_rows, false) AS suspicious
        FROM api JOIN lim USING (api_name)""",
    "failure_verdict": """WITH a AS (SELECT event_type AS api, user_id AS request,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
        s AS (SELECT api, request, count(*) AS attempts, count(*) FILTER (k < 18) AS failures,
            count(*) FILTER (k < 15) AS transient_failures, count(*) FILTER (k = 15) AS gone,
            max(CASE WHEN k >= 18 THEN CAST(greatest(k - 85, 0) AS BIGINT) END) AS max_rows FROM a GROUP BY 1, 2)
        SELECT api, request, attempts, failures, transient_failures, max_rows,
            CASE WHEN gone > 0 THEN 'missing' WHEN failures > 0 AND failures = transient_failures THEN 'flaky'
                 WHEN failures > 0 THEN 'structural' WHEN coalesce(max_rows, 0) = 0 THEN 'zero_rows' ELSE 'ok' END AS verdict
        FROM s""",
    "compare_sources": """WITH a AS (SELECT event_type AS source, CASE WHEN event_type = 'click' OR value > 60 THEN user_id END AS user_id,
            CAST(ts AS DATE) AS d FROM events WHERE event_type IN ('purchase', 'click')),
        both_codes AS (SELECT user_id FROM a WHERE user_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source) = 2)
        SELECT source, count(*) AS n_rows, count(DISTINCT user_id) AS n_codes, min(d) AS min_date, max(d) AS latest_date,
               (SELECT count(*) FROM both_codes) AS shared_codes FROM a GROUP BY 1""",
    "latest_complete_date": """WITH d AS (SELECT CAST(ts AS DATE) AS trade_date, count(DISTINCT CASE
            WHEN CAST(ts AS DATE) < DATE '2024-01-25' OR event_type = 'purchase' THEN user_id END) AS n_codes FROM events GROUP BY 1),
        n AS (SELECT *, avg(n_codes) OVER (ORDER BY trade_date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS norm FROM d),
        c AS (SELECT * FROM n WHERE norm IS NULL OR n_codes >= 0.95 * norm)
        SELECT max(trade_date) AS latest_complete_date, arg_max(n_codes, trade_date) AS n_codes,
               count(*) AS n_complete_dates FROM c""",
}
