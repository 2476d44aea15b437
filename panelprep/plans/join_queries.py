"""Code normalisation and joins over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelprep.functions import code_family, hierarchy_key, hk_default, hk_key, to_raw_code
from panelprep.operators import codes, joins, quality
from panelprep.plans.oracle_parts import CUSTOMER_DAYS, SPELLS, customer_code as code_sql, family
from panelprep.plans.tables import customer_code, customer_days, customer_spells, event_day, table


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_custkey", "c_acctbal", customer_code(F.col("c_custkey")).alias("code"))


def code_family_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir).select(
        "c_custkey", "code", code_family("code").alias("family"), to_raw_code("code").alias("raw"))


def normalize_hk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The observed table writes the codes of customers with finished orders without padding,
    # and others' not at all.
    unpadded = F.when(F.col("o_orderstatus") == "F", F.concat(F.col("o_custkey").cast("string"), F.lit(".HK")))
    observed = table(spark, sf_dir, "orders").select(unpadded.alias("seen_code"))
    return codes.normalize_hk(_coded(spark, sf_dir), observed, "code", "seen_code").select(
        "c_custkey", "code", "code_norm", hk_key("code").alias("hk_key"))


def family_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(customer_code(F.col("o_custkey")).alias("code"))
    return quality.family_profile(orders, "code")


def align_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = codes.align_columns(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey"),
        {"O_ORDERDATE": "trade_date", "o_CustKey": "con_code", "absent": "x"})
    return out.withColumn("trade_date", F.col("trade_date").cast("date"))


def _industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a compact 10-character code from their region, nation and key."""
    nation = table(spark, sf_dir, "nation")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    code = F.concat(
        F.lit("76"), two(F.col("n_regionkey")), two(F.col("c_nationkey")),
        two(F.pmod("c_custkey", F.lit(100))), F.lit("00"))
    return table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_acctbal", code.alias("ind_code"))


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    regions = table(spark, sf_dir, "region").select(
        F.rpad(F.concat(F.lit("76"), two(F.col("r_regionkey"))), 16, "0").alias("code"),
        F.lit(2).alias("levelnum"), F.col("r_name").alias("name"))
    # A nation without a code has no partner.
    known = F.when(F.col("n_nationkey") != 7, F.rpad(F.concat(F.lit("76"), two(F.col("n_regionkey")), two(F.col("n_nationkey"))), 16, "0"))
    nations = table(spark, sf_dir, "nation").select(known.alias("code"), F.lit(3).alias("levelnum"), F.col("n_name").alias("name"))
    low = _industry(spark, sf_dir).groupBy(F.rpad(F.substring("ind_code", 1, 8), 16, "0").alias("code")).agg(
        F.lit(4).alias("levelnum"), F.concat(F.lit("group of "), F.min("c_custkey").cast("string")).alias("name"))
    # Industries whose smallest customer has an odd key aren't in the dictionary.
    low = low.withColumn("code", F.when(F.substring("name", -1, 1).isin("0", "2", "4", "6", "8"), F.col("code")))
    return regions.unionByName(nations).unionByName(low)


def hierarchy_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _industry(spark, sf_dir).select(
        "c_custkey", *[hierarchy_key("ind_code", level).alias(f"level{level}") for level in (1, 2, 3)])


def hierarchy_join_query(level: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return joins.hierarchy_join(_industry(spark, sf_dir), _dictionary(spark, sf_dir), level).drop("c_acctbal")

    return query


def hierarchy_rollup_query(level: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = joins.hierarchy_rollup(_industry(spark, sf_dir), level, {"balance": "c_acctbal"})
        return out.withColumn("balance", F.round("balance", 2))

    return query


def interval_join_query(end_inclusive: bool, how: str = "inner"):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = table(spark, sf_dir, "orders")
        days, spells = customer_days(table(spark, sf_dir, "customer"), orders), customer_spells(orders)
        return joins.interval_join(
            days, spells, "code", "trade_date", "entry_dt", "remove_dt", end_inclusive=end_inclusive, how=how)

    return query


def interval_semantics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Spells as stored, plus the raw order days as zero-length spells: all kinds of transitions.
    orders = table(spark, sf_dir, "orders")
    extra = orders.select(
        F.col("o_custkey").alias("code"), F.col("o_orderdate").cast("date").alias("entry_dt"),
        F.date_add(F.col("o_orderdate").cast("date"), F.pmod("o_orderkey", F.lit(90)).cast("int") - 3).alias("remove_dt"))
    both = customer_spells(orders).drop("status").unionByName(extra)
    out = joins.interval_semantics(both, "code", "entry_dt", "remove_dt")
    return out.withColumn("inclusive_share", F.round("inclusive_share", 6)).withColumn(
        "exclusive_share", F.round("exclusive_share", 6))


def point_in_time_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    facts = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("code"),
        F.date_add(day, F.pmod("o_orderkey", F.lit(60)).cast("int")).alias("ann_dt"),
        F.trunc(day, "MM").alias("report_period"), "o_orderkey", "o_totalprice")
    return joins.point_in_time(customer_days(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")), facts, "code")


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer is listed from the first order; without one in 1999 or later it's delisted."""
    day = F.col("o_orderdate").cast("date")
    life = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("code")).agg(
        F.min(day).alias("listdate"), F.max(day).alias("last_day"))
    gone = F.col("last_day") < F.lit("2001-01-01").cast("date")
    return life.select(
        "code", "listdate", F.when(gone, F.date_add("last_day", 1)).alias("delistdate"),
        F.when(gone, "D").otherwise("L").alias("list_status"))


def _quarter_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(F.trunc(day, "quarter").alias("trade_date")).distinct()


def as_of_universe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.as_of_universe(_master(spark, sf_dir), _quarter_starts(spark, sf_dir))


def survivorship_gap_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.survivorship_gap(_master(spark, sf_dir), _quarter_starts(spark, sf_dir))


def metadata_without_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("code"), "o_orderstatus")
    data = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("code"))
    return joins.metadata_without_rows(meta, data, "code")


def _status_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "F", 1)
    label = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "交易").when(F.col("o_orderpriority") == "2-HIGH", "XD")
        .otherwise("停牌"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", code.alias("tradestatuscode"), label.alias("tradestatus"))


def tradeable_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.tradeable(_status_quotes(spark, sf_dir)).select("o_orderkey", "is_tradeable")


def status_disagreement_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.status_disagreement(_status_quotes(spark, sf_dir))


def suspension_check_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("day", event_day())
    suspensions = events.where("event_type = 'error'").select(
        F.col("user_id").alias("code"), "event_id", F.col("day").alias("suspend_date"),
        F.when(F.col("value") > 80, F.date_add("day", 2)).alias("resump_date"))
    quotes = events.groupBy(F.col("user_id").alias("code"), F.col("day").alias("trade_date")).agg(
        F.count_if((F.col("event_type") == "purchase") & (F.col("value") > 60)).alias("trades")
    ).withColumn("is_tradeable", F.col("trades") > 0)
    return joins.suspension_check(suspensions, quotes, "code")


def route_by_market_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        customer_code(F.col("o_custkey")).alias("con_code"), F.col("o_orderdate").cast("date").alias("trade_date"),
        "o_orderstatus", "o_totalprice")
    # A market quotes its own family; orders in another state are quoted a day late.
    def market(status: str, family_name: str) -> DataFrame:
        day = F.when(F.col("o_orderstatus") == status, F.col("trade_date")).otherwise(F.date_add("trade_date", 1))
        return orders.where(code_family("con_code") == family_name).groupBy("con_code", day.alias("trade_date")).agg(
            F.max("o_totalprice").alias("close"))

    constituents = orders.select("con_code", "trade_date").distinct()
    return joins.route_by_market(
        constituents, {"suffixed": market("F", "suffixed"), "hk": market("O", "hk")})


def route_by_market_hk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hong Kong constituents and quotes that pad their codes differently, and codes that no quote has."""
    orders = table(spark, sf_dir, "orders").select(
        customer_code(F.col("o_custkey")).alias("con_code"), F.col("o_custkey").alias("key"), F.col("o_orderdate").cast("date").alias("trade_date"), "o_totalprice")
    hk = orders.where(code_family("con_code") == "hk")
    quotes = hk.where("o_totalprice > 100000").groupBy(F.concat(F.col("key").cast("string"), F.lit(".HK")).alias("con_code"), "trade_date").agg(
        F.max("o_totalprice").alias("close"))
    constituents = hk.select("con_code", "trade_date").distinct()
    return joins.route_by_market(constituents, {"hk": quotes}, normalize=hk_default)


def first_available_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", event_day().alias("trade_date"), "event_type")
    sources = [(kind, events.where(F.col("event_type") == kind).drop("event_type"))
               for kind in ("purchase", "click", "view", "signup", "error")]
    return joins.first_available(sources, ["user_id", "trade_date"])


def unique_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = joins.assert_unique(table(spark, sf_dir, "orders"), "o_orderkey")
    return quality.duplicate_keys(
        orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate")), ["o_custkey", "o_orderdate"])


QUERIES = {
    "code_family": code_family_query,
    "normalize_hk": normalize_hk_query,
    "family_profile": family_profile_query,
    "align_columns": align_columns_query,
    "hierarchy_key": hierarchy_key_query,
    "hierarchy_join_level1": hierarchy_join_query(1),
    "hierarchy_join_level2": hierarchy_join_query(2),
    "hierarchy_join_level3": hierarchy_join_query(3),
    "hierarchy_rollup": hierarchy_rollup_query(2),
    "hierarchy_rollup_level3": hierarchy_rollup_query(3),
    "interval_join_inclusive": interval_join_query(True),
    "interval_join_exclusive": interval_join_query(False, "left"),
    "interval_semantics": interval_semantics_query,
    "point_in_time": point_in_time_query,
    "as_of_universe": as_of_universe_query,
    "survivorship_gap": survivorship_gap_query,
    "metadata_without_rows": metadata_without_rows_query,
    "tradeable": tradeable_query,
    "status_disagreement": status_disagreement_query,
    "suspension_check": suspension_check_query,
    "route_by_market": route_by_market_query,
    "route_by_market_hk": route_by_market_hk_query,
    "first_available": first_available_query,
    "unique_key": unique_key_query,
}

_CODED = f"coded AS (SELECT c_custkey, c_acctbal, {code_sql('c_custkey')} AS code FROM customer)"
_INDUSTRY = """ind AS (SELECT c_custkey, c_acctbal, '76' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0')
        || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '00' AS ind_code
    FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
_DICTIONARY = """dict AS (SELECT rpad('76' || lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), 16, '0') AS code,
        2 AS levelnum, r_name AS name FROM region
    UNION ALL SELECT rpad('76' || lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 2, '0'),
        16, '0'), 3, n_name FROM nation WHERE n_nationkey <> 7
    UNION ALL SELECT rpad(substr(ind_code, 1, 8), 16, '0'), 4, 'group of ' || min(c_custkey) FROM ind GROUP BY 1 HAVING min(c_custkey) % 2 = 0)"""
_HKEY = "rpad(substr(ind_code, 1, {n}), 16, '0')"
_MASTER = """life AS (SELECT o_custkey AS code, CAST(min(o_orderdate) AS DATE) AS listdate,
        CAST(max(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY 1),
    master AS (SELECT code, listdate, CASE WHEN last_day < DATE '2001-01-01' THEN last_day + 1 END AS delistdate,
        CASE WHEN last_day < DATE '2001-01-01' THEN 'D' ELSE 'L' END AS list_status FROM life),
    asked AS (SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS trade_date FROM orders),
    listed AS (SELECT trade_date, master.* FROM asked JOIN master
        ON listdate <= trade_date AND (delistdate IS NULL OR trade_date < delistdate))"""
_STATUS = """sq AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 END AS tradestatuscode,
        CASE o_orderpriority WHEN '1-URGENT' THEN '交易' WHEN '2-HIGH' THEN 'XD' ELSE '停牌' END AS tradestatus FROM orders)"""


def _hierarchy_join_sql(level: int) -> str:
    n = 2 + 2 * level
    return f"""WITH {_INDUSTRY}, {_DICTIONARY}
        SELECT {_HKEY.format(n=n)} AS hierarchy_code, c_custkey, ind_code, name,
               {level} AS hierarchy_level, {n} AS prefix_len
        FROM ind LEFT JOIN dict ON code = {_HKEY.format(n=n)} AND levelnum = {level + 1}"""


def _rollup_sql(level: int) -> str:
    n = 2 + 2 * level
    return f"""WITH {_INDUSTRY} SELECT {_HKEY.format(n=n)} AS hierarchy_code, count(*) AS n_rows,
        round(sum(c_acctbal), 2) AS balance, {level} AS hierarchy_level, {n} AS prefix_len FROM ind GROUP BY 1"""


ORACLES = {
    "code_family": f"""WITH {_CODED} SELECT c_custkey, code, {family('code')} AS family,
        split_part(code, '.', 1) AS raw FROM coded""",
    "normalize_hk": f"""WITH {_CODED}, seen AS (SELECT DISTINCT o_custkey FROM orders
            WHERE o_orderstatus = 'F')
        SELECT c_custkey, code, CASE WHEN code NOT LIKE '%.HK' THEN code
            WHEN o_custkey IS NOT NULL THEN c_custkey || '.HK'
            ELSE lpad(CAST(c_custkey AS VARCHAR), greatest(4, length(CAST(c_custkey AS VARCHAR))), '0') || '.HK' END AS code_norm,
            CASE WHEN code LIKE '%.HK' THEN CAST(c_custkey AS VARCHAR) END AS hk_key
        FROM coded LEFT JOIN seen ON c_custkey = o_custkey""".replace(
            "greatest(4, length(CAST(c_custkey AS VARCHAR)))",
            "CAST(greatest(4, length(CAST(c_custkey AS VARCHAR))) AS INTEGER)"),
    "family_profile": f"""WITH o AS (SELECT {code_sql('o_custkey')} AS code FROM orders)
        SELECT {family('code')} AS code_family, count(*) AS n_rows, count(DISTINCT code) AS n_codes,
               count(*) OVER () > 1 AS is_mixed FROM o GROUP BY 1""",
    "align_columns": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS trade_date, o_custkey AS con_code FROM orders",
    "hierarchy_key": f"WITH {_INDUSTRY} SELECT c_custkey, " + ", ".join(
        f"{_HKEY.format(n=2 + 2 * level)} AS level{level}" for level in (1, 2, 3)) + " FROM ind",
    "hierarchy_join_level1": _hierarchy_join_sql(1),
    "hierarchy_join_level2": _hierarchy_join_sql(2),
    "hierarchy_join_level3": _hierarchy_join_sql(3),
    "hierarchy_rollup": _rollup_sql(2),
    "hierarchy_rollup_level3": _rollup_sql(3),
    "interval_join_inclusive": f"""WITH {SPELLS}, {CUSTOMER_DAYS}
        SELECT g.code, trade_date, entry_dt, remove_dt, status FROM grid g JOIN spells s ON g.code = s.code
        AND entry_dt <= trade_date AND (remove_dt IS NULL OR trade_date <= remove_dt)""",
    "interval_join_exclusive": f"""WITH {SPELLS}, {CUSTOMER_DAYS}
        SELECT g.code, trade_date, entry_dt, remove_dt, status FROM grid g LEFT JOIN spells s ON g.code = s.code
        AND entry_dt <= trade_date AND (remove_dt IS NULL OR trade_date < remove_dt)""",
    "interval_semantics": f"""WITH {SPELLS}, raw AS (SELECT code, entry_dt, remove_dt FROM spells UNION ALL
            SELECT o_custkey, CAST(o_orderdate AS DATE),
                   CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) - 3 FROM orders),
        steps AS (SELECT entry_dt, remove_dt, lead(entry_dt) OVER (PARTITION BY code
                ORDER BY entry_dt, remove_dt NULLS LAST) AS nxt FROM raw WHERE remove_dt IS NULL OR remove_dt >= entry_dt),
        kinds AS (SELECT count(*) AS transitions, count(*) FILTER (nxt - remove_dt = 1) AS next_day,
                count(*) FILTER (nxt = remove_dt) AS same_day, count(*) FILTER (nxt - remove_dt > 1) AS gaps,
                count(*) FILTER (remove_dt IS NULL OR nxt < remove_dt) AS overlaps FROM steps WHERE nxt IS NOT NULL)
        SELECT *, round(next_day / transitions, 6) AS inclusive_share,
               round(same_day / transitions, 6) AS exclusive_share FROM kinds""",
    "point_in_time": f"""WITH {CUSTOMER_DAYS}, facts AS (SELECT o_custkey AS code,
            CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS ann_dt,
            CAST(date_trunc('month', o_orderdate) AS DATE) AS report_period, o_orderkey, o_totalprice FROM orders)
        SELECT g.code, g.trade_date, f.ann_dt, f.report_period, f.o_orderkey, f.o_totalprice
        FROM grid g LEFT JOIN facts f ON g.code = f.code AND f.ann_dt <= g.trade_date
        QUALIFY row_number() OVER (PARTITION BY g.code, g.trade_date
            ORDER BY f.report_period DESC, f.ann_dt DESC, f.o_orderkey DESC) = 1""",
    "as_of_universe": f"WITH {_MASTER} SELECT trade_date, code, listdate, delistdate, list_status FROM listed",
    "survivorship_gap": f"""WITH {_MASTER} SELECT a.trade_date, count(code) AS members,
        count(code) FILTER (list_status <> 'L') AS dropped FROM asked a LEFT JOIN listed USING (trade_date) GROUP BY 1""",
    "metadata_without_rows": """SELECT o_orderkey AS code, o_orderstatus FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "tradeable": f"WITH {_STATUS} SELECT o_orderkey, tradestatuscode <> 0 AS is_tradeable FROM sq",
    "status_disagreement": f"""WITH {_STATUS} SELECT tradestatuscode, tradestatus, count(*) AS n_rows,
        (tradestatuscode <> 0) IS NOT DISTINCT FROM (tradestatus IN ('交易', 'XD')) AS agrees FROM sq GROUP BY 1, 2""",
    "suspension_check": """WITH ev AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
        q AS (SELECT user_id AS code, day, count(*) FILTER (event_type = 'purchase' AND value > 60) > 0 AS trades
              FROM ev GROUP BY 1, 2),
        s AS (SELECT user_id AS code, event_id, day AS suspend_date, CASE WHEN value > 80 THEN day + 2 END AS resump_date
              FROM ev WHERE event_type = 'error'),
        n AS (SELECT s.*, (SELECT min(day) FROM q WHERE q.code = s.code AND q.day > s.suspend_date) AS next_quote,
              (SELECT min(day) FROM q WHERE q.code = s.code AND q.day > s.suspend_date AND trades) AS next_trade FROM s)
        SELECT code, event_id, suspend_date, resump_date,
               CASE WHEN resump_date IS NULL THEN next_trade END AS next_trade_date,
               CASE WHEN resump_date IS NOT NULL THEN 'resumed' WHEN next_trade IS NULL THEN 'open_ended'
                    WHEN next_trade = next_quote THEN 'one_day' ELSE 'resumed' END AS suspension_status FROM n""",
    "route_by_market": f"""WITH o AS (SELECT {code_sql('o_custkey')} AS con_code, CAST(o_orderdate AS DATE) AS trade_date,
            o_orderstatus, o_totalprice FROM orders),
        c AS (SELECT DISTINCT con_code, trade_date, {family('con_code')} AS code_family FROM o),
        q AS (SELECT con_code, CASE WHEN o_orderstatus = CASE WHEN {family('con_code')} = 'hk' THEN 'O' ELSE 'F' END
                     THEN trade_date ELSE trade_date + 1 END AS trade_date, max(o_totalprice) AS close FROM o
              WHERE {family('con_code')} IN ('suffixed', 'hk') GROUP BY 1, 2)
        SELECT c.con_code, c.trade_date, code_family, CASE WHEN code_family NOT IN ('suffixed', 'hk') THEN 'unroutable'
            WHEN close IS NOT NULL THEN 'joined' ELSE 'no_quote' END AS route, close
        FROM c LEFT JOIN q USING (con_code, trade_date)""",
    "route_by_market_hk": f"""WITH o AS (SELECT {code_sql('o_custkey')} AS con_code, CAST(o_orderdate AS DATE) AS trade_date,
            o_totalprice FROM orders WHERE o_custkey % 4 = 1)
        SELECT con_code, trade_date, 'hk' AS code_family, CASE WHEN max(o_totalprice) > 100000 THEN 'joined' ELSE 'no_quote' END AS route,
            max(o_totalprice) FILTER (o_totalprice > 100000) AS close FROM o GROUP BY 1, 2""",
    "first_available": """WITH p AS (SELECT event_id, user_id, CAST(ts AS DATE) AS trade_date, event_type AS source,
            CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3
            WHEN 'error' THEN 4 END AS pr FROM events)
        SELECT event_id, user_id, trade_date, source FROM p
        QUALIFY pr = min(pr) OVER (PARTITION BY user_id, trade_date)""",
    "unique_key": """SELECT o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, count(*) AS n_rows,
        count(*) - 1 AS excess_rows FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
}
