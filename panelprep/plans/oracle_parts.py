"""SQL fragments shared by the check queries; they mirror ``plans.tables``."""

WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

CALENDAR = """
cal AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date FROM orders
        WHERE dayofweek(CAST(o_orderdate AS DATE)) BETWEEN 1 AND 5),
calx AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS idx FROM cal)"""

EVENT_CALENDAR = """
ecal AS (SELECT trade_date, row_number() OVER (ORDER BY trade_date) AS idx
         FROM (SELECT DISTINCT CAST(ts AS DATE) AS trade_date FROM events))"""

PRICES = """
px AS (SELECT user_id AS con_code, CAST(ts AS DATE) AS trade_date, 100 + avg(value) AS close
       FROM events GROUP BY 1, 2),
ret AS (SELECT con_code, trade_date,
               close / lag(close) OVER (PARTITION BY con_code ORDER BY trade_date) - 1 AS ret FROM px)"""

FLOWS = """
flow AS (SELECT user_id AS con_code, CAST(ts AS DATE) AS trade_date, sum(value) FILTER (event_type IN ('purchase', 'signup')) AS flow
         FROM events GROUP BY 1, 2)"""

ANCHORS = """
anchors AS (SELECT user_id % 5 AS index_code, user_id AS con_code, CAST(ts AS DATE) AS trade_date,
                   CAST(count(*) AS DOUBLE) AS weight
            FROM events WHERE day(ts) IN (1, 16) GROUP BY 1, 2, 3)"""

SPANS = """
spans AS (SELECT index_code, trade_date AS anchor_date, idx AS anchor_idx,
                 coalesce(lead(idx) OVER (PARTITION BY index_code ORDER BY idx),
                          (SELECT max(idx) + 1 FROM ecal)) AS next_idx,
                 lead(trade_date) OVER (PARTITION BY index_code ORDER BY idx) AS next_anchor
          FROM (SELECT DISTINCT index_code, trade_date FROM anchors) JOIN ecal USING (trade_date))"""


def drift(returns: str = "ret", through_next: bool = False) -> str:
    end = "CASE WHEN s.next_anchor IS NULL THEN s.next_idx - 1 ELSE s.next_idx END" if through_next \
        else "s.next_idx - 1"
    return f"""
panel AS (SELECT a.index_code, a.con_code, c.trade_date, s.anchor_date, a.weight AS anchor_weight,
                 c.idx - s.anchor_idx AS days_since_anchor, c.idx,
                 CASE WHEN c.idx > s.anchor_idx THEN r.ret END AS ret,
                 c.idx > s.anchor_idx AND r.con_code IS NOT NULL AS quoted
          FROM anchors a JOIN spans s ON a.index_code = s.index_code AND a.trade_date = s.anchor_date
          JOIN ecal c ON c.idx BETWEEN s.anchor_idx AND {end}
          LEFT JOIN {returns} r ON r.con_code = a.con_code AND r.trade_date = c.trade_date),
drifted AS (SELECT index_code, con_code, trade_date, anchor_date, anchor_weight, days_since_anchor,
                   anchor_weight * product(1 + coalesce(ret, 0)) OVER (
                       PARTITION BY index_code, con_code, anchor_date ORDER BY idx) AS raw_weight,
                   bool_or(quoted) OVER (PARTITION BY index_code, con_code, anchor_date) AS has_quotes
            FROM panel)"""


CUSTOMER_CODE = """CASE {k} % 4
    WHEN 0 THEN lpad(CAST({k} AS VARCHAR), 6, '0') || '.SZ'
    WHEN 1 THEN lpad(CAST({k} AS VARCHAR), 5, '0') || '.HK'
    WHEN 2 THEN lpad(CAST({k} AS VARCHAR), 6, '0')
    ELSE 'Au' || CAST({k} AS VARCHAR) || '.SGE' END"""


def customer_code(key: str) -> str:
    return CUSTOMER_CODE.format(k=key)


FAMILY = r"""CASE WHEN regexp_matches({c}, '^\d{{6}}\.(SZ|SH)$') THEN 'suffixed'
    WHEN regexp_matches({c}, '^\d{{6}}$') THEN 'raw_index'
    WHEN regexp_matches({c}, '^\d+\.HK$') THEN 'hk'
    WHEN regexp_matches({c}, '^[A-Za-z0-9]+\.OF$') THEN 'fund'
    WHEN regexp_matches({c}, '^[A-Za-z0-9]+\.(MI|SPI|CI)$') THEN 'suffixed_index'
    WHEN regexp_matches({c}, '^[A-Za-z]+\d*\.[A-Z]{{3}}$') THEN 'venue' ELSE 'unknown' END"""


def family(col: str) -> str:
    return FAMILY.format(c=col)


SPELLS = """
spells AS (SELECT code, entry_dt,
                  lead(entry_dt) OVER (PARTITION BY code ORDER BY entry_dt) - 1 AS remove_dt, status
           FROM (SELECT o_custkey AS code, CAST(o_orderdate AS DATE) AS entry_dt,
                        arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1, 2))"""

CUSTOMER_DAYS = """
grid AS (SELECT c_custkey AS code, CAST(d AS DATE) AS trade_date
         FROM customer, (SELECT unnest(generate_series(date_trunc('quarter', (SELECT min(o_orderdate) FROM orders)),
             CAST((SELECT max(o_orderdate) FROM orders) AS DATE)::TIMESTAMP, INTERVAL 3 MONTH)) AS d))"""
