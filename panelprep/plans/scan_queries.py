"""Scans, value lists, sinks and text expressions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelprep.functions import doc_id, doc_url, key_value, literal_type, meta_map, normalize_ws, slug
from panelprep.operators import sets
from panelprep.plans.oracle_parts import CALENDAR, WS
from panelprep.plans.tables import scratch_path, table, weekday_calendar
from panelprep.sources import (
    Between, head, interval_scan, merge_params, parse_value_list, read_pages, read_values, rows_per_file, scan,
    split_log, split_read_paths, split_read_table, split_scan, split_summary, values_to_intervals, write,
)

REQUESTS = ["1-URGENT", "5-LOW", "1-URGENT", "9-NONE"]
DOC_ROOT = "https://docs.example.org/document/2"


def _requests(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(REQUESTS, start=1)), "pos int, value string")


def scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = spark.createDataFrame([(1, "l_linestatus=O")], "pos int, text string")
    params = merge_params({"l_linestatus": "F", "l_returnflag": ["A", "R"]}, settings)
    params["l_shipdate"] = Between("19960101", "19971231")
    out = scan(table(spark, sf_dir, "lineitem"), params, "l_orderkey,l_linenumber,l_shipdate,L_EXTENDEDPRICE")
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def split_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = {"o_orderstatus": "F", "o_orderpriority": "3-MEDIUM"}
    return split_scan(table(spark, sf_dir, "orders"), _requests(spark), "o_orderpriority", fixed,
                      "o_orderkey,o_totalprice")


DAYS = ["2024-01-01", "20240103", "2024-01-01", "no day", "19000101"]


def split_scan_days_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.createDataFrame(list(enumerate(DAYS, start=1)), "pos int, value string")
    return split_scan(table(spark, sf_dir, "events"), days, "ts", fields="event_id").select("request_pos", "event_id")


def split_log_days_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.createDataFrame(list(enumerate(DAYS, start=1)), "pos int, value string")
    return split_log(table(spark, sf_dir, "events"), days, "ts").withColumnRenamed("ts", "day")


def split_log_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_log(table(spark, sf_dir, "orders"), _requests(spark), "o_orderpriority")


def split_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_summary(split_log_query(spark, sf_dir))


def interval_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    out = interval_scan(table(spark, sf_dir, "orders"), "o_orderdate", "1997-01-01", "1998-06-30", keep)
    return out.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))


def interval_scan_partitioned_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with a folder per month, scanned for the months of an interval that had a very large order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "MM").alias("month"))
    path = write(orders, scratch_path(spark, "orders.parquet"), partition_by="month")
    months = orders.where("o_totalprice > 499000").select("month")
    stored = spark.read.schema(orders.schema).parquet(path)
    return interval_scan(stored, "month", "1995-01-01", "1997-12-31", months).select("o_orderkey", "month")


def values_to_intervals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    busy = orders.groupBy(F.col("o_orderdate").cast("date").alias("trade_date")).count().where("count >= 2")
    out = values_to_intervals(busy, weekday_calendar(orders))
    return out.withColumn("n_dates", F.col("n_dates").cast("long"))


def head_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = head(table(spark, sf_dir, "orders"), 25, [F.col("o_totalprice").desc(), "o_orderkey"])
    return out.select("o_orderkey", "o_totalprice")


def read_pages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("code"),
        F.when(F.col("p_size") > 5, F.col("p_name")).alias("name"))


def _value_counts(values: DataFrame) -> DataFrame:
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))


def read_values_csv_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write(_names(spark, sf_dir), scratch_path(spark, "codes.csv"))
    return read_values(spark, path, "code").select("value")


def read_values_tsv_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "names.tsv")
    _names(spark, sf_dir).select("name", "code").write.option("sep", "\t").csv(path)
    return _value_counts(read_values(spark, path, header=False))


def read_values_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "names.txt")
    padded = F.concat(F.lit("  "), F.coalesce("name", F.lit("")), F.lit(" "))
    _names(spark, sf_dir).select(padded).write.text(path)
    return _value_counts(read_values(spark, path, fmt="txt"))


def read_values_json_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write(_names(spark, sf_dir), scratch_path(spark, "names.json"))
    return read_values(spark, path, "code", fmt="jsonl").select("value")


def read_values_json_documents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON document of names for every five hundred parts, each a file: records, or an object with a list of values."""
    path = scratch_path(spark, "documents.json")
    bucket = F.floor(F.col("code").cast("int") / 500)
    records = F.to_json(F.collect_list(F.struct("code", "name")), {"ignoreNullFields": "false"})
    document = F.when(bucket % 2 == 0, records).otherwise(F.to_json(F.struct(F.collect_list("name").alias("values"))))
    names = _names(spark, sf_dir).groupBy(bucket).agg(document.alias("value"))
    names.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return _value_counts(read_values(spark, path, "name", fmt="json"))


def write_round_trip(fmt: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        names = _names(spark, sf_dir)
        path = write(names, scratch_path(spark, f"names.{fmt}"))
        reader = spark.read.schema(names.schema)
        return {"csv": lambda: reader.csv(path, header=True, escape='"'), "json": lambda: reader.json(path),
                "parquet": lambda: reader.parquet(path)}[fmt]()

    return query


def split_read_paths_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    root = scratch_path(spark, "slices")
    orders.withColumn("slice", F.col("o_orderstatus")).write.partitionBy("slice").parquet(root)
    rows, log = split_read_paths(
        spark, [f"{root}/slice={s}" for s in ("F", "missing", "O")], orders.schema, continue_on_error=True)
    files = rows_per_file(rows).withColumn("path", F.regexp_extract("file_path", r"slice=([^/]+)", 1))
    per_slice = files.groupBy("path").agg(F.sum("n_rows").alias("n_rows"))
    named = log.withColumn("slice", F.regexp_extract("path", r"slice=([^/]+)", 1)).drop("path")
    return named.join(per_slice, named["slice"] == per_slice["path"], "left").select(
        "request_pos", "slice", "status", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def split_read_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices by order priority, of which one asked for is missing and one is no Parquet file."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    root = scratch_path(spark, "slices")
    name = F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1))
    orders.withColumn("slice", name).write.partitionBy("slice").parquet(root)
    orders.where("o_orderpriority = '5-LOW'").select(F.col("o_orderkey").cast("string")).write.text(f"{root}/broken")
    asked = spark.createDataFrame([(1, "slice=p1"), (2, "absent"), (3, "broken"), (4, "slice=p5/")], "request_pos int, path string")
    rows, log = split_read_table(spark, root, asked, "o_orderkey long, o_totalprice double")
    read = rows.groupBy(F.regexp_extract("_metadata.file_path", r"(slice=[^/]+)", 1).alias("_slice")).agg(F.sum("o_orderkey").alias("key_sum"))
    return log.join(read, F.col("_slice") == F.trim("path", F.lit("/")), "left").select("request_pos", "path", "status", "n_rows", "key_sum")


def parse_value_list_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    text = (
        F.when(F.pmod("p_partkey", F.lit(3)) == 0, F.concat(F.lit(" "), F.col("p_brand"), F.lit(", ,"), size, F.lit(" ,000300")))
        .when(F.pmod("p_partkey", F.lit(3)) == 1, F.concat(F.lit('["'), F.col("p_brand"), F.lit('", '), size, F.lit(", true]")))
        .otherwise("  ")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(parse_value_list(text)).alias("pos", "v"))
    return parts.select("p_partkey", F.col("pos").cast("long").alias("pos"), "v.text", "v.kind")


def literal_type_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_text = F.col("event_id").cast("string")
    raw = (
        F.when(F.pmod("event_id", F.lit(6)) == 0, F.col("props"))
        .when(F.pmod("event_id", F.lit(6)) == 1, id_text)
        .when(F.pmod("event_id", F.lit(6)) == 2, F.concat(F.lit("000"), id_text))
        .when(F.pmod("event_id", F.lit(6)) == 3, F.concat(F.lit(" "), id_text, F.lit(".50 ")))
        .when(F.pmod("event_id", F.lit(6)) == 4, F.concat(F.lit('"'), F.col("event_type"), F.lit('"')))
        .otherwise(F.col("event_type"))
    )
    return table(spark, sf_dir, "events").select("event_id", literal_type(raw).alias("v")).select(
        "event_id", "v.text", "v.kind")


def key_value_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        F.when(F.col("p_size") % 4 == 0, F.concat(F.lit(" brand = "), F.col("p_brand"), F.lit("=x ")))
        .when(F.col("p_size") % 4 == 1, F.col("p_name"))
        .when(F.col("p_size") % 4 == 2, F.concat(F.lit(" ="), F.col("p_name")))
        .otherwise(F.concat(F.col("p_brand"), F.lit("= ")))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", key_value(raw).alias("loose"), key_value(raw, strict=True).alias("strict")
    ).select(
        "p_partkey", F.col("loose.key").alias("loose_key"), F.col("loose.value").alias("loose_value"),
        F.col("loose.valid").alias("loose_valid"), F.col("strict.value").alias("strict_value"),
        F.col("strict.valid").alias("strict_valid"))


def normalize_ws_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", normalize_ws("text").alias("text"))


def doc_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id").cast("string")
    target = (
        F.when(F.pmod("page_id", F.lit(4)) == 0, page)
        .when(F.pmod("page_id", F.lit(4)) == 1, F.concat(F.lit(f"{DOC_ROOT}?lang=x&doc_id=a%20"), page, F.lit("&doc_id=9#top")))
        .when(F.pmod("page_id", F.lit(4)) == 2, F.concat(F.lit("document?doc_id="), page))
        .otherwise(F.col("url"))
    )
    return table(spark, sf_dir, "pages").select("page_id", target.alias("target")).select(
        "page_id", doc_id("target").alias("doc_id"), doc_url("target", DOC_ROOT).alias("doc_url"))


def slug_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", slug("text").alias("slug"))


def meta_map_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(
        F.lit("接口： part_"), F.col("p_partkey").cast("string"), F.lit("\n\n描述:  "), F.col("p_name"),
        F.lit("\nno separator here\n限量: 5：1\r\n描述："), F.col("p_type"), F.lit("  "))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(meta_map(text)).alias("key", "value"))


def stack_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
                                                       F.col("c_acctbal").alias("balance"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("suppkey"), F.col("s_name").alias("name"),
                                                       F.col("s_nationkey").cast("double").alias("balance"))
    return sets.stack([customer, supplier])


def dedupe_first_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return sets.dedupe_first(li, ["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_partkey", "l_suppkey"])


def stable_sort_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return sets.stable_sort(part, F.col("p_size").desc(), "p_partkey")


def top_k_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return sets.top_k(orders, ["o_custkey"], [F.col("o_totalprice").desc(), "o_orderkey"], 3, "place").withColumn(
        "place", F.col("place").cast("long"))


QUERIES = {
    "scan": scan_query,
    "split_scan": split_scan_query,
    "split_log": split_log_query,
    "split_scan_days": split_scan_days_query,
    "split_log_days": split_log_days_query,
    "split_summary": split_summary_query,
    "split_read_paths": split_read_paths_query,
    "split_read_table": split_read_table_query,
    "interval_scan": interval_scan_query,
    "interval_scan_partitioned": interval_scan_partitioned_query,
    "values_to_intervals": values_to_intervals_query,
    "head": head_query,
    "read_pages": read_pages_query,
    "read_values_csv": read_values_csv_query,
    "read_values_tsv": read_values_tsv_query,
    "read_values_text": read_values_text_query,
    "read_values_json": read_values_json_query,
    "read_values_json_documents": read_values_json_documents_query,
    "write_csv": write_round_trip("csv"),
    "write_json": write_round_trip("json"),
    "write_parquet": write_round_trip("parquet"),
    "parse_value_list": parse_value_list_query,
    "literal_type": literal_type_query,
    "key_value": key_value_query,
    "normalize_ws": normalize_ws_query,
    "doc_id_url": doc_id_query,
    "slug": slug_query,
    "meta_map": meta_map_query,
    "stack": stack_query,
    "dedupe_first": dedupe_first_query,
    "stable_sort": stable_sort_query,
    "top_k_per_group": top_k_query,
}

_REQ = "(VALUES (1, '1-URGENT'), (2, '5-LOW'), (3, '1-URGENT'), (4, '9-NONE')) AS r(request_pos, value)"
_DAYS = """(VALUES (1, '2024-01-01', DATE '2024-01-01'), (2, '20240103', DATE '2024-01-03'), (3, '2024-01-01', DATE '2024-01-01'),
    (4, 'no day', CAST(NULL AS DATE)), (5, '19000101', DATE '1900-01-01')) AS d(pos, requested, day)"""
_SPLIT_LOG = f"""SELECT r.request_pos, r.value AS requested, r.value AS o_orderpriority, count(o.o_orderkey) AS n_rows
    FROM {_REQ} LEFT JOIN orders o ON o.o_orderpriority = r.value GROUP BY 1, 2, 3"""
_NAMES = """SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code,
    CASE WHEN p_size > 5 THEN p_name END AS name FROM part"""

ORACLES = {
    "scan": """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate, l_extendedprice
        FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag IN ('A', 'R')
        AND CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
    "split_scan": f"""SELECT r.request_pos, o.o_orderpriority, o.o_orderkey, o.o_totalprice
        FROM {_REQ} JOIN orders o ON o.o_orderpriority = r.value WHERE o.o_orderstatus = 'F'""",
    "split_log": _SPLIT_LOG,
    "split_scan_days": f"SELECT pos AS request_pos, event_id FROM {_DAYS} JOIN events ON CAST(ts AS DATE) = day",
    "split_log_days": f"""SELECT pos AS request_pos, requested, day, count(event_id) AS n_rows
        FROM {_DAYS} LEFT JOIN events ON CAST(ts AS DATE) = day GROUP BY 1, 2, 3""",
    "split_summary": f"""SELECT count(*) AS requests, count(*) FILTER (n_rows > 0) AS with_rows,
        CAST(sum(n_rows) AS BIGINT) AS n_rows FROM ({_SPLIT_LOG})""",
    "split_read_paths": """SELECT pos AS request_pos, s AS slice,
        CASE WHEN s = 'missing' THEN 'failed' ELSE 'ok' END AS status, count(o_orderkey) AS n_rows
        FROM (VALUES (1, 'F'), (2, 'missing'), (3, 'O')) AS v(pos, s)
        LEFT JOIN orders ON o_orderstatus = s GROUP BY 1, 2, 3""",
    "split_read_table": """SELECT pos AS request_pos, s AS path, CASE WHEN s = 'absent' THEN 'missing' WHEN s = 'broken' THEN 'failed' ELSE 'ok' END
            AS status, count(o_orderkey) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
        FROM (VALUES (1, 'slice=p1'), (2, 'absent'), (3, 'broken'), (4, 'slice=p5/')) AS v(pos, s)
        LEFT JOIN orders ON 'slice=p' || o_orderpriority[1] = trim(s, '/') GROUP BY 1, 2, 3""",
    "interval_scan": """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'
        AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "interval_scan_partitioned": """WITH o AS (SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)
        SELECT o_orderkey, month FROM o WHERE month BETWEEN DATE '1995-01-01' AND DATE '1997-12-31'
        AND month IN (SELECT month FROM o WHERE o_totalprice > 499000)""",
    "values_to_intervals": f"""WITH {CALENDAR},
        busy AS (SELECT CAST(o_orderdate AS DATE) AS trade_date FROM orders GROUP BY 1 HAVING count(*) >= 2),
        hit AS (SELECT trade_date, idx - row_number() OVER (ORDER BY trade_date) AS island
                FROM calx WHERE trade_date IN (SELECT trade_date FROM busy))
        SELECT min(trade_date) AS start_date, max(trade_date) AS end_date, count(*) AS n_dates
        FROM hit GROUP BY island
        UNION ALL SELECT trade_date, trade_date, 1 FROM busy WHERE trade_date NOT IN (SELECT trade_date FROM calx)""",
    "head": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    "read_pages": "SELECT page_id, url, length(html) AS n_chars FROM pages",
    "read_values_csv": f"SELECT code AS value FROM ({_NAMES})",
    "read_values_tsv": f"SELECT name AS value, count(*) AS n_rows FROM ({_NAMES}) WHERE name IS NOT NULL GROUP BY 1",
    "read_values_text": f"SELECT name AS value, count(*) AS n_rows FROM ({_NAMES}) WHERE name IS NOT NULL GROUP BY 1",
    "read_values_json": f"SELECT code AS value FROM ({_NAMES})",
    "read_values_json_documents": f"""SELECT name AS value, count(*) AS n_rows FROM ({_NAMES})
        WHERE name IS NOT NULL OR CAST(code AS INTEGER) // 500 % 2 = 0 GROUP BY 1""",
    "write_csv": _NAMES,
    "write_json": _NAMES,
    "write_parquet": _NAMES,
    "parse_value_list": """
        SELECT p_partkey, CAST(v.pos AS BIGINT) AS pos, v.text, v.kind FROM (
            SELECT p_partkey, unnest(CASE p_partkey % 3
                WHEN 0 THEN [{pos: 0, text: p_brand, kind: 'string'},
                             {pos: 1, text: CAST(p_size AS VARCHAR), kind: 'int'},
                             {pos: 2, text: '000300', kind: 'string'}]
                WHEN 1 THEN [{pos: 0, text: p_brand, kind: 'string'},
                             {pos: 1, text: CAST(p_size AS VARCHAR), kind: 'int'},
                             {pos: 2, text: 'true', kind: 'bool'}] ELSE [] END) AS v FROM part)""",
    "literal_type": """SELECT event_id,
        CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN CAST(event_id AS VARCHAR) WHEN 2 THEN '000' || event_id
            WHEN 3 THEN event_id || '.50' ELSE event_type END AS text,
        CASE event_id % 6 WHEN 0 THEN 'object' WHEN 1 THEN 'int' WHEN 2 THEN 'string' WHEN 3 THEN 'float'
            ELSE 'string' END AS kind FROM events""",
    "key_value": r"""WITH raw AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN ' brand = ' || p_brand || '=x '
            WHEN 1 THEN p_name WHEN 2 THEN ' =' || p_name ELSE p_brand || '= ' END AS t FROM part),
        cut AS (SELECT p_partkey, t, instr(t, '=') AS eq FROM raw),
        kv AS (SELECT p_partkey, CASE WHEN eq > 0 THEN trim(substr(t, 1, eq - 1)) END AS k,
                      CASE WHEN eq > 0 THEN substr(t, eq + 1) END AS v FROM cut)
        SELECT p_partkey, k AS loose_key, v AS loose_value, coalesce(k <> '', false) AS loose_valid,
               trim(v) AS strict_value, coalesce(k <> '' AND trim(v) <> '', false) AS strict_valid FROM kv""",
    "normalize_ws": f"SELECT doc_id, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS text FROM documents",
    "doc_id_url": f"""SELECT page_id,
        CASE page_id % 4 WHEN 0 THEN CAST(page_id AS VARCHAR) WHEN 1 THEN 'a ' || page_id END AS doc_id,
        CASE page_id % 4 WHEN 0 THEN '{DOC_ROOT}?doc_id=' || page_id
            WHEN 1 THEN '{DOC_ROOT}?lang=x&doc_id=a%20' || page_id || '&doc_id=9#top'
            WHEN 2 THEN 'document?doc_id=' || page_id ELSE url END AS doc_url FROM pages""",
    "slug": f"""WITH t AS (SELECT conv_id, turn, regexp_replace(lower(regexp_replace(text,
            '^{WS}+|{WS}+$', '', 'g')), '[^a-zA-Z0-9._-]+', '-', 'g') AS s FROM conversations)
        SELECT conv_id, turn, coalesce(nullif(trim(s, '-'), ''), 'runtime-note') AS slug FROM t""",
    "meta_map": """SELECT p_partkey, '接口' AS key, 'part_' || p_partkey AS value FROM part
        UNION ALL SELECT p_partkey, '描述', p_type FROM part UNION ALL SELECT p_partkey, '限量: 5', '1' FROM part""",
    "stack": """SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, CAST(NULL AS BIGINT) AS suppkey
        FROM customer UNION ALL SELECT s_name, NULL, CAST(s_nationkey AS DOUBLE), s_suppkey FROM supplier""",
    "dedupe_first": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_extendedprice, l_partkey, l_suppkey) = 1""",
    "stable_sort": "SELECT p_partkey, p_size FROM part ORDER BY p_size DESC, p_partkey",
    "top_k_per_group": """SELECT o_custkey, o_orderkey, o_totalprice,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
        FROM orders QUALIFY place <= 3""",
}
