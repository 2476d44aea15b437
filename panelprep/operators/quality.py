"""Validation: counts, spans, duplicates, nulls, filters, coverage, logs.

Whole-table checks are single passes of partial aggregates: what a check shuffles
is its result, not its input.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from panelprep.functions.codes import CODE_FAMILIES, code_family
from panelprep.functions.dates import as_date
from panelprep.sources.scans import param_conditions, resolve_name


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def shape(df: DataFrame) -> DataFrame:
    """One row: row count, column count, column names."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(", ".join(df.columns)).alias("column_names"))


def date_span(df: DataFrame, col: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """First, last and number of distinct days, optionally per code."""
    day = as_date(col, df.schema[col].dataType)
    aggs = [F.min(day).alias("min_date"), F.max(day).alias("max_date"), F.countDistinct(day).alias("n_dates"),
            F.count(F.lit(1)).alias("n_rows")]
    return df.groupBy(*_keys(by)).agg(*aggs) if by else df.agg(*aggs)


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys with more than one row, and the rows in excess."""
    return df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1").withColumn(
        "excess_rows", F.col("n_rows") - 1)


def null_profile(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Null count and ratio per column from one pass; ``null_heavy`` at the threshold."""
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)]
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_count"))
        for i, c in enumerate(df.columns)
    ])
    ratio = F.try_divide("null_count", "n_rows")
    return row.select("n_rows", F.inline(cells)).select(
        "column_name", "null_count", ratio.alias("null_ratio"),
        F.coalesce(ratio >= threshold, F.lit(False)).alias("null_heavy"))


def filter_violations(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """Returned rows that don't satisfy each requested filter; null doesn't satisfy."""
    conds = param_conditions(df, params)
    counts = [F.count_if(~F.coalesce(c, F.lit(False))).alias(f"v{i}") for i, c in enumerate(conds.values())]
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    cells = F.array(*[
        F.struct(F.lit(name).alias("param"), F.col(f"v{i}").alias("violations")) for i, name in enumerate(conds)
    ])
    return row.select("n_rows", F.inline(cells)).select(
        "param", "n_rows", "violations", (F.col("violations") == 0).alias("honoured"))


def contract_diff(contracts: DataFrame, df: DataFrame, api: str = "api_name", fields: str = "output_fields") -> DataFrame:
    """Documented fields against the columns that arrived, per contract.

    ``status`` is ``match``, ``case_only``, ``documented_absent`` or
    ``present_undocumented``, or ``no_contract`` for a page that gave none.  The arrived names are a literal array, so all of it
    happens within the contract's row.
    """
    arrived = F.array(*[F.lit(c) for c in df.columns]).cast("array<string>")
    documented = F.col(fields)

    def same(a: Column, b: Column) -> Column:
        return F.lower(a) == F.lower(b)

    def meet(name: Column) -> Column:
        exact = F.when(F.array_contains(arrived, name), name)
        other = F.get(F.filter(arrived, lambda p: same(p, name)), F.lit(0))
        return F.struct(name.alias("documented"), F.coalesce(exact, other).alias("present"))

    undocumented = F.filter(arrived, lambda p: ~F.exists(documented, lambda d: same(d, p)))
    pairs = F.concat(
        F.transform(documented, meet),
        F.transform(undocumented, lambda p: F.struct(F.lit(None).cast("string").alias("documented"), p.alias("present"))))
    failed = F.col("error").isNotNull() if "error" in contracts.columns else F.lit(False)
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("documented"), F.lit(None).cast("string").alias("present")))
    pairs = F.when(failed, nothing).otherwise(pairs)
    status = (
        F.when(F.col("documented").isNull() & F.col("present").isNull(), "no_contract")
        .when(F.col("documented").isNull(), "present_undocumented")
        .when(F.col("present").isNull(), "documented_absent")
        .when(F.col("documented") == F.col("present"), "match")
        .otherwise("case_only")
    )
    return contracts.select(api, F.inline(pairs)).select(api, "documented", "present", status.alias("status"))


def code_coverage(requested: DataFrame, df: DataFrame, key: str, families=CODE_FAMILIES, count: str | None = None) -> DataFrame:
    """Rows per requested code, zero included, with the code's family.

    Codes are counted before the join: what meets the request list is one row
    per code, however many rows a code has.  ``count`` names a column by which a
    row of ``df`` stands for several.
    """
    wanted = requested.select(key).distinct()
    counts = df.groupBy(key).agg((F.sum(count) if count else F.count(F.lit(1))).alias("n_rows"))
    n = F.coalesce("n_rows", F.lit(0))
    return wanted.join(counts, key, "left").select(
        key, code_family(F.col(key).cast("string"), families).alias("code_family"), n.alias("n_rows"),
        (n > 0).alias("covered"))


def coverage_by_family(coverage: DataFrame) -> DataFrame:
    """Requested and covered codes and their ratio per family."""
    return coverage.groupBy("code_family").agg(
        F.count(F.lit(1)).alias("requested"), F.count_if("covered").alias("covered_codes"),
        F.sum("n_rows").alias("n_rows"),
    ).withColumn("coverage_ratio", F.try_divide("covered_codes", "requested"))


def page_limit_check(
    page_log: DataFrame, limits: DataFrame, api: str = "api_name", request: str = "request", page: str = "page",
    rows: str = "rows", limit_text: str = "limit_text",
) -> DataFrame:
    """Largest page per API against the documented limit (first number in its text).

    ``suspicious`` when a request with several pages has only pages of the
    largest size, its last one included: the pull may have been cut at the limit.
    """
    per_request = page_log.groupBy(api, request).agg(
        F.count(F.lit(1)).alias("pages"), F.max(rows).alias("most"), F.min(rows).alias("least"))
    per_api = per_request.groupBy(api).agg(
        F.sum("pages").alias("n_pages"), F.max("most").alias("max_rows"),
        F.max(F.when((F.col("most") == F.col("least")) & (F.col("pages") > 1), F.col("most"))).alias("_full"),
    )
    number = F.regexp_replace(F.regexp_extract(limit_text, r"(\d[\d,]*)", 1), ",", "")
    documented = limits.select(api, F.nullif(number, F.lit("")).try_cast("long").alias("documented_limit"))
    return per_api.join(documented, api, "left").select(
        api, "n_pages", "max_rows", "documented_limit",
        (F.col("max_rows") == F.col("documented_limit")).alias("limit_observed"),
        F.coalesce(F.col("max_rows") > F.col("documented_limit"), F.lit(False)).alias("limit_exceeded"),
        F.coalesce(F.col("_full") == F.col("max_rows"), F.lit(False)).alias("suspicious"),
    )


# Messages of failures that pass, and of an API that isn't there.
TRANSIENT = r"(?i)\b503\b|IncompleteRead"
NO_INTERFACE = r"接口不存在"


def failure_verdict(
    attempts: DataFrame, by: Sequence[str] = ("api", "request"), error: str = "error", rows: str = "rows",
    transient: str = TRANSIENT, missing: str = NO_INTERFACE,
) -> DataFrame:
    """Per request: ok, flaky, missing, zero_rows or structural.

    ``flaky``: transient errors only, whether or not a retry got through.
    """
    err = F.col(error)
    failed = err.isNotNull() & (err != "")
    is_transient, is_missing = err.rlike(transient), err.rlike(missing)
    stats = attempts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(failed).alias("failures"),
        F.count_if(failed & is_transient & ~is_missing).alias("transient_failures"),
        F.count_if(failed & is_missing).alias("_missing"),
        F.count_if(~failed).alias("_ok"),
        F.max(F.when(~failed, F.col(rows))).alias("max_rows"),
    )
    f, t = F.col("failures"), F.col("transient_failures")
    verdict = (
        F.when(F.col("_missing") > 0, "missing")
        .when((f > 0) & (f == t), "flaky")
        .when(f > t, "structural")
        .when(F.coalesce("max_rows", F.lit(0)) == 0, "zero_rows")
        .otherwise("ok")
    )
    return stats.select(*by, "attempts", "failures", "transient_failures", "max_rows", verdict.alias("verdict"))


def compare_sources(
    a: DataFrame, b: DataFrame, key: str, date: str, names: tuple[str, str] = ("a", "b")
) -> DataFrame:
    """One row per source: rows, codes, date span, and codes shared with the other.

    Each source is read once and reduced to one row per code before anything is
    compared.  Rows without a code count as rows, not as a code.
    """
    def tagged(df: DataFrame, n: int) -> DataFrame:
        return df.select(F.col(key).alias("code"), as_date(date, df.schema[date].dataType).alias("day"), F.lit(n).alias("src"))

    both = tagged(a, 0).unionByName(tagged(b, 1))
    mine = [F.col("src") == 0, F.col("src") == 1]
    per_code = both.groupBy("code").agg(*[c for i in (0, 1) for c in (
        F.count_if(mine[i]).alias(f"n{i}"), F.min(F.when(mine[i], F.col("day"))).alias(f"lo{i}"), F.max(F.when(mine[i], F.col("day"))).alias(f"hi{i}"))])
    known = F.col("code").isNotNull()
    total = per_code.agg(F.count_if(known & (F.col("n0") > 0) & (F.col("n1") > 0)).alias("shared_codes"), *[c for i in (0, 1) for c in (
        F.sum(f"n{i}").alias(f"n{i}"), F.count_if(known & (F.col(f"n{i}") > 0)).alias(f"codes{i}"),
        F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}"))])
    rows = F.array(*[F.struct(
        F.lit(names[i]).alias("source"), F.col(f"n{i}").alias("n_rows"), F.col(f"codes{i}").alias("n_codes"), F.col(f"lo{i}").alias("min_date"),
        F.col(f"hi{i}").alias("latest_date"), "shared_codes") for i in (0, 1)])
    return total.select(F.inline(F.filter(rows, lambda r: r["n_rows"] > 0)))


def latest_complete_date(
    df: DataFrame, date: str, key: str, min_ratio: float = 0.9, trailing: int = 20
) -> DataFrame:
    """Newest day whose code count reaches a share of the trailing days' average."""
    day = as_date(date, df.schema[date].dataType)
    per_day = df.select(day.alias("trade_date"), key).groupBy("trade_date").agg(F.countDistinct(key).alias("n_codes"))
    # One row per day.
    norm = F.avg("n_codes").over(Window.orderBy("trade_date").rowsBetween(-trailing, -1))
    complete = per_day.withColumn("norm", norm).where(
        F.col("norm").isNull() | (F.col("n_codes") >= min_ratio * F.col("norm")))
    return complete.agg(
        F.max("trade_date").alias("latest_complete_date"),
        F.max_by("n_codes", "trade_date").alias("n_codes"), F.count(F.lit(1)).alias("n_complete_dates"))


def family_profile(df: DataFrame, col: str, families=CODE_FAMILIES) -> DataFrame:
    """Rows and distinct codes per code family; ``is_mixed`` with more than one."""
    per_code = df.groupBy(F.col(col).alias("_code")).agg(F.count(F.lit(1)).alias("_n"))
    per_family = per_code.groupBy(code_family("_code", families).alias("code_family")).agg(
        F.sum("_n").alias("n_rows"), F.count("_code").alias("n_codes"))
    # A handful of rows: the families are a fixed list.
    return per_family.withColumn("is_mixed", F.count(F.lit(1)).over(Window.partitionBy()) > 1)


def field_statuses(documented: Sequence[str], present: Sequence[str]) -> list[tuple[str, str]]:
    """Each documented field, then each column beyond them, with the statuses of ``contract_diff``."""
    lower = {c.lower() for c in present}
    known = {d.lower() for d in documented}
    of = lambda d: "match" if d in present else "case_only" if d.lower() in lower else "documented_absent"
    return [(d, of(d)) for d in documented] + [(c, "present_undocumented") for c in present if c.lower() not in known]


@dataclass
class ReportSpec:
    """What a validation report looks at; None leaves a check out."""

    key: Sequence[str] | None = None
    date_col: str | None = None
    params: Mapping[str, Any] = field(default_factory=dict)
    null_threshold: float = 0.5
    requested: DataFrame | None = None
    requested_key: str | None = None
    contract: Sequence[str] | None = None  # documented fields


def validation_report(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """The checks as long rows ``(check_name, subject, value, status)``.

    With a key or requested codes the table is read once, when the report is made:
    counts, spans, nulls and filter checks are observed on the rows on their way to
    one aggregate by key and code, from whose rows duplicates and coverage come.
    Without, the report is a lazy aggregate.  The input is never cached.
    """
    conds = param_conditions(df, spec.params)
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null{i}") for i, c in enumerate(df.columns)]
    aggs += [F.count_if(~F.coalesce(c, F.lit(False))).alias(f"bad{i}") for i, c in enumerate(conds.values())]
    if spec.date_col:
        name = resolve_name(df, spec.date_col)
        day = as_date(name, df.schema[name].dataType)
        days = F.size(F.collect_set(day))  # bounded by the date type
        aggs += [F.min(day).alias("lo"), F.max(day).alias("hi"), days.cast("long").alias("days")]

    def cell(check: str, subject: str, value: Column, status: Column | str) -> Column:
        return F.struct(
            F.lit(check).alias("check_name"), F.lit(subject).alias("subject"), value.cast("string").alias("value"),
            (F.lit(status) if isinstance(status, str) else status).alias("status"))

    def verdict(ok: Column) -> Column:
        return F.when(ok, "ok").otherwise("warn")

    cells = [
        cell("row_count", "*", F.col("n"), verdict(F.col("n") > 0)),
        cell("column_count", "*", F.lit(len(df.columns)), "info"),
    ]
    for i, c in enumerate(df.columns):
        ratio = F.coalesce(F.try_divide(f"null{i}", "n"), F.lit(0.0))
        cells.append(cell("null_count", c, F.col(f"null{i}"), verdict(ratio < spec.null_threshold)))
    for i, c in enumerate(conds):
        cells.append(cell("filter_violations", c, F.col(f"bad{i}"), verdict(F.col(f"bad{i}") == 0)))
    if spec.date_col:
        cells += [cell("min_date", spec.date_col, F.col("lo"), "info"),
                  cell("max_date", spec.date_col, F.col("hi"), "info"),
                  cell("distinct_dates", spec.date_col, F.col("days"), "info")]
    if spec.contract is not None:
        cells += [cell("contract_diff", name, F.lit(status), verdict(F.lit(status == "match"))) for name, status in field_statuses(spec.contract, df.columns)]
    if not spec.key and spec.requested is None:
        return df.agg(*aggs).select(F.inline(F.array(*cells)))

    spark, seen = df.sparkSession, Observation(f"report-{uuid.uuid4().hex}")
    code = (spec.requested_key or spec.requested.columns[0]) if spec.requested is not None else None
    fine = list(dict.fromkeys([*(spec.key or []), *([code] if code else [])]))
    per_key = df.observe(seen, *aggs).groupBy(*fine).agg(F.count(F.lit(1)).alias("n_rows"))
    summaries = []
    if spec.key:
        subject = ",".join(spec.key)
        repeated = (per_key if set(fine) == set(spec.key) else per_key.groupBy(*spec.key).agg(F.sum("n_rows").alias("n_rows"))).where("n_rows > 1")
        dup = repeated.agg(F.count(F.lit(1)).alias("k"), F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("x"))
        summaries.append(dup.select(F.inline(F.array(
            cell("duplicate_keys", subject, F.col("k"), verdict(F.col("k") == 0)),
            cell("excess_rows", subject, F.col("x"), verdict(F.col("x") == 0))))))
    if code:
        cov = code_coverage(spec.requested, per_key, code, count="n_rows").agg(
            F.count(F.lit(1)).alias("r"), F.count_if(~F.col("covered")).alias("z"))
        summaries.append(cov.select(F.inline(F.array(
            cell("requested_codes", code, F.col("r"), "info"),
            cell("zero_row_codes", code, F.col("z"), verdict(F.col("z") == 0))))))
    joint = reduce(DataFrame.unionByName, summaries)
    counted = joint.collect()  # two rows a check; the aggregate by key is one exchange that both read
    row = _observed(spark, df, aggs, seen)
    return row.select(F.inline(F.array(*cells))).unionByName(spark.createDataFrame(counted, joint.schema))


def _observed(spark: SparkSession, df: DataFrame, aggs: list[Column], seen: Observation) -> DataFrame:
    """What was observed, as the one row that the aggregates would give."""
    schema = df.limit(0).agg(*aggs).schema
    values = seen.get
    return spark.createDataFrame([tuple(values.get(name) for name in schema.names)], schema)
