"""Observation notes as a table: names, text, and what is worth promoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelprep.functions.text import slug
from panelprep.operators.sets import numbered


def note_names(notes: DataFrame, order_col: str = "note_id", topic: str = "topic", at: str = "noted_at") -> DataFrame:
    """Adds ``note_name``: ``yyyyMMdd-HHmmss-slug``, later notes of the same name ``-2``, ``-3`` …

    ``order_col`` is the unique numeric order in which notes came.
    """
    base = F.concat_ws("-", F.date_format(at, "yyyyMMdd-HHmmss"), slug(topic))
    ranked = numbered(notes.withColumn("_base", base), ["_base"], order_col, "_nth")
    name = F.when(F.col("_nth") == 1, F.col("_base")).otherwise(F.concat_ws("-", "_base", F.col("_nth")))
    return ranked.withColumn("note_name", name).drop("_base", "_nth")


def note_text(notes: DataFrame, name: str = "note_text") -> DataFrame:
    """Adds the note as Markdown with its fixed headings."""
    def given(col: str) -> Column:
        return F.nullif(F.col(col), F.lit(""))

    def code(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"- {label}: `"), value, F.lit("`"))

    nothing = F.lit("- none recorded")
    source = F.nullif(F.concat_ws("\n", code("`doc_id`", given("doc_id")), code("page", given("page_url"))), F.lit(""))
    params = F.transform(F.map_entries("params"), lambda e: F.concat(
        F.lit("- `"), e["key"], F.lit("` = `"), e["value"], F.lit("`")))
    param_lines = F.when(F.size("params") > 0, F.array_join(params, "\n"))
    evidence = F.array_join(F.transform("evidence", lambda e: F.concat(F.lit("- "), e)), "\n")
    blank = F.lit("")
    rows = [
        F.concat(F.lit("# Runtime Note: "), F.col("task")), blank,
        code("Date", F.date_format("noted_at", "yyyy-MM-dd HH:mm:ss")),
        code("Topic", F.col("topic")),
        code("Status", F.coalesce(given("status"), F.lit("tentative"))),
        code("API Name", F.coalesce(given("api_name"), F.lit("unknown"))), blank,
        F.lit("## Source"), F.coalesce(source, nothing), blank,
        F.lit("## Key Params"), F.coalesce(param_lines, nothing), blank,
        F.lit("## Observed Behavior"), F.col("summary"), blank,
        F.lit("## Evidence"), evidence, blank,
        F.lit("## Decision Impact"), F.col("impact"), blank,
    ]
    return notes.withColumn(name, F.concat_ws("\n", *rows))


def promotable(notes: DataFrame, min_tasks: int = 2) -> DataFrame:
    """Adds ``tasks_seen``, ``promote`` and the reason against it.

    Promoted: has evidence, changes a decision, is durable, and its topic and API
    came up in at least ``min_tasks`` tasks.  The task counts are a partial
    aggregate joined back, so a popular topic isn't gathered in one place.
    """
    keys = ["topic", "_api"]
    keyed = notes.withColumn("_api", F.coalesce("api_name", F.lit("")))
    seen = keyed.groupBy(*keys).agg(F.countDistinct("task").alias("tasks_seen"))
    has_evidence = F.exists("evidence", lambda e: F.trim(e) != "")
    reason = (
        F.when(~F.coalesce(has_evidence, F.lit(False)), "no evidence")
        .when(F.trim(F.coalesce("impact", F.lit(""))) == "", "changes no decision")
        .when(~F.col("status").eqNullSafe("durable"), "not durable")
        .when(F.coalesce("tasks_seen", F.lit(0)) < min_tasks, "seen in too few tasks")
    )
    return (
        keyed.join(seen, keys, "left").drop("_api")
        .withColumn("reject_reason", reason).withColumn("promote", F.col("reject_reason").isNull())
    )


def recurring_gaps(notes: DataFrame, gap: str = "summary", min_tasks: int = 2) -> DataFrame:
    """Gaps that came up in several tasks."""
    return notes.groupBy("topic", "api_name", gap).agg(
        F.countDistinct("task").alias("tasks_seen"), F.count(F.lit(1)).alias("n_notes"),
    ).where(F.col("tasks_seen") >= min_tasks)
