"""Aligning codes and column names with what a table really holds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from panelprep.functions.codes import hk_default, hk_key


def normalize_hk(df: DataFrame, observed: DataFrame, col: str, observed_col: str | None = None,
                 name: str = "code_norm") -> DataFrame:
    """Codes in the padding that the observed table uses for the same security.

    Hong Kong codes meet on their number without leading zeros; a code that the
    observed table lacks gets the four-digit form, and other markets' codes stay.
    """
    seen = (
        observed.select(F.col(observed_col or col).alias("_seen")).where(hk_key("_seen").isNotNull())
        .groupBy(hk_key("_seen").alias("_key")).agg(F.min("_seen").alias("_seen"))
    )
    return (
        # Other markets keep a key of their own, so they don't pile up on null.
        df.withColumn("_key", F.coalesce(hk_key(col), F.concat(F.lit("-"), F.col(col)))).join(seen, "_key", "left")
        .select(*df.columns, F.coalesce("_seen", hk_default(col)).alias(name))
    )


def align_columns(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Rename columns to common names before a join, whatever their case."""
    lower = {k.lower(): v for k, v in aliases.items()}
    renames = {c: lower[c.lower()] for c in df.columns if c.lower() in lower}
    out = [renames.get(c, c) for c in df.columns]
    if len({c.lower() for c in out}) != len(out):
        raise ValueError(f"aligned names collide: {', '.join(out)}")
    return df.withColumnsRenamed(renames)
