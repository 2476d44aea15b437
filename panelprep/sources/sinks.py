"""Sinks: csv, json lines and Parquet directories."""

from __future__ import annotations

from pyspark.sql import DataFrame

FORMATS = ("csv", "json", "parquet")


def resolve_format(path: str | None, explicit: str | None = None) -> str:
    """An explicit format wins; no path means csv; else the suffix, any case."""
    if explicit:
        return explicit
    if path is None:
        return "csv"
    name = str(path).rstrip("/").rsplit("/", 1)[-1]
    suffix = name.rsplit(".", 1)[-1].lower() if "." in name else ""
    if suffix not in FORMATS:
        raise ValueError(f"can't tell the format from {suffix or 'no suffix'!r}; name one of {', '.join(FORMATS)}")
    return suffix


def write(
    df: DataFrame, path: str, fmt: str | None = None, mode: str = "errorifexists", partition_by: str | None = None
) -> str:
    """Write a directory of part files, one per task; returns the path.

    Parent directories are made.  Json is one record per line with null keys
    kept; csv has a header and no byte-order mark.  ``partition_by`` makes a folder
    per value; rows are brought together by it first, a large value in several
    tasks, so a value has few files.
    """
    kind = resolve_format(path, fmt)
    if kind not in FORMATS:
        raise ValueError(f"unsupported format {kind!r}")
    writer = df.hint("rebalance", partition_by).write.mode(mode).partitionBy(partition_by) if partition_by else df.write.mode(mode)
    if kind == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif kind == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.parquet(path)
    return path
