"""Value lists: from files, from inline text, and slices that may be missing."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from panelprep.functions.text import as_col, literal_type, strip
from panelprep.session import durable


MAX_DOCUMENT_BYTES = 16 * 1024 * 1024


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    return name.rsplit(".", 1)[-1] if "." in name else ""


def _file_order() -> Column:
    """Sorts like file, then place in the file; tasks take blocks in any order, but a block's rows in their own."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def _with_pos(df: DataFrame, value: Column) -> DataFrame:
    # No shuffle and no single task: ``pos`` orders values, it doesn't count them.
    return df.select(_file_order().alias("pos"), value.alias("value")).where(F.col("value").isNotNull() & (F.col("value") != ""))


def read_values(
    spark: SparkSession, path: str, column: str | None = None, fmt: str | None = None, header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Value list ``(pos, value)`` from a txt, csv, tsv, json or jsonl file or folder.

    ``json`` is one document: an array, or an object that holds one.  ``jsonl`` is
    one record per line, which is what ``write`` makes and what splits over tasks.

    Values stay text (``000300`` keeps its zeros); ``typed_values`` types them.
    ``pos`` sorts in the order of files and of lines in them.  Blank values are
    dropped, a missing file is an error.  With ``multi_line`` a quoted csv cell may
    hold line breaks; a file is then read by one task, so it's off by default.
    """
    kind = (fmt or _suffix(path)).lower()
    if kind == "json":
        return _json_values(spark, path, column)
    if kind == "jsonl":
        return _json_line_values(spark, path, column)
    if kind in ("csv", "tsv"):
        sep = "\t" if kind == "tsv" else ","
        raw = spark.read.csv(path, sep=sep, header=header, inferSchema=False, encoding="UTF-8", escape='"', multiLine=multi_line)
        if not raw.columns:
            return spark.createDataFrame([], "pos struct<file:string,block:long,row:long>, value string")
        name = (column or raw.columns[0]) if header else raw.columns[0]
        if name not in raw.columns:
            raise ValueError(f"no column {name!r} in {path}; available: {', '.join(raw.columns)}")
        return _with_pos(raw, strip(F.col(f"`{name}`")))
    return _with_pos(spark.read.text(path), strip("value"))


def typed_values(values: DataFrame) -> DataFrame:
    """A value list's texts as ``(pos, text, kind)``."""
    return values.select("pos", literal_type("value").alias("v")).select("pos", "v.text", "v.kind")


def with_inline(values: DataFrame, inline: str) -> DataFrame:
    """A typed file list extended by an inline one: ``(part, pos, text, kind)``, ``part`` 0 before 1.

    ``pos`` becomes text that sorts as before within its part.
    """
    spark = values.sparkSession
    given = spark.range(1).select(F.posexplode(parse_value_list(F.lit(inline))).alias("pos", "v"))
    first = values.select(F.lit(0).alias("part"), F.concat_ws(
        "#", "pos.file", F.lpad(F.col("pos.block").cast("string"), 20, "0"), F.lpad(F.col("pos.row").cast("string"), 20, "0")).alias("pos"), "text", "kind")
    return first.unionByName(given.select(
        F.lit(1).alias("part"), F.lpad(F.col("pos").cast("string"), 20, "0").alias("pos"), "v.text", "v.kind"))


def _field(item: Column, column: str | None, path: str) -> Column:
    """Text of a JSON record's field; an error where there's no such field."""
    no_column = F.raise_error(F.lit(f"{path} holds JSON objects; name a column")).cast("string")
    if column is None:
        return no_column
    absent = F.raise_error(F.lit(f"column {column!r} is absent from a record in {path}")).cast("string")
    inner = F.try_variant_get(item, f"$['{column}']", "variant")
    return F.when(inner.isNull(), absent).otherwise(inner.cast("string"))


def _is_object(item: Column) -> Column:
    return F.startswith(F.schema_of_variant(item), F.lit("OBJECT"))


def _json_line_values(spark: SparkSession, path: str, column: str | None) -> DataFrame:
    item = F.try_parse_json("value")
    bad = F.raise_error(F.concat(F.lit(f"{path}: not JSON: "), F.col("value"))).cast("string")
    value = F.when(item.isNull(), bad).when(_is_object(item), _field(item, column, path)).otherwise(item.cast("string"))
    rows = spark.read.text(path).where(strip("value") != "")
    return rows.select(_file_order().alias("pos"), value.alias("value"))


def _json_values(spark: SparkSession, path: str, column: str | None) -> DataFrame:
    # One JSON document is one record for Spark, whatever reads it, and a parsed one has a size limit.
    size = spark.read.format("binaryFile").load(path).select("length").agg(F.max("length")).first()[0] or 0
    if size > MAX_DOCUMENT_BYTES:
        raise ValueError(f"a JSON document of {size} bytes under {path} can't be parsed as one value; write one record per line (jsonl)")
    doc = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("doc"))
    array = "array<variant>"
    top = F.try_variant_get("doc", "$", array)
    listed = [F.try_variant_get("doc", "$.values", array)]
    if column is not None:
        listed.append(F.try_variant_get("doc", f"$['{column}']", array))
    bad_json = F.raise_error(F.lit(f"{path} is not valid JSON")).cast(array)
    bad_shape = F.raise_error(F.lit(
        f"{path}: expected an array, an object with a 'values' array, or one with the column's array")).cast(array)
    items = F.when(F.col("doc").isNull(), bad_json).otherwise(F.coalesce(top, *listed, bad_shape))
    objects = top.isNotNull() & F.exists(items, _is_object)
    rows = doc.select(items.alias("items"), objects.alias("objects")).select(
        "objects", F.posexplode("items").alias("pos", "item"))
    mixed = F.raise_error(F.lit(f"{path} mixes scalars and objects")).cast("string")
    record = F.when(_is_object(F.col("item")), _field(F.col("item"), column, path)).otherwise(mixed)
    value = F.when(F.col("objects"), record).otherwise(F.col("item").cast("string"))
    return rows.select(F.col("pos").cast("long").alias("pos"), value.alias("value"))


def parse_value_list(col: Column | str, strict: bool = True) -> Column:
    """Inline list to ``array<struct<text, kind>>``.

    Blank gives an empty array; text that starts with ``[`` is a JSON array;
    anything else is split at commas, trimmed, blanks dropped.  A bad JSON array
    is an error, or NULL with ``strict=False``.
    """
    raw = strip(as_col(col))
    plain = F.filter(F.transform(F.split(raw, ","), strip), lambda x: x != "")
    items = F.try_variant_get(F.try_parse_json(raw), "$", "array<variant>")
    # a parsed 1.0 is an integer: numbers are typed from their text, which keeps a float one (1.50 becomes 1.5)
    texts = F.from_json(raw, "array<string>")
    as_literals = F.zip_with(items, texts, lambda v, text: literal_type(
        F.when(F.schema_of_variant(v).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), text).otherwise(F.to_json(v))))
    if strict:
        failed = F.raise_error(F.concat(F.lit("not a JSON array: "), raw)).cast(
            "array<struct<text:string,kind:string>>")
        as_literals = F.coalesce(as_literals, failed)
    empty = F.array().cast("array<struct<text:string,kind:string>>")
    return (
        F.when(raw == "", empty)
        .when(F.startswith(raw, F.lit("[")), as_literals)
        .otherwise(F.transform(plain, literal_type))
    )


def split_read_paths(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | str, continue_on_error: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Stored slices as one scan, plus a log ``(request_pos, path, status)``.

    A slice that can't be read is an error, or is left out and logged as failed
    with ``continue_on_error``; if every slice fails it's an error either way, and
    no slices give an empty frame.  To know before anything is used,
    ``continue_on_error`` reads each slice once on its own, all its columns; what
    breaks later is an error, so no slice is ever lost in part.  ``paths`` is the
    caller's request list.
    """
    good: list[str] = []
    log: list[tuple[int, str, str]] = []
    for pos, path in enumerate(paths, start=1):
        try:
            slice_ = spark.read.schema(schema).option("ignoreCorruptFiles", False).parquet(path)
            if continue_on_error:
                slice_.write.format("noop").mode("overwrite").save()
        except (PySparkException, Py4JJavaError):  # a file that breaks while it's read is the JVM's error
            if not continue_on_error:
                raise
            log.append((pos, path, "failed"))
        else:
            good.append(path)
            log.append((pos, path, "ok"))
    log_df = spark.createDataFrame(log, "request_pos int, path string, status string")
    if not good:
        if log:
            raise ValueError("all slices failed")
        return spark.createDataFrame([], schema), log_df
    return spark.read.schema(schema).option("ignoreCorruptFiles", False).parquet(*good), log_df


_PROBED = "file string, readable boolean, n_rows long"


def _probe(schema: T.StructType):
    """Reads files given as bytes, footers and all pages of the columns asked for."""
    wanted = to_arrow_schema(schema)

    def same(found: pa.DataType, asked: pa.DataType) -> bool:
        if pa.types.is_timestamp(asked):
            return pa.types.is_timestamp(found)
        whole = pa.types.is_integer(asked) and pa.types.is_integer(found)
        return found.equals(asked) or (whole or pa.types.is_floating(asked) and pa.types.is_floating(found)) and found.bit_width <= asked.bit_width

    def rows_of(content: bytes) -> int:
        file = pq.ParquetFile(pa.BufferReader(content))
        columns = [f.name for f in wanted if f.name in file.schema_arrow.names]
        if not all(same(file.schema_arrow.field(c).type, wanted.field(c).type) for c in columns):
            raise pa.ArrowInvalid("another type than asked for")
        counted = sum(batch.num_rows for batch in file.iter_batches(columns=columns)) if columns else file.metadata.num_rows
        if counted != file.metadata.num_rows:
            raise pa.ArrowInvalid("fewer rows than the footer says")
        return counted

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    out.append((path, True, rows_of(content.as_py())))
                except (pa.ArrowException, OSError, ValueError):
                    out.append((path, False, 0))
            columns = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.bool_(), pa.int64()))], names=["file", "readable", "n_rows"])

    return probe


def split_read_table(
    spark: SparkSession, root: str, requests: DataFrame, schema: T.StructType | str, path_col: str = "path",
) -> tuple[DataFrame, DataFrame]:
    """Stored slices named by a table of requests: the readable ones as one scan, and a log of all.

    A slice is a Parquet file or a folder of such files right under ``root``.  One
    job lists and reads all files there, a file a row, on the executors, and the
    requests are joined to what it found; so there's no loop over slices, and they
    may be in any store that Spark reads.  The log is ``requests`` with ``status``
    and ``n_rows``: ``ok``, ``missing``, or ``failed`` if a file can't be read to
    its end or has another type than asked for.  Rows come from slices that are
    ``ok``, each once; their paths are collected, as Spark's own list of files is.
    What breaks after the probe is an error, so no slice is lost in part.  A single
    file must be under 2 GB, the largest value Spark holds; a larger one is an error.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    base = root.rstrip("/")
    inside = "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "", base).strip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base).select("path", "content")
    probed = files.mapInArrow(_probe(schema), _PROBED)
    below = F.expr("substring(file, locate(inside, file) + length(inside))")
    slices = probed.withColumn("inside", F.lit(inside)).select(
        F.substring_index(below, "/", 1).alias("_slice"), "readable", "n_rows")
    found = durable(slices.groupBy("_slice").agg(F.min("readable").alias("_readable"), F.sum("n_rows").alias("_n")))
    status = F.when(F.col("_readable").isNull(), "missing").when(F.col("_readable"), "ok").otherwise("failed")
    asked = requests.withColumn("_asked", F.trim(F.col(path_col), F.lit("/")))
    log = asked.join(found, F.col("_asked") == F.col("_slice"), "left").select(
        *requests.columns, status.alias("status"), F.when(status == "ok", F.col("_n")).otherwise(0).cast("long").alias("n_rows"))
    good = [r[0] for r in log.where("status = 'ok'").select(F.trim(F.col(path_col), F.lit("/"))).distinct().collect()]
    if not good:
        return spark.createDataFrame([], schema), log
    return spark.read.schema(schema).option("ignoreCorruptFiles", False).parquet(*(f"{base}/{name}" for name in sorted(good))), log


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows that each file of a file-based scan delivered, for the slice log."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("n_rows"))
