"""Session settings the operators are measured with, and cutting of lineage."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE does the sizing at run time: it merges small shuffle partitions, splits a
# hot join key over several tasks, and turns a join into a broadcast only when
# the measured side is under the threshold.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HTML pages are wide rows: bound an Arrow batch by bytes, not rows only.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def local_session(name: str = "panelprep", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PANELPREP_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Without one, only a session whose executors run inside the driver (master
    ``local``) gets a folder of its own; any other is an error, as executors
    would write to disks that nobody else sees.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = f"/tmp/panelprep-{uuid.uuid4().hex}"
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    For a frame with more than one consumer: the plan below it runs once and a
    lost executor costs a re-read, not a re-run.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
