"""Sessions with the settings that the operators rely on, and their workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run.

    One zip a Spark application, sent by ``addPyFile`` so that executors that
    join later fetch it too.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="siftworks-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, f"{root.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def session(name: str = "siftworks", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew joins; anything else by ``conf``."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """A table whose files have fewer splits than there are cores is dealt over
    all of them, as the work on a row costs more than moving it; a table of
    more splits stays as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
