"""Incremental runs: postings as a stream, state in shared tables.

Each micro-batch is one run of the fast or the slow loop: split against the
seen store, judged, scored, handed to a sink, and only then remembered, so what
a sink did not treat comes again.  Seen keys are an append-only table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftworks.operators import dedup

SEEN = "stable_id string, first_seen timestamp"


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """The seen store; a missing one is empty, any other trouble an error, as
    an empty store would have everything published again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], SEEN)
    return spark.read.schema(SEEN).parquet(path)


def run_batch(batch: DataFrame, seen_path: str, treat: Callable[[DataFrame], DataFrame], *order: str, now=None) -> None:
    """One run.  ``treat`` takes the new postings and returns the rows (with
    ``stable_id``) that were treated; those are remembered after it returns."""
    spark = batch.sparkSession
    split = dedup.split_status(batch, read_seen(spark, seen_path), *order)
    treated = treat(split.where(F.col("status") == dedup.NEW).drop("status"))
    when = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    fresh = treated.select("stable_id").distinct().withColumn("first_seen", when)
    # the treated keys stem from rows that the store lacked: they are an append
    fresh.write.mode("append").parquet(seen_path)


def follow(postings: DataFrame, seen_path: str, checkpoint: str, treat: Callable[[DataFrame], DataFrame], *order: str) -> StreamingQuery:
    """Run over everything that has arrived (a cron run), then stop.

    A batch that is repeated after a crash finds the treated keys remembered
    and does not treat them again.
    """
    return (
        postings.writeStream.foreachBatch(lambda b, _: run_batch(b, seen_path, treat, *order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def high_water(entries: DataFrame, cursor: str) -> DataFrame:
    """Dated entries strictly after a cursor; late ones at or before it are
    passed over, as an incremental crawl does."""
    return entries.where((F.col("lastmod") != "") & (F.col("lastmod") > cursor))
