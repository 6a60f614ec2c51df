"""Exact dedup across runs: new, already seen, repeated in this run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

NEW, SEEN, REPEAT = "new", "seen", "repeat"


def split_status(postings: DataFrame, seen: DataFrame, *order: str | Column, key: str = "stable_id") -> DataFrame:
    """Postings with ``status``.

    The first row of a key in ``order`` is ``seen`` where the store has the key,
    else ``new``; later rows are ``repeat`` even where it is stored.  One shuffle
    by key serves the window and the join; the store may have any size.
    """
    first = W.partitionBy(key).orderBy(*order)
    known = seen.select(F.col(key)).distinct().withColumn("__known", F.lit(True))
    rows = postings.withColumn("__turn", F.row_number().over(first)).join(known, key, "left")
    status = F.when(F.col("__turn") > 1, REPEAT).when(F.col("__known"), SEEN).otherwise(NEW)
    return rows.withColumn("status", status).drop("__turn", "__known")


def status_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("status").agg(F.count("*").alias("n"))


def remember(seen: DataFrame, treated: DataFrame, when: Column, *, key: str = "stable_id") -> DataFrame:
    """The store with the keys of treated postings added; a first-seen date
    never changes."""
    fresh = treated.select(key).distinct().join(seen, key, "left_anti").withColumn("first_seen", when)
    return seen.select(key, "first_seen").unionByName(fresh)
