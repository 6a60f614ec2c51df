"""The main query: parsed postings to a ranked, judged, deduplicated result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.functions import dates as D
from siftworks.functions import text as T
from siftworks.functions import vocabulary as V
from siftworks.operators import dedup, retention, scoring


def normalise(raw: DataFrame, vocabulary: V.Vocabulary = V.TECHNOLOGIES, slugger=T.slug) -> DataFrame:
    """The unified schema from pivot rows; rows with neither id nor URL go.

    Carries any order columns of the input.  Adds ``tech`` and ``stable_id``.
    """
    own = {"id", "source", "company", "title", "location", "remote_type", "url", "date", "description"}
    carried = [c for c in raw.columns if c not in own]
    flat = ("id", "source", "company", "title", "location", "url")
    clean = raw.select(*carried, *[T.squash(F.col(c)).alias(c) for c in flat], "remote_type", "date", "description").where("id <> '' OR url <> ''")
    rows = clean.select(
        *carried,
        F.when(F.col("id") != "", F.col("id")).otherwise(T.derived_id(F.col("url"))).alias("id"),
        *flat[1:],
        T.work_mode(F.col("remote_type"), F.col("location")).alias("remote_type"),
        D.to_iso_utc(F.col("date")).alias("date"),
        T.strip_markup(F.col("description")).alias("description"),
    )
    return rows.withColumn("tech", V.tag_posting(F.col("title"), F.col("description"), vocabulary)).withColumn("stable_id", T.stable_id(F.col("source"), F.col("company"), F.col("id"), slugger))


def collect(raw: DataFrame, seen: DataFrame, keep: retention.Retention, rate: scoring.Scoring, *order: str, slugger=T.slug) -> dict[str, DataFrame]:
    """judged, split, scored and ranked frames of one run: retention, then dedup of
    what stayed, then scores of what is new.  Two shuffles: one by key, one for
    the final order."""
    rows = normalise(raw, keep.vocabulary, slugger)
    judged = retention.judge(rows, keep)
    split = dedup.split_status(judged.where("verdict.kept").drop("verdict"), seen, *order)
    scored = scoring.score(split.where(F.col("status") == dedup.NEW), rate)
    return {"judged": judged, "split": split, "scored": scored, "ranked": scoring.ranked(scored, *order)}


def valid(posting: DataFrame) -> DataFrame:
    """Rows that satisfy the schema's constraints."""
    filled = (F.col("id") != "") & (F.col("source") != "") & (F.col("url") != "")
    return posting.where(filled & F.col("remote_type").isin("remote", "hybrid", "onsite", "unknown"))
