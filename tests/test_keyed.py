"""Keyed state against the split by a seen store, run by run."""

from __future__ import annotations

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftworks.operators import dedup
from siftworks.streaming import keyed

SCHEMA = "stable_id string, turn int, label string, run int"


class Runs:
    """Folders that grow, and a query over them on one checkpoint."""

    def __init__(self, spark, top, **options):
        self.spark, self.top, self.options, self.n = spark, top, options, 0
        for folder in ("postings", "treated"):
            spark.createDataFrame([], SCHEMA if folder == "postings" else "stable_id string").write.mode("append").parquet(f"{top}/{folder}/0")

    def __call__(self, postings, treated=(), sink=None):
        self.n += 1
        self.spark.createDataFrame(postings, SCHEMA).repartition(2).write.parquet(f"{self.top}/postings/{self.n}")
        if treated:
            self.spark.createDataFrame([(k,) for k in treated], "stable_id string").write.parquet(f"{self.top}/treated/{self.n}")
        self.again(sink)
        return [tuple(r) for r in self.spark.read.parquet(f"{self.top}/out").where(F.col("run") == self.n).select("stable_id", "turn", "label", "status").collect()]

    def again(self, sink=None):
        read = lambda folder, schema: self.spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.top}/{folder}")
        split = keyed.split_stream(read("postings", SCHEMA), read("treated", "stable_id string"), "turn", "label", **self.options)
        writer = split.writeStream.option("checkpointLocation", f"{self.top}/checkpoint").trigger(availableNow=True)
        writer = writer.foreachBatch(sink) if sink else writer.format("parquet").option("path", f"{self.top}/out")
        query = writer.start()
        query.awaitTermination()


def test_runs_equal_the_split_by_a_store(spark, tmp_path):
    """Every start is a restart on the checkpoint; ids that the sink put off come
    as new again."""
    rng = random.Random(11)
    runs, seen, treated = Runs(spark, str(tmp_path)), set(), []
    for n in range(1, 4):
        keys = ["hot"] * 40 + [None] * 3 + [f"k{rng.randrange(12)}" for _ in range(30)]
        rows = [(k, rng.choice([None, *range(5)]), f"l{i}", n) for i, k in enumerate(keys)]
        rng.shuffle(rows)
        got = runs(rows, treated)
        store = spark.createDataFrame([(k, None) for k in seen | set(treated)], "stable_id string, first_seen timestamp")
        some = spark.createDataFrame(rows, SCHEMA).where("stable_id IS NOT NULL")
        want = dedup.split_status(some, store, "turn", "label").select("stable_id", "turn", "label", "status")
        assert Counter(r for r in got if r[0] is not None) == Counter(map(tuple, want.collect()))
        assert Counter(r[3] for r in got if r[0] is None) == {"new": 1, "repeat": 2}
        seen |= set(treated)
        new = sorted(r[0] for r in got if r[3] == "new" and r[0] is not None)
        treated = new[::2]  # the others are put off
    assert seen and any(r[3] == "seen" for r in got)


def test_a_failed_run_is_repeated_as_it_was(spark, tmp_path):
    runs = Runs(spark, str(tmp_path))

    def fails(batch, number):
        raise RuntimeError("the sink broke")

    with pytest.raises(Exception, match="sink broke"):
        runs([("a", 1, "x", 1), ("a", 2, "y", 1)], ["a"], sink=fails)
    got = []
    runs.again(sink=lambda batch, number: got.extend((r["label"], r["status"]) for r in batch.collect()))
    assert sorted(got) == [("x", "seen"), ("y", "repeat")]


def test_ids_are_forgotten_after_their_retention(spark, tmp_path):
    runs = Runs(spark, str(tmp_path), retention_days=6 / 86_400)
    assert runs([], ["a", "b"]) == []
    assert [r[3] for r in runs([("a", 1, "x", 2)])] in (["seen"], ["new"])  # a slow machine may take longer than that
    time.sleep(7)
    assert [r[3] for r in runs([("a", 1, "x", 3)])] == ["new"]
    assert runs([("c", 1, "x", 4)]) == [("c", 1, "x", "new")]
