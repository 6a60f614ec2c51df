"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target number of words and a weight schedule over training
time 0..1.  Its documents form a stream in hashed order, repeated until the
target; the schedule's integral is the share of the target that is due by a
time, so inverting it at a document's place in the stream gives the time at
which the document is due.  The demand of all sources up to that time, in
words, is its training position; sorting all occurrences by position (a range
sort) is the training order.

Places in the stream are prefix sums over (source, hash).  A source may hold a
third of all rows, so they are taken in two levels: inside hash buckets that
are small by construction, and over the buckets' totals.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siftworks.llm.common import materialise, text_of, word_count

#: Knots (time, weight) of a schedule; between knots the weight is linear.
Schedule = Sequence[tuple[float, float]]
FLAT: Schedule = ((0.0, 1.0), (1.0, 1.0))
#: Default curriculum: sources of high weight early and late, the rest between.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 1.0), (0.5, 0.6), (1.0, 1.4)),
    ((0.0, 1.2), (1.0, 0.6)),
    ((0.0, 0.4), (0.6, 1.2), (1.0, 1.0)),
)
#: Sources up to this number are joined by broadcast, 100 bytes each.
BROADCAST_SOURCES = 20_000


def water_fill(sizes: Sequence[int], weights: Sequence[float], budget: float, most: float) -> list[float]:
    """Shares of ``budget`` by weight, none above ``most`` times its size; what
    a capped share loses goes to the others by weight, until none is above."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(budget)
    while open_:
        total = sum(weights[i] for i in open_)
        if total <= 0 or left <= 0:
            break
        over = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        # every share above its limit is set to it; the excess is shared anew
        for i in over:
            out[i] = most * float(sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def segments(schedule: Schedule) -> list[tuple[float, float, float, float, float, float]]:
    """(from, to, weight from, weight to, due before, due after) for each part
    of a schedule, ``due`` being the normalised integral of the weight."""
    parts = list(zip(schedule, schedule[1:]))
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in parts]
    if not parts or sum(areas) <= 0 or any(t1 < t0 for (t0, _), (t1, _) in parts) or any(w < 0 for _, w in schedule):
        raise ValueError(f"not a weight schedule: {schedule!r}")
    total, done, out = sum(areas), 0.0, []
    for ((t0, w0), (t1, w1)), a in zip(parts, areas):
        out.append((float(t0), float(t1), float(w0), float(w1), done / total, (done + a) / total))
        done += a
    out[-1] = (*out[-1][:5], 1.0)
    return out


SEGMENT = "array<struct<t0:double,t1:double,w0:double,w1:double,d0:double,d1:double>>"


def due_time(due: Column, parts: Column) -> Column:
    """The time at which a share ``due`` (0..1) of a source is due.

    Inside a segment the integral is a quadratic in time; the stable root
    ``2c / (w0 + sqrt(w0^2 + 2 k c))`` also covers constant weights.
    """
    part = F.coalesce(F.get(F.filter(parts, lambda p: p["d1"] >= due), F.lit(0)), F.element_at(parts, -1))
    total = F.aggregate(parts, F.lit(0.0), lambda s, p: s + (p["t1"] - p["t0"]) * (p["w0"] + p["w1"]) / 2)
    area = (due - part["d0"]) * total
    slope = (part["w1"] - part["w0"]) / F.when(part["t1"] > part["t0"], part["t1"] - part["t0"]).otherwise(1.0)
    root = part["w0"] + F.sqrt(F.greatest(F.lit(0.0), part["w0"] * part["w0"] + 2 * slope * area))
    return F.when(root > 0, F.least(part["t1"], part["t0"] + 2 * area / F.when(root > 0, root).otherwise(1.0))).otherwise(part["t0"])


def share_due(time: Column, schedule: Schedule) -> Column:
    """The share (0..1) of a source of this schedule that is due by ``time``:
    the inverse of :func:`due_time`."""
    parts = segments(schedule)
    total = sum((t1 - t0) * (w0 + w1) / 2 for t0, t1, w0, w1, _, _ in parts)
    area = F.lit(0.0)
    for t0, t1, w0, w1, _, _ in parts:
        x = F.least(F.greatest(time - t0, F.lit(0.0)), F.lit(t1 - t0))
        area = area + x * w0 + x * x * ((w1 - w0) / (2 * (t1 - t0)) if t1 > t0 else 0.0)
    return area / total


def mix(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    schedules: Sequence[Schedule] = SCHEDULES,
    source_weights: Mapping[str | None, float] | None = None,
    rows_per_bucket: int = 1_000,
) -> DataFrame:
    """One row a document: what the mix takes of it, and when.

    Columns: doc_id, source, size, source_size, target, taken, n_passes,
    positions (array<struct<time, position, pass, words>>, empty where nothing
    is taken; ``position`` counts the words that all sources owe by then).

    Sources in code-point order, null last, get ``weights`` and ``schedules`` in
    turn (``source_weights`` overrides single ones).  They share ``share`` times
    all words; no target is above ``most`` times its source.  A source's stream
    is passed over until its target is met; the last document is cut there, so
    a source's taken words are its target rounded to a word.  The order hashes
    id and size, so reruns agree; rows equal in id, source and size are
    interchangeable.  Documents without words (null, empty, blank) take 0 and
    have no position.  An empty table gives an empty result.
    """
    spark = df.sparkSession
    docs = materialise(
        df.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            word_count(text_of(text_col)).alias("size"),
        ).withColumn("rank", F.xxhash64("doc_id", "size")),
        "mix-sizes",
    )
    sources = docs.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()  # one row a source
    sources.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["n"] for r in sources]
    shares = [float((source_weights or {}).get(r["source"], weights[i % len(weights)])) for i, r in enumerate(sources)]
    targets = water_fill(sizes, shares, share * sum(sizes), most)
    # both levels of the prefix sums grow as the root of a very large source
    bucket = [max(rows_per_bucket, math.isqrt(r["rows"])) for r in sources]
    owed = [0.0] * len(schedules)  # words of all sources of each schedule
    for i, t in enumerate(targets):
        owed[i % len(schedules)] += t
    table = spark.createDataFrame(
        [(i, r["source"], sizes[i], targets[i], math.floor(targets[i] + 0.5), -(-r["rows"] // bucket[i]), segments(schedules[i % len(schedules)])) for i, r in enumerate(sources)],
        f"source_no int, source string, source_size long, target double, goal long, n_buckets long, parts {SEGMENT}",
    )
    if len(sources) <= BROADCAST_SOURCES:
        table = F.broadcast(table)

    docs = docs.join(table, docs["source"].eqNullSafe(table["source"])).drop(table["source"])
    # as many buckets as a source needs for them to be of one size, in hash order
    docs = docs.withColumn("bucket", F.floor((F.shiftrightunsigned("rank", 1) / float(2**63)) * F.col("n_buckets")).cast("long"))
    within = W.partitionBy("source_no", "bucket").orderBy("rank", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    docs = docs.withColumn("upto", F.sum("size").over(within))
    totals = docs.groupBy("source_no", "bucket").agg(F.sum("size").alias("held"))
    before = totals.select("source_no", "bucket", (F.sum("held").over(W.partitionBy("source_no").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("held")).alias("before"))
    docs = docs.join(before, ["source_no", "bucket"])

    start = F.col("before") + F.col("upto") - F.col("size")
    passes = F.when((F.col("size") > 0) & (F.col("goal") > start), F.ceil((F.col("goal") - start) / F.col("source_size"))).otherwise(0).cast("int")
    docs = docs.withColumn("n_passes", passes)

    def occurrence(k: Column) -> Column:
        at = start + k * F.col("source_size")
        words = F.least(F.col("size"), F.col("goal") - at)
        return F.struct(
            due_time((at + words / 2) / F.greatest(F.col("goal"), F.lit(1)), F.col("parts")).alias("time"),
            F.lit(0.0).alias("position"),
            (k + 1).cast("int").alias("pass"),
            words.cast("long").alias("words"),
        )

    some = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_passes").cast("long") - 1), occurrence)
    docs = docs.withColumn("positions", F.when(F.col("n_passes") > 0, some).otherwise(F.array().cast("array<struct<time:double,position:double,pass:int,words:bigint>>")))
    demand = lambda t: sum((share_due(t, s) * o for s, o in zip(schedules, owed)), F.lit(0.0))
    docs = docs.withColumn("positions", F.transform("positions", lambda p: p.withField("position", demand(p["time"]))))
    taken = F.aggregate("positions", F.lit(0).cast("long"), lambda s, p: s + p["words"])
    return docs.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "n_passes", "positions")


#: The training order: ties of position by time, source, id, pass and words.
ORDER = ("position", "time", "source", "doc_id", "pass", "words")


def training_order(mixed: DataFrame) -> DataFrame:
    """Every occurrence, range-sorted by its training position (ties as in
    :data:`ORDER`): position, time, doc_id, source, pass, words."""
    return (
        mixed.select("doc_id", "source", F.explode("positions").alias("p"))
        .select("p.position", "p.time", "doc_id", "source", "p.pass", "p.words")
        .orderBy(*ORDER)
    )


def places(mixed: DataFrame) -> DataFrame:
    """``mixed`` with the places of each document's occurrences in the training
    order: times (array<double>) and places (array<long>, counted from 0), pass
    by pass, empty where nothing is taken.

    The order is one range sort.  A row's number inside its part of the sort,
    and the parts' running totals (one row a part on the driver), give its
    place, so no task sees all rows.
    """
    spark = mixed.sparkSession
    rows = materialise(mixed.withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    sorted_ = (
        rows.select("row", "source", "doc_id", F.explode("positions").alias("p"))
        .select("row", "source", "doc_id", "p.pass", "p.position", "p.time", "p.words")
        .orderBy(*ORDER)
        # the upper bits are the part, the lower 33 the number in it
        .select("row", "pass", "time", F.monotonically_increasing_id().alias("n"))
    )
    numbered = materialise(sorted_, "mix-order").select("row", "pass", "time", F.shiftright("n", 33).alias("part"), F.col("n").bitwiseAND(2**33 - 1).alias("at"))
    counts = sorted((r["part"], r["count"]) for r in numbered.groupBy("part").count().collect())
    before, total = [], 0
    for part, n in counts:
        before.append((part, total))
        total += n
    first = F.broadcast(spark.createDataFrame(before, "part long, before long"))
    listed = (
        numbered.join(first, "part")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("pass", "time", (F.col("before") + F.col("at")).alias("place")))).alias("all"))
    )
    return rows.join(listed, "row", "left").select(
        *mixed.columns,
        F.coalesce(F.col("all")["time"], F.array().cast("array<double>")).alias("times"),
        F.coalesce(F.col("all")["place"], F.array().cast("array<bigint>")).alias("places"),
    )


def copies(mixed: DataFrame) -> DataFrame:
    """How often a whole document enters the mix, and where: a pass counts where
    at least half of the document is taken.  doc_id, size, copies, positions
    (array<struct<position, time, pass>>); one row a document."""
    whole = F.filter("positions", lambda p: 2 * p["words"] >= F.col("size"))
    return mixed.select("doc_id", "size", F.size(whole).alias("copies"), F.transform(whole, lambda p: F.struct(p["position"].alias("position"), p["time"].alias("time"), p["pass"].alias("pass"))).alias("positions"))
