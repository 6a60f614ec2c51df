"""Geographic priority, stack bonus and the final order of postings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions import vocabulary as V
from siftworks.functions.dates import instant
from siftworks.functions.places import NEUTRAL_WORDS, ZONES
from siftworks.functions.text import REMOTE, text
from siftworks.operators.retention import zone_term

# Keys of the priorities that are no zones, and the suffix that a
# zone's key may carry.
REMOTE_GLOBAL, DEFAULT, RELOCATION = "remote_global", "default", "_relocation"
# The shipped priorities, in order.
PRIORITIES = {"remote_global": 100, "asia_relocation": 80, "europe": 60, "france": 40, "default": 0}


@dataclass(frozen=True)
class Scoring:
    """Priorities in configuration order, points by canonical technology, and
    the cap of the bonus (None: no cap)."""

    priorities: Mapping[str, int] = field(default_factory=lambda: dict(PRIORITIES))
    points: Mapping[str, int] = field(default_factory=dict)
    cap: int | None = None
    zones: Mapping[str, Sequence[str]] = field(default_factory=lambda: ZONES)

    @classmethod
    def of(cls, priorities: Mapping[str, int], groups: Mapping[str, tuple[int, Sequence[str]]], cap: int | None, vocabulary: V.Vocabulary = V.TECHNOLOGIES) -> Scoring:
        """From groups (points, terms): terms become canonical names; a name in
        several groups keeps its most points."""
        best: dict[str, int] = {}
        for points, terms in groups.values():
            for name in V.canonical(terms, vocabulary):
                best[name] = max(points, best.get(name, points))
        return cls(dict(priorities), best, cap)


def names_no_place(c: Column) -> Column:
    """Are all words of a location neutral ones (or is it empty)?"""
    words = F.regexp_extract_all(F.lower(text(c)), F.lit(r"\p{L}+"), F.lit(0))
    return F.forall(words, lambda w: w.isin(*NEUTRAL_WORDS))


def geography(rules: Scoring, location: Column, mode: Column) -> Column:
    """struct<score int, category string, detail string>: the best category;
    among equal scores the first configured; the floor where none applies."""
    keys = [k for k in rules.priorities if k not in (REMOTE_GLOBAL, DEFAULT)]
    world = REMOTE_GLOBAL in rules.priorities

    def option(rank: int, key: str, detail: Column) -> Column:
        return F.struct(F.lit(rules.priorities.get(key, 0)).alias("score"), F.lit(-rank).alias("rank"), F.lit(key).alias("category"), detail.alias("detail"))

    floor = option(len(keys) + world, DEFAULT, F.lit(""))
    applies = F.when((text(mode) == REMOTE) & names_no_place(location), option(0, REMOTE_GLOBAL, F.lit(""))) if world else F.lit(None)
    if not keys:
        return F.coalesce(applies, floor) if world else floor

    def best(terms: Column) -> Column:
        """Of the first terms of the zones, null where there is none."""
        zones = [F.when(terms[i].isNotNull(), option(i + world, key, terms[i])) for i, key in enumerate(keys)]
        return F.coalesce(F.array_max(F.array_compact(F.array(*([applies] * world), *zones))), floor)

    return V.let(F.array(*[zone_term(location, key.removesuffix(RELOCATION), rules.zones) for key in keys]), best)


def stack_of(rules: Scoring, tech: Column) -> Column:
    """The posting's technologies that earn points, in its own order."""
    if not rules.points:
        return F.array().cast("array<string>")
    return F.filter(tech, lambda t: t.isin(*rules.points))


def bonus_of(rules: Scoring, stack: Column) -> Column:
    """Sum of the points of a posting's stack, capped."""
    if not rules.points:
        return F.lit(0)
    points = F.create_map(*[F.lit(x) for kv in rules.points.items() for x in kv])
    total = F.aggregate(stack, F.lit(0), lambda s, t: s + points[t])
    return total if rules.cap is None else F.least(total, F.lit(rules.cap))


def score(postings: DataFrame, rules: Scoring) -> DataFrame:
    """Postings with score, category, geo_detail, bonus and stack: a projection,
    no shuffle and no Python."""
    stack = V.let(stack_of(rules, F.col("tech")), lambda s: F.struct(s.alias("stack"), bonus_of(rules, s).alias("bonus")))
    made = postings.withColumns({"__geo": geography(rules, F.col("location"), F.col("remote_type")), "__rate": stack})
    return made.withColumns(
        {
            "bonus": F.col("__rate.bonus"),
            "stack": F.col("__rate.stack"),
            "score": F.col("__geo.score") + F.col("__rate.bonus"),
            "category": F.col("__geo.category"),
            "geo_detail": F.col("__geo.detail"),
        }
    ).drop("__geo", "__rate")


def ranked(scored: DataFrame, *order: str) -> DataFrame:
    """Best score first, then the latest date, undated last, then the input
    order that the ``order`` columns state.

    A sort evaluates its expressions at every comparison, so the date is read
    into a column before."""
    rows = scored.withColumn("__at", instant(F.col("date")))
    return rows.orderBy(F.col("score").desc(), F.col("__at").desc_nulls_last(), *order).drop("__at")


def positions(scored: DataFrame, *order: str) -> DataFrame:
    """Scored rows with their ``position`` in the order of :func:`ranked`,
    counted from 1.

    A row's number inside its part of the range sort, and the parts' running
    totals (one row a part on the driver), give its position, so no task sees
    all rows.  Scores are kept for the sort, which reads its input twice, and
    the sorted rows, as both readings must see the same parts; on disk only.
    """
    kept = scored.persist(StorageLevel.DISK_ONLY)
    # the upper bits are the part, the lower 33 the number in it
    rows = ranked(kept, *order).withColumn("__n", F.monotonically_increasing_id()).persist(StorageLevel.DISK_ONLY)
    part = F.shiftright("__n", 33)
    before, total = [], 0
    for p, n in sorted(tuple(r) for r in rows.groupBy(part).count().collect()):
        before.append((p, total))
        total += n
    kept.unpersist()
    table = F.broadcast(rows.sparkSession.createDataFrame(before, "__part long, __before long"))
    placed = rows.join(table, part == F.col("__part"))
    return placed.withColumn("position", F.col("__before") + F.col("__n").bitwiseAND(2**33 - 1) + 1).drop("__n", "__part", "__before")


def category_counts(scored: DataFrame, rules: Scoring) -> DataFrame:
    """category, n and the configured order as ``ord``, the default last."""
    keys = [k for k in rules.priorities if k != DEFAULT] + [DEFAULT]
    order = F.array_position(F.array(*map(F.lit, keys)), F.col("category")).cast("int")
    return scored.groupBy("category").agg(F.count("*").alias("n")).withColumn("ord", order)


def top(ranked_rows: DataFrame, n: int) -> tuple[DataFrame, Column]:
    """The first ``n`` rows, and how many more there are, as an aggregate."""
    return ranked_rows.limit(n), F.greatest(F.count("*") - n, F.lit(0)).alias("more")
