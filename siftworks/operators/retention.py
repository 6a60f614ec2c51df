"""Retention: which postings stay, and why each other one goes.

One struct column per posting: kept, reason, detail.  Rules go in a fixed
order and the first that rejects gives the reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions import vocabulary as V
from siftworks.functions.places import LEVELS, ZONES
from siftworks.functions.text import any_contains, first_contained, text

# Reasons of rejection, in reporting order.
REASONS = ("titre-exclu", "titre-non-inclus", "seniorite", "localisation", "tech")
TITLE_EXCLUDED, TITLE_NOT_INCLUDED, SENIORITY, LOCATION, TECH = REASONS


@dataclass(frozen=True)
class Retention:
    """Rules of one configuration; an empty list never rejects."""

    title_include: Sequence[str] = ()
    title_exclude: Sequence[str] = ()
    seniority_keep: Sequence[str] = ()
    seniority_drop: Sequence[str] = ()
    require_any: Sequence[str] = ()
    relocation_regions: Sequence[str] = ()
    tech_any: Sequence[str] = ()
    vocabulary: V.Vocabulary = field(default_factory=lambda: V.TECHNOLOGIES)
    levels: Mapping[str, Sequence[str]] = field(default_factory=lambda: LEVELS)
    zones: Mapping[str, Sequence[str]] = field(default_factory=lambda: ZONES)


def level_terms(level: str, levels: Mapping[str, Sequence[str]]) -> list[str]:
    """Words of a level: its name and synonyms; an unknown level as it stands."""
    key = level.strip().lower()
    return [key, *(t for t in levels.get(key, ()) if t.lower() != key)] if key else []


def zone_terms(zone: str, zones: Mapping[str, Sequence[str]] = ZONES) -> list[str]:
    """The zone's name, then its members; an unknown zone as it stands."""
    key = zone.strip().lower()
    return [key, *(t for t in zones.get(key, ()) if t.lower() != key)] if key else []


def zone_term(c: Column, zone: str, zones: Mapping[str, Sequence[str]] = ZONES) -> Column:
    """First term of a zone that is a whole word of the text, else null."""
    return V.first_word(c, zone_terms(zone, zones))


def verdict(rules: Retention, title: Column, location: Column, mode: Column, tech: Column) -> Column:
    """struct<kept boolean, reason string, detail string>; empty strings where kept."""
    low = F.lower(text(title))
    rejects: list[Column] = []

    def reject(reason: str, value: Column, when, detail=lambda v: v) -> None:
        """Reject where ``when`` says so of a value, which is computed once."""
        rejects.append(V.let(value, lambda v: F.when(when(v), judged(F.lit(False), F.lit(reason), detail(v)))))

    if rules.title_exclude:
        reject(TITLE_EXCLUDED, first_contained(low, rules.title_exclude), Column.isNotNull)
    if rules.title_include:  # a list of blank terms includes nothing
        reject(TITLE_NOT_INCLUDED, text(title), lambda _: ~any_contains(low, rules.title_include))

    has = lambda level: V.has_word(title, level_terms(level, rules.levels))
    named = lambda levels: [F.when(has(level), F.lit(level)) for level in levels]
    if rules.seniority_drop:
        reject(SENIORITY, F.coalesce(*named(rules.seniority_drop)), Column.isNotNull)
    if rules.seniority_keep:
        seen = F.array_sort(F.array_compact(F.array(*named(rules.levels))))
        wanted = F.coalesce(*named(rules.seniority_keep)).isNotNull()
        reject(SENIORITY, F.when(~wanted, seen), lambda v: F.size(v) > 0, lambda v: F.array_join(v, ", "))

    if rules.require_any or rules.relocation_regions:
        both = F.concat(text(location), F.lit(" "), text(mode))
        terms = [t for zone in rules.relocation_regions for t in zone_terms(zone, rules.zones)]
        where = F.when(text(location) != "", text(location)).otherwise(text(mode))
        reject(LOCATION, where, lambda _: ~(any_contains(F.lower(both), rules.require_any) | V.has_word(both, terms)))

    wanted_tech = V.canonical(rules.tech_any, rules.vocabulary)
    if wanted_tech:
        reject(TECH, F.lit(", ".join(sorted(wanted_tech))), lambda _: ~F.arrays_overlap(tech, F.array(*map(F.lit, wanted_tech))))

    return F.coalesce(*rejects, judged(F.lit(True), F.lit(""), F.lit("")))


def judged(kept: Column, reason: Column, detail: Column) -> Column:
    return F.struct(kept.alias("kept"), reason.alias("reason"), F.coalesce(detail, F.lit("")).alias("detail"))


def judge(postings: DataFrame, rules: Retention) -> DataFrame:
    """Postings (title, location, remote_type, tech) with a ``verdict``.  No
    shuffle; consumers that need both sides filter this one frame.

    The verdict goes through a one-element ``explode``: a filter on it is then
    not pushed below, where its whole expression would be written out, and
    evaluated, a second time.
    """
    made = verdict(rules, F.col("title"), F.col("location"), F.col("remote_type"), F.col("tech"))
    return postings.select("*", F.explode(F.array(made)).alias("verdict"))


def reason_counts(judged_postings: DataFrame) -> DataFrame:
    """reason, n for the reasons that occur, with their fixed order as ``ord``."""
    order = F.array_position(F.array(*map(F.lit, REASONS)), F.col("reason")).cast("int")
    return (
        judged_postings.where(~F.col("verdict.kept")).groupBy(F.col("verdict.reason").alias("reason")).agg(F.count("*").alias("n")).withColumn("ord", order)
    )
