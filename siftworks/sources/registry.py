"""Registries and configuration: small, typed, on the driver; never Spark."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.functions import vocabulary as V
from siftworks.operators.retention import Retention
from siftworks.operators.scoring import Scoring

log = logging.getLogger(__name__)

#: Runs a day of the fast loop; a feed that allows fewer calls is slow.
FAST_RUNS = 96
FAST, SLOW = "fast", "slow"


class ConfigError(ValueError):
    """A configuration that cannot be used."""


@dataclass(frozen=True)
class Capability:
    """What a feed needs and allows."""

    needs_token: bool = False
    calls_per_day: int | None = None


# The feeds that there are.
CAPABILITIES: dict[str, Capability] = {
    **{n: Capability(needs_token=True) for n in ("greenhouse", "lever", "ashby", "smartrecruiters", "workable")},
    **{n: Capability() for n in ("remoteok", "weworkremotely", "hackernews", "himalayas", "workingnomads", "nodesk", "jobspresso", "euremotejobs", "landingjobs", "freework", "apec")},
    "remotive": Capability(calls_per_day=4),
    "japandev": Capability(calls_per_day=4),
}


@dataclass(frozen=True)
class Source:
    name: str
    feed: str
    token: str = ""


def cadence(feed: str) -> str:
    """Fast, or slow where the feed allows fewer calls than the fast loop makes."""
    limit = CAPABILITIES[feed].calls_per_day
    return SLOW if limit is not None and limit < FAST_RUNS else FAST


def cadence_column(feed: Column) -> Column:
    """The same over a column; null for an unknown feed."""
    table = F.create_map(*[F.lit(x) for n in CAPABILITIES for x in (n, cadence(n))])
    return F.try_element_at(table, feed)


def entry_problem(e) -> str | None:
    """Why a registry entry is left out: the first reason that holds."""
    if not isinstance(e, Mapping):
        return "mapping"
    if not isinstance(e.get("nom"), str) or not e["nom"]:
        return "nom"
    if not isinstance(e.get("ats"), str) or not e["ats"]:
        return "ats"
    if e["ats"] not in CAPABILITIES:
        return "unknown"
    token = e.get("token")
    if token is not None and not isinstance(token, str):
        return "token"
    return "token" if not token and CAPABILITIES[e["ats"]].needs_token else None


def problem_column(name: Column, feed: Column, token: Column) -> Column:
    """:func:`entry_problem` over columns, for registries that are tables."""
    needs = F.create_map(*[F.lit(x) for n, c in CAPABILITIES.items() for x in (n, c.needs_token)])
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    need = F.try_element_at(needs, F.coalesce(feed, F.lit("")))
    return F.when(blank(name), "nom").when(blank(feed), "ats").when(need.isNull(), "unknown").when(need & blank(token), "token")


def tolerant(entries) -> list[Source]:
    """Usable entries in order; the others are logged and left out."""
    if entries is None:
        return []
    if not isinstance(entries, list):
        log.warning("a registry is a list, not %s: nothing is loaded", type(entries).__name__)
        return []
    out = []
    for i, e in enumerate(entries):
        if why := entry_problem(e):
            log.warning("registry entry %d is left out: %s", i, why)
        else:
            out.append(Source(e["nom"], e["ats"], e.get("token") or ""))
    return out


def strict(entries) -> list[Source]:
    """All entries; any bad one is an error."""
    if not isinstance(entries, list):
        raise ConfigError("a source file holds a list")
    for i, e in enumerate(entries):
        if not isinstance(e, Mapping) or any(not isinstance(e.get(k), str) or not e[k] for k in ("nom", "ats", "token")):
            raise ConfigError(f"source {i}: nom, ats and token are texts")
    return [Source(e["nom"], e["ats"], e["token"]) for e in entries]


def load_all(files: Iterable[str | Path], only: str | None = None) -> list[Source]:
    """Sources of several registries in order; a missing file is logged.
    ``only`` keeps one cadence."""
    if only not in (None, FAST, SLOW):
        raise ValueError(f"no cadence {only!r}")
    out: list[Source] = []
    for f in map(Path, files):
        if f.is_file():
            out += tolerant(read_config(f))
        else:
            log.warning("no registry at %s", f)
    return [s for s in out if only is None or cadence(s.feed) == only]


def by_cadence(sources: list[Source]) -> tuple[list[Source], list[Source]]:
    """(fast, slow), order kept."""
    return [s for s in sources if cadence(s.feed) == FAST], [s for s in sources if cadence(s.feed) == SLOW]


def read_config(path: str | Path):
    """A JSON file, or a YAML one where a YAML reader is installed."""
    content = Path(path).read_text(encoding="utf-8")
    if Path(path).suffix == ".json":
        return json.loads(content)
    try:
        import yaml
    except ImportError as e:
        raise ConfigError(f"{path}: YAML needs a YAML reader; use JSON") from e
    return yaml.safe_load(content)


def registry_table(spark: SparkSession, sources: list[Source]) -> DataFrame:
    rows = [(i, s.name, s.feed, s.token) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, "source_ord int, company string, source string, token string")


def mapping(data: Mapping, key: str, required: bool = False) -> Mapping:
    value = data.get(key)
    if value is None:
        if required:
            raise ConfigError(f"{key} is missing")
        return {}
    if not isinstance(value, Mapping):
        raise ConfigError(f"{key} is no mapping")
    return value


def texts(data: Mapping, key: str) -> list[str]:
    """Absent and empty are alike: no constraint."""
    value = data.get(key)
    if value is None:
        return []
    if not isinstance(value, list) or not all(isinstance(x, str) for x in value):
        raise ConfigError(f"{key} is no list of texts")
    return value


def integer(value, key: str) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise ConfigError(f"{key} is no integer")
    return value


def filters(data: Mapping) -> tuple[Retention, Scoring]:
    """Retention and scoring rules of one configuration; they share the
    vocabulary, extended by every technology that either names."""
    if not isinstance(data, Mapping):
        raise ConfigError("filters are a mapping")
    keep, rate = mapping(data, "retention", True), mapping(data, "scoring", True)
    if data.get("retention_days") is not None:
        integer(data["retention_days"], "retention_days")
    seniority, place, bonus = mapping(keep, "seniority"), mapping(keep, "location"), mapping(rate, "tech_bonus")
    groups: dict[str, tuple[int, list[str]]] = {}
    for name, group in bonus.items():
        if name != "max":
            g = mapping(bonus, name)
            groups[name] = (integer(g.get("points"), f"{name}.points"), texts(g, "techs"))
    wanted = texts(keep, "tech_include_any")
    vocabulary = V.extended([*wanted, *(t for _, ts in groups.values() for t in ts)])
    retention = Retention(
        texts(keep, "title_include"), texts(keep, "title_exclude"), texts(seniority, "keep"), texts(seniority, "drop"),
        texts(place, "require_any"), texts(place, "relocation_regions"), wanted, vocabulary,
    )
    priorities = {k: integer(v, k) for k, v in mapping(rate, "geo_priority").items()}
    cap = None if bonus.get("max") is None else integer(bonus["max"], "max")
    return retention, Scoring.of(priorities, groups, cap, vocabulary)
