"""Small JSON state between runs, on the driver."""

from __future__ import annotations

import json
import logging
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from siftworks.operators.crawl import KNOWN_LIMIT

log = logging.getLogger(__name__)


class StateError(ValueError):
    """State that must not be guessed at."""


def write_atomic(path: str | Path, value) -> None:
    """JSON with sorted keys, by a temporary file and a rename."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2, sort_keys=True)
        f.write("\n")
    os.replace(name, path)


def read_mapping(path: str | Path) -> dict:
    """A JSON object; a missing, broken or other file is an empty one."""
    try:
        value = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        log.warning("state %s starts empty: %s", path, e)
        return {}
    return value if isinstance(value, dict) else {}


def read_seen(path: str | Path) -> dict[str, str]:
    """id -> first-seen date; bad entries are dropped one by one."""
    return {k: v for k, v in read_mapping(path).items() if k and isinstance(v, str) and v}


def read_crawl(path: str | Path) -> dict[str, dict]:
    """source -> cursor and known URLs; bad parts read as empty."""
    out = {}
    for source, v in read_mapping(path).items():
        if isinstance(v, dict):
            urls = v.get("urls")
            out[source] = {"cursor": v["cursor"] if isinstance(v.get("cursor"), str) else "", "urls": [u for u in urls if isinstance(u, str)] if isinstance(urls, list) else []}
    return out


def record_crawl(state: dict[str, dict], source: str, cursor: str, urls) -> dict[str, dict]:
    """The state with a source's progress: a cursor never recedes; URLs are
    sorted and cut."""
    old = state.get(source, {}).get("cursor", "")
    return state | {source: {"cursor": max(cursor, old), "urls": sorted(set(urls))[:KNOWN_LIMIT]}}


def read_cards(path: str | Path) -> dict[str, dict]:
    """The publication registry; a missing one is empty, a broken one an error,
    as taking it for empty would publish everything again."""
    path = Path(path)
    if not path.exists():
        return {}
    try:
        value = json.loads(path.read_text(encoding="utf-8"))
    except ValueError as e:
        raise StateError(f"{path} is broken: {e}") from e
    if not isinstance(value, dict) or not all(isinstance(v, dict) for v in value.values()):
        raise StateError(f"{path} is no registry")
    return value


def seen_table(spark: SparkSession, seen: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(seen.items()), "stable_id string, first_seen string")
