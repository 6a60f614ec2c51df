"""Robots rules of many hosts: a table, joined by host and literal prefix.

A rule is kept under its host and the part before its first ``*``.  A URL is
tried under the prefixes of its own path that are as long as one of its host's:
two equi-joins, and only rules that go on after a ``*`` or end in ``$`` are
matched by expression, against the few URLs that reach them.  The longest match
is a maximum that is combined before it is shuffled.
"""

from __future__ import annotations

from functools import partial
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftworks.functions.text import path_of, text
from siftworks.operators.crawl import decoded, path_pattern, read_robots
from siftworks.session import ship_package

RULES = "host string, allow boolean, pattern string, len int, prefix string, regex string"


def host_of(url: Column) -> Column:
    """Host, and port if any, of a URL in lower case; empty without."""
    return F.lower(F.regexp_extract(text(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1))


def rule_rows(batches, agent: str):
    """Rows of RULES of (host, content) rows; ``regex`` is null where the prefix
    is the whole rule."""
    import pyarrow as pa

    for batch in batches:
        rows = []
        for host, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            said = read_robots(content or "", agent)
            for allow, patterns in ((True, said.allow), (False, said.disallow)):
                for p in patterns:
                    prefix = unquote(p.removesuffix("$").split("*")[0])
                    rows.append((host, allow, p, len(p), prefix, path_pattern(p) if "*" in p or p.endswith("$") else None))
        kinds = [pa.string(), pa.bool_(), pa.string(), pa.int32(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["host", "allow", "pattern", "len", "prefix", "regex"])


def rules_of_hosts(files: DataFrame, agent: str, *, host_col: str = "host", content_col: str = "content") -> DataFrame:
    """What the robots files of many hosts say to one agent, a row a rule.  A
    host with no file, a null one, or no rule for the agent has no row."""
    ship_package(files.sparkSession)
    named = files.select(F.lower(F.col(f"`{host_col}`").cast("string")).alias("host"), F.col(f"`{content_col}`").cast("string").alias("content"))
    return named.mapInArrow(partial(rule_rows, agent=agent), RULES)


def allowed_by_host(urls: DataFrame, rules: DataFrame, *, url_col: str = "url") -> DataFrame:
    """The rows of ``urls`` with ``allowed``: by the longest rule of the URL's
    host that its path matches, allow on equal length, true without any.

    A URL that stands in many rows is judged once.  Rules that stand twice count
    once.  A column ``allowed`` of ``urls`` is replaced.
    """
    at = urls.withColumns({"__host": host_of(F.col(f"`{url_col}`")), "__path": decoded(path_of(F.col(f"`{url_col}`")))})
    places = at.select(F.col("__host").alias("host"), F.col("__path").alias("path")).distinct()
    lengths = rules.groupBy("host").agg(F.collect_set(F.length("prefix")).alias("lengths"))
    tried = places.join(lengths, "host").select("host", "path", F.explode_outer("lengths").alias("n")).where(F.col("n") <= F.length("path"))
    tried = tried.select("host", "path", F.substring("path", F.lit(1), F.col("n")).alias("prefix"))
    met = tried.join(rules.select("host", "prefix", "regex", "len", "allow"), ["host", "prefix"]).where(F.col("regex").isNull() | F.rlike("path", F.col("regex")))
    best = met.groupBy(F.col("host").alias("__host"), F.col("path").alias("__path")).agg(F.max(F.struct("len", "allow")).alias("__best"))
    out = at.drop("allowed").join(best, ["__host", "__path"], "left")
    return out.withColumn("allowed", F.coalesce(F.col("__best.allow"), F.lit(True))).drop("__host", "__path", "__best")
