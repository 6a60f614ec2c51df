"""Views of the driver's tables in the posting schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.functions.dates import iso
from siftworks.session import spread

COLOURS = ("blue", "cold", "hot", "large", "new", "old", "red", "small")
THINGS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
#: Vocabulary of part names: every word is a technology of its own name.
PARTS = {w.capitalize(): (w,) for w in COLOURS + THINGS}
#: Seniority levels of part types.
TYPES = {w: () for w in ("economy", "small", "medium", "promo", "standard", "large")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str, tags: Callable[[Column], Column] | None = None) -> DataFrame:
    """Line items as postings; (id) repeats, so ``ord`` columns tell rows apart.

    ``tags`` makes ``tech`` of a title.  A title is a part's, so it is tagged
    once a part and not once a line.
    """
    t = lambda n: table(spark, sf_dir, n)
    part = t("part").withColumn("title", F.concat_ws(" ", "p_name", "p_type"))
    if tags:
        part = spread(part).withColumn("tech", tags(F.col("title")))
    rows = (
        spread(t("lineitem"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    mode = F.when(F.col("l_returnflag") == "N", "remote").when(F.col("l_returnflag") == "R", "hybrid").otherwise("onsite")
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.lit("li").alias("source"),
        F.col("s_name").alias("company"),
        "title",
        F.col("r_name").alias("location"),
        mode.alias("remote_type"),
        F.concat(F.lit("https://jobs.example.com/"), F.col("p_partkey"), F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("-"))).alias("url"),
        iso(F.col("l_shipdate")).alias("date"),
        F.lit("").alias("description"),
        F.col("l_partkey").alias("ord1"),
        F.col("l_suppkey").alias("ord2"),
        F.col("l_extendedprice").alias("ord3"),
        *(["tech"] if tags else []),
    )


POSTS_SQL = """
post AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, 'li' AS source, s_name AS company, p_name || ' ' || p_type AS title,
    r_name AS location, CASE l_returnflag WHEN 'N' THEN 'remote' WHEN 'R' THEN 'hybrid' ELSE 'onsite' END AS remote_type,
    'https://jobs.example.com/' || p_partkey || '/' || replace(p_name, ' ', '-') AS url,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S+00:00') AS date, l_partkey AS ord1, l_suppkey AS ord2, l_extendedprice AS ord3
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
)"""


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_word(expr: str, term: str, left: str = "A-Za-z0-9_", right: str = "A-Za-z0-9_") -> str:
    """Is a term a bounded word?  Without look-behind: existence only."""
    import re

    flag = "" if any(c.isupper() for c in term) else "(?i)"
    return f"regexp_matches({expr}, {sql_text(f'{flag}(^|[^{left}]){re.escape(term)}($|[^{right}])')})"


def sql_first_word(expr: str, terms) -> str:
    return "CASE " + " ".join(f"WHEN {sql_word(expr, t)} THEN {sql_text(t)}" for t in terms) + " END"


def sql_any(parts) -> str:
    return "(" + " OR ".join(parts) + ")" if parts else "FALSE"


def sql_values(rows, columns: str) -> str:
    """A FROM item of literal rows."""
    lit = lambda v: "NULL" if v is None else ("TRUE" if v is True else "FALSE" if v is False else sql_text(v) if isinstance(v, str) else repr(v))
    body = ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)
    return f"(VALUES {body}) AS v({columns})"
