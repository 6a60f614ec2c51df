"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every text is content-addressed.  The ledger has one row for
each (blob, rule version) that was ever scanned, with its findings; a run scans
only pairs that the ledger lacks, once however many paths carry the blob, and
joins the findings back to all paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm.common import starts_of, text_of, work_dir

#: Changes with every change of RULES: older findings are then not reused.
RULE_VERSION = 1

#: kind, pattern, group whose length counts, least length.  The first three are
#: the base rules; patterns take a failing match whole, so that dropping it
#: afterwards leaves what a leftmost scan leaves.
RULES: tuple[tuple[str, str, int, int], ...] = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    # a maximal run shorter than the limit has no match inside: the limit may stand in the pattern
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    ("github", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 40),
    ("slack", r"xox[abeoprs]-[A-Za-z0-9-]{20,}", 0, 25),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 36),
)
BASE = ("assign", "access", "hex")
FINDINGS = "array<struct<start:bigint,rule:int,kind:string,end:bigint>>"


def rule_findings(text: Column, number: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Leftmost, non-overlapping matches of one rule with their code points.

    The text is cut at the matches; running lengths of the gaps and matches
    give the positions.  Texts without a match skip all that.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(gaps, matches, lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))
    ends = F.zip_with(starts_of(lengths), lengths, lambda at, n: at + n)

    def finding(match: Column, end: Column) -> Column:
        start = end - F.length(match)
        return F.struct(start.alias("start"), F.lit(number).alias("rule"), F.lit(kind).alias("kind"), end.alias("end"), match.alias("match"))

    def fits(f: Column) -> Column:
        size = F.length(f["match"]) if group == 0 else F.length(F.regexp_extract(f["match"], pattern, group))
        return f["match"].isNotNull() & (size >= least)

    found = F.filter(F.zip_with(matches, ends, finding), fits)
    plain = F.transform(found, lambda f: F.struct(*[f[k].alias(k) for k in ("start", "rule", "kind", "end")]))
    return F.when(text.rlike(pattern), plain).otherwise(F.array().cast(FINDINGS))


def findings(text: Column, rules=RULES) -> Column:
    """All findings of a text, by start, then rule."""
    return F.array_sort(F.flatten(F.array(*[rule_findings(text, i, *r) for i, r in enumerate(rules)])))


def paths_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("blob"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(f"blob string, rule_version int, found {FINDINGS}").parquet(ledger)


def update_ledger(df: DataFrame, ledger: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", rule_version: int = RULE_VERSION, rules=RULES) -> str:
    """Scan the blobs of ``df`` that the ledger lacks under this rule version
    and append them; returns the ledger's path.

    Each unseen blob is scanned at one of its paths, the least id: blobs meet
    as hashes, and only the chosen rows' texts travel, dealt by blob and id, so
    a blob that a third of the rows share is no hot key.  An interrupted run
    appends nothing; a repeated one finds nothing left to scan.
    """
    spark = df.sparkSession
    rows = paths_of(df, id_col, text_col)
    least = rows.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    if ledger is None:
        ledger = work_dir(spark, "secret-ledger")
    else:
        known = read_ledger(spark, ledger).where(F.col("rule_version") == rule_version).select("blob")
        least = least.join(known, "blob", "left_anti")
    least = least.withColumnRenamed("doc_id", "at")
    chosen = rows.join(least, (rows["blob"] == least["blob"]) & rows["doc_id"].eqNullSafe(least["at"]), "left_semi")
    # rows that repeat an id and its text would be scanned alike: one stays
    scanned = chosen.withColumn("found", findings(F.col("text"), rules)).select("blob", F.lit(rule_version).cast("int").alias("rule_version"), "found")
    scanned.dropDuplicates(["blob"]).write.mode("append").parquet(ledger)
    return ledger


def scan_secrets(df: DataFrame, ledger: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", rule_version: int = RULE_VERSION, rules=RULES) -> DataFrame:
    """doc_id, blob, found (array of start, rule, kind, end) of every row.

    Null texts are the empty blob.  Repeated rows each keep theirs.
    """
    spark = df.sparkSession
    ledger = update_ledger(df, ledger, id_col=id_col, text_col=text_col, rule_version=rule_version, rules=rules)
    known = read_ledger(spark, ledger).where((F.col("rule_version") == rule_version) & (F.size("found") > 0)).select("blob", "found").dropDuplicates(["blob"])
    rows = paths_of(df, id_col, text_col).select("doc_id", "blob")
    return rows.join(known, "blob", "left").select("doc_id", "blob", F.coalesce("found", F.array().cast(FINDINGS)).alias("found"))


def spans(found: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of findings, comma-joined, in order."""
    some = found if kinds is None else F.filter(found, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
