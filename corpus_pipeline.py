"""Corpus pipeline: quality, near duplicates, decontamination, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's documents.  Every stage but the
last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm import decontam, mixing, quality, simhash, token_store
from siftworks.llm.common import tables, work_dir
from siftworks.llm.queries import tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; limits are fitted on those that
    ``labels`` calls good."""
    fitted = quality.fit_bands(docs, tables(spark, sf_dir, "labels").where("quality = 1"))
    return quality.annotate_quality(docs.select(COLUMNS), fitted=fitted).where("kept").select(COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of least id.  Rows
    that share an id but belong to unlike groups are each one's."""
    return simhash.representatives(docs.select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.annotate_leaks(docs.select(COLUMNS), tables(spark, sf_dir, "benchmark")).where("NOT leaked").select(COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none, once or twice, in the
    order of their training positions.  Rows that share an id enter equally
    often, at the same positions."""
    most = F.max(F.struct("copies", "positions"))["positions"].alias("positions")
    taken = mixing.copies(mixing.mix(docs)).groupBy(F.col("doc_id").alias("id")).agg(most).where("size(positions) > 0")
    rows = docs.join(taken, F.col("doc_id").eqNullSafe(F.col("id")))
    placed = rows.select(*COLUMNS, F.explode("positions").alias("at")).select(*COLUMNS, "at.position", "at.time", "at.pass")
    return placed.orderBy("position", "time", "source", "doc_id", "pass").select(COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of the token store of the mix."""
    return token_store.token_report(docs, tokenizer_file("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_output", token_output),
]

#: SQL has neither zstandard, xxhash, singular vectors nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last through Parquet."""
    docs = tables(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = work_dir(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
