"""The corpus pipeline: quality rules, line dedup, near-duplicates, PII, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
works on all rows its predecessor kept and returns the columns of
``documents`` (the last one: packed pieces). ``run`` applies them in turn;
between two stages the rows are written as Parquet to the shared folder and
read again, so a lost executor costs a re-read. Empty tables pass through
every stage; null texts and ids are handled as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm._stage import staged
from sluice.llm.op2_minhash import one_of_each_group
from sluice.llm.op4_lines import dedup_lines
from sluice.llm.op5_packing import pack
from sluice.llm.op6_quality import apply_rules
from sluice.llm.op8_pii import mask_pii


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the changed text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rules or the line-frequency rule reject,
    and cuts frequent lines out of the others."""
    return _sized(apply_rules(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated three-line windows; documents stay, even if nothing of them is left."""
    return _sized(dedup_lines(docs).select(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the
    smallest id. Every row is a document of its own, also one that repeats an
    id; of rows equal in id and text one stays."""
    return one_of_each_group(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return _sized(mask_pii(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into bins of words."""
    return pack(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("pii", pii), ("packing", packing)]

# The span classifier and the packing order are no SQL; tests/llm checks the
# pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
