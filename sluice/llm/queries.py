"""The registered ``opN_*`` queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import op1_search, op4_lines, op6_quality, op11_variants, op13_bitsliced

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op1_wand_search": op1_search.ORACLE, "op4_line_windows": op4_lines.ORACLE,
                          "op6_line_frequency": op6_quality.ORACLE, "op11_part_enum": op11_variants.ORACLE,
                          "op13_bit_sliced": op13_bitsliced.ORACLE}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_wand_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return op1_search.search(docs, docs.filter(F.col("doc_id") % 20 == 0).withColumnRenamed("doc_id", "query_id"))


@query
def op2_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.op2_minhash import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op3_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.op3_resample import resample
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op4_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_lines.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed_lines", "text")


@query
def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.op5_packing import pack
    return pack(_table(spark, sf_dir, "documents"))


@query
def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_quality.quality(_table(spark, sf_dir, "documents")).drop("h", "host", "removed_lines")


@query
def op7_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.op7_pieces import encode
    return encode(_table(spark, sf_dir, "documents"))


@query
def op8_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.op8_pii import find_pii
    return find_pii(_table(spark, sf_dir, "documents")).drop("h", "span_list")


@query
def op9_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.op9_html import main_text
    return main_text(_table(spark, sf_dir, "pages"))


@query
def op10_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.op10_chains import fuzzy_passages
    return fuzzy_passages(_table(spark, sf_dir, "documents"))


@query
def op11_part_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_variants.spelling_variants(_table(spark, sf_dir, "documents"))


@query
def op12_learned_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.op12_cells import nearest
    return nearest(_table(spark, sf_dir, "embeddings"))


@query
def op13_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_bitsliced.importance_draw(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
