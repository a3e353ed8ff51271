"""Control-plane sources: CSV with header (S1), required columns (S2),
empty-input guard (S3), input row numbers (W1).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.fixed import NA_TOKENS
from ..operators.quality import require_columns, require_rows
from ..session import scratch_path

MALFORMED = "_malformed"
PLACE = "_place"


def _headers(spark: SparkSession, path: str, reader: DataFrameReader) -> dict[tuple[str, ...], list[str]]:
    """Header -> files that have it, in file order. One small read per file, a
    few at a time; files are jobs here, not rows."""
    files = sorted(reader.csv(path).inputFiles())
    with ThreadPoolExecutor(max_workers=8) as pool:
        found = list(pool.map(lambda f: tuple(reader.csv(f).columns), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for f, names in zip(files, found, strict=True):
        if names:  # an empty file has no header
            groups.setdefault(names, []).append(f)
    return groups


def read_csv_text(spark: SparkSession, path: str, na_tokens: Sequence[str] = NA_TOKENS,
                  multi_line: bool = False, keep_malformed: bool = False, keep_place: bool = False) -> DataFrame:
    """CSV with header, every column text (no inference), missing-value
    tokens (``NA``, ``None``, empty, ...) read as NULL. Whitespace-only text
    stays text. CRLF line ends and blank lines are handled by the reader.

    Every file is read by its own header: columns go by name, in the order of
    the first file's header; a column that a file lacks is NULL in its rows.

    Files stay splittable (parallel read) unless ``multi_line`` is asked for,
    which is only needed when quoted fields contain line breaks.

    A row whose number of fields is not its header's is never cut or padded in
    silence: reading it fails, or, with ``keep_malformed``, the column
    ``_malformed`` holds its text (NULL for good rows). ``keep_place`` adds the
    column ``_place`` (file, start of the split) for ``with_row_number``.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("multiLine", multi_line).option("escape", '"'))
    groups = _headers(spark, path, reader) or {tuple(reader.csv(path).columns): [path]}
    tokens = list(na_tokens)

    def read(names: tuple[str, ...], files: list[str]) -> DataFrame:
        schema = StructType([StructField(c, StringType()) for c in [*names, MALFORMED]])
        df = (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
              .option("enforceSchema", True).option("columnPruning", False).schema(schema)
              .csv(path if len(groups) == 1 else files))
        # Spark refuses a scan of nothing but the malformed-row column, so it
        # carries an (empty) part of the first column.
        malformed = F.concat(F.col(MALFORMED), F.substring(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), 1, 0))
        place = [F.struct(F.col("_metadata.file_path").alias("f"),
                          F.col("_metadata.file_block_start").alias("s")).alias(PLACE)] if keep_place else []
        return df.select(*[
            F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string"))
             .otherwise(F.col(f"`{c}`")).alias(c)
            for c in names], malformed.alias(MALFORMED), *place)

    if any(not names for names in groups):
        return spark.read.option("header", True).csv(path)  # no header at all
    out = None
    for names, files in groups.items():
        part = read(names, files)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    last = [MALFORMED, *([PLACE] if keep_place else [])]
    out = out.select(*[F.col(f"`{c}`") for c in out.columns if c not in last], *last)
    if keep_malformed:
        return out
    bad = F.raise_error(F.concat(F.lit(f"row with a wrong number of fields in {path}: "), F.col(MALFORMED)))
    return out.filter(F.when(F.col(MALFORMED).isNull(), True).otherwise(bad.cast("boolean"))).drop(MALFORMED)


def read_control(spark: SparkSession, path: str, required: Sequence[str],
                 keep_malformed: bool = False, keep_place: bool = False) -> DataFrame:
    """S1 + S2 + S3 for a control table."""
    df = read_csv_text(spark, path, keep_malformed=keep_malformed, keep_place=keep_place)
    require_columns(df, required)
    require_rows(df, path)
    return df


def with_row_number(df: DataFrame, name: str = "row_num") -> DataFrame:
    """1-based row number in input order, computed distributed.

    Input order is the order of file paths, then of the place in the file, from
    the scan or from the column ``_place`` of ``read_csv_text``, which goes
    (a frame that has neither: the order of its partitions). Every row
    gets its input split and its position there right after the scan; one
    row per split (a listing the driver holds anyway) gives every split its
    starting offset, so no global window over the data is needed. The planner
    chooses the join.

    Apply it directly on a scan (optionally after narrow filters/projections),
    never on a shuffle output: rows inside a post-shuffle partition may come
    in a different order each time the partition is computed.
    """
    cols = [F.col(f"`{c}`") for c in df.columns if c != PLACE]
    mid = F.monotonically_increasing_id()
    try:
        if PLACE in df.columns:
            tagged = df.select(*cols, F.col(PLACE)["f"].alias("__f"), F.col(PLACE)["s"].alias("__s"), mid.alias("__mid"))
        elif not df.inputFiles():
            raise AnalysisException("no file scan")
        else:
            tagged = df.select(*cols, F.col("_metadata.file_path").alias("__f"),
                               F.col("_metadata.file_block_start").alias("__s"), mid.alias("__mid"))
        tagged.schema  # noqa: B018 - resolves the hidden column
    except AnalysisException:
        tagged = df.select(*cols, F.lit("").alias("__f"), F.spark_partition_id().cast("long").alias("__s"),
                           mid.alias("__mid"))
    splits = tagged.groupBy("__f", "__s").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = Window.orderBy("__f", "__s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("__f", "__s", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (tagged.join(offsets, ["__f", "__s"])
            .select(*cols, (F.col("__off") + F.col("__mid") - F.col("__first") + F.lit(1)).alias(name)))


def parquet_with_row_number(spark: SparkSession, path: str, name: str = "row_num") -> DataFrame:
    """W1 on a Parquet table: 1-based row number in file order, the data read once.

    The place in the file is the reader's own row index. The files' offsets come from
    their row counts, which a scan without columns takes from the file footers;
    that small table (a row per file) is written before, so the returned plan
    scans the data a single time and shuffles it only if the list of files is
    too large to broadcast.
    """
    df = spark.read.parquet(path)
    at = scratch_path(spark, "file_offsets")
    sizes = df.select(F.col("_metadata.file_path").alias("__f")).groupBy("__f").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__f").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("__f", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")).write.parquet(at)
    offsets = spark.read.schema("__f string, __off long").parquet(at)
    rows = df.select("*", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.row_index").alias("__i"))
    return (rows.join(offsets, "__f").withColumn(name, F.col("__off") + F.col("__i") + F.lit(1))
            .select(*[F.col(f"`{c}`") for c in df.columns if c != name], name))
