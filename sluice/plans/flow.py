"""The control-plane flow as one lazy plan.

control table -> validate (every finding) -> fan out per banner -> names ->
storage requests (insert-if-absent) -> mapping lookup -> per-item outcome ->
run summary.

Actions happen only at the gate (validation findings), the request append
and whatever the caller does with ``items`` / ``summary``. Each step is a
DataFrame function, so a control table of millions of rows runs the same way
as one of two.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed
from ..functions import names as N
from ..functions.codes import account_suffix, lower_or_default, refresh_label, service_account
from ..operators import quality as Q
from ..operators.dedup import first_per_key
from ..operators.explode import explode_list
from ..operators.lookup import insert_if_absent, lookup
from ..operators.outcomes import run_summary, with_outcome
from ..sinks import lake
from ..sinks.files import exists
from ..sources.control import MALFORMED, read_control, read_csv_text, with_row_number

# Validation rules in reporting order: the five checks of the original tool,
# then two of ours (schema and source table must be present too).
CONTROL_RULES = (
    Q.Rule("table_empty", "dlTableName", "not_blank", message="dlTableName is empty"),
    Q.Rule("banner_empty", "BANNER_NAME", "not_blank", message="BANNER_NAME is empty"),
    Q.Rule("banner_invalid", "BANNER_NAME", "each_in", allowed=fixed.BANNERS,
           message="Invalid banner(s)"),
    Q.Rule("sensitivity_invalid", "dataSensitivity", "in_ci", allowed=fixed.SENSITIVITIES,
           message="Invalid sensitivity; must be one of: " + ", ".join(fixed.SENSITIVITIES)),
    Q.Rule("load_type_invalid", "tableLoadType", "in_upper", allowed=fixed.LOAD_TYPES,
           message="Invalid tableLoadType; must be INC or FULL"),
    Q.Rule("schema_empty", "dlSchemaName", "not_blank", message="dlSchemaName is empty"),
    Q.Rule("source_empty", "icdsTableName", "not_blank", message="icdsTableName is empty"),
)


def control_rules() -> tuple[Q.Rule, ...]:
    """First the row's shape (the number of fields of the header), then ``CONTROL_RULES``."""
    malformed = Q.Rule("row_malformed", MALFORMED, "expr", message="wrong number of fields",
                       predicate=F.col(MALFORMED).isNotNull())
    return (malformed, *CONTROL_RULES)


DEFAULT_TAGS = ("Ephemeral", "SLT")
DEFAULT_ACCOUNT = "svc-ingest-{suffix}@lake-{suffix}-{env}.example"


def work_items(control: DataFrame, lake_root: str = "output") -> DataFrame:
    """Fan-out (X1) and naming (P3-P7): one row per (control row, banner),
    banner order kept (``pos``). Values are normalised once, after
    validation: load type upper, sensitivity lower."""
    c = control.select(
        F.col("icdsTableName").alias("source_table"), "BANNER_NAME",
        F.lower("dataSensitivity").alias("sensitivity"),
        F.col("dlSchemaName").alias("schema"), F.col("dlTableName").alias("table"),
        F.upper("tableLoadType").alias("load_type"),
        F.col("keyPreCombine").alias("precombine"), F.col("keyPrimaryKey").alias("primary_key"),
        *[c for c in ("row_id", *schemas.EXTRACT_COLUMNS) if c in control.columns])
    items = explode_list(c, "BANNER_NAME", sep=",", value_col="banner", pos_col="pos")
    tname = N.table_name("banner", "table")
    return items.select(
        "*",
        tname.alias("table_name"),
        N.cluster_name("schema", "banner", "table").alias("cluster_name"),
        N.unit_name("banner", "load_type", "schema", "table").alias("unit_name"),
        N.output_dir(lake_root, "schema", tname).alias("output_dir"),
        N.tags(DEFAULT_TAGS, "banner", tname).alias("tags"),
    ).drop("BANNER_NAME")


def storage_requests(items: DataFrame, env: str, account_template: str = DEFAULT_ACCOUNT) -> DataFrame:
    """P2 (with P9-P11): one storage request row per work item."""
    suffix = account_suffix("sensitivity")
    acct = service_account(suffix, F.lit(env), account_template)
    load = lower_or_default("load_type", fixed.DEFAULT_LOAD_TYPE)
    return items.select(
        F.lit(fixed.BUCKET_NAME_TYPE).alias("bucketNameType"),
        F.col("schema").alias("databaseName"),
        F.col("table_name").alias("tableName"),
        F.concat(F.lit(fixed.COMPANY_CODE_PREFIX), F.upper("banner")).alias("opCmpnyCd"),
        refresh_label(load).alias("refreshMode"),
        acct.alias("storage_uploader"), acct.alias("storage_viewer"),
        F.lit(False).alias("isDevBigLake"),
        F.lit(fixed.SOFT_DELETE_POLICY).alias("updateSoftDelete"),
        F.lit(None).cast("string").alias("resourceBucketType"),
        *[F.col(c) for c in ("row_id", "pos") if c in items.columns],
    )


def storage_mapping(export: DataFrame, by_schema: bool = True,
                    only_created: Column | None = None) -> DataFrame:
    """A1 + P1: the storage portal export reduced to one storage id per
    (schema,) lower-cased table name, first row in export order winning.
    ``only_created`` optionally drops rows the portal failed to create."""
    m = export if only_created is None else export.filter(only_created)
    numbered = with_row_number(m, "__row")
    cols = [F.lower(schemas.MAPPING_SOURCE_KEY).alias("dlTableName"),
            F.col(schemas.MAPPING_SOURCE_VALUE).alias("bucket_id"), F.col("__row")]
    keys = ["dlTableName"]
    if by_schema:
        cols.insert(0, F.col("databaseName").alias("dlSchemaName"))
        keys = ["dlSchemaName", "dlTableName"]
    m = numbered.select(*cols).filter(F.col("dlTableName").isNotNull())
    return first_per_key(m, keys, ["__row"]).drop("__row")


def resolve_items(items: DataFrame, mapping: DataFrame, scheme: str = "gs://") -> DataFrame:
    """J1 + J2 + C1: look every item up in a mapping with one row per key (as
    ``storage_mapping`` gives it); misses become error outcomes."""
    m = mapping.withColumn("__o", F.lit(0))
    if "dlSchemaName" in mapping.columns:
        j = lookup(items, m, ["schema", "table_name"], ["dlSchemaName", "dlTableName"],
                   order=["__o"], values=["bucket_id"], hit_col="_hit", right_is_unique=True)
    else:
        j = lookup(items, m, "table_name", "dlTableName", order=["__o"], values=["bucket_id"],
                   hit_col="_hit", right_is_unique=True)
    out = with_outcome(j, [
        (F.col("table_name").isNull(), "bad_name", F.lit("table name could not be derived")),
        (~F.col("_hit"), "not_found",
         F.concat(F.lit("Table '"), F.col("table_name"), F.lit("' not found in mapping"))),
    ])
    return out.withColumn("lake_path", F.when(
        F.col("status") == "ok", N.lake_path("bucket_id", "table_name", scheme))).drop("_hit")


@dataclass
class ControlRun:
    findings: DataFrame
    items: DataFrame | None = None
    requests: DataFrame | None = None
    summary: DataFrame | None = None


def run(spark: SparkSession, control_path: str, mapping_export_path: str, env: str = "dev",
        request_log_path: str | None = None, dry_run: bool = False,
        fail_on_item_error: bool = False, by_schema: bool = True,
        findings_path: str | None = None) -> ControlRun:
    """The whole control plane. Raises ``ValidationError`` when any control
    row is invalid; nothing is written then but, with ``findings_path``, all
    findings (the exception carries them too). ``dry_run`` stops after
    validation."""
    control = read_control(spark, control_path, schemas.CONTROL_REQUIRED, keep_malformed=True, keep_place=True)
    numbered = with_row_number(control, "row_id")
    rules = control_rules()
    findings = Q.violations(numbered, rules, "row_id")
    Q.gate(numbered, rules, "row_id", findings_path=findings_path)
    if dry_run:
        return ControlRun(findings)
    for opt in ("keyPreCombine", "keyPrimaryKey"):
        if opt not in numbered.columns:
            numbered = numbered.withColumn(opt, F.lit(None).cast("string"))
    items = work_items(numbered)
    requests = storage_requests(items, env)
    if request_log_path is not None:
        key = list(schemas.REQUEST_KEY)
        req = requests.drop("pos")
        if exists(spark, request_log_path):
            existing = spark.read.parquet(request_log_path)
            new = insert_if_absent(existing, req, key, ["row_id"]).drop("row_id")
        else:
            new = first_per_key(req, key, ["row_id"]).drop("row_id")
        lake.append(new, request_log_path)
    mapping = storage_mapping(read_csv_text(spark, mapping_export_path, keep_place=True), by_schema=by_schema)
    resolved = resolve_items(items, mapping)
    summary = run_summary(resolved)
    if fail_on_item_error and not resolved.filter(F.col("status") != "ok").isEmpty():
        raise RuntimeError("some work items failed; see items.status/error")
    return ControlRun(findings, resolved, requests, summary)

