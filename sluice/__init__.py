"""sluice: control-table-driven lake ingestion on Spark.

Every operator is a function from DataFrame(s) to DataFrame built from
built-in Spark expressions, so the same validation, fan-out, naming,
lookup, deduplication and upsert logic runs on a two-row control table and
on a multi-terabyte source table alike.
"""

__version__ = "0.1.0"

from .operators.dedup import first_per_key, latest_per_key  # noqa: E402
from .operators.explode import explode_list, per_row_list, zip_lists  # noqa: E402
from .operators.lookup import insert_if_absent, lookup, lookup_misses  # noqa: E402
from .operators.outcomes import counts, run_summary, with_outcome  # noqa: E402
from .operators.quality import (Rule, ValidationError, flag, gate, split_valid,  # noqa: E402
                                violations, write_split)
from .sinks.lake import append, full_load, overwrite, publish_snapshot  # noqa: E402
from .sinks.upsert import merge_latest, snapshot, upsert  # noqa: E402

__all__ = [
    "Rule", "ValidationError", "append", "counts", "explode_list", "first_per_key",
    "flag", "full_load", "gate", "insert_if_absent", "latest_per_key", "lookup", "lookup_misses",
    "merge_latest", "overwrite", "per_row_list", "publish_snapshot", "run_summary", "snapshot",
    "split_valid", "upsert", "violations", "with_outcome", "write_split", "zip_lists",
]
