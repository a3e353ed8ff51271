"""Command line: run the control plane, and the loads, as a Spark application.

    spark-submit sluice/__main__.py --input control.csv --mapping export.csv \\
        --env dev [--dry-run] [--request-log PATH] [--items-out PATH] \\
        [--load-from PATH --raw-root PATH [--lake-root PATH] [--database DB] [--run-id ID]]

With ``--load-from`` every resolved item is loaded too, from the Parquet table
``<load-from>/<source table>.parquet``; a run started again under its
``--run-id`` goes on where it stopped. Exit code 0 when validation passed and
(unless ``--allow-item-errors``) every work item resolved and loaded; 1 otherwise. Only the run summary (a handful of rows) and
the first validation findings are printed; items go to ``--items-out``, all
findings to ``--findings-out``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import uuid

from pyspark.sql import SparkSession

from .operators.quality import ValidationError
from .plans import flow, ingest
from .sources.tables import table


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="sluice", description=__doc__.splitlines()[0])
    ap.add_argument("--input", "-i", required=True, help="control table (CSV with header)")
    ap.add_argument("--mapping", "-m", required=True, help="storage portal export (CSV with header)")
    ap.add_argument("--env", "-e", choices=["dev", "test", "prod"], default="dev")
    ap.add_argument("--dry-run", action="store_true", help="validate only; write nothing")
    ap.add_argument("--request-log", help="storage request table (Parquet), insert-if-absent")
    ap.add_argument("--items-out", help="write the resolved work items here (Parquet)")
    ap.add_argument("--table-only-key", action="store_true",
                    help="match storage by table name only (ignore the schema)")
    ap.add_argument("--allow-item-errors", action="store_true",
                    help="exit 0 even when some items did not resolve")
    ap.add_argument("--findings-out", help="write all validation findings here (Parquet) if there are any")
    ap.add_argument("--load-from", help="load the items from the Parquet tables in this folder")
    ap.add_argument("--raw-root", help="raw zone of the loads (required with --load-from)")
    ap.add_argument("--lake-root", help="folder for the lake tables; by default each item's own storage path")
    ap.add_argument("--database", default="{schema}",
                    help="catalog database of the external tables; by default each item's own schema")
    ap.add_argument("--run-id", help="name of the load run; by default a new one")
    ap.add_argument("--buckets", type=int, help="buckets of new tables; by default from the source's size")
    ap.add_argument("--parallel", type=int, default=4, help="items loaded at a time")
    args = ap.parse_args(argv)
    if args.load_from and not args.raw_root:
        ap.error("--load-from needs --raw-root")

    spark = spark or SparkSession.builder.appName("sluice-control-plane").getOrCreate()
    try:
        run = flow.run(spark, args.input, args.mapping, env=args.env,
                       request_log_path=None if args.dry_run else args.request_log,
                       dry_run=args.dry_run, by_schema=not args.table_only_key,
                       findings_path=args.findings_out)
    except ValidationError as e:
        print(f"validation failed: {e}", file=sys.stderr)
        return 1
    if args.dry_run:
        print("validation passed (dry run: nothing written)")
        return 0
    if args.items_out:
        run.items.write.mode("overwrite").parquet(args.items_out)
    summary = run.summary
    if args.load_from:
        started = dt.datetime.now(dt.timezone.utc)
        run_id = args.run_id or f"run-{started:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
        print(f"load run {run_id}")
        for r in run.items.filter("status = 'ok'").select("schema").distinct().collect():  # schemas, not rows
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database.format(schema=r['schema'])}")
        lake_path = (lambda i: f"{args.lake_root.rstrip('/')}/{i['schema']}/{i['table_name']}") if args.lake_root else None
        loads = ingest.run_items(spark, run.items, lambda i: table(spark, args.load_from, i["source_table"]),
                                 args.raw_root, started, run_id, lake_path, args.database,
                                 num_buckets=args.buckets, max_parallel=args.parallel)
        for o in loads.outcomes.filter("status != 'ok'").orderBy("item").collect():  # items, not rows
            print(f"{o['item']}\t{o['error_class']}\t{o['error']}", file=sys.stderr)
        summary = loads.summary
    summary = summary.orderBy("status", "error_class").collect()
    for r in summary:
        print(f"{r.status}\t{r.error_class or ''}\t{r['items']}")
    failed = sum(r["items"] for r in summary if r.status != "ok")
    return 0 if failed == 0 or args.allow_item_errors else 1


if __name__ == "__main__":
    sys.exit(main())
