"""Lake writes: overwrite (K1), append (K2), FULL load (K3), external table
registration (K5), load timestamp (K8).

Overwriting a path that the DataFrame itself reads would delete the input
before it is read (static overwrite deletes first). ``overwrite`` detects that
from the folders of the plan's input files and first writes the rows to a
staging folder in the shared root, so the write never reads what it replaces;
if the write fails the staged rows stay, and the error says where.
"""

from __future__ import annotations

import datetime as dt
import posixpath
import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from ..session import scratch_path
from .files import partition_folders, remove

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def load_ts(run_started: dt.datetime) -> Column:
    """K8: one literal per run (tasks retried later still write the same value).

    Built from text, so the value does not depend on the session time zone.
    """
    text = run_started.replace(tzinfo=None).isoformat(sep=" ")
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def _plain(path: str) -> tuple[str, str]:
    """(scheme and authority, normalised path) of a path text."""
    u = urlsplit(path)
    return f"{u.scheme}://{u.netloc}" if u.scheme else "", posixpath.normpath("/" + u.path.lstrip("/"))


def reads_path(df: DataFrame, path: str) -> bool:
    """True when an input file of ``df`` lies under ``path``.

    Folder texts are compared, once per folder, without asking the file
    system. A path without a scheme matches any scheme (a needless staging
    write at worst).
    """
    scheme, root = _plain(path)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        other, here = _plain(unquote(folder))
        if (here == root or here.startswith(root.rstrip("/") + "/")) and (
                not scheme or not other or scheme == other):
            return True
    return False


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (),
              fmt: str = "parquet", options: Mapping[str, str] | None = None) -> None:
    """K1 / K3: replace the data at ``path`` with ``df`` (``fmt="csv"`` with
    ``options={"header": "true"}`` gives a CSV table with a header)."""
    staging = None
    if reads_path(df, path):
        staging = scratch_path(df.sparkSession, "_overwrite")
        df.write.parquet(staging)
        df = df.sparkSession.read.schema(df.schema).parquet(staging)
    try:
        w = df.write.mode("overwrite").format(fmt).options(**(options or {}))
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(path)
    except Exception as e:
        if staging:  # the old data may be gone: this is the only copy
            e.add_note(f"the rows for {path} are complete in {staging}")
        raise
    if staging:
        remove(df.sparkSession, staging)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
           options: Mapping[str, str] | None = None) -> None:
    """K2: one batched append for all rows (no read-all / rewrite-all)."""
    w = df.write.mode("append").format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_run(df: DataFrame, path: str, run_id: str) -> str:
    """K2 exactly once: the rows of one run go into a folder of that run below
    ``path``, which a repeated run replaces; other runs' rows stay. Readers of
    ``path`` see the column ``run_id``. Returns the folder."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
        raise ValueError(f"run id {run_id!r} is no folder name")
    folder = f"{path.rstrip('/')}/run_id={run_id}"
    df.write.mode("overwrite").parquet(folder)
    return folder


def full_load(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K3: FULL load, the target is replaced by the new snapshot."""
    overwrite(df, path, partition_by)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_external_table(spark: SparkSession, name: str, path: str, schema_of: DataFrame,
                            partition_by: Sequence[str] = (), comments: Mapping[str, str] | None = None,
                            replace: bool = True, folders: Mapping[str, str] | None = None) -> None:
    """K5: external Parquet table over an existing lake path.

    ``DROP TABLE`` on it keeps the files. Column comments become metadata.
    ``folders`` (``a=1/b=2`` -> location) says where the partitions lie; by
    default they are the folders below ``path``. A table that exists
    (``replace``) is brought up to date in place: comments, new columns,
    location, and only those partitions that were added, moved or dropped, so
    a reader always finds it. Only another column type or partitioning needs a
    new table.
    """
    comments = comments or {}
    fields = schema_of.schema.fields
    if spark.catalog.tableExists(name) and replace:
        have = {c.name: c for c in spark.catalog.listColumns(name)}
        want = {f.name: f.dataType.simpleString() for f in fields}
        same = (all(want.get(n) == c.dataType for n, c in have.items())
                and [c.name for c in have.values() if c.isPartition] == list(partition_by))
        if same:
            added = [f for f in fields if f.name not in have]
            if added:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(_column_sql(f, comments) for f in added)})")
            for n, c in have.items():
                if not c.isPartition and comments.get(n, c.description or "") != (c.description or ""):
                    spark.sql(f"ALTER TABLE {name} ALTER COLUMN {_q(n)} COMMENT {_text(comments[n])}")
            _move_table(spark, name, path, partition_by, folders)
            return
        spark.sql(f"DROP TABLE {name}")
    parts = f" PARTITIONED BY ({', '.join(_q(p) for p in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({', '.join(_column_sql(f, comments) for f in fields)}) USING parquet{parts} "
              f"LOCATION {_text(path)}")
    if partition_by:
        _sync_partitions(spark, name, path, partition_by, folders)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column_sql(f: StructField, comments: Mapping[str, str]) -> str:
    c = f"{_q(f.name)} {f.dataType.simpleString()}"
    return c + (f" COMMENT {_text(comments[f.name])}" if f.name in comments else "")


def _partition_sql(spec: str) -> str:
    """``a=1/b=x%20y`` (as SHOW PARTITIONS prints it) -> ``a='1', b='x y'``."""
    parts = []
    for kv in spec.split("/"):
        k, v = kv.split("=", 1)
        parts.append(f"{_q(k)}=" + ("null" if v == _NULL_PARTITION else _text(unquote(v))))
    return ", ".join(parts)


def _move_table(spark: SparkSession, name: str, path: str, partition_by: Sequence[str],
                folders: Mapping[str, str] | None) -> None:
    """Point an existing table at ``path`` and its partitions at their folders."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(path)}")
    if partition_by:
        _sync_partitions(spark, name, path, partition_by, folders)
    spark.catalog.refreshTable(name)


def _sync_partitions(spark: SparkSession, name: str, path: str, partition_by: Sequence[str],
                     folders: Mapping[str, str] | None) -> None:
    """Add, move and drop partition entries until they are ``folders``; entries
    that are right are left alone. The statements are bounded by the number of partitions
    (catalog metadata, not data)."""
    if folders is None:
        folders = {n: f"{path}/{n}" for n in partition_folders(spark, path, len(partition_by))}
    want = {_partition_sql(n): at for n, at in folders.items()}
    have = {_partition_sql(r[0]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    if have:
        # Where the entries point now, from the file listing of the table.
        places = {_plain(unquote(f.rsplit("/", 1)[0]))[1] for f in spark.table(name).inputFiles()}
        for spec in sorted(have & want.keys()):
            if _plain(want[spec])[1] not in places:
                spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION {_text(want[spec])}")
    new = sorted(want.keys() - have)
    for lo in range(0, len(new), 200):
        entries = " ".join(f"PARTITION ({spec}) LOCATION {_text(want[spec])}" for spec in new[lo:lo + 200])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {entries}")
    for spec in sorted(have - want.keys()):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(name)


def publish_snapshot(spark: SparkSession, df: DataFrame, table_name: str, base_path: str,
                     version: str, partition_by: Sequence[str] = (),
                     comments: Mapping[str, str] | None = None) -> str:
    """K3 with publish safety: write the new snapshot into its own folder
    ``<base_path>/v=<version>``, then point the catalog table at it.

    Readers of the table see the old snapshot until the location switch (one
    catalog operation) and the new one after it, never a half-written
    folder. Old version folders stay until the caller removes them (readers
    that started before the switch may still be reading them).

    Partitioned tables: partition entries keep their own locations and are
    re-pointed one by one; the table is never without them, but a reader in
    between may see some partitions of each version.
    """
    target = f"{base_path.rstrip('/')}/v={version}"
    w = df.write.mode("errorifexists").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(target)
    if spark.catalog.tableExists(table_name):
        _move_table(spark, table_name, target, partition_by, None)
    else:
        register_external_table(spark, table_name, target, df, partition_by, comments,
                                replace=False)
    return target
