"""Publishing tables in versions, and the audit of loads."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstone.operators.quality import CheckFailed, publish_key_check, require

AUDIT_SCHEMA = (
    "table_name string, started_at timestamp_ntz, ended_at timestamp_ntz, rows bigint, error string, source_version string"
)
ERROR_LENGTH = 2000  # as the platform stores it


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def publish_replace(df: DataFrame, table: str, location: str, key: str | None = None) -> dict:
    """Replace a table by a new version; says whether its columns stayed ('replaced') or changed ('recreated').

    Overwriting files in place is not atomic and would break readers half-way, so each version is written to its
    own folder and the table, a view, is pointed at it last: readers see the old version or the new one.  With a
    ``key`` the new version is checked before the switch, and a failed check leaves the old version standing.
    The view lives in the session's catalog; with a shared metastore every session sees the switch.
    """
    spark = df.sparkSession
    parent = f"{location.rstrip('/')}/{table}"
    before = _columns(spark.table(table)) if spark.catalog.tableExists(table) else None
    folder = f"{parent}/version={time.time_ns()}-{uuid.uuid4().hex[:8]}"
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    fresh = spark.read.schema(df.schema).parquet(folder)
    if key is not None:
        try:
            require(publish_key_check(fresh, key))
        except CheckFailed:
            _remove(spark, folder)
            raise
    spark.sql(f"CREATE OR REPLACE VIEW `{table}` AS SELECT * FROM parquet.`{folder}`")
    outcome = "created" if before is None else "replaced" if before == _columns(df) else "recreated"
    return {"table": table, "outcome": outcome, "rows": int(written.get["rows"])}


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def prune_versions(spark: SparkSession, table: str, location: str, keep: int = 2) -> list[str]:
    """Remove all but the ``keep`` newest versions of a table; says which.  Run it when no reader of older ones is left."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{location.rstrip('/')}/{table}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    folders = sorted(s.getPath().toString() for s in found if s.getPath().getName().startswith("version="))
    old = folders[: max(0, len(folders) - max(1, keep))]
    for folder in old:
        _remove(spark, folder)
    return [folder.rpartition("/")[2] for folder in old]


class LoadsFailed(RuntimeError):
    """Some tables of a run failed; the others were loaded."""


def run_loads(
    spark: SparkSession,
    loads: Mapping[str, Callable[[], int]],
    audit_location: str,
    versions: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Run each table's load, append one audit row per table, and fail at the end if any of them failed.

    The loop is over table names; the loads themselves are Spark jobs that return their row counts.  ``versions`` names
    the version of the source each table was read at (a commit, a snapshot), for tables whose source has one.
    """
    done, failed = {}, {}
    for table, load in loads.items():
        started, rows, error = datetime.now(timezone.utc).replace(tzinfo=None), None, None
        try:
            rows = done[table] = load()
        except Exception as problem:  # noqa: BLE001 - recorded, and the run goes on with the next table
            error = failed[table] = str(problem)[:ERROR_LENGTH]
        ended = datetime.now(timezone.utc).replace(tzinfo=None)
        row = spark.createDataFrame([(table, started, ended, rows, error, (versions or {}).get(table))], AUDIT_SCHEMA)
        row.write.mode("append").parquet(audit_location)
    if failed:
        raise LoadsFailed(f"{len(failed)} of {len(loads)} loads failed: {failed}")
    return done


def load_audit(audit: DataFrame) -> DataFrame:
    """Per table: the end of the latest good load, rows loaded by good loads, and how many loads failed."""
    good = F.col("error").isNull()
    return audit.groupBy("table_name").agg(
        F.max(F.when(good, F.col("ended_at"))).alias("latest_good"),
        F.sum(F.when(good, F.col("rows"))).alias("rows"),
        F.count(F.when(~good, 1)).alias("failures"),
    )
