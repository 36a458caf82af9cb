"""Session settings and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What the jobs want on a cluster.  Shuffle partitions start high and are coalesced at run time; a join side is
# broadcast only when its measured size is under the threshold; skewed shuffle partitions are split.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}

# How joins are planned, also in a session that was made elsewhere (``planned``).
PLANNING = {
    # Tables laid out by product also serve joins on (branch, product) and (month, product) as they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Files are compressed: what is broadcast takes several times as much in the driver's memory as on disk.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}

#: The folder for settled steps, for sessions whose cluster names none in spark.checkpoint.dir.  Unlike that setting,
#: it can be set on a running session.
FOLDER_SETTING = "tillstone.settled.dir"


def planned(spark: SparkSession) -> SparkSession:
    """The session with ``PLANNING``, whoever made it: jobs are laid out for joins that are planned so."""
    for name, value in PLANNING.items():
        spark.conf.set(name, value)
    return spark


def _settled_in(builder: SparkSession.Builder, folder: str | None) -> SparkSession.Builder:
    return builder.config(FOLDER_SETTING, folder) if folder else builder


def cluster_session(app: str = "tillstone", folder: str | None = None) -> SparkSession:
    """Session of a cluster job: ``CLUSTER_SETTINGS``, master and resources as submitted.

    ``folder`` is for settled steps and must be shared by all executors; where the cluster names one in
    spark.checkpoint.dir, that one is used.
    """
    builder = SparkSession.builder.appName(app)
    for name, value in (CLUSTER_SETTINGS | PLANNING).items():
        builder = builder.config(name, value)
    spark = _settled_in(builder, folder).getOrCreate()
    shared_folder(spark)  # better now than at the first settled step
    return spark


def local_session(
    cpus: str = "*", app: str = "tillstone", partitions: int = 8, folder: str | None = None
) -> SparkSession:
    """Session for tests and the benchmark: same settings, partitions sized for one machine, no web page."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for name, value in (CLUSTER_SETTINGS | PLANNING).items():
        builder = builder.config(name, value)
    return (
        _settled_in(builder, folder)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir as the cluster sets it, else ``FOLDER_SETTING``.

    Without either, a local session (one machine, so any folder is shared) uses the system's temporary folder;
    any other session is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER_SETTING, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return f"{tempfile.gettempdir()}/tillstone"
    raise RuntimeError(f"set spark.checkpoint.dir or {FOLDER_SETTING} to a folder shared by all executors")


def run_folder(spark: SparkSession) -> str:
    """This run's part of the shared folder."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


#: Bytes of a file that a task reads where it sorts what it has: some hundred thousand rows, so that the sort stays in memory.
SPLIT = 64 << 20
#: Bytes of a shuffle partition that a task reads where it sorts wide rows for joins and groups: they are compressed there, and
#: take about twenty times as much in memory.
SHUFFLED = 16 << 20


@contextmanager
def _at_most(spark: SparkSession, name: str, size: int) -> Iterator[None]:
    """A session's setting, in bytes, is ``size`` at most."""
    before = spark.conf.get(name)
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) > size:
        spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settled(df: DataFrame, name: str, by: str | None = None, splits: bool = False, wide: bool = False) -> DataFrame:
    """Compute a step once, as a table in the shared folder, and go on from the table.

    A lost executor then re-reads files instead of redoing everything upstream, later steps read only the columns
    they need, and the planner knows the table's real size when it chooses join strategies.  ``by``: the column whose values
    get folders of their own, for readers of some of them.  It should have few values: nothing is shuffled, each task sorts
    what it has and writes a file per value.  ``splits``: for such a step to read, in row groups of ``SPLIT``.  ``wide``: the
    step shuffles and sorts wide rows, and its tasks read ``SHUFFLED`` at most, whatever the session reads at once.
    """
    folder = f"{run_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.option("compression", "zstd")  # half the files of the documents and columns that are settled
    if splits:
        writer = writer.option("parquet.block.size", SPLIT)
    if by is not None:
        with _at_most(df.sparkSession, "spark.sql.files.maxPartitionBytes", SPLIT):
            writer.partitionBy(by).parquet(folder)
    elif wide:
        with _at_most(df.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", SHUFFLED):
            writer.parquet(folder)
    else:
        writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder).select(*df.columns)


#: Bytes, as the planner takes them, of a table in one of the parts it is dealt into: rows by day take many times as much once
#: they have been given their months.
DEALT = 1 << 20


def parts(df: DataFrame, most: int = DEALT) -> int:
    """How many parts to deal a table into: one per shuffle partition, more where those would get larger than ``most``."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // most))


def dealt(df: DataFrame, *key: str, count: int | None = None) -> DataFrame:
    """Shuffle a table as ``laid_out`` tables of the same key and count lie, so that both meet without another exchange."""
    return df.repartition(count or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def _prefix(spark: SparkSession) -> str:
    return "laid_out_" + re.sub(r"\W", "_", spark.sparkContext.applicationId)


def laid_out(df: DataFrame, name: str, key: str, count: int | None = None) -> DataFrame:
    """Like ``settled``, with the table's files dealt by ``key`` into ``count`` buckets, else one per shuffle partition.

    Whatever groups, windows or joins by the key, or by more columns than it, reads the table as it lies.  The key must
    be one that no value of holds a large part of the rows.
    """
    spark, table = df.sparkSession, f"{_prefix(df.sparkSession)}_{uuid.uuid4().hex[:12]}"
    buckets = count or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{run_folder(spark)}/{name}-{table[-12:]}"
    dealt(df, key, count=buckets).write.bucketBy(buckets, key).option("path", folder).saveAsTable(table)
    # Columns of their own instead of the catalog table's: a union compares columns with their qualifiers, and would not see
    # that its sides lie alike.  The metadata keeps the renaming from being optimised away.
    return spark.table(table).select(*[F.col(f"`{c}`").alias(c, metadata={"laid_out": name}) for c in df.columns])


def discard_settled(spark: SparkSession) -> None:
    """Remove this run's settled steps.  For the end of a job: frames built on them can't be read afterwards."""
    for row in spark.sql(f"SHOW TABLES LIKE '{_prefix(spark)}_*'").collect():
        spark.sql(f"DROP TABLE IF EXISTS `{row.tableName}`")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
