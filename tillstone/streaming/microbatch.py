"""The scheduled refreshes as Structured Streaming jobs that take what has arrived and stop.

Sources are read every few minutes, not continuously: ``availableNow`` does exactly that, and the checkpoint
remembers what was taken, so a run that dies is repeated without losing or doubling pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillstone.sources.landing import PAGE_SCHEMA


def land_new_pages(spark: SparkSession, incoming: str, location: str, checkpoint: str) -> StreamingQuery:
    """Append response pages (JSON lines files dropped into ``incoming``) to the raw table, per endpoint."""
    return (
        spark.readStream.schema(PAGE_SCHEMA)
        .json(incoming)
        .writeStream.format("parquet")
        .partitionBy("endpoint")
        .option("path", location)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def apply_batches(
    changes: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Hand each micro-batch of ``changes`` to ``step`` (a window_sync or insert_absent and its publication).

    ``step`` gets the batch id and must be idempotent for it, because a batch may be replayed after a failure.
    """
    return (
        changes.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
