"""Response pages kept by run: landed once however often they are delivered, and a ledger of the ids they answer for."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstone.functions.relational import dedup_latest
from tillstone.plans.session import settled
from tillstone.sources.landing import PAGE_SCHEMA, ids_done
from tillstone.sources.partitions import PartitionedTable
from tillstone.sources.sync import insert_absent
from tillstone.streaming.microbatch import apply_batches

RUN = "run"
KEY = [RUN, "endpoint", "parameters"]


def kept_by_run(spark: SparkSession, location: str) -> PartitionedTable:
    return PartitionedTable(spark, location, RUN)


def land_once(table: PartitionedTable, pages: DataFrame) -> int:
    """Add the pages that are not there yet, by run, endpoint and parameters; says how many those are.

    Only the runs that are delivered are opened and written.  Of several pages with one key the first extracted counts.
    """
    runs = [r[0] for r in pages.select(RUN).distinct().collect()]
    order: list[Column] = [F.col("extracted_at").asc_nulls_last(), F.col("payload").asc_nulls_last()]
    names = pages.columns
    if not table.number:
        added = dedup_latest(pages, KEY, order)
    else:
        added = insert_absent(table.read(only=runs), pages, KEY, order, nulls_equal=True, additions_only=True)
    added = settled(added.select(*names), "new-pages")
    fresh = {r[RUN]: r["count"] for r in added.groupBy(RUN).count().collect()}
    if fresh:
        rows = added if not table.number else table.read(only=fresh).select(*names).unionByName(added)
        table.replace(rows, fresh, f"pages {uuid.uuid4().hex}")
    return sum(fresh.values())


def land_new_pages_once(spark: SparkSession, incoming: str, table: PartitionedTable, checkpoint: str) -> StreamingQuery:
    """Take the JSON lines files that have arrived in ``incoming``.  A batch handed over again, or a run delivered again in
    other files or to a stream that has lost its checkpoint, adds nothing."""
    arrived = spark.readStream.schema(PAGE_SCHEMA).json(incoming)
    return apply_batches(arrived, lambda batch, _: land_once(table, batch), checkpoint)


def refresh_ledger(ledger: PartitionedTable, pages: PartitionedTable, parameter: str, error_key: str) -> list[str]:
    """Bring the ledger of ids answered without an error up to the pages; says which runs were opened for it.

    The ledger's newest list names the list of the pages it has seen, so only runs landed since are parsed.  A lost
    ledger starts from nothing and parses them all once.
    """
    seen = json.loads(ledger.current()["batch"])["pages"] if ledger.number else 0
    runs = pages.touched_since(seen)
    if runs or not ledger.number:
        done = ids_done(pages.read(only=runs), parameter, error_key, RUN).distinct()
        ledger.replace(done, runs, json.dumps({"pages": pages.number}))
    return runs
