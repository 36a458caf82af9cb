"""Time the headline queries:  BENCH_SF_DIR, BENCH_CPUS (environment).  Prints one JSON line.

Each query runs in full into a sink that discards rows, so nothing is collected and no column is pruned away.
Settled steps (tables a job writes on its way) are part of the time; finance documents are landed beforehand, as a
first line of its own (``land_documents``), because the platform stores them before any query runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from tillstone.plans.job import Job
from tillstone.plans.overlays import Sources
from tillstone.plans.registry import QUERIES
from tillstone.plans.session import discard_settled, local_session

HEADLINE = [
    "window_sync",
    "stg_sales_item",
    "stg_title_allocation",
    "sales_by_month",
    "stock_validity",
    "closing_stock",
    "opening_stock",
    "asof_cost",
    "item_base",
    "expenses",
    "expense_mart",
    "item_margin",
    "slip_tolerance_match",
    "slip_reconciliation",
    "purchase_reconciliation",
    "card_reconciliation",
    "queue_dispatch",
    "page_by_key",
    "dq_unique_combo",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", partitions=2 * int(cpus) if cpus.isdigit() else 16)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the engine

    seconds = {}
    started = time.perf_counter()
    job = Job(Sources(spark, folder))
    job.titles, job.cards  # noqa: B018 - landing and flattening write the stored tables
    seconds["land_documents"] = round(time.perf_counter() - started, 2)
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name].spark(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 2)
        print(name, seconds[name], file=sys.stderr, flush=True)
    discard_settled(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 2),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
