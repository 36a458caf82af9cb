"""Relational building blocks that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.  NULL keys form one group.

    ``order`` must be total and must state where NULLs go (``asc_nulls_last`` ...), because engines disagree.
    Filtering row_number() = 1 lets Spark cut each map task's rows to one per key before the shuffle
    (WindowGroupLimit), so a key holding a third of the table costs one row per task, not a third of the table.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def asof_last(
    probes: DataFrame,
    probe_date: str,
    states: DataFrame,
    state_date: str,
    keys: Sequence[str],
    values: Sequence[str],
    probes_unique: bool = False,
) -> DataFrame:
    """Left as-of join: each probe row gets ``values`` of the last state dated on or before it.

    A join on the keys with a date range compares every probe with every state of its key.  Here both sides
    are stacked and one running ``last`` per key answers all probes, so the work is linear.  The window group
    holds the states of one key (unique per date, so bounded by the calendar) plus one probe per date: probes
    not known to be unique per (keys, date) are reduced to that first and joined back afterwards.
    """
    if not probes_unique:
        asked = probes.select(*keys, F.col(probe_date).alias("_on")).distinct()
        found = asof_last(asked, "_on", states, state_date, keys, values, probes_unique=True)
        same = [probes[k] == found[k] for k in keys] + [probes[probe_date] == found["_on"]]
        return probes.join(found, same, "left").select(probes["*"], *[found[v] for v in values])

    state = F.struct(*[F.col(v) for v in values])
    probe = F.struct(*[F.col(f"`{c}`") for c in probes.columns if c not in keys])
    stacked = states.where(F.col(state_date).isNotNull()).select(
        *keys, F.col(state_date).alias("_at"), F.lit(0).alias("_side"), state.alias("_state")
    ).unionByName(
        probes.select(*keys, F.col(probe_date).alias("_at"), F.lit(1).alias("_side"), probe.alias("_probe")),
        allowMissingColumns=True,
    )
    so_far = (
        Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        stacked.withColumn("_state", F.last("_state", ignorenulls=True).over(so_far))
        .where(F.col("_side") == 1)
        # The keys themselves, not copies of them: what is partitioned by them stays so.
        .select(
            *[F.col(f"`{c}`") if c in keys else F.col(f"_probe.`{c}`") for c in probes.columns],
            *[F.col(f"_state.{v}").alias(v) for v in values],
        )
    )
