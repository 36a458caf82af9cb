"""Synchronising a stored table with what a source delivered.

Plain files have no MERGE, so each operator computes the next state.  Publish it whole with ``publish_replace``, or only
the partitions it changes with ``partitions.apply_read``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.relational import dedup_latest


def split_windows(df: DataFrame, first: str, last: str, days: int = 30) -> DataFrame:
    """Contiguous windows of at most ``days`` days covering each row's [first, last]: ``window_start``, ``window_end``."""
    starts = F.sequence(F.col(first), F.col(last), F.expr(f"interval {int(days)} day"))
    return (
        df.where(F.col(first) <= F.col(last))
        .withColumn("window_start", F.explode(starts))
        .withColumn("window_end", F.least(F.date_add("window_start", days - 1), F.col(last)))
    )


def between_days(name: str, as_of: date, before: int, after: int = 0) -> Column:
    """Scope: ``name`` lies from ``before`` days before ``as_of`` to ``after`` days after it."""
    return F.col(name).between(F.lit(as_of - timedelta(days=before)), F.lit(as_of + timedelta(days=after)))


def window_sync(
    state: DataFrame,
    batch: DataFrame,
    key: str,
    scope: Column,
    seen_at: Column,
    batch_order: Sequence[Column],
) -> DataFrame:
    """Next state after reading one window of the source again.

    Batch rows replace state rows of the same key in full.  State rows inside the scope that did not come back
    were deleted at the source; rows outside it were not read and stay.  Batch rows without a key are dropped;
    of several rows with one key the first in ``batch_order`` counts (order it so that the last delivered leads).
    Only keys of the batch meet the state, and a batch under the broadcast threshold costs the state no shuffle.
    """
    fresh = dedup_latest(batch.where(F.col(key).isNotNull()), [key], batch_order)
    fresh = fresh.withColumn("seen_at", seen_at).select(*state.columns)
    unread = state.where(~F.coalesce(scope, F.lit(False)))
    return unread.join(fresh.select(key), key, "left_anti").select(*state.columns).unionByName(fresh)


Read = tuple[DataFrame, Column]  # what a read of the source delivered, and the scope that it covered


def sync_reads(
    state: DataFrame, reads: Sequence[Read], key: str, seen_at: Column, batch_order: Sequence[Column]
) -> DataFrame:
    """Next state after several reads, each of a scope of its own, applied in order.

    The order counts where scopes meet: a row that one read brought and a later read of its scope did not is deleted.
    """
    for batch, scope in reads:
        state = window_sync(state, batch, key, scope, seen_at, batch_order)
    return state


def sync_counts(state: DataFrame, batch: DataFrame, key: str, scope: Column) -> DataFrame:
    """What ``window_sync`` does to a state, as one row: inserted, replaced, deleted."""
    delivered = batch.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_new", F.lit(True))
    both = state.select(key, F.coalesce(scope, F.lit(False)).alias("_scope"), F.lit(True).alias("_old")).join(
        delivered, key, "full"
    )

    def rows(where: Column) -> Column:
        return F.count(F.when(where, 1))

    old, new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    return both.agg(
        rows(new & ~old).alias("inserted"),
        rows(new & old).alias("replaced"),
        rows(old & ~new & F.col("_scope")).alias("deleted"),
    )


def touched_partitions(state: DataFrame, batch: DataFrame, key: str, scope: Column, partition: str) -> DataFrame:
    """Partitions (one column, as named) that a sync changes: those of the scope, of the rows delivered, and those that
    rows of the same keys stood in before."""
    keys = batch.where(F.col(key).isNotNull()).select(key).distinct()
    before = state.join(keys.withColumn("_new", F.lit(True)), key, "left")
    left = before.where(F.coalesce(scope, F.lit(False)) | F.col("_new").isNotNull()).select(partition)
    return left.union(batch.where(F.col(key).isNotNull()).select(partition)).distinct()


def insert_absent(
    target: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    nulls_equal: bool = False,
    additions_only: bool = False,
) -> DataFrame:
    """Add rows whose key is not there yet; existing rows are never changed.

    With ``additions_only`` the result is the rows to append, so that a small batch need not rewrite the target.

    With ``nulls_equal`` NULL key parts equal each other.  Without it a row with a NULL key part conflicts with
    nothing, so all such rows enter; they bypass the de-duplication and cannot pile up in one group.
    """
    if nulls_equal:
        candidates, free = new, None
    else:
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        candidates, free = new.where(whole), new.where(~whole)
    once = dedup_latest(candidates, keys, order)

    def same(left: str, right: str) -> Column:
        pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
        return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if nulls_equal else a == b for a, b in pairs])

    # The target is cut to the new keys first: a small batch is broadcast and the target is not shuffled.
    wanted = once.select(*keys)
    present = target.select(*keys).alias("t").join(wanted.alias("w"), same("t", "w"), "left_semi")
    added = once.alias("n").join(present.alias("p"), same("n", "p"), "left_anti")
    if free is not None:
        added = added.unionByName(free)
    return added if additions_only else target.unionByName(added, allowMissingColumns=True)


def dim_sync(
    dim: DataFrame, source: DataFrame, key: str, name: str, cols: Sequence[str], touched_at: Column
) -> DataFrame:
    """Dimension upsert: insert new keys, update rows that really changed, delete nothing.

    Texts are trimmed and rows whose ``name`` is blank are skipped.  ``touched_at`` is stamped on inserts and
    real changes only.  A key delivered twice is an error, raised by the tasks that find it.
    """
    texts = {f.name for f in source.schema.fields if f.dataType.simpleString() == "string"}
    clean = source.select(key, *[(F.trim(c) if c in texts else F.col(c)).alias(c) for c in cols]).where(
        F.coalesce(F.col(name), F.lit("")) != ""
    )
    twice = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit("key delivered twice: "), F.col(key).cast("string")))
    )
    # The error is checked on a column the result uses, or column pruning would drop the check.
    fresh = clean.groupBy(key).agg(
        F.coalesce(twice.cast("boolean"), F.lit(True)).alias("_delivered"), *[F.max(c).alias(c) for c in cols]
    )
    d, s = dim.alias("d"), fresh.alias("s")
    delivered = F.col("s._delivered")
    differs = reduce(lambda a, b: a | b, [~F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in cols])
    return d.join(s, key, "full").select(
        key,
        *[F.when(delivered, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in cols],
        F.when(delivered & differs, touched_at).otherwise(F.col("d.touched_at")).alias("touched_at"),
    )
