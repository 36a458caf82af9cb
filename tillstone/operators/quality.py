"""Data-quality checks.  Each gives one row: (check, severity, violations); nothing reaches the driver but that."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(RuntimeError):
    """A check of severity 'error' found violations."""


def _result(violations: DataFrame, check: str, severity: str) -> DataFrame:
    return violations.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(check).alias("check"), F.lit(severity).alias("severity"), "violations"
    )


def dq_unique(df: DataFrame, name: str, severity: str = "error") -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    repeated = df.where(F.col(name).isNotNull()).groupBy(name).count().where("count > 1")
    return _result(repeated, f"unique:{name}", severity)


def dq_not_null(df: DataFrame, name: str, severity: str = "error") -> DataFrame:
    return _result(df.where(F.col(name).isNull()), f"not_null:{name}", severity)


def dq_unique_combo(df: DataFrame, names: Sequence[str], severity: str = "error") -> DataFrame:
    """Combinations that occur more than once; NULL counts as a value."""
    repeated = df.groupBy(*names).count().where("count > 1")
    return _result(repeated, f"unique_combo:{','.join(names)}", severity)


def dq_accepted_values(df: DataFrame, name: str, values: Sequence, severity: str = "error") -> DataFrame:
    """Distinct values outside the list; NULL passes."""
    unexpected = df.where(~F.col(name).isin(*values)).select(name).distinct()
    return _result(unexpected, f"accepted_values:{name}", severity)


@dataclass(frozen=True)
class Check:
    """One check of a table, for ``in_one_pass``: 'unique', 'not_null', 'unique_combo' or 'accepted_values'."""

    kind: str
    names: tuple[str, ...]
    values: tuple = ()
    severity: str = "error"

    @property
    def title(self) -> str:
        return f"{self.kind}:{','.join(self.names)}"

    def key(self) -> Column:
        """What is counted of a row, as text; NULL if nothing is.  JSON tells NULL from '' and parts from one another."""
        c, whole = F.col(self.names[0]), F.to_json(F.struct(*self.names))
        return {
            "unique": F.when(c.isNotNull(), whole),
            "not_null": F.when(c.isNull(), F.lit("")),
            "unique_combo": whole,
            "accepted_values": F.when(~c.isin(*self.values), whole),
        }[self.kind]

    def violations(self, rows: Column) -> Column:
        """What a key that ``rows`` rows have adds to the violations."""
        return {
            "unique": F.when(rows > 1, 1),
            "not_null": rows,
            "unique_combo": F.when(rows > 1, 1),
            "accepted_values": F.lit(1),
        }[self.kind]


def in_one_pass(df: DataFrame, *checks: Check) -> DataFrame:
    """Several checks of a table: one scan, and one grouping of the keys of all, combined before the shuffle.

    The keys themselves are grouped, not hashes of them, so there are no collisions to look into.
    """
    keys = [F.struct(F.lit(i).alias("check"), check.key().alias("key")) for i, check in enumerate(checks)]
    found = F.filter(F.array(*keys), lambda one: one["key"].isNotNull())
    grouped = df.select(F.inline(found)).groupBy("check", "key").agg(F.count(F.lit(1)).alias("rows"))
    sums = [
        F.coalesce(F.sum(F.when(F.col("check") == i, check.violations(F.col("rows")))), F.lit(0)).cast("bigint").alias(str(i))
        for i, check in enumerate(checks)
    ]
    said = F.array(*[F.struct(F.lit(c.title).alias("check"), F.lit(c.severity).alias("severity"), F.col(str(i)).alias("violations")) for i, c in enumerate(checks)])
    return grouped.agg(*sums).select(F.inline(said))


def all_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def publish_key_check(df: DataFrame, key: str = "id") -> DataFrame:
    """The key of a table about to be published is unique and not NULL: one pass over the data.

    Duplicates and NULLs are both read off the same grouping of the key.
    """
    grouped = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    counts = grouped.agg(
        total(F.when(F.col("k").isNotNull() & (F.col("n") > 1), 1)).alias(f"unique:{key}"),
        total(F.when(F.col("k").isNull(), F.col("n"))).alias(f"not_null:{key}"),
    )
    return counts.unpivot([], [f"unique:{key}", f"not_null:{key}"], "check", "violations").select(
        "check", F.lit("error").alias("severity"), "violations"
    )


def require(checks: DataFrame) -> None:
    """Raise if any check of severity 'error' found something.  Collects the check rows, one per check."""
    failed = checks.where("severity = 'error' and violations > 0").collect()
    if failed:
        raise CheckFailed("; ".join(f"{r['check']}: {r['violations']}" for r in failed))
