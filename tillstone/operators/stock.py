"""Stock from sparse daily positions: a row is valid until the day before the next row of its branch and product.

The daily table is unique per (branch, product, date), which the window over an item's days checks as it goes, so a
window group never holds more rows than the calendar has days, however large the table is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstone.functions.columns import QUANTITY, month_of, zero
from tillstone.functions.relational import asof_last, dedup_latest

ITEM = ["branch_id", "product_code"]
ITEM_MONTH = ["month", "branch_id", "product_code"]


def _months(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.expr("interval 1 month"))


def _month_end(month: Column, as_of: date) -> Column:
    return F.least(F.last_day(month), F.lit(as_of))


def month_calendar(spark: SparkSession, start: date, as_of: date) -> DataFrame:
    """Months from ``start`` to the month of ``as_of``; each ends on its last day, the current one on ``as_of``."""
    bounds = spark.range(1).select(F.lit(start).alias("first"))
    return months_since(bounds, "first", as_of).select("month", "month_end")


def months_since(df: DataFrame, first: str, as_of: date) -> DataFrame:
    """One row per input row and month from the month of ``first`` to the month of ``as_of``."""
    start, last = month_of(F.col(first)), month_of(F.lit(as_of))
    return (
        df.where(start <= last)
        .withColumn("month", F.explode(_months(start, last)))
        .withColumn("month_end", _month_end(F.col("month"), as_of))
    )


def stock_validity(daily: DataFrame) -> DataFrame:
    """Daily rows with ``next_date`` (next row of the item) and ``positive_cost`` (last cost > 0 up to the row).

    Rows may bring a ``positive_cost`` of their own: what is known from before the first of them.  A day that comes twice
    fails the task that meets it: which of its rows is in force would be left to chance.
    """
    by_date = Window.partitionBy(*ITEM).orderBy("date")
    so_far = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    positive = F.when(F.col("cost") > 0, F.col("cost"))
    if "positive_cost" in daily.columns:
        positive = F.coalesce(positive, "positive_cost")
    next_date = F.lead("date").over(by_date)
    twice = F.concat_ws(" ", F.lit("day delivered twice:"), *[F.col(c).cast("string") for c in (*ITEM, "date")])
    # On the date itself, which every reader uses: the check can't be pruned away.
    return daily.select(
        *ITEM,
        F.when(next_date == F.col("date"), F.raise_error(twice).cast("date")).otherwise(F.col("date")).alias("date"),
        next_date.alias("next_date"),
        "quantity",
        "cost",
        F.last(positive, ignorenulls=True).over(so_far).alias("positive_cost"),
    )


def last_positive_cost(daily: DataFrame) -> DataFrame:
    """The cost of each row if positive, else the last positive cost before it; NULL before the first."""
    return stock_validity(daily).select(*ITEM, "date", "cost", "positive_cost")


def _bounded(rows: DataFrame, first: Column, last: Column) -> DataFrame:
    return rows.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")


def _expand(bounded: DataFrame) -> DataFrame:
    """Give each row its own months.  A narrow map: no join against the calendar, no shuffle."""
    return bounded.withColumn("month", F.explode(_months(F.col("_first"), F.col("_last")))).drop("_first", "_last")


def position_before_month(validity: DataFrame, start: date, as_of: date) -> DataFrame:
    """For each month, the row in force at the start of its first day: date < month <= next_date.

    The months of a row run from the month after its date to the month of its next date.
    """
    calendar_first, calendar_last = month_of(F.lit(start)), month_of(F.lit(as_of))
    bounded = _bounded(
        validity,
        F.greatest(F.add_months(F.trunc("date", "MM"), 1), calendar_first),
        F.least(F.trunc("next_date", "MM"), calendar_last),
    )
    months = _expand(bounded)
    return months.select(
        *ITEM_MONTH, F.col("date").alias("position_date"), "quantity", "cost", "positive_cost"
    )


def closing_stock(validity: DataFrame, start: date, as_of: date) -> DataFrame:
    """For each month, the row in force at the end of its last day (``as_of`` in the current month).

    A row closes the months from its own to the one before its next date.  Rows after ``as_of`` do not exist
    yet, so a next date after ``as_of`` counts as none and the row closes the current month.
    """
    months = _expand(_closing_spans(validity, start, as_of))
    return months.select(
        *ITEM_MONTH, F.col("date").alias("position_date"), "quantity", "cost", "positive_cost"
    )


def _closing_spans(validity: DataFrame, start: date, as_of: date) -> DataFrame:
    """The rows with the months they close, from ``_first`` to ``_last``."""
    calendar_first, calendar_last = month_of(F.lit(start)), month_of(F.lit(as_of))
    return _bounded(
        validity.where(F.col("date") <= F.lit(as_of)),
        F.greatest(F.trunc("date", "MM"), calendar_first),
        F.least(
            F.when(F.col("next_date") <= F.lit(as_of), F.add_months(F.trunc("next_date", "MM"), -1)), calendar_last
        ),
    )


def first_inventory_of_month(inventory: DataFrame, start: date, last_day: int = 5) -> DataFrame:
    """First processed inventory of the item in days 1..5 of the month, counted or zeroing the uncounted."""
    usable = inventory.where(
        F.col("processed")
        & (F.dayofmonth("reference_date") <= last_day)
        & (F.col("counted") | F.col("zeroes_uncounted"))
        & (F.col("reference_date") >= F.lit(start))
    ).select(
        F.trunc("reference_date", "MM").alias("month"),
        *ITEM,
        "inventory_id",
        "reference_date",
        zero(F.col("counted_quantity"), QUANTITY).alias("counted_quantity"),
    )
    order = [F.col("reference_date").asc_nulls_last(), F.col("inventory_id").asc_nulls_last()]
    return dedup_latest(usable, ITEM_MONTH, order)


def asof_cost(probes: DataFrame, probe_date: str, validity: DataFrame, probes_unique: bool = False) -> DataFrame:
    """Add the cost in force on a date per (branch, product); a zero cost becomes the last positive one.

    Probes without any earlier stock row stay, with NULL cost.
    """
    found = asof_last(probes, probe_date, validity, "date", ITEM, ["cost", "positive_cost"], probes_unique)
    return found.withColumn("asof_cost", _effective_cost())


def _effective_cost() -> Column:
    return F.coalesce(F.when(F.col("cost") != 0, F.col("cost")), F.col("positive_cost"))


def opening_sides(
    inventory: DataFrame,
    validity: DataFrame,
    start: date,
    as_of: date,
    last_day: int = 5,
    deal: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Early inventories and positions before the month, stacked: at most one row of each per item and month.

    ``deal`` shuffles the inventories as the validity lies, if that is laid out.  Whoever groups the stack by item and month (``opening_stock``, or the item base together with its other facts)
    then reads the opening off with ``opening_columns``.
    """
    counted = asof_cost(
        deal(first_inventory_of_month(inventory, start, last_day)), "reference_date", validity, probes_unique=True
    ).select(
        *ITEM_MONTH,
        F.lit(True).alias("won"),
        "inventory_id",
        "reference_date",
        "counted_quantity",
        F.col("cost").alias("counted_cost"),
        F.col("positive_cost").alias("counted_positive"),
    )
    before = position_before_month(validity, start, as_of).withColumnsRenamed(
        {"quantity": "position_quantity", "cost": "position_cost", "positive_cost": "position_positive"}
    )
    return before.unionByName(counted, allowMissingColumns=True)


def opening_columns() -> dict[str, Column]:
    """The opening stock in terms of a grouped stack of ``opening_sides``.

    The cost comes from the side that won, even when it is NULL there.  Each side's cost already is the one in force on
    its stock date, so ``effective_cost`` needs no second as-of join.
    """
    won = F.col("won").isNotNull()
    cost = F.when(won, F.col("counted_cost")).otherwise(F.col("position_cost"))
    positive = F.when(won, F.col("counted_positive")).otherwise(F.col("position_positive"))
    return {
        "origin": F.when(won, "inventory").when(F.col("position_date").isNotNull(), "position"),
        "stock_date": F.when(won, F.col("reference_date")).when(F.col("position_date").isNotNull(), F.date_sub("month", 1)),
        "quantity": F.coalesce("counted_quantity", "position_quantity"),
        "cost": cost,
        "positive_cost": positive,
        "effective_cost": F.coalesce(F.when(cost != 0, cost), positive),
    }


def opening_spans(counted: DataFrame, validity: DataFrame, start: date, as_of: date, values: Sequence[str]) -> DataFrame:
    """The months that positions open, as spans: what is in force before months ``first`` to ``last``, in ``position`` (date
    and ``values``), an early inventory (``counted``, at most one per item and month) taking its month out of them.

    Each inventory stands among its item's positions, on the day before its month, and ends the span it falls into; its row
    has it in ``counted``, the position it replaces, and the span after it.  One running pass over the days of an item, so
    what meets here are positions and inventories, not a row per item and month.
    """
    calendar_first, calendar_last = month_of(F.lit(start)), month_of(F.lit(as_of))
    after = F.add_months(F.trunc("date", "MM"), 1)
    stacked = validity.select(
        *ITEM, F.col("date").alias("_at"), F.lit(0).alias("_side"), after.alias("_first"),
        F.trunc("date", "MM").alias("_until"), F.struct("date", *values).alias("position"),
    ).unionByName(
        counted.select(
            *ITEM, F.date_sub("month", 1).alias("_at"), F.lit(1).alias("_side"), F.add_months("month", 1).alias("_first"),
            F.add_months("month", -1).alias("_until"), F.struct(*[c for c in counted.columns if c not in ITEM]).alias("counted"),
        ),
        allowMissingColumns=True,
    )
    days = Window.partitionBy(*ITEM).orderBy("_at", "_side")
    so_far = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = stacked.select(
        *ITEM,
        "counted",
        F.last("position", ignorenulls=True).over(so_far).alias("position"),
        F.greatest("_first", calendar_first).alias("_first"),
        F.least(F.lead("_until").over(days), calendar_last).alias("_last"),
    )
    open_ = F.col("position").isNotNull() & (F.col("_first") <= F.col("_last"))
    return spans.select(
        *ITEM, "counted", "position", F.when(open_, F.col("_first")).alias("first"), F.when(open_, F.col("_last")).alias("last")
    )


def opening_stock(
    inventory: DataFrame,
    validity: DataFrame,
    start: date,
    as_of: date,
    last_day: int = 5,
    deal: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Opening stock per month: the early inventory if there is one, else the position before the month.

    Which of the two counts is settled on the spans of months (``opening_spans``), so the rows per item and month are written
    out as they are expanded: no join, grouping or sort of those.
    """
    first = deal(first_inventory_of_month(inventory, start, last_day))
    counted = asof_cost(first, "reference_date", validity, probes_unique=True).drop("asof_cost")
    spans = opening_spans(counted, validity, start, as_of, ["quantity", "cost", "positive_cost"])
    none = F.array().cast("array<date>")
    own = F.when(F.col("counted").isNotNull(), F.array("counted.month")).otherwise(none)
    rest = F.when(F.col("first").isNotNull(), _months(F.col("first"), F.col("last"))).otherwise(none)
    months = spans.withColumn("month", F.explode(F.concat(own, rest)))
    won = F.coalesce(F.col("month") == F.col("counted.month"), F.lit(False))
    held = F.col("month") <= month_of(F.lit(as_of))
    sides = months.select(
        *ITEM_MONTH,
        F.when(won, True).alias("won"),
        *[F.when(won, F.col(f"counted.{c}")).alias(c) for c in ("inventory_id", "reference_date", "counted_quantity")],
        F.when(won, F.col("counted.cost")).alias("counted_cost"),
        F.when(won, F.col("counted.positive_cost")).alias("counted_positive"),
        F.when(held, F.col("position.date")).alias("position_date"),
        F.when(held, F.col("position.quantity")).alias("position_quantity"),
        F.when(held, F.col("position.cost")).alias("position_cost"),
        F.when(held, F.col("position.positive_cost")).alias("position_positive"),
    )
    return sides.select(
        *ITEM_MONTH,
        *[c.alias(name) for name, c in opening_columns().items()],
        "inventory_id",
        "position_quantity",
        "position_date",
    )


def stocked_spans(
    inventory: DataFrame,
    validity: DataFrame,
    start: date,
    as_of: date,
    last_day: int = 5,
    deal: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """(branch, product) with an opening or closing stock other than zero in the months ``first`` to ``last``; spans may
    overlap.  Costs play no part, so no as-of join for them."""
    counted = deal(first_inventory_of_month(inventory, start, last_day)).select(*ITEM_MONTH, "counted_quantity")
    spans = opening_spans(counted, validity, start, as_of, ["quantity"])
    own = F.struct(F.col("counted.month").alias("first"), F.col("counted.month").alias("last"))
    opened = F.array(
        F.when(F.col("counted.counted_quantity") != 0, own),
        F.when((F.col("position.quantity") != 0) & F.col("first").isNotNull(), F.struct("first", "last")),
    )
    opening = spans.select(*ITEM, F.explode(opened).alias("span")).where(F.col("span").isNotNull())
    closing = _closing_spans(validity.where(F.col("quantity") != 0), start, as_of)
    return opening.select(*ITEM, "span.first", "span.last").union(closing.select(*ITEM, "_first", "_last"))


def reference_branch_cost(validity: DataFrame, branch_id: int, start: date, as_of: date) -> DataFrame:
    """Cost of one branch per month and product, at the day before the month and at its end.

    The branch filter sits on a window key, so it reaches the scan below the validity window.
    """
    own = validity.where(F.col("branch_id") == branch_id)
    at_start = position_before_month(own, start, as_of).select(
        "month", "product_code", F.col("positive_cost").alias("start_cost")
    )
    at_end = closing_stock(own, start, as_of).select(
        "month", "product_code", F.col("positive_cost").alias("end_cost")
    )
    return (
        at_start.unionByName(at_end, allowMissingColumns=True)
        .groupBy("month", "product_code")
        .agg(F.max("start_cost").alias("start_cost"), F.max("end_cost").alias("end_cost"))
    )
