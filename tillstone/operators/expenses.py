"""Expenses from the finance system and their allocation to departments."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.functions.columns import MONEY, QUANTITY, month_of, share, zero

# Installment states that are not an expense, and the marker of income lines.
DROPPED_TITLE_STATUS = ("Baixado", "Renegociados")
DROPPED_CARD_STATUS = "Baixados"
EXPENSE, INCOME = "Despesa", "Receita"

# Expense groups that get a column of their own in the margin mart.
PIVOT_GROUPS = (
    "PESSOAS",
    "ADMINISTRATIVAS",
    "EMBALAGEM",
    "FINANCEIRA",
    "INTERVENIENCIA",
    "MANUTENCAO",
    "MARKETING",
    "OCUPACAO",
)

EXPENSE_KEY = ["month", "branch_id", "expense_group", "account_plan", "department", "party"]


def expenses(
    title_allocations: DataFrame,
    card_allocations: DataFrame,
    plan_groups: DataFrame,
    centre_departments: DataFrame,
    branches: DataFrame,
) -> DataFrame:
    """Title expenses (mapped plans only) and card fees (any plan), with branch and department.

    A NULL status fails both status tests, so such rows drop.  Income lines inside an expense are negative.
    """
    common = ["source", "installment_id", "company_tax_id", "date", "cost_centre", "account_plan", "party", "value"]
    titles = title_allocations.where(
        (F.col("installment_type") == EXPENSE) & ~F.col("status").isin(*DROPPED_TITLE_STATUS)
    ).select(
        F.lit("title").alias("source"),
        "installment_id",
        "company_tax_id",
        F.col("issue_date").alias("date"),
        "cost_centre",
        "account_plan",
        "party",
        F.when(F.col("line_type") == INCOME, -F.col("value")).otherwise(F.col("value")).alias("value"),
    )
    cards = card_allocations.where(
        (F.col("line_type") == EXPENSE) & (F.col("status") != DROPPED_CARD_STATUS)
    ).select(
        F.lit("card").alias("source"),
        "installment_id",
        "company_tax_id",
        F.col("sale_date").alias("date"),
        "cost_centre",
        "account_plan",
        F.concat("acquirer", F.lit(" ["), "brand", F.lit("]")).alias("party"),
        "value",
    )
    groups = plan_groups.select("account_plan", "expense_group")
    booked = (
        titles.join(groups, "account_plan")
        .select(*common, "expense_group")
        .unionByName(cards.join(groups, "account_plan", "left").select(*common, "expense_group"))
    )
    return (
        booked.join(
            branches.select("branch_id", F.col("tax_id_formatted").alias("company_tax_id")), "company_tax_id", "left"
        )
        .join(centre_departments.select("cost_centre", "department"), "cost_centre", "left")
        .select(
            "source",
            "installment_id",
            "branch_id",
            "company_tax_id",
            "date",
            F.year("date").alias("year"),
            F.month("date").alias("month_number"),
            "expense_group",
            "account_plan",
            "party",
            "cost_centre",
            "department",
            F.col("department").isNotNull().alias("direct"),
            zero(F.col("value"), MONEY).cast(MONEY).alias("value"),
        )
    )


def department_sales(measures: DataFrame) -> DataFrame:
    """Sales per month, branch and department: what both the department and the item shares divide by.

    An aggregation combined map-side, so a department holding a third of the items sends one row per task.  It
    reads four columns of the measures; the plan beneath is pruned to them.
    """
    return measures.groupBy("month", "branch_id", "department").agg(F.sum("total_sales").alias("department_sales"))


def department_sales_of(
    sales: DataFrame, present: Sequence[DataFrame], products: DataFrame, start: date, as_of: date, spans: DataFrame | None = None
) -> DataFrame:
    """The same from the monthly sales alone: ``present`` are the (month, branch, product) that have an item, repeats
    allowed, which adds the departments without sales; ``spans`` (branch, product, first, last) those that have one in each of
    these months.  Nothing of the item base is computed for it, and spans get their months only once they are the few
    different ones of a department."""
    key = ["month", "branch_id", "product_code"]
    sold = sales.select(*key, (zero(F.col("internal_net"), "int") + zero(F.col("sold_net"), "int")).cast(QUANTITY).alias("total"))
    none = F.lit(0).cast(sold.schema["total"].dataType)
    departments = products.select("product_code", "department")
    rows = reduce(DataFrame.union, [sold, *[p.select(*key, none.alias("total")) for p in present]])
    rows = rows.join(departments, "product_code", "left").select("month", "branch_id", "department", "total")
    if spans is not None:
        few = spans.join(departments, "product_code", "left").select("branch_id", "department", "first", "last").distinct()
        months = F.explode(F.sequence("first", "last", F.expr("interval 1 month")))
        rows = rows.union(few.select(months.alias("month"), "branch_id", "department", none.alias("total")))
    return (
        rows.where(F.col("month").between(F.lit(start), month_of(F.lit(as_of))))
        .groupBy("month", "branch_id", "department")
        .agg(F.sum("total").alias("department_sales"))
    )


def department_weights(by_department: DataFrame) -> DataFrame:
    """Share of each department in the sales of its branch and month, to 8 places; 0 when the total is not positive."""
    key = ["month", "branch_id"]
    totals = by_department.groupBy(*key).agg(F.sum("department_sales").alias("branch_sales"))
    weight = share(F.col("department_sales"), F.col("branch_sales"))
    return by_department.join(totals, key).select(
        *key, "department", F.round(weight, 8).cast("decimal(18,8)").alias("department_share")
    )


def allocate_expenses(
    booked: DataFrame, weights: DataFrame, start: date, as_of: date, deal: Callable[..., DataFrame] = lambda df, *key: df
) -> DataFrame:
    """Direct expenses pass; indirect ones are spread over all departments of their branch and month.

    Rounding to 4 places happens per expense and department, so amounts are not summed before the spread.
    An indirect expense without a branch, or whose branch and month have no items, finds no weights and is left out.

    The expenses are read once: each brings a list of departments, its own or those of its branch and month, and is given
    them last.  ``deal`` shuffles them by the columns of a key before that, for whoever groups by it and the department.
    """
    key = ["month", "branch_id"]
    kept = [c for c in EXPENSE_KEY if c != "department"]
    dated = booked.withColumn("month", month_of(F.col("date"))).where(
        F.col("month").between(F.lit(start), month_of(F.lit(as_of)))
    )
    shares = weights.groupBy(*key).agg(F.collect_list(F.struct("department", "department_share")).alias("shares"))
    own = F.array(F.struct("department", F.lit(None).cast(weights.schema["department_share"].dataType).alias("department_share")))
    parts = F.when(F.col("direct"), own).when(~F.col("direct"), F.col("shares"))
    rows = deal(dated.select(*kept, "department", "direct", "value"), *kept).join(shares, key, "left")
    spread = F.round(F.col("value") * F.col("part.department_share"), 4)
    return rows.select(*kept, "direct", "value", F.explode(parts).alias("part")).select(
        *kept,
        F.col("part.department").alias("department"),
        F.when(F.col("direct"), F.col("value").cast("decimal(22,4)")).otherwise(spread.cast("decimal(22,4)")).alias("allocated"),
    )


def expense_mart(allocated: DataFrame) -> DataFrame:
    """Allocated expenses per month, branch, group, plan, department and party, with a digest as id.

    The digest skips NULL parts, so two keys that differ only in where the NULL sits collide: the uniqueness
    check on ``id`` guards publication.
    """
    return (
        allocated.groupBy(*EXPENSE_KEY)
        .agg(F.sum("allocated").alias("allocated"))
        .select(
            F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in EXPENSE_KEY])).alias("id"),
            *EXPENSE_KEY,
            F.year("month").alias("year"),
            F.month("month").alias("month_number"),
            "allocated",
        )
    )


def expense_pivot(mart: DataFrame, groups: tuple[str, ...] = PIVOT_GROUPS) -> DataFrame:
    """The fixed expense groups as columns per month, branch and department; other groups are not shown."""
    sums = [F.sum(F.when(F.col("expense_group") == g, F.col("allocated"))).alias(g.lower()) for g in groups]
    return mart.groupBy("month", "branch_id", "department").agg(*sums)
