"""Item margin mart: expenses spread to items by sales weight, and margins in cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.columns import percent, share
from tillstone.operators.expenses import PIVOT_GROUPS

DEPARTMENT_KEY = ["month", "branch_id", "department"]

# The order in which expense groups are taken off the margin, and the name of each step.
CASCADE = (
    ("ocupacao", "margin_occupancy"),
    ("pessoas", "margin_people"),
    ("administrativas", "margin_administrative"),
    ("embalagem", "margin_packaging"),
    ("manutencao", "margin_maintenance"),
    ("marketing", "margin_marketing"),
    ("interveniencia", "margin_intermediation"),
)


def _null_safe(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    """Plain equality on all but the last key column, NULL-safe on the last."""
    on = left[key[-1]].eqNullSafe(right[key[-1]])
    for k in key[:-1]:
        on = on & (left[k] == right[k])
    return on


def item_weight(measures: DataFrame, by_department: DataFrame) -> DataFrame:
    """Share of each item in the sales of its month, branch and department (NULL is a department too).

    The department totals are joined: a window would put every item of a large department into one task.
    """
    i, totals = measures, by_department
    return i.join(totals, _null_safe(i, totals, DEPARTMENT_KEY), "left").select(
        i["*"],
        (F.col("total_sales") - F.col("cogs")).alias("gross_margin"),
        (F.col("sales_tax_due") - F.col("purchase_tax_credit").cast("double")).alias("net_tax"),
        share(F.col("total_sales"), F.col("department_sales")).alias("item_share"),
    )


def allocate_to_items(weighted: DataFrame, pivot: DataFrame) -> DataFrame:
    """Expense columns per item: department expense × item share.  Department is matched NULL-safely."""
    groups = [g.lower() for g in PIVOT_GROUPS]
    on = _null_safe(weighted, pivot, DEPARTMENT_KEY)
    spread = [
        (F.coalesce(pivot[g].cast("double"), F.lit(0.0)) * weighted["item_share"]).alias(f"cost_{g}") for g in groups
    ]
    return weighted.join(pivot, on, "left").select(
        weighted["*"],
        (weighted["gross_margin"].cast("double") - weighted["net_tax"]).alias("margin_after_tax"),
        *spread,
    )


def item_margin(allocated: DataFrame, branches: DataFrame) -> DataFrame:
    """Final mart: identifiers, measures, margin percentages and the margin cascade."""
    total_cost = sum((F.col(f"cost_{g.lower()}") for g in PIVOT_GROUPS[1:]), F.col(f"cost_{PIVOT_GROUPS[0].lower()}"))
    after_breakage = F.col("margin_after_tax") - F.col("restated_breakage").cast("double")
    rows = allocated.withColumn("margin_after_breakage", after_breakage).withColumn("cost_total", total_cost)

    steps, running = [], F.col("margin_after_breakage")
    for group, name in CASCADE:
        running = running - F.col(f"cost_{group}")
        steps.append(running.alias(name))

    sales = F.col("total_sales")
    return (
        rows.join(branches.select("branch_id", "branch_name"), "branch_id", "left")
        .select(
            F.concat_ws(
                "-",
                F.substring(F.col("month").cast("string"), 1, 7),
                F.col("branch_id").cast("string"),
                F.col("product_code").cast("string"),
            ).alias("id"),
            F.year("month").alias("year"),
            F.month("month").alias("month_number"),
            "branch_name",
            *rows.columns,
            percent(F.col("gross_margin"), sales).alias("gross_margin_pct"),
            percent(F.col("margin_after_tax"), sales).alias("margin_after_tax_pct"),
            percent(F.col("margin_after_breakage"), sales).alias("margin_after_breakage_pct"),
            *steps,
            (F.col("margin_after_breakage") - F.col("cost_total")).alias("margin_final"),
        )
    )
