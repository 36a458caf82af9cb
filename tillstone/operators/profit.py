"""Monthly profitability per branch and product, up to the measures the margin mart starts from."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.columns import MONEY, QUANTITY, month_of, zero
from tillstone.operators.stock import ITEM_MONTH, opening_columns

EXTENDED = "decimal(24,4)"
DEFAULT_SIMPLES_RATE = 0.04


def product_reclass(products: DataFrame, rules: DataFrame, sections: DataFrame) -> DataFrame:
    """Move products between departments by rule; a rule naming the section beats a rule for the department.

    The rules are resolved first into one target per (department, section) and one per department, so the
    products see two equi-joins with unique right sides instead of an OR condition and a ranking of products.
    A moved product keeps its old department as its section.
    """
    named = rules.join(
        sections.select(
            F.col("section_id").alias("source_section_id"),
            F.col("section").alias("rule_section"),
            F.col("department").alias("rule_department"),
        ),
        "source_section_id",
    ).where("rule_department = source_department")
    by_section = named.groupBy(F.col("source_department").alias("department"), F.col("rule_section").alias("section")).agg(
        F.min_by("target_department", "source_section_id").alias("section_target")
    )
    by_department = (
        rules.where(F.col("source_section_id").isNull())
        .groupBy(F.col("source_department").alias("department"))
        .agg(F.min("target_department").alias("department_target"))
    )
    target = F.coalesce("section_target", "department_target")
    rest = [c for c in products.columns if c not in ("department", "section", "origin")]
    return (
        products.where(F.col("origin") == "current")
        .join(by_section, ["department", "section"], "left")
        .join(by_department, "department", "left")
        .select(
            *rest,
            F.coalesce(target, F.col("department")).alias("department"),
            F.when(target.isNotNull(), F.col("department")).otherwise(F.col("section")).alias("section"),
            F.col("department").alias("original_department"),
        )
    )


def _row_tax() -> Column:
    """Taxes of one row, rounded to cents before any sum."""
    parts = [zero(F.col(c), QUANTITY) for c in ("icms", "pis", "cofins", "fcp")]
    return F.round(reduce(lambda a, b: a + b, parts), 2).cast(MONEY)


def _total(c: Column) -> Column:
    """Sum back in 18 digits, which Spark keeps in a machine word.  Overflow raises; it does not wrap."""
    return F.sum(c).cast(QUANTITY)


def sales_by_month(sales: DataFrame, start: date, intercompany_document: str) -> DataFrame:
    """Quantity, gross and net per item and month, intercompany sales apart, plus discount and tax.

    NULL in any of the three validity flags drops the row.
    """
    discount = zero(F.col("item_discount"), QUANTITY) + zero(F.col("payment_discount"), QUANTITY)
    valid = sales.where(
        ~F.col("sale_cancelled")
        & ~F.col("item_cancelled")
        & (F.col("invoice_status") == 1)
        & (F.col("issued_at") >= F.lit(start))
    ).select(
        month_of(F.col("issued_at")).alias("month"),
        "branch_id",
        "product_code",
        "quantity",
        F.col("total").alias("gross"),
        (F.col("total") - discount).alias("net"),
        discount.alias("discount"),
        _row_tax().alias("tax"),
        (F.coalesce(F.col("customer_document").cast("string"), F.lit("")) == intercompany_document).alias("internal"),
    )

    def part(value: str, internal: bool, name: str) -> Column:
        chosen = F.col("internal") if internal else ~F.col("internal")
        return _total(F.when(chosen, F.col(value))).alias(name)

    return valid.groupBy(*ITEM_MONTH).agg(
        part("quantity", True, "internal_quantity"),
        part("gross", True, "internal_gross"),
        part("net", True, "internal_net"),
        part("quantity", False, "sold_quantity"),
        part("gross", False, "sold_gross"),
        part("net", False, "sold_net"),
        _total(F.col("discount")).alias("sales_discount"),
        _total(F.col("tax")).alias("sales_tax"),
    )


def purchases_by_month(purchases: DataFrame, start: date, final_status: int = 3) -> DataFrame:
    return (
        purchases.where((F.col("invoice_status") == final_status) & (F.col("issued_at") >= F.lit(start)))
        .groupBy(month_of(F.col("issued_at")).alias("month"), "branch_id", "product_code")
        .agg(
            _total((F.col("quantity") * F.col("units_per_box")).cast(EXTENDED)).alias("bought_quantity"),
            F.sum("total").alias("bought_value"),
            _total(_row_tax()).alias("purchase_tax"),
        )
    )


def transformations_by_month(transformations: DataFrame, start: date) -> DataFrame:
    return (
        transformations.where(F.col("transformed_at") >= F.lit(start))
        .groupBy(
            month_of(F.col("transformed_at")).alias("month"), "branch_id", F.col("target_product").alias("product_code")
        )
        .agg(_total(F.col("target_quantity")).alias("transformed_quantity"))
    )


def breakage_by_month(daily: DataFrame, start: date) -> DataFrame:
    return (
        daily.where(F.col("date") >= F.lit(start))
        .groupBy(month_of(F.col("date")).alias("month"), "branch_id", "product_code")
        .agg(
            _total(F.col("breakage_quantity")).alias("breakage_quantity"),
            _total(F.col("breakage_value")).alias("breakage_value"),
        )
    )


def active_keys(
    facts: Sequence[DataFrame], stocked: DataFrame, deal: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """(month, branch, product) seen in any fact, or in a stock with a quantity other than zero (``stocked_spans``).

    An item's months meet as spans and are expanded once per item, each month once: an item has at most as many as the calendar.
    ``deal`` shuffles the facts as the stock lies, if that is laid out by product.
    """
    item = ["branch_id", "product_code"]
    seen = [f.select(*item, F.col("month").alias("first"), F.col("month").alias("last")) for f in facts]
    spans = deal(reduce(DataFrame.union, seen)).union(stocked)
    listed = F.collect_set(F.struct("first", "last")).alias("spans")
    months = F.transform(
        "spans",
        lambda s: F.when(s["first"] < s["last"], F.sequence(s["first"], s["last"], F.expr("interval 1 month"))).otherwise(F.array(s["first"])),
    )
    return (
        spans.groupBy(*item)
        .agg(listed)
        .select(F.explode(F.array_distinct(F.flatten(months))).alias("month"), *item)
    )


def stock_facts(openings: DataFrame, closing: DataFrame) -> DataFrame:
    """Both sides of the opening stock (``opening_sides``) and the closing stock, stacked for ``item_facts``."""
    sides = [c for c in openings.columns if c not in ITEM_MONTH]
    return openings.select(*ITEM_MONTH, *sides, F.lit(False).alias("moved")).unionByName(
        closing.select(
            *ITEM_MONTH,
            F.col("quantity").alias("closing_quantity"),
            F.col("cost").alias("closing_stock_cost"),
            F.col("positive_cost").alias("closing_positive"),
            F.col("position_date").alias("closing_date"),
            (F.col("quantity") != 0).alias("moved"),
        ),
        allowMissingColumns=True,
    )


def by_item_month(stacked: DataFrame) -> DataFrame:
    """The facts stacked for an item and month side by side.  Each is there once, so the greatest value is the only one; the
    buffers have a fixed width, so it stays a hash aggregate."""
    carried = [c for c in stacked.columns if c not in (*ITEM_MONTH, "moved")]
    return stacked.groupBy(*ITEM_MONTH).agg(F.bool_or("moved").alias("moved"), *[F.max(c).alias(c) for c in carried])


def item_facts(flows: Sequence[DataFrame], stock: DataFrame, deal: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """One row per (month, branch, product) that any fact or stock knows, with all of them side by side.

    ``flows`` are the monthly sales, purchases, transformations and breakage, ``stock`` is what ``stock_facts`` stacks: which side
    of the opening counts is settled in the same grouping as everything else, so the stock is not shuffled for that
    first.  Instead of a distinct key set and six joins, all are stacked and grouped once.  ``moved`` says whether a
    flow, or a closing stock other than zero, makes the key one of the month's.

    Over a validity laid out by product neither stock is shuffled: ``deal`` shuffles the flows as it lies, and the
    grouping runs on that.  A product holds at most six rows per month and branch.
    """
    stacked = [deal(f).withColumn("moved", F.lit(True)) for f in flows]
    return by_item_month(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*stacked, stock]))


def reference_cost_of(facts: DataFrame, branch_id: int) -> DataFrame:
    """Cost of one branch per month and product (C9), read off the facts of its items."""
    return facts.where(F.col("branch_id") == branch_id).select(
        "month", "product_code", F.col("position_positive").alias("start_cost"), F.col("closing_positive").alias("end_cost")
    )


def item_base(
    products: DataFrame,
    prices: DataFrame,
    butcher_cost: DataFrame,
    reference_cost: DataFrame,
    facts: DataFrame,
    butcher_department: str,
) -> DataFrame:
    """One row per active (month, branch, product) with every fact, zeros where a fact is missing.

    A fact activates its key always, a stock row only with a quantity other than zero.  Attributes of the products come
    last, onto narrow rows.  What is joined are few rows a product: they are hashed, and the items by month, which are many
    times as many, are not sorted for any of the joins.
    """
    opening = opening_columns()
    known = facts.withColumns(
        {
            "opening_quantity": opening["quantity"],
            "opening_stock_cost": opening["effective_cost"],
            "opening_date": opening["stock_date"],
            "opening_counted": opening["origin"] == "inventory",
            "closing_best": F.coalesce(F.when(F.col("closing_stock_cost") != 0, F.col("closing_stock_cost")), "closing_positive"),
        }
    ).where(F.col("moved") | (F.coalesce("opening_quantity", F.lit(0)) != 0))
    butcher = butcher_cost.where(F.col("unit_cost") > 0).select(
        F.make_date("year", "month_number", F.lit(1)).alias("month"),
        F.col("product_code").cast("bigint").alias("product_code"),
        F.col("unit_cost").alias("butcher_cost"),
    )
    joined = (
        known.join(reference_cost.hint("shuffle_hash"), ["month", "product_code"], "left")
        .join(butcher.hint("shuffle_hash"), ["month", "product_code"], "left")
        .join(products.hint("shuffle_hash"), "product_code", "left")
        .join(
            prices.select("branch_id", "product_code", "entry_tax", "exit_tax", "sale_price").hint("shuffle_hash"),
            ["branch_id", "product_code"],
            "left",
        )
    )

    def cost(own: str, reference: str) -> Column:
        special = F.when(F.col("department") == butcher_department, F.col("butcher_cost"))
        return F.coalesce(
            special, F.when(F.col(own) != 0, F.col(own)), F.col(reference), F.lit(0).cast(QUANTITY)
        ).cast(QUANTITY)

    attributes = [c for c in products.columns if c != "product_code"]
    amounts = [
        "bought_quantity", "bought_value", "purchase_tax",
        "internal_quantity", "internal_gross", "internal_net",
        "sold_quantity", "sold_gross", "sold_net",
        "sales_discount", "sales_tax",
        "transformed_quantity", "breakage_quantity", "breakage_value",
    ]
    return joined.select(
        *ITEM_MONTH,
        *attributes,
        "entry_tax",
        "exit_tax",
        "sale_price",
        zero(F.col("opening_quantity"), QUANTITY).alias("opening_quantity"),
        cost("opening_stock_cost", "start_cost").alias("opening_cost"),
        F.coalesce("opening_date", "month").alias("opening_date"),
        F.when(F.col("opening_counted"), "inventory")
        .when(~F.col("opening_counted"), "position")
        .alias("opening_origin"),
        zero(F.col("closing_quantity"), QUANTITY).alias("closing_quantity"),
        cost("closing_best", "end_cost").alias("closing_cost"),
        "closing_date",
        *[zero(F.col(a), "int").alias(a) for a in amounts],
    )


def simples_rate(
    calendar: DataFrame,
    allocations: DataFrame,
    sales: DataFrame,
    company_tax_id: str,
    tax_account: str,
    branch_id: int,
    default: float = DEFAULT_SIMPLES_RATE,
) -> DataFrame:
    """Tax rate per month: one account's allocations of the competence over the branch's external sales.

    ``sales`` are the monthly sales (C11); every sale key is an active key, so summing them gives the same as
    summing the item base, without building it.  No allocation, or no or zero sales, gives the default.
    """
    tax = (
        allocations.where(
            (F.col("company_tax_id") == company_tax_id) & (F.upper("account_plan") == tax_account.upper())
        )
        .groupBy("competence")
        .agg(F.sum("value").alias("tax"))
    )
    sold = sales.where(F.col("branch_id") == branch_id).groupBy("month").agg(F.sum("sold_net").alias("sold"))
    rate = F.col("tax").cast("double") / F.when(F.col("sold") != 0, F.col("sold").cast("double"))
    return (
        calendar.select("month", F.date_format("month", "yyyy-MM").alias("competence"))
        .join(tax, "competence", "left")
        .join(sold, "month", "left")
        .select("month", F.coalesce(rate, F.lit(default)).alias("rate"))
    )


def item_measures(base: DataFrame, rates: DataFrame, own_tax_branch: int, simples_branch: int) -> DataFrame:
    """Derived measures.  The inner join with the rates drops months outside the calendar.

    COGS and restated breakage use the closing cost.  Sales tax: the branch's own for one branch, external
    sales × rate for the other, 0 elsewhere.
    """
    sold_quantity = (F.col("internal_quantity") + F.col("sold_quantity")).cast(QUANTITY)
    sold_value = (F.col("internal_net") + F.col("sold_net")).cast(QUANTITY)
    in_branch = F.col("branch_id")
    return base.join(rates, "month").select(
        *base.columns,
        (F.col("opening_quantity") + F.col("bought_quantity")).alias("stock_and_purchases_quantity"),
        (F.col("opening_quantity") * F.col("opening_cost") + F.col("bought_value")).alias("stock_and_purchases_value"),
        sold_quantity.alias("total_sold_quantity"),
        sold_value.alias("total_sales"),
        (sold_quantity * F.col("closing_cost")).alias("cogs"),
        F.when(in_branch == own_tax_branch, F.col("sales_tax").cast("double"))
        .when(in_branch == simples_branch, F.col("sold_net").cast("double") * F.col("rate"))
        .otherwise(F.lit(0.0))
        .alias("sales_tax_due"),
        F.when(in_branch == own_tax_branch, F.col("purchase_tax"))
        .otherwise(F.lit(0).cast(MONEY))
        .alias("purchase_tax_credit"),
        (F.col("breakage_quantity") * F.col("closing_cost")).alias("restated_breakage"),
    )
