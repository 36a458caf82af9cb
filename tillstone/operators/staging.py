"""Staging: rename, cast and join source tables into the shapes the analytical operators read.

Joins carry no broadcast hints.  Dimensions under the broadcast threshold are broadcast by their measured size;
larger ones are shuffled and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.functions.columns import QUANTITY, blank_to_null, flag_is, tax_id_mask, zero
from tillstone.functions.relational import dedup_latest


def stg_branch(branches: DataFrame) -> DataFrame:
    """Branches with the company tax id written the way the finance system writes it."""
    return branches.select(
        F.col("branch_code").cast("int").alias("branch_id"),
        F.col("trade_name").alias("branch_name"),
        "legal_name",
        "tax_id",
        tax_id_mask(F.col("tax_id")).alias("tax_id_formatted"),
    )


def stg_sales_item(
    items: DataFrame,
    receipts: DataFrame,
    branches: DataFrame,
    consumer_invoices: DataFrame,
    company_invoices: DataFrame,
) -> DataFrame:
    """Receipt items with their receipt, branch and whichever invoice exists.  Cancelled rows stay."""
    r, n, c = receipts.alias("r"), consumer_invoices.alias("n"), company_invoices.alias("c")
    header = (
        r.join(branches.alias("b"), "branch_code")
        .join(n, F.col("n.receipt_id") == F.col("r.receipt_id"), "left")
        .join(c, F.col("c.receipt_id") == F.col("r.receipt_id"), "left")
        .select(
            F.col("r.receipt_id").alias("sale_id"),
            F.col("branch_code").cast("int").alias("branch_id"),
            F.col("b.trade_name").alias("branch_name"),
            F.col("r.sequence_text").alias("sequence_text"),
            flag_is(F.col("r.cancelled"), 1).alias("sale_cancelled"),
            F.col("r.issued_at").alias("issued_at"),
            F.coalesce("r.person_document", "r.company_document").alias("customer_document"),
            F.coalesce("n.invoice_number", "c.invoice_number").alias("invoice_number"),
            F.coalesce("n.invoice_series", "c.invoice_series").alias("invoice_series"),
            F.coalesce("n.access_key", "c.access_key").alias("access_key"),
            F.coalesce(F.col("n.cancelled_flag").cast("int"), F.lit(1)).alias("invoice_status"),
            F.col("n.cancel_reason").alias("cancel_reason"),
            F.when(F.col("n.access_key").isNotNull(), "NFCe")
            .when(F.col("c.access_key").isNotNull(), "NFe")
            .otherwise("N/A")
            .alias("invoice_type"),
        )
    )
    lines = items.select(
        F.col("item_id").alias("id"),
        F.col("receipt_id").alias("sale_id"),
        "registered_at",
        F.col("sequence").cast("int").alias("item"),
        F.col("product_code").cast("bigint").alias("product_code"),
        flag_is(F.col("cancelled"), 1).alias("item_cancelled"),
        "quantity",
        "unit_price",
        "item_discount",
        "payment_discount",
        "item_surcharge",
        "payment_surcharge",
        "total",
        "icms",
        "fcp",
        "pis",
        "cofins",
    )
    return lines.join(header, "sale_id")


def stg_purchase_item(
    lines: DataFrame,
    headers: DataFrame,
    branches: DataFrame,
    suppliers: DataFrame,
    operations: DataFrame,
    tax_codes: DataFrame,
    orders: DataFrame,
) -> DataFrame:
    """Purchase invoice lines with header and dimensions; the order is optional."""
    key = ["branch_code", "supplier_code", "document", "series"]
    header = (
        headers.join(branches.select("branch_code", F.col("trade_name").alias("branch_name")), "branch_code")
        .join(suppliers.select("supplier_code", "supplier_name"), "supplier_code")
        .join(operations.select("operation_code", "operation_name"), "operation_code")
        .join(orders.select("order_number", F.lit(True).alias("_ordered")), "order_number", "left")
        .withColumn("order_number", F.when(F.col("_ordered"), F.col("order_number")).cast("int"))
    )
    gross = F.col("boxes").cast(QUANTITY) * F.col("units_per_box").cast("decimal(9,2)") * F.col("box_price")
    return (
        lines.join(header, key)
        .join(tax_codes.select("tax_code", "substituted"), "tax_code")
        .select(
            F.col("line_id").alias("id"),
            F.col("branch_code").cast("int").alias("branch_id"),
            "branch_name",
            F.col("order_number"),
            F.col("operation_code").cast("int").alias("operation_id"),
            "operation_name",
            F.col("supplier_code").alias("supplier_document"),
            "supplier_name",
            "access_key",
            F.col("document").cast("int").alias("invoice_number"),
            F.col("series").alias("invoice_series"),
            "issued_at",
            "entered_at",
            F.col("sequence").cast("int").alias("item"),
            F.col("product_code").cast("bigint").alias("product_code"),
            F.col("boxes").cast(QUANTITY).alias("quantity"),
            F.col("units_per_box").cast(QUANTITY).alias("units_per_box"),
            F.col("box_price").cast(QUANTITY).alias("unit_price"),
            F.col("discount").cast(QUANTITY).alias("discount"),
            F.col("calculated_discount").cast(QUANTITY).alias("calculated_discount"),
            (gross - (zero(F.col("discount"), QUANTITY) + F.col("calculated_discount")))
            .cast("decimal(24,6)")
            .alias("total"),
            F.when(flag_is(F.col("substituted"), 0), F.col("icms").cast(QUANTITY))
            .otherwise(F.lit(0).cast(QUANTITY))
            .alias("icms"),
            F.col("fcp").cast(QUANTITY).alias("fcp"),
            F.col("pis_credit").cast(QUANTITY).alias("pis"),
            F.col("cofins_credit").cast(QUANTITY).alias("cofins"),
            "item_status",
            F.col("invoice_status").cast("int").alias("invoice_status"),
            "changed_at",
        )
    )


def stg_daily_stock(daily: DataFrame) -> DataFrame:
    return daily.select(
        F.col("moved_at").cast("date").alias("date"),
        F.col("branch_code").cast("int").alias("branch_id"),
        F.col("product_code").cast("bigint").alias("product_code"),
        "quantity",
        "cost",
        "breakage_quantity",
        "breakage_value",
    )


def stg_inventory_item(headers: DataFrame, lines: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Last line per (branch, inventory, product) with its header; counted quantity is store + deposit."""
    key = ["branch_code", "inventory", "product_code"]
    order = [F.col("sequence").desc_nulls_first()] + [F.col(c).desc_nulls_last() for c in tie_break]
    last = dedup_latest(lines, key, order)
    counted = F.col("store_quantity").isNotNull() | F.col("deposit_quantity").isNotNull()
    return headers.join(last, ["branch_code", "inventory"]).select(
        F.col("branch_code").cast("int").alias("branch_id"),
        F.col("inventory").cast("int").alias("inventory_id"),
        F.col("updated_at").cast("date").alias("reference_date"),
        "processed_at",
        F.col("processed_at").isNotNull().alias("processed"),
        F.col("selection_kind").cast("int").alias("selection_kind"),
        blank_to_null(F.col("selection_code")).alias("selection_code"),
        (F.coalesce(F.col("zero_uncounted").cast("string"), F.lit("0")) == "1").alias("zeroes_uncounted"),
        F.col("product_code").cast("bigint").alias("product_code"),
        "store_quantity",
        "deposit_quantity",
        F.when(
            counted, zero(F.col("store_quantity"), QUANTITY) + zero(F.col("deposit_quantity"), QUANTITY)
        ).alias("counted_quantity"),
        counted.alias("counted"),
        "cost",
    )


# Movement operations that adjust stock to an inventory count (in, out).
INVENTORY_OPERATIONS = (101, 201)


def stg_stock_movement(movements: DataFrame, adjustments: Sequence[int] = INVENTORY_OPERATIONS) -> DataFrame:
    return movements.select(
        F.col("branch_code").cast("int").alias("branch_id"),
        F.col("product_code").cast("bigint").alias("product_code"),
        "operated_at",
        F.col("operation_code").cast("int").alias("operation_id"),
        F.col("operation_code").isin(*adjustments).alias("inventory_adjustment"),
        "quantity",
        "balance",
        "inventory_quantity",
        "price",
        "cost",
        "cancelled_at",
        "document",
    )


def stg_price(current_stock: DataFrame, products: DataFrame, branches: DataFrame) -> DataFrame:
    return (
        current_stock.join(products.select("product_code", "short_name"), "product_code")
        .join(branches.select("branch_code", "trade_name"), "branch_code")
        .select(
            F.col("branch_code").cast("int").alias("branch_id"),
            F.col("trade_name").alias("branch_name"),
            F.col("product_code").cast("bigint").alias("product_code"),
            F.col("short_name").alias("description"),
            "quantity",
            "cost",
            F.col("price").alias("sale_price"),
            F.col("entry_tax_rate").alias("entry_tax"),
            F.col("exit_tax_rate").alias("exit_tax"),
        )
    )


def stg_transformation(headers: DataFrame, lines: DataFrame) -> DataFrame:
    return headers.join(lines, ["branch_code", "number"]).select(
        F.col("branch_code").cast("int").alias("branch_id"),
        F.col("number").cast("int").alias("transformation_id"),
        "processed_at",
        "transformed_at",
        F.col("product_code").cast("bigint").alias("source_product"),
        F.col("product_quantity").alias("source_quantity"),
        F.col("output_code").cast("bigint").alias("target_product"),
        F.col("output_quantity").alias("target_quantity"),
    )


def stg_butcher_cost(feed: DataFrame) -> DataFrame:
    return feed.select(
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month_number"),
        F.col("scale_code").alias("product_code"),
        F.col("unit_value").alias("unit_cost"),
        F.col("last_cost").alias("last_cost_date"),
    )


# Field names of the finance system's allocation lines.
def _allocation_columns() -> list:
    return [
        F.col("line.Tipo").alias("line_type"),
        F.col("line.Competencia").alias("competence"),
        F.trim("line.CentroDeCusto").alias("cost_centre"),
        F.col("line.PlanoDeContas").alias("account_plan"),
        F.col("line.Valor").alias("value"),
    ]


def stg_title_allocation(titles: DataFrame) -> DataFrame:
    """One row per title installment and allocation line; an absent (or JSON null) array gives no rows."""
    return titles.withColumn("line", F.explode("lines")).select(
        "installment_id",
        "title_id",
        F.col("type").alias("installment_type"),
        "status",
        F.coalesce("cancelled", F.lit(False)).alias("cancelled"),
        "issue_date",
        "due_date",
        "settled_date",
        "company_tax_id",
        F.col("party_name").alias("party"),
        *_allocation_columns(),
    )


def stg_card_allocation(cards: DataFrame) -> DataFrame:
    """One row per card installment and allocation line."""
    return cards.withColumn("line", F.explode("lines")).select(
        "installment_id",
        "card_id",
        F.col("type").alias("installment_type"),
        "status",
        F.coalesce("cancelled", F.lit(False)).alias("cancelled"),
        "sale_date",
        "due_date",
        "settled_date",
        "company_tax_id",
        "acquirer",
        "brand",
        *_allocation_columns(),
    )
