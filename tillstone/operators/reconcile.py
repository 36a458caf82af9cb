"""Served views and reconciliations between the ERP and the finance system."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from datetime import date, timedelta
from decimal import Decimal
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstone.functions.columns import MONEY, digits, document_number, flag_is, unpadded, zero
from tillstone.functions.relational import dedup_latest

EXPENSE, INCOME = "Despesa", "Receita"  # fixed values: title types of the finance system
MERCHANDISE_PLAN = "Compra de Mercadorias"  # fixed value: account plan of goods for resale


def days_before(as_of: date, days: int) -> Column:
    return F.lit(as_of - timedelta(days=days))


# -- served views ----------------------------------------------------------------------------------------------


def _product_names(products: DataFrame, masters: DataFrame, groups: DataFrame, sections: DataFrame) -> DataFrame:
    """Sold product code → description, package, group and section: the dimension chain joined once."""
    return (
        products.select("product_code", "package", "internal_code")
        .join(masters.select("internal_code", "full_name", "group_code"), "internal_code", "left")
        .join(groups.select("group_code", "group_name", "section_code"), "group_code", "left")
        .join(sections.select("section_code", "section_name"), "section_code", "left")
        .select("product_code", F.col("full_name").alias("product"), "package", "group_name", "section_name")
    )


def stock_position(
    current_stock: DataFrame,
    branches: DataFrame,
    products: DataFrame,
    masters: DataFrame,
    groups: DataFrame,
    sections: DataFrame,
) -> DataFrame:
    return (
        current_stock.join(
            branches.select("branch_code", F.col("trade_name").alias("branch_name")), "branch_code", "left"
        )
        .join(_product_names(products, masters, groups, sections), "product_code", "left")
        .select(
            (F.col("branch_code").cast("bigint") * 1_000_000_000 + F.col("product_code")).alias("id"),
            "branch_name",
            "product_code",
            "product",
            "package",
            "group_name",
            "section_name",
            "quantity",
            "average_cost",
            "price",
            "abc_class",
            "last_sale",
            "last_purchase",
        )
    )


def receipt_payments(payments: DataFrame, receipts: DataFrame, branches: DataFrame, forms: DataFrame) -> DataFrame:
    kept = receipts.where(flag_is(F.col("cancelled"), 0)).join(
        branches.select("branch_code", F.col("trade_name").alias("branch_name")), "branch_code", "left"
    )
    return (
        payments.join(kept, "receipt_id")
        .join(forms.select("form_code", "form_name"), "form_code", "left")
        .select(
            F.col("payment_id").alias("id"),
            F.to_date("issued_at").alias("date"),
            "branch_name",
            "terminal",
            "receipt_id",
            "form_code",
            "form_name",
            "amount",
            "change",
            "installments",
        )
    )


def sales_item_current(
    items: DataFrame,
    receipts: DataFrame,
    branches: DataFrame,
    products: DataFrame,
    masters: DataFrame,
    groups: DataFrame,
    sections: DataFrame,
) -> DataFrame:
    """Items of live receipts.  Discounts and surcharges are plain sums: a NULL part makes the net NULL."""
    kept = (
        receipts.where(flag_is(F.col("cancelled"), 0))
        .join(branches.select("branch_code", F.col("trade_name").alias("branch_name")), "branch_code", "left")
        .select("receipt_id", "issued_at", "branch_name", "terminal")
    )
    discount = F.col("item_discount") + F.col("payment_discount")
    surcharge = F.col("item_surcharge") + F.col("payment_surcharge")
    return (
        items.where(flag_is(F.col("cancelled"), 0))
        .join(kept, "receipt_id")
        .join(_product_names(products, masters, groups, sections), "product_code", "left")
        .select(
            F.col("item_id").alias("id"),
            F.to_date("issued_at").alias("date"),
            F.date_format("issued_at", "HH:mm:ss").alias("time"),
            "branch_name",
            "terminal",
            "receipt_id",
            F.col("sequence").alias("item"),
            "product_code",
            "product",
            "package",
            "group_name",
            "section_name",
            "quantity",
            "unit_price",
            discount.alias("discount"),
            surcharge.alias("surcharge"),
            "total",
            (F.col("total") - discount + surcharge).alias("net"),
        )
    )


def sales_item_legacy(
    items: DataFrame,
    receipts: DataFrame,
    branches: DataFrame,
    goods: DataFrame,
    units: DataFrame,
    classes: DataFrame,
) -> DataFrame:
    """Items of the retired ERP that were not reversed; personal documents are not carried."""
    return (
        items.where(~F.col("item_reversed"))
        .join(receipts.where(~F.col("receipt_reversed")), "receipt_id")
        .join(branches.select("branch_key", "branch_name"), "branch_key")
        .join(goods.select("goods_id", "goods_code", F.col("description").alias("goods"), "unit_id"), "goods_id")
        .join(units.select("unit_id", F.col("symbol").alias("unit")), "unit_id", "left")
        .join(classes.select("class_id", "class_code", "class_name"), "class_id", "left")
        .select(
            F.col("item_id").alias("id"),
            "date",
            "time",
            "branch_name",
            "terminal",
            "receipt_number",
            "item",
            "goods_code",
            "goods",
            "unit",
            "class_code",
            "class_name",
            "quantity",
            "unit_price",
            "discount",
            "surcharge",
            "total",
            "receipt_id",
            "goods_id",
        )
    )


def product_catalog(
    products: DataFrame,
    masters: DataFrame,
    groups: DataFrame,
    sections: DataFrame,
    departments: DataFrame,
    subgroups: DataFrame,
    cost_centres: DataFrame,
    units: DataFrame,
    crosswalk: DataFrame,
    loads: DataFrame,
    legacy: DataFrame,
    catalog_table: str = "products",
    no_date: date = date(1900, 1, 1),
) -> DataFrame:
    """Current catalogue plus legacy products that have no valid pair in it (with negative ids).

    Only crosswalk pairs whose current code exists count.  The latest-load time is a scalar.  A
    crosswalk giving two legacy codes to one product fans it out: the key check on ``id`` stops publication.
    """
    pairs = crosswalk.join(products.select("product_code"), "product_code", "left_semi").select(
        "product_code", "legacy_code"
    )
    loaded = loads.where((F.col("table_name") == catalog_table) & F.col("error").isNull()).agg(F.max("ended_at"))
    current = (
        products.join(pairs, "product_code", "left")
        .join(masters, "internal_code", "left")
        .join(groups.select("group_code", "group_name", "section_code"), "group_code", "left")
        .join(sections.select("section_code", "section_name", "department_code"), "section_code", "left")
        .join(departments.select("department_code", "department_name"), "department_code", "left")
        .join(subgroups.select("subgroup_code", "subgroup_name", "margin"), "subgroup_code", "left")
        .join(cost_centres.select("centre_code", "centre_name"), "centre_code", "left")
        .join(units.select("unit_code", "unit_symbol"), "unit_code", "left")
        .withColumn("refreshed_at", loaded.scalar())
        .select(
            F.col("product_code").cast("bigint").alias("id"),
            F.lit("current").alias("origin"),
            F.col("product_code").cast("bigint").alias("product_code"),
            F.col("legacy_code").cast("bigint").alias("legacy_code"),
            F.col("internal_code").cast("int").alias("internal_code"),
            F.col("default_code").cast("bigint").alias("default_code"),
            (F.col("product_code") == F.col("default_code")).alias("is_default"),
            F.col("short_name").alias("description"),
            F.col("full_name").alias("full_description"),
            "package",
            F.col("units_per_package").cast(MONEY).alias("units_per_package"),
            F.col("unit_symbol").alias("unit"),
            F.coalesce("centre_name", "department_name").alias("cost_centre"),
            F.col("centre_name").alias("own_cost_centre"),
            F.col("department_name").alias("department"),
            F.col("section_name").alias("section"),
            "group_name",
            "subgroup_name",
            F.coalesce("margin", F.lit(0)).cast("decimal(18,4)").alias("subgroup_margin"),
            (F.col("scale_flag") == "1").alias("sold_by_scale"),
            (F.col("weight_flag") == "V").alias("variable_weight"),
            F.coalesce(F.col("online_flag") == "1", F.lit(False)).alias("sold_online"),
            (F.col("deactivated_at").isNull() & F.col("deleted_at").isNull()).alias("active"),
            F.to_date("created_at").alias("created_on"),
            F.to_date("deactivated_at").alias("deactivated_on"),
            F.col("changed_at").alias("changed_at"),
            "refreshed_at",
        )
    )
    unpaired = legacy.join(pairs.select("legacy_code").distinct(), "legacy_code", "left_anti")
    retired = unpaired.select(
        (-F.col("legacy_code")).cast("bigint").alias("id"),
        F.lit("legacy").alias("origin"),
        F.col("legacy_code").cast("bigint").alias("legacy_code"),
        F.trim("short_name").alias("description"),
        F.trim("full_name").alias("full_description"),
        F.trim("unit_symbol").alias("unit"),
        F.coalesce(F.trim("centre_name"), F.trim("department_name")).alias("cost_centre"),
        F.trim("centre_name").alias("own_cost_centre"),
        F.trim("department_name").alias("department"),
        F.trim("section_name").alias("section"),
        F.trim("group_name").alias("group_name"),
        F.trim("subgroup_name").alias("subgroup_name"),
        F.coalesce("margin", F.lit(0)).cast("decimal(18,4)").alias("subgroup_margin"),
        F.col("scale_flag").alias("sold_by_scale"),
        F.coalesce(F.col("online_flag") == 1, F.lit(False)).alias("sold_online"),
        F.lit(False).alias("active"),
        F.nullif(F.col("created_on"), F.lit(no_date)).alias("created_on"),
        F.col("changed_at").cast("timestamp_ntz").alias("changed_at"),
    )
    return current.unionByName(retired, allowMissingColumns=True)


# -- slips × titles --------------------------------------------------------------------------------------------


def _nearest_by_value(titles: DataFrame, asked: DataFrame, steps: int, cent: Decimal) -> DataFrame:
    """The nearest title per (value, due date) asked for, titles offered at every value within ``steps`` cents.

    Per value one running pass over the dates finds the last title on or before and the first on or after each date
    asked for.  A value shared by a third of all slips and titles becomes one group of at most two rows per calendar day.
    """
    offered = (
        titles.withColumn("step", F.explode(F.sequence(F.lit(-steps), F.lit(steps))))
        .select((F.col("value") + F.col("step") * F.lit(cent)).cast(MONEY).alias("value"), "due_date", "title")
        .groupBy("value", "due_date")
        .agg(F.min("title").alias("title"))
        .withColumn("title", F.struct("due_date", "title.installment_id", "title.status"))
    )
    timeline = offered.withColumn("asked", F.lit(0)).unionByName(
        asked.withColumn("asked", F.lit(1)), allowMissingColumns=True
    )
    dates = Window.partitionBy("value").orderBy("due_date", "asked")
    dates_down = Window.partitionBy("value").orderBy(F.col("due_date").desc(), "asked")
    seen = (Window.unboundedPreceding, Window.currentRow)
    found = (
        timeline.withColumn("before", F.last("title", ignorenulls=True).over(dates.rowsBetween(*seen)))
        .withColumn("after", F.last("title", ignorenulls=True).over(dates_down.rowsBetween(*seen)))
        .where("asked = 1")
    )
    for side in ("before", "after"):
        days = F.abs(F.datediff("due_date", F.col(f"{side}.due_date")))
        candidate = F.struct(
            days.alias("days"),
            *[F.col(f"{side}.{field}").alias(field) for field in ("installment_id", "status", "due_date")],
        )
        found = found.withColumn(side, F.when(days.isNotNull(), candidate))
    return found.select("value", "due_date", F.least("before", "after").alias("best"))


BAND = 8


def _sweep(rows: pd.DataFrame, width: int) -> pd.DataFrame:
    """One band in the order of its values: the titles within ``width`` cents of the value asked for stand by their day, each
    day with its ids in a heap.  Titles come in as the values rise, and go out when their day is looked at and they are too small."""
    rows = rows.sort_values(["cents", "asked"], kind="stable")
    titles = rows[rows["asked"] == 0]
    coming = list(zip(titles["cents"], titles["day"], titles["installment_id"], titles["status"].where(titles["status"].notna(), None), strict=True))
    days: list[int] = []
    heaps: dict[int, list[tuple]] = {}
    out, at = [], 0

    def first(place: int, step: int, least: int) -> tuple | None:
        """(day, id, status) of the nearest day from a place on that still has a title."""
        while 0 <= place < len(days):
            day = days[place]
            heap = heaps[day]
            while heap and heap[0][1] < least:
                heappop(heap)
            if heap:
                return day, heap[0][0], heap[0][2]
            del days[place], heaps[day]
            place += min(step, 0)
        return None

    wanted = rows[rows["asked"] == 1]
    for cents, day in zip(wanted["cents"], wanted["day"], strict=True):
        while at < len(coming) and coming[at][0] <= cents + width:
            value, due, name, status = coming[at]
            at += 1
            if due not in heaps:
                insort(days, due)
                heaps[due] = []
            heappush(heaps[due], (name, value, status))
        near = [first(bisect_left(days, day) - 1, -1, cents - width), first(bisect_left(days, day), 1, cents - width)]
        best = min(((abs(due - day), name, status, due) for due, name, status in filter(None, near)), key=lambda t: t[:2], default=None)
        if best is not None:
            out.append((cents, day, *best))
    return pd.DataFrame(out, columns=["cents", "day", "days", "installment_id", "status", "due"])


def _in_bands(titles: DataFrame, asked: DataFrame, steps: int, cent: Decimal) -> DataFrame:
    """Both sides by band of values, ``BAND`` times as wide as the tolerance; titles that near the next band stand there too."""
    cents = F.round(F.col("value") / F.lit(cent)).cast("bigint")
    dated = F.col("due_date").isNotNull() & F.col("value").isNotNull()
    placed = titles.where(dated).select(
        cents.alias("cents"), F.unix_date("due_date").alias("day"), F.col("title.installment_id").alias("installment_id"),
        F.col("title.status").alias("status"), F.lit(0).alias("asked"),
    )
    wanted = asked.where(dated).select(cents.alias("cents"), F.unix_date("due_date").alias("day"), F.lit(1).alias("asked"))
    band = lambda at: F.floor((F.col("cents") + at) / (BAND * steps))
    offered = placed.withColumn("band", F.explode(F.sequence(band(-steps), band(steps))))
    return offered.unionByName(wanted.withColumn("band", band(0)), allowMissingColumns=True)


def _nearest_by_band(titles: DataFrame, asked: DataFrame, steps: int, cent: Decimal) -> DataFrame:
    """The same for a wide tolerance: one ordered pass per band of values (``_sweep``).  A band has at most a row per cent and
    calendar day, however often they occur."""
    schema = "cents bigint, day int, days int, installment_id string, status string, due int"
    found = _in_bands(titles, asked, steps, cent).groupBy("band").applyInPandas(lambda rows: _sweep(rows, steps), schema)
    return found.select(
        (F.col("cents") * F.lit(cent)).cast(MONEY).alias("value"),
        F.date_from_unix_date("day").alias("due_date"),
        F.struct("days", "installment_id", "status", F.date_from_unix_date("due").alias("due_date")).alias("best"),
    )


def slip_tolerance_match(
    slips: DataFrame,
    titles: DataFrame,
    tolerance: Decimal = Decimal("0.01"),
    max_days: int = 60,
    cent: Decimal = Decimal("0.01"),
) -> DataFrame:
    """For each slip, the unnumbered income title within the value tolerance whose due date is nearest.

    Equal distances go to the smaller title id.  No pairs are formed: both sides are first reduced to one row per
    (value, due date).  For a tolerance of a cent titles are offered at each value; for wider ones in bands of values.
    """
    steps = int(tolerance / cent)
    unnumbered = (
        titles.where((F.col("type") == INCOME) & F.coalesce(F.col("number") == "", F.lit(True)))
        .groupBy("value", "due_date")
        .agg(F.min(F.struct("installment_id", "status")).alias("title"))
    )
    asking = slips.select(
        "slip_number", F.col("value").cast(MONEY).alias("value"), F.to_date("due_at").alias("due_date")
    )
    asked = asking.select("value", "due_date").distinct()
    nearest = _nearest_by_value if steps <= 1 else _nearest_by_band
    best = nearest(unnumbered, asked, steps, cent).where(F.col("best.days") <= max_days)
    return asking.join(best, ["value", "due_date"]).select(
        "slip_number",
        F.col("best.installment_id").alias("title_installment"),
        F.col("best.due_date").alias("title_due_date"),
        F.col("best.status").alias("title_status"),
        F.col("best.days").alias("days_apart"),
    )


def slip_reconciliation(
    slips: DataFrame,
    titles: DataFrame,
    as_of: date,
    test_limit: Decimal = Decimal("10"),
    tolerance: Decimal = Decimal("0.01"),
    match_days: int = 60,
    read_days: int = 180,
) -> DataFrame:
    """One row per slip with the title of the same number and the outcome of comparing the two."""
    by_number = dedup_latest(
        titles.where((F.col("type") == INCOME) & F.col("number").isNotNull()),
        ["number"],
        [F.col("cancelled").asc_nulls_last(), F.col("seen_at").desc_nulls_first(), F.col("installment_id").asc()],
    ).select(
        "number",
        F.col("status").alias("title_status"),
        F.col("settled_date").alias("title_settled"),
        F.col("value").alias("title_value"),
        F.col("party_name").alias("customer"),
    )
    # One row per number, however many slips carry it: a slip is never multiplied by its namesakes.
    matched = slip_tolerance_match(slips, titles, tolerance, match_days).select("slip_number").distinct()
    near = matched.withColumn("near", F.lit(True))
    joined = (
        slips.join(by_number, F.trim("slip_number") == F.col("number"), "left").join(near, "slip_number", "left")
    )
    cancelled, untitled = F.col("cancelled_at").isNotNull(), F.col("number").isNull()
    due = F.to_date("due_at")
    outcome = (
        F.when(F.col("value") < test_limit, "test slip")
        .when(cancelled & ~untitled & F.col("title_settled").isNull(), "cancelled in ERP, open in finance")
        .when(cancelled, "ok")
        .when(untitled & F.col("near"), "in finance without the slip number")
        .when(untitled & (due >= days_before(as_of, read_days)), "no title in finance")
        .when(untitled, "outside the window read from finance")
        .when(F.abs(F.col("title_value") - F.col("value")) > tolerance, "value differs")
        .when(F.col("title_settled").isNull() & (due < F.lit(as_of)), "overdue and open in finance")
        .otherwise("ok")
    )
    return joined.select(
        F.trim("slip_number").alias("id"),
        "bank_number",
        F.to_date("issued_at").alias("issue_date"),
        due.alias("due_date"),
        "value",
        cancelled.alias("cancelled"),
        "customer",
        "title_status",
        "title_settled",
        "title_value",
        outcome.alias("outcome"),
    )


# -- purchases × titles ----------------------------------------------------------------------------------------


def posting_companies(invoices: DataFrame, branches: DataFrame, as_of: date, posting_days: int = 30) -> DataFrame:
    """Companies (company_digits) with an invoice entered lately: a row per company, so small by nature.

    Settle it before use and the planner knows; from the query alone it would guess the size of all invoices.
    """
    return (
        invoices.where(F.col("entered_at") >= days_before(as_of, posting_days))
        .select("branch_code")
        .distinct()
        .join(branches, "branch_code")
        .select(digits(F.col("tax_id")).alias("company_digits"))
        .distinct()
    )


def _titles_of(expense: DataFrame, wanted: DataFrame, since: date) -> DataFrame:
    """Of expense installments those issued since the month of ``since``, and older ones of the suppliers of either: what can
    make a title of the invoices ``wanted``, or share its number with a title issued since.

    The month of issue is what titles are kept by, so the recent ones open recent partitions alone; of older ones only the
    suppliers asked for go on. An installment without a title's id may belong to any, and goes on too.
    """
    lately = F.coalesce(F.col("issue_month") >= F.trunc(F.lit(since), "MM"), F.lit(False))
    older = expense.where(~lately)
    first = expense.where(lately).unionByName(older.where(F.col("title_id").isNull()))
    suppliers = wanted.select("supplier_digits").union(first.select("supplier_digits")).distinct()
    rest = older.where(F.col("title_id").isNotNull()).join(suppliers, "supplier_digits", "left_semi")
    return first.unionByName(rest.select(expense.columns))


def title_rollup(
    titles: DataFrame,
    invoices: DataFrame,
    branches: DataFrame,
    as_of: date,
    posting_days: int = 30,
    posting: DataFrame | None = None,
    wanted: DataFrame | None = None,
    since: date | None = None,
) -> DataFrame:
    """Expense titles from their installments, then per (supplier, invoice) of the companies that post invoices.

    ``posting``: the settled ``posting_companies``, if there is one.  With ``wanted`` (supplier_digits, invoice) and ``since``,
    only the keys in ``wanted`` and those with a title issued since are sure to be there.  All aggregates combine
    map-side (sorted first, because the largest of texts is no hash aggregate), so the group of titles without an id may be
    arbitrarily large.  Installments of a title agree on its supplier, its number and its day of issue.
    """
    expense = titles.where((F.col("type") == EXPENSE) & ~F.coalesce("cancelled", F.lit(False))).select(
        digits(F.col("party_document")).alias("supplier_digits"), "party_document", "title_id",
        F.coalesce("title_number", "number").alias("number"), "party_name", "company", "company_tax_id", "issue_date", "issue_month", "title_value", "settled_date", "due_date",
        F.coalesce(
            F.exists("lines", lambda line: line["PlanoDeContas"].ilike(f"%{MERCHANDISE_PLAN}%")), F.lit(False)
        ).alias("goods"),
    )
    if wanted is not None:
        expense = _titles_of(expense, wanted, since)
    per_title = (
        expense.groupBy("title_id")
        .agg(
            F.max("party_document").alias("party_document"),
            F.max("number").alias("number"),
            F.max("party_name").alias("supplier"),
            F.max("company").alias("company"),
            F.max("company_tax_id").alias("company_tax_id"),
            F.max("issue_date").alias("issue_date"),
            F.max("title_value").alias("value"),
            F.bool_and(F.col("settled_date").isNotNull()).alias("paid"),
            F.min(F.when(F.col("settled_date").isNull(), F.col("due_date"))).alias("next_due"),
            F.bool_or("goods").alias("merchandise"),
        )
        .select(
            digits(F.col("party_document")).alias("supplier_digits"),
            document_number(F.col("number")).alias("invoice"),
            digits(F.col("company_tax_id")).alias("company_digits"),
            "issue_date", "supplier", "company", "value", "paid", "next_due", "merchandise",
        )
    )
    if posting is None:
        posting = posting_companies(invoices, branches, as_of, posting_days)
    return (
        per_title.where(F.col("invoice") != "")
        .join(posting, "company_digits", "left_semi")
        .groupBy("supplier_digits", "invoice")
        .agg(
            F.max("supplier").alias("supplier"),
            F.max("company").alias("company"),
            F.min("issue_date").alias("issue_date"),
            F.sum("value").alias("value"),
            F.count(F.lit(1)).alias("titles"),
            F.bool_and("paid").alias("paid"),
            F.min("next_due").alias("next_due"),
            F.bool_or("merchandise").alias("merchandise"),
        )
    )


def purchase_reconciliation(
    invoices: DataFrame,
    titles: DataFrame,
    branches: DataFrame,
    as_of: date,
    read_days: int = 120,
    grace_days: int = 3,
    posting_days: int = 30,
    tolerance: Decimal = Decimal("1.00"),
    posting: DataFrame | None = None,
) -> DataFrame:
    """Purchase invoices × payable titles per (supplier, invoice), classified.

    Both sides of the full join are already one row per key, so no key is hot.
    """
    key = ["supplier_digits", "invoice"]
    posted = (
        invoices.where(
            F.col("cancelled_at").isNull()
            & (F.col("entered_at") >= days_before(as_of, read_days))
            & (F.coalesce(F.col("bonus_flag").cast("string"), F.lit("0")) != "1")
        )
        .groupBy(digits(F.col("supplier_code")).alias("supplier_digits"), unpadded(F.col("document")).alias("invoice"))
        .agg(
            F.to_date(F.min("issued_at")).alias("issue_date"),
            F.to_date(F.min("entered_at")).alias("entry_date"),
            F.sum("total").alias("value"),
            F.count(F.lit(1)).alias("invoices"),
        )
    )
    since = as_of - timedelta(days=read_days)
    booked = title_rollup(titles, invoices, branches, as_of, posting_days, posting, posted, since)
    named = titles.where((F.col("type") == EXPENSE) & F.col("party_document").isNotNull()).select(
        digits(F.col("party_document")).alias("supplier_digits"), "party_name", "seen_at", "installment_id"
    )
    # A name is looked up for invoices that only the ERP has, and where titles have none.
    asked = posted.select("supplier_digits").union(named.where(F.col("party_name").isNull()).select("supplier_digits"))
    names = (
        dedup_latest(
            named.join(asked.distinct(), "supplier_digits", "left_semi"),
            ["supplier_digits"],
            [F.col("seen_at").desc_nulls_first(), F.col("installment_id").asc()],
        )
        .select("supplier_digits", F.col("party_name").alias("latest_name"))
    )
    in_erp, in_finance = F.col("l.invoices").isNotNull(), F.col("f.titles").isNotNull()
    grace = days_before(as_of, grace_days)
    erp, finance, titles_found = F.col("l.value"), F.col("f.value"), F.col("f.titles")
    outcome = (
        F.when(~in_erp & (F.col("f.issue_date") > grace), "recent, waiting for ERP")
        .when(~in_erp, "only in finance")
        .when(~in_finance & (F.col("l.entry_date") > grace), "recent, waiting for finance")
        .when(~in_finance, "only in ERP")
        .when((titles_found > 1) & (F.abs(erp * titles_found - finance) <= tolerance), "duplicate title in finance")
        .when(F.abs(erp - finance) > tolerance, "value differs")
        .otherwise("ok")
    )
    recent_goods = F.col("f.merchandise") & (F.col("f.issue_date") >= days_before(as_of, read_days))
    return (
        posted.alias("l").join(booked.alias("f"), key, "full")
        .where(in_erp | recent_goods)
        .join(names, "supplier_digits", "left")
        .select(
            F.concat(F.col("supplier_digits"), F.lit("-"), F.col("invoice")).alias("id"),
            F.coalesce("f.supplier", "latest_name").alias("supplier"),
            F.col("supplier_digits").alias("supplier_document"),
            "invoice",
            F.coalesce("l.issue_date", "f.issue_date").alias("issue_date"),
            F.col("l.entry_date").alias("entry_date"),
            erp.alias("erp_value"),
            finance.alias("finance_value"),
            F.col("f.company").alias("company"),
            titles_found.alias("titles"),
            F.col("f.paid").alias("paid"),
            F.col("f.next_due").alias("next_due"),
            outcome.alias("outcome"),
        )
    )


# -- receipts × cards ------------------------------------------------------------------------------------------

# Payment form codes that go through a card acquirer, and the one that is instant transfer.
CARD_FORMS = (
    4, 5, 6, 900, 901, 903, 905, 906, 907, 908, 909, 910, 911, 912, 913, 914, 915,
    918, 920, 921, 922, 923, 925, 926, 928, 929, 930, 931, 932,
)
TRANSFER_FORM = 904


def card_reconciliation(
    payments: DataFrame,
    receipts: DataFrame,
    branches: DataFrame,
    cards: DataFrame,
    as_of: date,
    card_forms: Sequence[int] = CARD_FORMS,
    transfer_form: int = TRANSFER_FORM,
    read_days: int = 45,
    tolerance: Decimal = Decimal("1.00"),
) -> DataFrame:
    """Receipts taken by card against what the acquirers reported, per day and company."""
    since = days_before(as_of, read_days)
    paid = F.col("amount") - zero(F.col("change"), MONEY)
    tills = (
        payments.join(
            receipts.where(flag_is(F.col("cancelled"), 0) & (F.col("issued_at") >= since)).select(
                "receipt_id", "issued_at", "branch_code"
            ),
            "receipt_id",
        )
        .join(branches.select("branch_code", "trade_name", "tax_id"), "branch_code", "left")
        .groupBy(F.to_date("issued_at").alias("date"), digits(F.col("tax_id")).alias("company"))
        .agg(
            F.max("trade_name").alias("store"),
            F.sum(F.when(F.col("form_code").isin(*card_forms), paid)).alias("card"),
            F.sum(F.when(F.col("form_code") == transfer_form, paid)).alias("transfer"),
            F.lit(True).alias("present"),
        )
        .alias("l")
    )
    # Fixed value: how the modality of an instant transfer is written.
    is_transfer = F.col("modality").ilike("%pix%")
    reported = (
        cards.where(
            (F.col("sale_date") >= since)  # a group key, so cutting before the group-by changes no group that is kept
            & (F.col("sale_month") >= F.trunc(since, "MM"))  # what cards are kept by
            & ~F.coalesce("cancelled", F.lit(False))
            & (F.coalesce("type", F.lit(INCOME)) == INCOME)
        )
        .groupBy(F.col("sale_date").alias("date"), digits(F.col("company_tax_id")).alias("company"))
        .agg(
            F.sum(F.when(~is_transfer, F.col("gross_value"))).alias("card"),
            F.sum(F.when(is_transfer, F.col("gross_value"))).alias("transfer"),
            F.sum("fee").alias("fees"),
            F.count_distinct("card_id").alias("sales"),
            F.count(F.when(~F.coalesce("reconciled", F.lit(False)), 1)).alias("unreconciled"),
            F.lit(True).alias("present"),
        )
        .alias("f")
    )
    till, acquirer = zero(F.col("l.card"), MONEY), zero(F.col("f.card"), MONEY)
    outcome = (
        F.when(F.col("date") >= days_before(as_of, 1), "waiting for acquirer")
        .when(F.col("f.present").isNull() & (till > 0), "no acquirer file")
        .when(F.abs(acquirer - till) <= tolerance, "ok")
        .when(acquirer < till, "finance below ERP")
        .otherwise("finance above ERP")
    )
    return (
        tills.join(reported, ["date", "company"], "full")
        .where(F.col("date") >= since)
        .select(
            F.concat(F.col("date").cast("string"), F.lit("-"), F.col("company")).alias("id"),
            "date",
            F.coalesce("l.store", "company").alias("store"),
            till.alias("erp_card"),
            acquirer.alias("finance_card"),
            (acquirer - till).alias("card_difference"),
            zero(F.col("l.transfer"), MONEY).alias("erp_transfer"),
            zero(F.col("f.transfer"), MONEY).alias("finance_transfer"),
            F.col("f.fees").alias("fees"),
            F.col("f.sales").alias("card_sales"),
            F.col("f.unreconciled").alias("unreconciled"),
            outcome.alias("outcome"),
        )
    )
