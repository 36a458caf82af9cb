from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from tillstone.operators import expenses as ex
from tillstone.operators import margin as mg
from tillstone.operators import profit as pf

START, AS_OF = date(2001, 1, 1), date(2001, 4, 20)
MONTH = date(2001, 1, 1)


def test_null_cancelled_flag_drops_the_sale_and_tax_is_rounded_per_row(spark):
    schema = (
        "issued_at timestamp_ntz, branch_id int, product_code bigint, quantity decimal(18,4), total decimal(18,2), "
        "item_discount decimal(18,4), payment_discount decimal(18,4), icms decimal(18,4), pis decimal(18,4), "
        "cofins decimal(18,4), fcp decimal(18,4), sale_cancelled boolean, item_cancelled boolean, invoice_status int, "
        "customer_document string"
    )
    from datetime import datetime

    def sale(cancelled, document):
        amounts = (D(2), D("10.00"), None, D(1), D("0.0050"), None, None, None)
        return (datetime(2001, 1, 9), 1, 1, *amounts, cancelled, False, 1, document)

    df = spark.createDataFrame([sale(False, None), sale(False, None), sale(None, None), sale(True, None), sale(False, "own")], schema)
    (row,) = pf.sales_by_month(df, START, "own").collect()
    assert (int(row.sold_quantity), int(row.internal_quantity)) == (4, 2)
    assert row.sold_net == D("18.0000") and row.internal_net == D("9.0000")
    assert row.sales_tax == D("0.0300")  # 0.005 rounds to 0.01 in each of three rows


def test_rule_with_section_beats_rule_without(spark, rows):
    products = spark.createDataFrame(
        [(1, "CAFE", "DRINKS", "current"), (2, "CAFE", "OTHER", "current"), (3, "MEAT", "DRINKS", "current"),
         (4, None, "DRINKS", "current"), (5, "CAFE", "DRINKS", "legacy")],
        "product_code bigint, department string, section string, origin string",
    )
    rules = spark.createDataFrame(
        [("CAFE", None, "DELI"), ("CAFE", 19, "SWEETS"), ("CAFE", 17, "BEVERAGES")],
        "source_department string, source_section_id int, target_department string",
    )
    sections = spark.createDataFrame(
        [(17, "DRINKS", "CAFE"), (19, "DRINKS", "CAFE"), (20, "DRINKS", "MEAT")], "section_id int, section string, department string"
    )
    found = rows(pf.product_reclass(products, rules, sections), "product_code", "department", "section", "original_department")
    assert found == [
        (1, "BEVERAGES", "CAFE", "CAFE"), (2, "DELI", "CAFE", "CAFE"), (3, "MEAT", "DRINKS", "MEAT"), (4, None, "DRINKS", None),
    ]


def _facts(spark):
    month = f"date'{MONTH}' as month, 1 as branch_id"
    none = spark.sql(f"select {month}, 1L as product_code where false")
    opening = spark.sql(
        f"""select {month}, product_code, cast(q as decimal(18,4)) position_quantity, cast(c as decimal(18,4)) position_cost,
            cast(null as decimal(18,4)) position_positive, month - interval 3 days as position_date, cast(null as boolean) won,
            cast(null as bigint) inventory_id, cast(null as date) reference_date, cast(null as decimal(18,4)) counted_quantity,
            cast(null as decimal(18,4)) counted_cost, cast(null as decimal(18,4)) counted_positive
            from (select date'{MONTH}' as month, 1 as branch_id, * from values (1L, 5, 0), (2L, 0, 3), (3L, 4, null), (4L, 1, 9) as t(product_code, q, c))"""
    )
    closing = opening.select(
        "month", "branch_id", "product_code", F.lit(0).cast("decimal(18,4)").alias("quantity"),
        F.lit(0).cast("decimal(18,4)").alias("cost"), F.lit(None).cast("decimal(18,4)").alias("positive_cost"),
        F.col("month").alias("position_date"),
    )

    def with_columns(names):
        return none.select("*", *[F.lit(None).cast("decimal(18,4)").alias(n) for n in names.split()])

    return (
        with_columns("internal_quantity internal_gross internal_net sold_quantity sold_gross sold_net sales_discount sales_tax"),
        with_columns("bought_quantity bought_value purchase_tax"),
        with_columns("transformed_quantity"),
        with_columns("breakage_quantity breakage_value"),
        opening,
        closing,
    )


def test_item_cost_falls_back_and_zero_stock_is_not_active(spark):
    products = spark.createDataFrame([(1, "X"), (3, "X"), (4, "MEAT")], "product_code bigint, department string")
    prices = spark.createDataFrame([], "branch_id int, product_code bigint, entry_tax double, exit_tax double, sale_price double")
    butcher = spark.createDataFrame([(2001, 1, 4, D(2)), (2001, 1, 1, D(7))], "year int, month_number int, product_code bigint, unit_cost decimal(18,4)")
    reference = spark.createDataFrame([(MONTH, 1, D(6), D(5))], "month date, product_code bigint, start_cost decimal(18,4), end_cost decimal(18,4)")
    *flows, opening, closing = _facts(spark)
    base = pf.item_base(products, prices, butcher, reference, pf.item_facts(flows, pf.stock_facts(opening, closing)), "MEAT")
    found = {r.product_code: r for r in base.collect()}
    assert set(found) == {1, 3, 4}  # product 2: stock of zero and no movement
    assert int(found[1].opening_cost) == 6 and int(found[1].closing_cost) == 5  # zero, so the reference branch's
    assert int(found[3].opening_cost) == 0  # nothing known
    assert int(found[4].opening_cost) == 2  # butcher department: the monthly feed


WEIGHTS = "month date, branch_id int, department string, department_share decimal(18,8)"
BOOKED = "date date, branch_id int, expense_group string, account_plan string, department string, party string, direct boolean, value decimal(18,2)"


def test_indirect_expenses_need_weights(spark, rows):
    weights = spark.createDataFrame(
        [(MONTH, 1, "A", D("0.33333333")), (MONTH, 1, None, D("0.66666667")), (MONTH, 2, "A", D(0))], WEIGHTS
    )
    day = date(2001, 1, 20)
    booked = spark.createDataFrame(
        [
            (day, 1, "G", "p", None, "x", False, D("100.00")),
            (day, 2, "G", "p", None, "x", False, D("50.00")),  # no sales: rows of zero
            (day, 3, "G", "p", None, "x", False, D("50.00")),  # no items: no rows
            (day, None, "G", "p", None, "x", False, D("50.00")),  # no branch: no rows
            (day, None, "G", "p", "A", "x", True, D("7.00")),  # direct stays without a branch
            (date(2001, 5, 1), 1, "G", "p", "A", "x", True, D("9.00")),  # after the calendar
        ],
        BOOKED,
    )
    found = rows(ex.allocate_expenses(booked, weights, START, AS_OF), "branch_id", "department", "allocated")
    assert found == [(1, "A", D("33.3333")), (1, None, D("66.6667")), (2, "A", D("0.0000")), (None, "A", D("7.0000"))]


def test_expense_id_can_collide_and_the_check_sees_it(spark):
    from tillstone.operators.quality import publish_key_check

    schema = "month date, branch_id int, expense_group string, account_plan string, department string, party string, allocated decimal(22,4)"
    df = spark.createDataFrame([(MONTH, 1, "g", "a", None, "b", D(1)), (MONTH, 1, "g", "a", "b", None, D(1))], schema)
    mart = ex.expense_mart(df)
    assert mart.select("id").distinct().count() == 1 and mart.count() == 2
    assert {r["check"]: r["violations"] for r in publish_key_check(mart).collect()} == {"unique:id": 1, "not_null:id": 0}


def test_weights_and_expenses_meet_on_a_null_department(spark):
    measures = spark.createDataFrame(
        [(MONTH, 1, 1, None, D(30), D(10), 0.0, D(0)), (MONTH, 1, 2, None, D(10), D(5), 0.0, D(0)), (MONTH, 1, 3, "A", D(0), D(0), 0.0, D(0))],
        "month date, branch_id int, product_code bigint, department string, total_sales decimal(18,2), cogs decimal(18,2), "
        "sales_tax_due double, purchase_tax_credit decimal(18,2)",
    )
    weighted = mg.item_weight(measures, ex.department_sales(measures))
    assert {r.product_code: r.item_share for r in weighted.collect()} == {1: 0.75, 2: 0.25, 3: 0.0}
    mart = spark.createDataFrame(
        [(MONTH, 1, None, "PESSOAS", D(100)), (MONTH, 1, "A", "OCUPACAO", D(50)), (MONTH, 1, None, "NOT SHOWN", D(9))],
        "month date, branch_id int, department string, expense_group string, allocated decimal(22,4)",
    )
    found = {r.product_code: r for r in mg.allocate_to_items(weighted, ex.expense_pivot(mart)).collect()}
    assert (found[1].cost_pessoas, found[2].cost_pessoas, found[3].cost_ocupacao) == (75.0, 25.0, 0.0)
    assert found[1].margin_after_tax == 20.0


def test_rate_defaults_without_tax_or_sales(spark):
    calendar = spark.createDataFrame([(date(2001, m, 1),) for m in (1, 2, 3, 4)], "month date")
    lines = spark.createDataFrame(
        [("c", "Simples", "2001-01", D(5)), ("c", "SIMPLES", "2001-02", D(5)), ("c", "SIMPLES", "2001-04", D(5)), ("z", "SIMPLES", "2001-03", D(5))],
        "company_tax_id string, account_plan string, competence string, value decimal(18,2)",
    )
    sales = spark.createDataFrame(
        [(date(2001, 1, 1), 2, D(60)), (date(2001, 1, 1), 2, D(40)), (date(2001, 1, 1), 1, D(9)), (date(2001, 2, 1), 2, D(0)), (date(2001, 3, 1), 2, D(9))],
        "month date, branch_id int, sold_net decimal(18,2)",
    )
    found = {r.month.month: r.rate for r in pf.simples_rate(calendar, lines, sales, "c", "simples", 2).collect()}
    assert found == {1: 0.05, 2: 0.04, 3: 0.04, 4: 0.04}


def test_spans_of_stock_add_months_and_departments_without_sales(spark, rows):
    key = "month date, branch_id int, product_code bigint"
    day = lambda m: date(2001, m, 1)
    fact = spark.createDataFrame([(day(2), 1, 10), (day(2), 1, 10), (day(9), 1, 11), (day(3), None, None)], key)
    stocked = spark.createDataFrame(
        [(1, 10, day(1), day(3)), (1, 10, day(3), day(4)), (1, 12, day(2), day(2)), (None, None, day(3), day(4))],
        "branch_id int, product_code bigint, first date, last date",
    )
    keys = rows(pf.active_keys([fact, fact], stocked))
    expected = [(day(m), 1, 10) for m in (1, 2, 3, 4)] + [(day(9), 1, 11), (day(2), 1, 12), (day(3), None, None), (day(4), None, None)]
    assert sorted(keys, key=str) == sorted(expected, key=str)

    sales = spark.createDataFrame([(day(2), 1, 10, 5, 6)], key + ", internal_net int, sold_net int")
    sales = sales.withColumns({c: F.col(c).cast("decimal(18,4)") for c in ("internal_net", "sold_net")})
    products = spark.createDataFrame([(10, "A"), (11, "B"), (12, "B")], "product_code bigint, department string")
    by_month = ex.department_sales_of(sales, [fact, pf.active_keys([fact], stocked)], products, day(2), day(8))
    by_span = ex.department_sales_of(sales, [fact], products, day(2), day(8), stocked)
    assert rows(by_span) == rows(by_month)
    assert {(r.month.month, r.branch_id, r.department): int(r.department_sales) for r in by_span.collect()} == {
        (2, 1, "A"): 11, (3, 1, "A"): 0, (4, 1, "A"): 0, (2, 1, "B"): 0, (3, None, None): 0, (4, None, None): 0,
    }
