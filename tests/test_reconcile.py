from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillstone.operators import reconcile as rc

AS_OF = date(2001, 8, 31)
TITLES = (
    "installment_id string, type string, number string, status string, settled_date date, due_date date, value decimal(14,2), "
    "party_name string, party_document string, company string, company_tax_id string, cancelled boolean, seen_at date, title_id string, "
    "title_number string, issue_date date, issue_month date, title_value decimal(18,2), lines array<struct<PlanoDeContas:string>>"
)


def title(spark, *rows):
    base = dict(
        type="Receita", number=None, status="open", settled_date=None, due_date=AS_OF, value=D(100), party_name="P",
        party_document=None, company="C", company_tax_id="1", cancelled=None, seen_at=AS_OF, title_id=None,
        title_number=None, issue_date=None, issue_month=None, title_value=None, lines=None,
    )
    names = [f.split()[0] for f in TITLES.split(", ")]
    made = [dict(base, installment_id=f"t{i}", **r) if "installment_id" not in r else dict(base, **r) for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(m[n] for n in names) for m in made], TITLES)


def slips(spark, *rows):
    made = [(n, "b", AS_OF - timedelta(days=90), due, D(v), cancelled) for n, due, v, cancelled in rows]
    return spark.createDataFrame(
        made, "slip_number string, bank_number string, issued_at date, due_at date, value decimal(18,2), cancelled_at date"
    )


def test_slip_outcomes(spark):
    day = lambda n: AS_OF + timedelta(days=n)
    s = slips(
        spark, ("test ", day(5), 5, None), ("void ", day(5), 50, AS_OF), ("void2 ", day(5), 50, AS_OF), ("none ", day(5), 60, None),
        ("old ", day(-200), 61, None), ("diff ", day(5), 70, None), ("late ", day(-1), 80, None), ("fine ", day(5), 90, None),
        ("near ", day(5), 95, None),
    )
    t = title(
        spark, dict(number="void", value=D(50)), dict(number="void2", value=D(50), settled_date=AS_OF), dict(number="diff", value=D(71)),
        dict(number="late", value=D(80)), dict(number="fine", value=D("90.01")), dict(value=D("95.01"), due_date=day(60)),
        dict(number="fine", value=D(1), cancelled=True), dict(number="late", value=D(2), cancelled=True, seen_at=day(9)),
    )
    t = t.withColumn("cancelled", F.coalesce("cancelled", F.lit(False)))
    found = {r.id: r.outcome for r in rc.slip_reconciliation(s, t, AS_OF).collect()}
    assert found == {
        "test": "test slip", "void": "cancelled in ERP, open in finance", "void2": "ok", "none": "no title in finance",
        "old": "outside the window read from finance", "diff": "value differs", "late": "overdue and open in finance", "fine": "ok",
        "near": "in finance without the slip number",
    }


@pytest.mark.parametrize("tolerance", ["0.00", "0.01", "0.02", "0.05", "0.30"])
def test_nearest_title_against_all_pairs(spark, tolerance):
    random.seed(int(D(tolerance) * 100))
    day = lambda: AS_OF + timedelta(days=random.randint(-50, 50))
    cents = lambda: D(random.randint(1000, 1030)) / 100
    made_slips = [(f"s{i}", day(), cents(), None) for i in range(60)]
    made_titles = [dict(installment_id=f"t{i:02}", value=cents(), due_date=day(), number=random.choice([None, "", "9"])) for i in range(60)]
    got = {
        r.slip_number: (r.days_apart, r.title_installment)
        for r in rc.slip_tolerance_match(slips(spark, *made_slips), title(spark, *made_titles), D(tolerance), max_days=15).collect()
    }
    want = {}
    for name, due, value, _ in made_slips:
        near = [
            (abs((t["due_date"] - due).days), t["installment_id"])
            for t in made_titles
            if not t["number"] and abs(t["value"] - value) <= D(tolerance) and abs((t["due_date"] - due).days) <= 15
        ]
        if near:
            want[name] = min(near)
    assert want and got == want


def test_a_tolerance_of_fifty_equals_the_plain_join_and_triples_the_rows_at_most(spark):
    rng = random.Random(50)
    n, days = 3000, [AS_OF + timedelta(days=i) for i in range(-300, 300)]
    t = spark.createDataFrame(
        [(f"t{i}", "Receita", rng.choice([None, "", "x"]), "open", rng.choice(days), D(rng.randint(0, 200_000)) / 100 if i % 3 else D("77.00")) for i in range(n)],
        "installment_id string, type string, number string, status string, due_date date, value decimal(14,2)",
    )
    s = slips(spark, *[(f"s{i}", rng.choice(days), D(rng.randint(0, 200_000)) / 100 if i % 3 else D("90.00"), None) for i in range(400)])
    found = rc.slip_tolerance_match(s, t, D("50.00"), max_days=20)
    near = (F.abs(s["value"] - t["value"]) <= 50) & (F.abs(F.datediff(s["due_at"], t["due_date"])) <= 20)
    pairs = s.join(t.where("coalesce(number, '') = ''"), near)
    best = pairs.groupBy("slip_number").agg(F.min(F.struct(F.abs(F.datediff("due_at", "due_date")).alias("d"), "installment_id")).alias("b"))
    want = {r.slip_number: (r.b.d, r.b.installment_id) for r in best.collect()}
    assert want and {r.slip_number: (r.days_apart, r.title_installment) for r in found.collect()} == want
    both = rc._in_bands(t.select("value", "due_date", F.struct("installment_id", "status").alias("title")), s.select("value", F.col("due_at").alias("due_date")), 5000, D("0.01"))
    assert both.count() < 1.5 * (n + 400)


def invoice_titles(spark, *rows):
    made = []
    for i, (titles, number, value, issued, plan) in enumerate(rows):
        doc = dict(title_id=titles, title_number=number, issue_date=issued, issue_month=issued.replace(day=1), title_value=D(value))
        made.append(dict(type="Despesa", party_document="11.1", number=number, lines=[(plan,)] if plan else None, value=D(1), **doc))
    return title(spark, *made)


def test_purchase_outcomes(spark):
    day = lambda n: AS_OF + timedelta(days=n)
    branches = spark.createDataFrame([(1, "1")], "branch_code int, tax_id string")
    invoice = lambda number, total, entered, **k: (1, "1.11", number, entered, entered, k.get("cancelled"), k.get("bonus"), D(total))
    invoices = spark.createDataFrame(
        [
            invoice("001", 100, day(-10)), invoice("002", 50, day(-10)), invoice("003", 10, day(-10)), invoice("004", 10, day(-10)),
            invoice("005", 10, day(-1)), invoice("006", 10, day(-10), cancelled=AS_OF), invoice("007", 10, day(-10), bonus="1"),
        ],
        "branch_code int, supplier_code string, document string, issued_at date, entered_at date, cancelled_at date, "
        "bonus_flag string, total decimal(18,2)",
    )
    t = invoice_titles(
        spark, ("a", "NF 1", 100, day(-9), None), ("b", "2", 50, day(-9), None), ("c", "02", 50, day(-9), None), ("d", "3", 12, day(-9), None),
        ("e", "91", 5, day(-9), "Grupo - compra de mercadorias (X)"), ("f", "92", 5, day(-1), "Compra de Mercadorias"),
        ("g", "93", 5, day(-9), "Aluguel"), ("h", "letters", 5, day(-9), "Compra de Mercadorias"),
    )
    found = {r.invoice: r.outcome for r in rc.purchase_reconciliation(invoices, t, branches, AS_OF).collect()}
    assert found == {
        "1": "ok", "2": "duplicate title in finance", "3": "value differs", "4": "only in ERP", "5": "recent, waiting for finance",
        "91": "only in finance", "92": "recent, waiting for ERP",
    }


def test_old_titles_count_where_an_invoice_or_a_new_title_has_their_number(spark):
    """Cut to what the reconciliation can show, the rollup says of each key what it says uncut."""
    rng = random.Random(11)
    branches = spark.createDataFrame([(1, "1")], "branch_code int, tax_id string")
    invoices = spark.createDataFrame([(1, AS_OF)], "branch_code int, entered_at date")
    since, made = AS_OF - timedelta(days=120), []
    for i in range(400):
        issued = rng.choice([None, AS_OF - timedelta(days=rng.randint(0, 900))])
        supplier, number = f"{rng.randint(1, 40)}.0", str(rng.randint(1, 12))
        made += [
            dict(
                type="Despesa", party_document=supplier, number=number, title_id=rng.choice([f"T{i}"] * 9 + [None]), issue_date=issued,
                issue_month=issued and issued.replace(day=1), title_value=D(i), party_name=rng.choice([None, "P"]), installment_id=f"{i}-{k}",
            )
            for k in range(rng.randint(1, 3))
        ]
    t = title(spark, *made)
    wanted = spark.createDataFrame([(f"{s}0", str(n)) for s in range(1, 41, 3) for n in range(1, 9)], "supplier_digits string, invoice string")
    asked = {tuple(r) for r in wanted.collect()}
    whole = {(r.supplier_digits, r.invoice): r for r in rc.title_rollup(t, invoices, branches, AS_OF).collect()}
    cut = {(r.supplier_digits, r.invoice): r for r in rc.title_rollup(t, invoices, branches, AS_OF, wanted=wanted, since=since).collect()}
    shown = {k for k, r in whole.items() if k in asked or (r.issue_date and r.issue_date >= since)}
    assert len(shown) > 60 and len(cut) < len(whole)
    assert all(cut[k] == whole[k] for k in shown)
    old = [k for k in shown if k in asked and whole[k].issue_date and whole[k].issue_date < since]
    assert old
    assert not [k for k in cut if k not in asked and cut[k].issue_date and cut[k].issue_date >= since and k not in shown]


def test_titles_without_an_id_roll_up_into_one(spark):
    branches = spark.createDataFrame([(1, "1")], "branch_code int, tax_id string")
    invoices = spark.createDataFrame([(1, AS_OF)], "branch_code int, entered_at date")
    t = invoice_titles(spark, (None, "7", 10, AS_OF, None), (None, "7", 10, AS_OF, None), ("x", "7", 10, AS_OF, None))
    (row,) = rc.title_rollup(t, invoices, branches, AS_OF).collect()
    assert (row.titles, row.value, row.paid, row.merchandise) == (2, D("20.00"), False, False)


def test_card_days_and_a_null_modality(spark):
    branches = spark.createDataFrame([(1, "S", "1")], "branch_code int, trade_name string, tax_id string")
    at = lambda n: datetime(2001, 8, 31) - timedelta(days=n)
    receipts = spark.createDataFrame([(i, at(i), 1, 0) for i in (0, 5, 6, 7)], "receipt_id int, issued_at timestamp_ntz, branch_code int, cancelled int")
    payments = spark.createDataFrame(
        [(i, 4, D(10), D(1)) for i in (0, 5, 6, 7)] + [(5, 904, D(3), None), (5, 1, D(99), None)],
        "receipt_id int, form_code int, amount decimal(18,2), change decimal(18,2)",
    )
    card = lambda days, modality, value: (at(days).date(), "1", modality, D(value), D(1), "k", None, False, "Receita", at(days).date().replace(day=1))
    cards = spark.createDataFrame(
        [card(5, "Credit", 9), card(5, None, 50), card(5, "PIX qr", 3), card(6, "Credit", 5), card(40, "Credit", 5)],
        "sale_date date, company_tax_id string, modality string, gross_value decimal(14,2), fee decimal(14,2), card_id string, "
        "reconciled boolean, cancelled boolean, type string, sale_month date",
    )
    found = {(AS_OF - r.date).days: r for r in rc.card_reconciliation(payments, receipts, branches, cards, AS_OF).collect()}
    assert {k: r.outcome for k, r in found.items()} == {
        0: "waiting for acquirer", 5: "ok", 6: "finance below ERP", 7: "no acquirer file", 40: "finance above ERP",
    }
    assert (found[5].finance_card, found[5].finance_transfer, found[5].erp_transfer) == (D(9), D(3), D(3))
    assert (found[5].card_sales, found[5].unreconciled, found[5].fees) == (1, 3, D(3))
