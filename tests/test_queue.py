from __future__ import annotations

import json
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillstone.operators import queue as qu

SCHEMA = (
    "queue_key string, kind string, company_tax_id string, party_name string, party_document string, title_number string, "
    "document_type string, issue_date date, value decimal(14,2), installments string, bank_account string, payment_means string, "
    "account_plan string, cost_centre string, competence string, note string, status string, sent_at date, error string"
)
OWNER = "12.312.312/0001-55"  # invented
PLAIN = "12312312000155"
#: Three installments: due at a time of day, numbered zero, not numbered.
PARTS = [
    {"numeroParcela": 4, "vencimento": "2001-03-10T08:30:00", "valor": 70.05, "codigoDeBarras": None},
    {"numeroParcela": 0, "vencimento": "2001-04-10", "valor": 20, "codigoDeBarras": "0777"},
    {"numeroParcela": None, "vencimento": "2001-05-10", "valor": 9.95, "codigoDeBarras": ""},
]
ROW = dict(
    queue_key="k", kind="pagar", company_tax_id="55", party_name="Pottery Ltd", party_document=OWNER, title_number="7001",
    document_type="duplicata", issue_date=date(2001, 2, 8), value=D("100.00"), installments=json.dumps(PARTS), bank_account="B2",
    payment_means="dda", account_plan="Clay", cost_centre="Kiln", competence="02-2001", note="two crates", status="approved",
    sent_at=None, error=None,
)


@pytest.fixture
def queue(spark):
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def build(*changes):
        made = [dict(ROW, queue_key=f"k{i}") | c for i, c in enumerate(changes)]
        return spark.createDataFrame([tuple(m[n] for n in names) for m in made], SCHEMA)

    return build


@pytest.fixture
def titles(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "type string, number string, party_document string, cancelled boolean")

    return build


def outgoing(rows) -> list[dict]:
    found = qu.queue_payload(rows).orderBy("queue_key").collect()
    assert [r.problem for r in found] == [None] * len(found)
    return [json.loads(r.payload)["titulos"][0] for r in found]


def test_whole_document(queue):
    (title,) = outgoing(queue({}))
    numbers, days, values = (4, 2, 3), ("2001-03-10", "2001-04-10", "2001-05-10"), (70.05, 20.0, 9.95)
    assert title == {
        "cnpj": "55", "tipoTitulo": "pagar", "numeroTitulo": "7001", "clienteFornecedor": PLAIN, "emissao": "2001-02-08", "valor": 100.0,
        "tipoDocumento": "duplicata", "contaBancaria": "B2", "meioPagamento": "dda", "historico": "two crates",
        "detalhesClienteFornecedor": {"nome": "Pottery Ltd", "cpfCnpj": PLAIN},
        "parcelas": [
            {"vencimento": d, "valor": v, "numeroParcela": n, "liquidacao": None, "codigoDeBarras": c}
            for n, d, v, c in zip(numbers, days, values, (None, "0777", ""), strict=True)
        ],
        "rateio": [
            {"competencia": "02-2001", "planoDeContas": "Clay", "numeroParcela": n, "valor": v, "centroDeCusto": "Kiln"}
            for n, v in zip(numbers, values, strict=True)
        ],
    }


@pytest.mark.parametrize(
    "change,party,detailed,centre",
    [
        ({"cost_centre": None}, PLAIN, True, False),
        ({"cost_centre": ""}, PLAIN, True, False),
        ({"party_document": "none"}, "Pottery Ltd", False, True),
        ({"party_document": "123.123.123-55", "party_name": ""}, "12312312355", False, True),
        ({"party_document": None, "party_name": None, "cost_centre": None}, "", False, False),
    ],
)
def test_what_a_document_leaves_out(queue, change, party, detailed, centre):
    (title,) = outgoing(queue(change))
    assert title["clienteFornecedor"] == party
    assert ("detalhesClienteFornecedor" in title, "centroDeCusto" in title["rateio"][0]) == (detailed, centre)


def changed(at: int, **fields) -> str:
    return json.dumps([part | fields if i == at else part for i, part in enumerate(PARTS)])


@pytest.mark.parametrize(
    "change,problem",
    [
        ({"bank_account": None, "competence": ""}, "missing fields: bank_account, competence"),
        ({"payment_means": "barter"}, "payment means not accepted: barter"),
        ({"document_type": "letter"}, "document type not accepted: letter"),
        ({"document_type": None}, "document type not accepted: null"),
        ({"installments": "[]"}, "no installments"),
        ({"installments": None}, "no installments"),
        ({"value": None}, "no title value"),
        ({"installments": changed(1, valor=None)}, "an installment has no value"),
        ({"installments": changed(2, vencimento=None)}, "an installment has no due date"),
        ({"installments": changed(0, vencimento="")}, "an installment has no due date"),
        ({"value": D("99.98")}, "installments sum to 100.00, title value is 99.98"),
        ({"value": D("99.99")}, None),
        ({"value": D("100.01")}, None),
    ],
)
def test_what_is_not_sent(queue, titles, change, problem):
    rows = queue(change)
    (row,) = qu.queue_payload(rows).collect()
    assert (row.problem, row.payload is None) == (problem, problem is not None)
    (dispatched,) = qu.queue_dispatch(rows, titles(("Receita", "1", "1", False))).collect()
    assert (dispatched.status, dispatched.error) == (("error", problem) if problem else ("ready", None))


def test_presence_by_number_and_document(queue, titles):
    rows = queue(
        dict(title_number="0038"), dict(title_number="38", party_document=None), dict(title_number="38", party_document="9"),
        dict(title_number="abc", party_document=None), dict(title_number="77"), dict(title_number="38", kind="receber"),
    )
    t = titles(
        ("Despesa", "38-X", PLAIN, None), ("Despesa", "xyz", "1", False), ("Despesa", "77", PLAIN, True),
        ("Despesa", "38", "5", False),
    )
    found = [r.present for r in qu.already_present(rows, t).orderBy("queue_key").collect()]
    assert found == [True, True, False, True, False, False]  # letters-only numbers match each other


def test_dispatch(queue, titles):
    rows = queue({}, dict(title_number="1"), dict(title_number="2", account_plan=None), dict(status="pending", title_number="1"))
    found = [(r.status, r.error, r.payload is None) for r in qu.queue_dispatch(rows, titles(("Despesa", "1", PLAIN, None))).orderBy("queue_key").collect()]
    assert found == [
        ("ready", None, False), ("confirmed", "already in finance, not sent", True), ("error", "missing fields: account_plan", True),
        ("pending", None, True),
    ]


def test_confirm(queue, titles):
    as_of = date(2001, 8, 31)
    rows = queue(
        dict(status="sent", title_number="1", sent_at=as_of), dict(status="sent", sent_at=date(2001, 8, 28)),
        dict(status="sent", sent_at=date(2001, 8, 29)), dict(status="approved", sent_at=date(2001, 1, 1)),
    )
    done = qu.queue_confirm(rows, titles(("Despesa", "1", PLAIN, None)), as_of)
    found = [(r.status, r.result) for r in done.orderBy("queue_key").collect()]
    assert found == [("confirmed", "confirmed"), ("error", "no sign"), ("sent", "no sign"), ("approved", None)]
    assert {r.result: r.rows for r in qu.count_results(done).collect()} == {"confirmed": 1, "no sign": 2, None: 1}


RECONCILED = "supplier_document string, invoice string, supplier string, issue_date date, erp_value decimal(18,2), outcome string"
PAYABLES = "supplier_code string, document string, number int, due_at date, value decimal(18,2), payment_line string, barcode string, cancelled_at date"


def _pending(spark):
    day = date(2001, 8, 1)
    return spark.createDataFrame(
        [("11", "5", "S", day, D(30), "only in ERP"), ("12", "6", "T", day, D(40), "only in ERP"), ("13", "7", "U", day, D(1), "ok"),
         ("99", "8", "OWN", day, D(1), "only in ERP")],
        RECONCILED,
    )


def _history(spark):
    lines = lambda *plans: [(p, "c") for p in plans]
    return spark.createDataFrame(
        [("Despesa", "1.1", lines("b", "a")), ("Despesa", "11", lines("b")), ("Receita", "11", lines("a", "a")), ("Despesa", "12", None)],
        "type string, party_document string, lines array<struct<PlanoDeContas:string, CentroDeCusto:string>>",
    )


@pytest.mark.parametrize("unknown_branch", [False, True])
def test_queue_from_purchases(spark, unknown_branch):
    payables = spark.createDataFrame(
        [("1.1", "005", 2, date(2001, 9, 1), D(10), "  ", "B", None), ("11", "5", 1, date(2001, 9, 1), D(20), "L", "B", None),
         ("11", "5", 3, date(2001, 8, 1), D(99), None, None, date(2001, 8, 2))],
        PAYABLES,
    )
    branches = spark.createDataFrame([("9.9",)] + ([(None,)] if unknown_branch else []), "tax_id string")
    rows = qu.queue_from_purchases(_pending(spark), payables, _history(spark), branches, "C", "B")
    found = {r.queue_key: r for r in rows.collect()}
    if unknown_branch:  # NOT IN over a list with a NULL lets nothing through
        assert not found
        return
    assert set(found) == {"pagar:11:5", "pagar:12:6"}
    assert [(p["numeroParcela"], p["valor"], p["codigoDeBarras"]) for p in json.loads(found["pagar:11:5"].installments)] == [
        (1, 20.0, "L"), (2, 10.0, None),
    ]
    assert json.loads(found["pagar:12:6"].installments) == [
        {"numeroParcela": 1, "vencimento": "2001-08-31", "valor": 40.0, "codigoDeBarras": None}
    ]
    assert (found["pagar:11:5"].account_plan, found["pagar:12:6"].account_plan) == ("b", None)
    assert found["pagar:11:5"].competence == "08-2001"


def test_times_of_sending_and_confirming(queue, titles):
    """ready → sent gets sent_at, found in finance gets confirmed_at; other rows keep what they had."""
    now = F.lit("2001-06-01 10:00:00")
    rows = queue({}, dict(title_number="1"), dict(status="sent", title_number="1"), dict(status="sent")).drop("sent_at")
    known = titles(("Despesa", "1", PLAIN, None))
    dispatched = qu.queue_dispatch(rows, known, now)
    found = [(r.status, str(r.confirmed_at)) for r in dispatched.orderBy("queue_key").collect()]
    assert found == [("ready", "None"), ("confirmed", "2001-06-01 10:00:00"), ("sent", "None"), ("sent", "None")]
    sent = qu.mark_sent(dispatched, rows.select("queue_key"), F.lit("2001-06-01 11:00:00"))
    found = [(r.status, str(r.sent_at)) for r in sent.orderBy("queue_key").collect()]
    assert found == [("sent", "2001-06-01 11:00:00"), ("confirmed", "None"), ("sent", "None"), ("sent", "None")]
    done = qu.queue_confirm(sent, known, date(2001, 6, 2), now=F.lit("2001-06-02 09:00:00"))
    found = [(r.status, str(r.confirmed_at)) for r in done.orderBy("queue_key").collect()]
    assert found == [
        ("sent", "None"), ("confirmed", "2001-06-01 10:00:00"), ("confirmed", "2001-06-02 09:00:00"), ("sent", "None"),
    ]


def test_enqueue_leaves_known_keys_alone(spark):
    queued = spark.createDataFrame([("a", "1", "discarded")], "queue_key string, title_number string, status string")
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "3")], "queue_key string, title_number string")
    found = {r.queue_key: (r.title_number, r.status) for r in qu.enqueue(queued, new, new).collect()}
    assert found == {"a": ("1", "discarded"), "b": ("2", "pending")}
