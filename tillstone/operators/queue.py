"""Approval queue: discrepancies become queue rows, people approve them, approved rows become payloads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.functions.columns import digits, document_number, unpadded
from tillstone.functions.relational import dedup_latest
from tillstone.operators.reconcile import EXPENSE, INCOME, days_before
from tillstone.sources.sync import insert_absent

# Title kinds and the closed lists the finance system accepts.
PAYABLE, RECEIVABLE = "pagar", "receber"
PAYMENT_MEANS = (
    "boleto",
    "dinheiro",
    "cheque",
    "dda",
    "doc/ted",
    "depósito em conta",
    "transferência bancária",
    "débito automático",
    "cartão de crédito / débito",
    "outros",
)
DOCUMENT_TYPES = (
    "duplicata",
    "boleto",
    "nota fiscal",
    "nota de débito",
    "conta de consumo",
    "cupom fiscal",
    "outros",
    "previsão",
)
# The account plan of sales, and the fields of a queued installment.
SALES_PLAN = "Vendas de Mercadorias"
INSTALLMENTS = "array<struct<numeroParcela:int, vencimento:string, valor:decimal(18,2), codigoDeBarras:string>>"

QUEUE_COLUMNS = [
    "queue_key", "origin", "reason", "kind", "company_tax_id", "party_name", "party_document", "title_number",
    "document_type", "issue_date", "value", "installments", "bank_account", "payment_means", "account_plan",
    "cost_centre", "competence", "note",
]


def _one_installment(due: Column, value: Column) -> Column:
    # Field names of an installment.
    one = F.struct(
        F.lit(1).alias("numeroParcela"),
        due.cast("string").alias("vencimento"),
        value.cast("decimal(18,2)").alias("valor"),
        F.lit(None).cast("string").alias("codigoDeBarras"),
    )
    return F.to_json(F.array(one), {"ignoreNullFields": "false"})


def installment_array(
    invoices: DataFrame, payables: DataFrame, default_days: int = 30
) -> DataFrame:
    """JSON array of each invoice's open installments, numbered by (due date, number).

    ``invoices`` (supplier_document, invoice, issue_date, value) are the few that need it: payables are cut to
    them before anything is collected, and an array holds one invoice's installments, which is the row asked for.
    An invoice without installments gets one for the whole value.
    """
    key = ["supplier_document", "invoice"]
    wanted = invoices.select(*key).distinct()
    opened = (
        payables.where(F.col("cancelled_at").isNull())
        .select(
            digits(F.col("supplier_code")).alias("supplier_document"),
            unpadded(F.col("document")).alias("invoice"),
            F.to_date("due_at").alias("due"),
            F.col("number").cast("int").alias("number"),
            F.col("value").cast("decimal(18,2)").alias("value"),
            F.nullif(F.trim(F.coalesce("payment_line", "barcode", F.lit(""))), F.lit("")).alias("barcode"),
        )
        .join(wanted, key, "left_semi")
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct("due", "number", "value", "barcode"))).alias("parts"))
    )
    numbered = F.transform(
        "parts",
        lambda part, i: F.struct(
            (i + 1).alias("numeroParcela"),
            part["due"].cast("string").alias("vencimento"),
            part["value"].alias("valor"),
            part["barcode"].alias("codigoDeBarras"),
        ),
    )
    whole = _one_installment(F.date_add("issue_date", default_days), F.col("value"))
    return (
        invoices.join(opened, key, "left")
        .withColumn(
            "installments",
            F.coalesce(
                F.when(F.col("parts").isNotNull(), F.to_json(numbered, {"ignoreNullFields": "false"})), whole
            ),
        )
        .drop("parts")
    )


def history_mode(titles: DataFrame, suppliers: DataFrame | None = None) -> DataFrame:
    """Most frequent (plan, centre) in each supplier's past expense lines; ties by plan, then centre.

    ``suppliers`` (supplier_document): those asked for.  Titles of others are not shuffled.
    """
    spent = titles.where(F.col("type") == EXPENSE).select(
        digits(F.col("party_document")).alias("supplier_document"), "lines"
    )
    if suppliers is not None:
        spent = spent.join(suppliers.select("supplier_document").distinct(), "supplier_document", "left_semi")
    counted = (
        spent.select("supplier_document", F.explode("lines").alias("line"))
        .groupBy(
            "supplier_document",
            F.col("line.PlanoDeContas").alias("account_plan"),
            F.col("line.CentroDeCusto").alias("cost_centre"),
        )
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    order = [F.col("uses").desc(), F.col("account_plan").asc_nulls_last(), F.col("cost_centre").asc_nulls_last()]
    return dedup_latest(counted, ["supplier_document"], order)


def queue_from_purchases(
    reconciled: DataFrame,
    payables: DataFrame,
    titles: DataFrame,
    branches: DataFrame,
    company_tax_id: str,
    bank_account: str,
) -> DataFrame:
    """Queue rows for invoices found only in the ERP, with installments and the supplier's usual plan and centre.

    Purchases from the company's own branches are internal moves.  The exclusion follows NOT IN: one branch
    without a tax id leaves nothing.
    """
    own = branches.select(digits(F.col("tax_id")).alias("own_document"))
    # One scalar over the branch list, instead of a null-aware anti join that always broadcasts its right side.
    unknown = own.agg(F.coalesce(F.bool_or(F.col("own_document").isNull()), F.lit(False)))
    pending = (
        reconciled.where(F.col("outcome").startswith("only in ERP") & F.col("supplier_document").isNotNull())
        .join(own.where(F.col("own_document").isNotNull()), F.col("supplier_document") == F.col("own_document"), "left_anti")
        .where(~unknown.scalar())
        .select(
            "supplier_document", "invoice", "supplier", "issue_date", "outcome", F.col("erp_value").alias("value")
        )
    )
    return (
        installment_array(pending, payables)
        .join(history_mode(titles, pending), "supplier_document", "left")
        .select(
            F.concat(F.lit(f"{PAYABLE}:"), "supplier_document", F.lit(":"), "invoice").alias("queue_key"),
            F.lit("purchase without title").alias("origin"),
            F.col("outcome").alias("reason"),
            F.lit(PAYABLE).alias("kind"),
            F.lit(company_tax_id).alias("company_tax_id"),
            F.col("supplier").alias("party_name"),
            F.col("supplier_document").alias("party_document"),
            F.col("invoice").alias("title_number"),
            F.lit("nota fiscal").alias("document_type"),
            "issue_date",
            "value",
            "installments",
            F.lit(bank_account).alias("bank_account"),
            F.lit("boleto").alias("payment_means"),
            "account_plan",
            "cost_centre",
            F.date_format("issue_date", "MM-yyyy").alias("competence"),
            F.concat(F.lit("Purchase invoice "), "invoice", F.lit(" without a title in finance")).alias("note"),
        )
    )


def queue_from_slips(
    reconciled: DataFrame,
    slips: DataFrame,
    customers: DataFrame,
    as_of: date,
    company_tax_id: str,
    bank_account: str,
    cost_centre: str,
    min_age_days: int = 2,
) -> DataFrame:
    """Queue rows for slips without a title that were issued at least two days ago."""
    due = reconciled.where(
        (F.col("outcome") == "no title in finance") & (F.col("issue_date") <= days_before(as_of, min_age_days))
    )
    owners = slips.select(F.trim("slip_number").alias("id"), "customer_number").join(
        customers.select("customer_number", "trade_name", "customer_code"), "customer_number", "left"
    )
    return due.join(owners, "id").select(
        F.concat(F.lit(f"{RECEIVABLE}:boleto:"), "id").alias("queue_key"),
        F.lit("slip without title").alias("origin"),
        F.col("outcome").alias("reason"),
        F.lit(RECEIVABLE).alias("kind"),
        F.lit(company_tax_id).alias("company_tax_id"),
        F.coalesce(
            F.nullif(F.trim("trade_name"), F.lit("")),
            # Fixed value: how a customer without a name is called.
            F.concat(F.lit("Cliente "), F.col("customer_number").cast("string")),
        ).alias("party_name"),
        F.nullif(digits(F.coalesce(F.col("customer_code").cast("string"), F.lit(""))), F.lit("")).alias(
            "party_document"
        ),
        F.col("id").alias("title_number"),
        F.lit("boleto").alias("document_type"),
        "issue_date",
        "value",
        _one_installment(F.col("due_date"), F.col("value")).alias("installments"),
        F.lit(bank_account).alias("bank_account"),
        F.lit("boleto").alias("payment_means"),
        F.lit(SALES_PLAN).alias("account_plan"),
        F.lit(cost_centre).alias("cost_centre"),
        F.date_format("issue_date", "MM-yyyy").alias("competence"),
        F.concat(
            F.lit("Slip "), "id", F.lit(" (bank number "), "bank_number", F.lit(") without a title in finance")
        ).alias("note"),
    )


def enqueue(queue: DataFrame, *new: DataFrame) -> DataFrame:
    """Add new rows as pending; keys already queued, in whatever status, are left alone."""
    for rows in new:
        queue = insert_absent(
            queue, rows.withColumn("status", F.lit("pending")), ["queue_key"], [F.col("title_number").asc()]
        )
    return queue


def queue_payload(queue: DataFrame) -> DataFrame:
    """Add ``payload`` (outgoing JSON) or ``problem`` (why there is none) to each row.

    No payload leaves an amount or a due date open: a missing one is a problem of its own, before sums are compared.
    """
    required = ("account_plan", "bank_account", "payment_means", "competence")
    empty = {c: F.coalesce(F.col(c) == "", F.lit(True)) for c in required}
    missing = F.concat_ws(", ", *[F.when(empty[c], F.lit(c)) for c in required])
    parts = F.from_json("installments", INSTALLMENTS)
    no_amount = F.exists("parts", lambda p: p["valor"].isNull())
    no_date = F.exists("parts", lambda p: F.coalesce(p["vencimento"], F.lit("")) == "")
    total = F.round(F.aggregate("parts", F.lit(0).cast("decimal(28,2)"), lambda a, p: (a + p["valor"]).cast("decimal(28,2)")), 2)
    value = F.round(F.col("value"), 2).cast("decimal(18,2)")

    problem = (
        F.when(missing != "", F.concat(F.lit("missing fields: "), missing))
        .when(~F.col("payment_means").isin(*PAYMENT_MEANS), F.concat(F.lit("payment means not accepted: "), "payment_means"))
        .when(
            F.coalesce(~F.col("document_type").isin(*DOCUMENT_TYPES), F.lit(True)),
            F.concat(F.lit("document type not accepted: "), F.coalesce("document_type", F.lit("null"))),
        )
        .when(F.coalesce(F.size("parts") < 1, F.lit(True)), F.lit("no installments"))
        .when(value.isNull(), F.lit("no title value"))
        .when(F.coalesce(no_amount, F.lit(True)), F.lit("an installment has no value"))
        .when(F.coalesce(no_date, F.lit(True)), F.lit("an installment has no due date"))
        .when(
            F.abs(total - value) > F.lit(Decimal("0.01")),
            F.concat(
                F.lit("installments sum to "), total.cast("string"), F.lit(", title value is "), value.cast("string")
            ),
        )
    )
    document = F.coalesce(digits(F.col("party_document")), F.lit(""))
    by_document = F.length(document).isin(11, 14)
    has_centre = F.coalesce(F.col("cost_centre") != "", F.lit(False))
    named = by_document & F.coalesce(F.col("party_name") != "", F.lit(False))
    number = lambda p, i: F.coalesce(F.nullif(p["numeroParcela"], F.lit(0)), i + 1)

    def lines(with_centre: bool) -> Column:
        centre = [F.col("cost_centre").alias("centroDeCusto")] if with_centre else []
        return F.transform(
            "parts",
            lambda p, i: F.struct(
                F.col("competence").alias("competencia"),
                F.col("account_plan").alias("planoDeContas"),
                number(p, i).alias("numeroParcela"),
                p["valor"].alias("valor"),
                *centre,
            ),
        )

    installments = F.transform(
        "parts",
        lambda p, i: F.struct(
            F.substring(p["vencimento"], 1, 10).alias("vencimento"),
            p["valor"].alias("valor"),
            number(p, i).alias("numeroParcela"),
            F.lit(None).cast("string").alias("liquidacao"),
            p["codigoDeBarras"].alias("codigoDeBarras"),
        ),
    )

    def body(with_details: bool, with_centre: bool) -> Column:
        # Field names of the outgoing title document.
        details = (
            [F.struct(F.col("party_name").alias("nome"), document.alias("cpfCnpj")).alias("detalhesClienteFornecedor")]
            if with_details
            else []
        )
        title = F.struct(
            F.col("company_tax_id").alias("cnpj"),
            F.col("kind").alias("tipoTitulo"),
            F.col("title_number").alias("numeroTitulo"),
            F.when(by_document, document).otherwise(F.coalesce("party_name", F.lit(""))).alias("clienteFornecedor"),
            F.col("issue_date").cast("string").alias("emissao"),
            value.alias("valor"),
            F.col("document_type").alias("tipoDocumento"),
            F.col("bank_account").alias("contaBancaria"),
            F.col("payment_means").alias("meioPagamento"),
            F.substring(F.coalesce("note", F.lit("")), 1, 500).alias("historico"),
            installments.alias("parcelas"),
            lines(with_centre).alias("rateio"),
            *details,
        )
        return F.to_json(F.struct(F.array(title).alias("titulos")), {"ignoreNullFields": "false"})

    payload = (
        F.when(named & has_centre, body(True, True))
        .when(named, body(True, False))
        .when(has_centre, body(False, True))
        .otherwise(body(False, False))
    )
    return (
        queue.withColumn("parts", parts)
        .withColumn("problem", problem)
        .withColumn("payload", F.when(F.col("problem").isNull(), payload))
        .drop("parts")
    )


def already_present(queue: DataFrame, titles: DataFrame) -> DataFrame:
    """Add ``present``: a live title of the same type, number and (if the row has one) document exists.

    Numbers compare by their digits without leading zeros, so two all-letter numbers match each other.  The live
    titles are reduced to distinct (type, number, document), and "any document" is a second distinct set: two
    joins with unique right sides, where one residual join would test every pair sharing the empty number.  Titles
    are cut to the numbers the queue asks for first; a queue under the broadcast threshold costs them no shuffle.
    """
    asked = queue.select(
        F.when(F.col("kind") == PAYABLE, EXPENSE).otherwise(INCOME).alias("_type"),
        document_number(F.col("title_number")).alias("_number"),
    ).distinct()
    live = (
        titles.where(~F.coalesce("cancelled", F.lit(False)))
        .select(
            F.col("type").alias("_type"),
            document_number(F.coalesce("number", F.lit(""))).alias("_number"),
            digits(F.coalesce("party_document", F.lit(""))).alias("_document"),
        )
        .join(asked, ["_type", "_number"], "left_semi")
        .distinct()
    )
    any_document = live.select("_type", "_number").distinct().withColumn("_any", F.lit(True))
    same_document = live.withColumn("_same", F.lit(True))
    rows = queue.withColumns(
        {
            "_type": F.when(F.col("kind") == PAYABLE, EXPENSE).otherwise(INCOME),
            "_number": document_number(F.col("title_number")),
            "_document": F.coalesce(digits(F.col("party_document")), F.lit("")),
        }
    )
    present = F.when(F.col("_document") == "", F.col("_any")).otherwise(F.col("_same"))
    return (
        rows.join(any_document, ["_type", "_number"], "left")
        .join(same_document, ["_type", "_number", "_document"], "left")
        .select(*queue.columns, F.coalesce(present, F.lit(False)).alias("present"))
    )


def queue_dispatch(queue: DataFrame, titles: DataFrame, now: Column | None = None) -> DataFrame:
    """Approved rows become confirmed (already in finance), error (with the reason) or ready; others stay.

    With ``now``, rows confirmed here get it as ``confirmed_at``; ``mark_sent`` stamps the ready ones once sent.
    """
    approved = F.col("status") == "approved"
    checked = queue_payload(already_present(queue, titles))
    if now is not None:
        checked = _stamp(checked, "confirmed_at", approved & F.col("present"), now)
    return checked.select(
        *[c for c in queue.columns if c not in ("status", "error", *_stamped(now))],
        *_stamped(now),
        F.when(~approved, F.col("status"))
        .when(F.col("present"), "confirmed")
        .when(F.col("problem").isNotNull(), "error")
        .otherwise("ready")
        .alias("status"),
        F.when(approved & F.col("present"), "already in finance, not sent")
        .when(approved, F.substring("problem", 1, 1000))
        .otherwise(F.col("error"))
        .alias("error"),
        F.when(approved & ~F.col("present"), F.col("payload")).alias("payload"),
    )


def _stamp(rows: DataFrame, name: str, where: Column, now: Column) -> DataFrame:
    before = F.col(name) if name in rows.columns else F.lit(None).cast("timestamp_ntz")
    return rows.withColumn(name, F.when(where, now.cast("timestamp_ntz")).otherwise(before))


def _stamped(now: Column | None) -> list[str]:
    return [] if now is None else ["confirmed_at"]


def mark_sent(queue: DataFrame, keys: DataFrame, now: Column) -> DataFrame:
    """Ready rows whose key was taken by finance become sent, with the time; what else ``keys`` names stays."""
    taken = keys.select("queue_key").distinct().withColumn("_taken", F.lit(True))
    sent = (F.col("status") == "ready") & F.coalesce("_taken", F.lit(False))
    rows = _stamp(queue.join(taken, "queue_key", "left"), "sent_at", sent, now)
    return rows.withColumn("status", F.when(sent, "sent").otherwise(F.col("status"))).drop("_taken")


def queue_confirm(
    queue: DataFrame, titles: DataFrame, as_of: date, wait_days: int = 2, now: Column | None = None
) -> DataFrame:
    """Sent rows become confirmed when the title shows up, error when it has not after ``wait_days``.

    With ``now``, rows confirmed here get it as ``confirmed_at``.
    """
    sent = F.col("status") == "sent"
    late = F.col("sent_at") < F.lit(as_of - timedelta(days=wait_days))
    checked = already_present(queue, titles)
    lost = sent & ~F.col("present") & F.coalesce(late, F.lit(False))
    if now is not None:
        checked = _stamp(checked, "confirmed_at", sent & F.col("present"), now)
    return checked.select(
        *[c for c in queue.columns if c not in ("status", "error", *_stamped(now))],
        *_stamped(now),
        F.when(sent & F.col("present"), "confirmed").when(lost, "error").otherwise(F.col("status")).alias("status"),
        F.when(lost, f"not in finance after {wait_days} days").otherwise(F.col("error")).alias("error"),
        F.when(sent, F.when(F.col("present"), "confirmed").otherwise("no sign")).alias("result"),
    )


def count_results(rows: DataFrame, by: Sequence[str] = ("result",)) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
