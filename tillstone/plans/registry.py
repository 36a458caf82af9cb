"""Every query of the driver contract: the Spark job, the columns it serves, and the SQL step that checks it.

Columns are given as ``name:kind`` and encoded the same way on both sides (dates, times and booleans as text, exact
numbers as doubles), so results compare by value:
i integer, s text, b boolean, d date, t date-time, n exact number, m computed amount (cents), r ratio (6 places).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.functions.relational import dedup_latest
from tillstone.operators import access as ac
from tillstone.operators import profit as pf
from tillstone.operators import quality as dq
from tillstone.operators import queue as qu
from tillstone.operators import reconcile as rc
from tillstone.operators import stock as sk
from tillstone.plans import overlays as ov
from tillstone.plans.job import BUTCHER_DEPARTMENT, REFERENCE_BRANCH, Job
from tillstone.plans.oracles import oracle
from tillstone.plans.refresh import MonthlyFacts
from tillstone.plans.session import run_folder, settled
from tillstone.sources import landing, publish, sync
from tillstone.sources.pages import kept_by_run, land_new_pages_once, land_once, refresh_ledger
from tillstone.sources.partitions import PartitionedTable, apply_read

# -- serving -----------------------------------------------------------------------------------------------------


def _spark_column(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    scale = {"m": 100.0, "r": 1000000.0}.get(kind)
    encoded = {
        "i": lambda: c.cast("bigint"),
        "s": lambda: c.cast("string"),
        "b": lambda: c.cast("boolean").cast("string"),
        "d": lambda: c.cast("date").cast("string"),
        "t": lambda: F.date_format(c.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss"),
        "n": lambda: F.round(c, 4).cast("double"),
        "m": lambda: F.floor(c.cast("double") * scale + 0.5) / scale,
        "r": lambda: F.floor(c.cast("double") * scale + 0.5) / scale,
    }
    return encoded[kind]().alias(name)


def _duck_column(name: str, kind: str) -> str:
    encoded = {
        "i": f"CAST({name} AS BIGINT)",
        "s": f"CAST({name} AS VARCHAR)",
        "b": f"CAST(CAST({name} AS BOOLEAN) AS VARCHAR)",
        "d": f"strftime(CAST({name} AS DATE), '%Y-%m-%d')",
        "t": f"strftime(CAST({name} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
        "n": f"CAST(round({name}, 4) AS DOUBLE)",
        "m": f"floor(CAST({name} AS DOUBLE) * 100.0 + 0.5) / 100.0",
        "r": f"floor(CAST({name} AS DOUBLE) * 1000000.0 + 0.5) / 1000000.0",
    }
    return f"{encoded[kind]} AS {name}"


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.split(":")) for part in spec.split()]


@dataclass(frozen=True)
class Query:
    run: Callable[[Job], DataFrame]
    spec: str
    step: str | None = None  # step of the SQL side; None: rows only
    sql: str | None = None  # or a whole statement over the plain tables

    def spark(self, spark: SparkSession, folder: str) -> DataFrame:
        result = self.run(Job(ov.Sources(spark, folder)))
        return result.select(*[_spark_column(*c) for c in _columns(self.spec)])

    def oracle(self) -> str | None:
        select = ", ".join(_duck_column(*c) for c in _columns(self.spec))
        if self.sql is not None:
            return f"SELECT {select} FROM ({self.sql.strip()}) q"
        return oracle(self.step, select) if self.step else None


# -- queries that need a little wiring of their own ----------------------------------------------------------------


def _padded_conversations(j: Job) -> DataFrame:
    return j.s.conversations.select(
        F.col("conv_id").alias(" Conv_ID "),
        F.col("turn").alias("TURN"),
        F.when(F.col("turn") != 0, F.concat(F.substring("role", 1, 2), F.lit("\x00"), F.substring("role", 3, 99), F.lit("  "))).alias("Role"),
        F.concat("text", F.lit(" \t\n")).alias("TEXT "),
    )


def _narrow_parts(j: Job) -> DataFrame:
    return j.s.part.select(
        F.col("p_partkey").alias("P_PartKey"),
        F.col("p_size").cast("short").alias("P_Size"),
        F.col("p_retailprice").cast("float").alias("Price"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("Exact"),
        (F.col("p_size") > 10).alias("Large"),
        F.date_add(F.lit("1995-01-01").cast("date"), "p_size").alias("Made"),
        F.col("p_name").cast("binary").alias("Name"),
    )


def _publish(j: Job) -> DataFrame:
    """Publish orders three times: new table, same columns, one more column."""
    spark = j.s.spark
    folder = f"{run_folder(spark)}/published"
    table = f"served_orders_{spark.sparkContext.applicationId.replace('-', '_')}_{id(j)}"
    rows = j.s.orders.select(F.col("o_orderkey").alias("id"), "o_custkey")
    versions = [rows, rows, rows.withColumn("extra", F.lit(1))]
    done = [publish.publish_replace(v, table, folder, key="id") for v in versions]
    spark.sql(f"DROP VIEW IF EXISTS `{table}`")
    values = [(step, d["outcome"], d["rows"]) for step, d in enumerate(done, start=1)]
    return spark.createDataFrame(values, "step int, outcome string, rows bigint")


def _pages(j: Job) -> DataFrame:
    """Response pages of 500 events each: a list under one key, beside the page's totals."""
    item = F.struct(F.col("event_id").alias("id"), "user_id", "event_type", "k")
    return (
        j.s.landed_event.groupBy("page")
        .agg(F.to_json(F.struct(F.collect_list(item).alias("events"), F.count(F.lit(1)).alias("total"))).alias("payload"))
        .select(
            F.lit("run-1").alias("run"), F.lit("events/").alias("endpoint"),
            F.format_string('{"page":%d}', "page").alias("parameters"),
            F.lit("2001-08-31").cast("timestamp_ntz").alias("extracted_at"), "payload", "page",
        )
    )


def _land_and_explode(j: Job) -> DataFrame:
    location = f"{run_folder(j.s.spark)}/pages-{id(j)}"
    landing.land_pages(_pages(j), location)
    landed = j.s.spark.read.parquet(location)
    return landing.explode_pages(
        landed, "events", "struct<id:bigint, user_id:bigint, event_type:string, k:bigint>", keep=["page"]
    )


def _land_replayed(j: Job) -> DataFrame:
    """Pages dropped as files and landed by a stream; then the same files by a stream without its checkpoint, and a page
    more than once in a batch."""
    spark = j.s.spark
    place = f"{run_folder(spark)}/replayed-{uuid.uuid4().hex[:12]}"
    pages = settled(_pages(j).drop("page").withColumn("run", F.concat(F.lit("run-"), F.crc32("parameters") % 3)), "pages")
    table = kept_by_run(spark, f"{place}/pages")
    pages.where("run <> 'run-2'").write.json(f"{place}/in")
    for mark in ("mark", "mark", "other-mark"):
        land_new_pages_once(spark, f"{place}/in", table, f"{place}/{mark}").awaitTermination()
    land_once(table, pages.union(pages))
    item = "struct<id:bigint, user_id:bigint, event_type:string, k:bigint>"
    number = F.get_json_object("parameters", "$.page").cast("bigint").alias("page")
    return landing.explode_pages(table.read().select("*", number), "events", item, keep=["page"])


def _refresh_by_ledger(j: Job) -> DataFrame:
    """Responses of four runs; the ledger is brought up to date after two of them and after the rest."""
    spark = j.s.spark
    place = f"{run_folder(spark)}/ledger-{uuid.uuid4().hex[:12]}"
    pages, ledger = kept_by_run(spark, f"{place}/pages"), kept_by_run(spark, f"{place}/done")
    responses = j.s.detail_response.select(
        F.concat(F.lit("run-"), F.get_json_object("parameters", "$.id").cast("bigint") % 4).alias("run"),
        F.lit("details/").alias("endpoint"), "parameters", F.lit("2001-08-31").cast("timestamp_ntz").alias("extracted_at"), "payload",
    )
    for runs in (["run-0", "run-2"], ["run-1", "run-3"]):
        land_once(pages, responses.where(F.col("run").isin(runs)))
        refresh_ledger(ledger, pages, "id", "_http_error")
    events = j.s.events.select(F.col("event_id").alias("id"), "event_type")
    return landing.ids_not_done(events, "id", F.col("event_type").isin("view", "click"), ledger.read())


def _balances(j: Job) -> DataFrame:
    """Each event as a balance response: a list, an object around a list, or an empty list."""
    line = F.format_string('[{"stock":%d,"item":%d}]', "user_id", "k")
    payload = (
        F.when(F.col("event_id") % 3 == 0, line)
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"count":1,"results":'), line, F.lit("}")))
        .otherwise(F.lit("[]"))
    )
    return landing.balance_pairs(j.s.landed_event.select("event_id", payload.alias("payload")))


def _incomplete_pages(j: Job) -> DataFrame:
    events = j.s.landed_event
    announced = events.groupBy("page").agg(F.count(F.lit(1)).alias("total"))
    return landing.completeness_by_window(events.where(~F.col("lost")), announced, ["page"])


def _incomplete_ids(j: Job) -> DataFrame:
    events = j.s.landed_event
    announced = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("total")).withColumn("page", F.lit(1))
    return landing.completeness_by_ids(events.where(~F.col("lost")), "event_id", announced, by=["event_type"])


def _windows(j: Job) -> DataFrame:
    spans = j.s.orders.groupBy(F.col("o_custkey").alias("customer")).agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last")
    )
    return sync.split_windows(spans, "first", "last", 30)


def _window_sync(j: Job) -> DataFrame:
    return sync.window_sync(
        j.s.old_title, j.s.title_batch, "title", sync.between_days("due", j.as_of, 180, 120), F.lit(j.as_of),
        [F.col("delivery").desc()],
    )


def _finance_reads(j: Job) -> list[sync.Read]:
    """Titles by due date, type by type, then expenses by issue date, then cards by sale date."""
    rows, kind = j.s.finance_read, F.col("kind")
    due, issued = sync.between_days("due", j.as_of, 180, 120), sync.between_days("issued", j.as_of, 120)
    sold = sync.between_days("issued", j.as_of, 45)
    return [
        (rows.where((F.col("read") == "due") & (kind == "income")), (kind == "income") & due),
        (rows.where((F.col("read") == "due") & (kind == "expense")), (kind == "expense") & due),
        (rows.where(F.col("read") == "issue"), (kind == "expense") & issued),
        (rows.where(F.col("read") == "sale"), (kind == "card") & sold),
    ]


def _sync_reads(j: Job) -> DataFrame:
    return sync.sync_reads(j.s.finance_state, _finance_reads(j), "id", F.lit(j.as_of), [F.col("delivery").desc()])


def _sync_partitions(j: Job) -> DataFrame:
    """The same reads on a table kept by month of issue: each replaces the months it touches, the last one twice."""
    spark, month = j.s.spark, F.date_format("issued", "yyyy-MM").alias("month")
    table = PartitionedTable(spark, f"{run_folder(spark)}/finance-{uuid.uuid4().hex[:12]}", "month")
    state = j.s.finance_state.select("*", month)
    table.replace(state, [r[0] for r in state.select("month").distinct().collect()], "first load")
    reads = [(batch.select("*", month), scope) for batch, scope in _finance_reads(j)]
    announced = j.s.finance_read.groupBy("read", "kind").agg(F.count(F.lit(1)).alias("total"))
    for step, (batch, scope) in enumerate([*reads, reads[-1]]):
        name = f"read {min(step, len(reads) - 1)}"
        named = announced.join(batch.select("read", "kind").distinct(), ["read", "kind"], "left_semi")
        wrong = landing.completeness_by_window(batch, named, ["read", "kind"])
        apply_read(table, batch, "id", scope, F.lit(j.as_of), [F.col("delivery").desc()], name, wrong)
    return table.read()


def _refreshed_base(j: Job) -> DataFrame:
    """The item base kept by month: built without what arrives late, then refreshed with it.

    Late are some sales and purchases, corrections of sales that were first delivered with other amounts, whole
    transformations, positions and inventories, all of closed months.
    """
    spark = j.s.spark
    kept = MonthlyFacts(spark, f"{run_folder(spark)}/monthly-{uuid.uuid4().hex[:12]}", j.start, j.as_of, ov.INTERCOMPANY)
    day = lambda name: F.to_date(name)
    late = {
        "sales": (j.sales, day("issued_at").between("2001-02-10", "2001-04-20") & (F.col("id") % 7 == 3)),
        "purchases": (j.purchases, day("issued_at").between("2001-03-01", "2001-03-31") & (F.col("invoice_number") % 5 == 0)),
        "transformations": (j.transformations, day("transformed_at").between("2001-04-05", "2001-04-25")),
        "daily": (j.daily, F.col("date").between("2001-03-15", "2001-05-10") & (F.col("product_code") % 3 == 0)),
        "inventory": (j.inventory, F.col("reference_date").between("2001-05-01", "2001-05-05")),
    }
    wrong = day("issued_at").between("2001-06-01", "2001-06-20") & (F.col("id") % 11 == 1)
    for name, (rows, delayed) in late.items():
        rows = settled(rows, name)
        first = rows.where(~F.coalesce(delayed, F.lit(False)))
        if name == "sales":
            first = first.withColumn("total", F.when(wrong, F.col("total") + 1).otherwise(F.col("total")).cast("decimal(18,2)"))
            delayed = delayed | wrong
        kept.load(name, first, "first")
        late[name] = (rows, delayed)
    kept.refresh()
    for name, (rows, delayed) in late.items():
        kept.load(name, rows.where(delayed), "late")
    kept.refresh()
    facts = j.by_product(kept.facts())
    return pf.item_base(
        j.settled_products, j.settled_prices, j.butcher_cost, pf.reference_cost_of(facts, REFERENCE_BRANCH), facts, BUTCHER_DEPARTMENT
    )


def _sync_counts(j: Job) -> DataFrame:
    state, counts = j.s.finance_state, []
    for step, (batch, scope) in enumerate(_finance_reads(j), 1):
        counts.append(sync.sync_counts(state, batch, "id", scope).withColumn("step", F.lit(step)))
        state = sync.window_sync(state, batch, "id", scope, F.lit(j.as_of), [F.col("delivery").desc()])
    return reduce(DataFrame.unionByName, counts)


def _touched(j: Job) -> DataFrame:
    batch, scope = _finance_reads(j)[2]
    month = F.date_format("issued", "yyyy-MM").alias("month")
    return sync.touched_partitions(j.s.finance_state.select("*", month), batch.select("*", month), "id", scope, "month")


def _first_lists(j: Job) -> DataFrame:
    """Registers delivered as a list, or as an object whose first list counts: names upserted."""
    name = F.to_json(F.array(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))))
    wrapped = F.concat(F.lit('{"total":1,"items":'), name, F.lit(',"errors":[]}'))
    pages = j.s.customer.select(F.when(F.col("c_custkey") % 2 == 0, name).otherwise(wrapped).alias("payload"))
    rows = F.from_json(landing.first_list(F.col("payload")), "array<struct<id:bigint, name:string>>", {"mode": "FAILFAST"})
    source = pages.select(F.explode(rows).alias("row")).select(F.col("row.id").alias("code"), "row.name")
    return sync.dim_sync(j.s.old_customer.select("code", "name", "touched_at"), source, "code", "name", ["name"], F.lit(j.as_of))


def _refresh(j: Job) -> DataFrame:
    events = j.s.events.select(F.col("event_id").alias("id"), "event_type")
    return landing.ids_to_refresh(
        events, "id", F.col("event_type").isin("view", "click"), j.s.detail_response, "id", "_http_error"
    )


def _insert_absent(nulls_equal: bool) -> Callable[[Job], DataFrame]:
    def run(j: Job) -> DataFrame:
        target = j.s.queued.withColumn("old", F.lit(True))
        new = j.s.proposed.withColumn("old", F.lit(False))
        return sync.insert_absent(target, new, ["customer", "priority"], [F.col("title").asc()], nulls_equal)

    return run


def _dim_sync(j: Job) -> DataFrame:
    return sync.dim_sync(j.s.old_customer, j.s.new_customer, "code", "name", ["name", "segment"], F.lit(j.as_of))


def _segment_months(j: Job) -> DataFrame:
    first = j.s.orders.groupBy(F.col("o_custkey").alias("segment")).agg(F.min("o_orderdate").alias("first"))
    return sk.months_since(first, "first", j.as_of)


def _asof_cost(j: Job) -> DataFrame:
    probes = j.purchases.select("id", "branch_id", "product_code", F.to_date("issued_at").alias("issued_at"))
    return sk.asof_cost(probes, "issued_at", j.validity)


def _latest_order(j: Job) -> DataFrame:
    orders = j.s.orders.select(
        F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("title"), F.to_date("o_orderdate").alias("ordered_on")
    )
    order = [F.col("ordered_on").desc_nulls_last(), F.col("title").desc_nulls_last()]
    return dedup_latest(orders, ["customer"], order)


def _parts_summary(rows: DataFrame) -> DataFrame:
    """The installment array as columns."""
    parts = F.from_json("installments", qu.INSTALLMENTS)
    total = F.aggregate(parts, F.lit(0).cast("decimal(28,2)"), lambda a, p: (a + p["valor"]).cast("decimal(28,2)"))
    return rows.withColumns(
        {
            "parts": F.size(parts),
            "parts_total": total,
            "last_due": F.array_max(F.transform(parts, lambda p: p["vencimento"])).cast("date"),
        }
    )


def _installments(j: Job) -> DataFrame:
    pending = j.published_invoices.where("outcome like 'only in ERP%'").join(
        j.s.branch.select(F.col("tax_id").alias("supplier_document")), "supplier_document", "left_anti"
    )
    arrays = qu.installment_array(
        pending.select("supplier_document", "invoice", "issue_date", F.col("erp_value").alias("value")), j.s.payable
    )
    lines = F.explode(F.from_json("installments", qu.INSTALLMENTS)).alias("line")
    return arrays.select("supplier_document", "invoice", lines).select(
        "supplier_document",
        "invoice",
        F.col("line.numeroParcela").alias("n"),
        F.col("line.vencimento").cast("date").alias("due"),
        F.col("line.valor").alias("value"),
        F.col("line.codigoDeBarras").alias("barcode"),
    )


def _payload(j: Job) -> DataFrame:
    """Payload read back as columns: its JSON text is not compared, its content is."""
    title = F.get_json_object("payload", "$.titulos[0]")

    def field(name: str) -> Column:
        return F.get_json_object(title, f"$.{name}")

    def rows(name: str, *fields: str) -> Column:
        """A list's rows as text, fields between bars."""
        kinds = ", ".join(f"{f}:{'decimal(18,2)' if f == 'valor' else 'string'}" for f in fields)
        listed = F.from_json(field(name), f"array<struct<{kinds}>>")
        line = lambda r: F.concat_ws("|", *[F.coalesce(r[f].cast("string"), F.lit("")) for f in fields])
        return F.when(listed.isNotNull(), F.array_join(F.transform(listed, line), ";"))

    return qu.queue_payload(j.reviewed_queue).select(
        "queue_key",
        "problem",
        field("cnpj").alias("company_tax_id"),
        field("tipoTitulo").alias("kind"),
        field("numeroTitulo").alias("title_number"),
        field("clienteFornecedor").alias("party"),
        F.concat(field("detalhesClienteFornecedor.nome"), F.lit("/"), field("detalhesClienteFornecedor.cpfCnpj")).alias("details"),
        field("emissao").alias("issued"),
        field("valor").cast("decimal(18,2)").alias("value"),
        field("tipoDocumento").alias("document_type"),
        field("contaBancaria").alias("bank_account"),
        field("meioPagamento").alias("payment_means"),
        field("historico").alias("history"),
        rows("parcelas", "numeroParcela", "vencimento", "valor", "codigoDeBarras").alias("parts"),
        rows("rateio", "competencia", "planoDeContas", "numeroParcela", "valor", "centroDeCusto").alias("lines"),
    )


def _enqueued(j: Job) -> DataFrame:
    """New rows on top of a queue that already holds the invoices with an even number, some of them discarded."""
    rows = settled(j.purchase_queue, "purchase-queue")
    number = F.col("title_number").try_cast("bigint")
    queued = rows.where(number % 2 == 0).withColumn("status", F.when(number % 4 == 0, "discarded").otherwise("pending"))
    return _parts_summary(qu.enqueue(queued, rows))


def _served_orders(j: Job) -> DataFrame:
    o = j.s.orders
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("value"),
        F.col("o_orderdate").alias("ordered_at"),
        F.when(F.col("o_orderkey") % 6 != 0, F.date_add(F.to_date("o_orderdate"), 20)).alias("settled"),
    )


def _filter_compare(j: Job) -> DataFrame:
    d = _served_orders(j)
    c = lambda name: ac.column(d, name)
    big = ac.filter_compare(c("value"), "ge", 100000) & ac.filter_compare(c("value"), "lt", 400000.5)
    open_ = ac.filter_compare(c("settled"), "eq", None) | ~ac.filter_compare(c("status"), "ne", "O")
    return d.where(big & open_ & ac.filter_compare(c("customer"), "gt", 10))


def _filter_text(j: Job) -> DataFrame:
    d = _served_orders(j)
    c = ac.transform_text(ac.column(d, "priority"), "tolower")
    wild = ac.filter_text(c, "contains", "H_G") | ac.filter_text(c, "endswith", "LOW")
    return d.where(wild | (ac.filter_text(c, "startswith", "1-u") & ac.filter_text(c, "contains", None)))


def _filter_date(j: Job) -> DataFrame:
    d = _served_orders(j)
    when = ac.column(d, "ordered_at")
    late = ac.filter_compare(when, "ge", ac.date_literal("1998-03-01T00:00:00-03:00"))
    spring = ac.filter_compare(ac.date_part(when, "month"), "le", 6) & ac.filter_compare(ac.date_part(when, "day"), "gt", 9)
    not_day = ac.filter_compare(ac.date_part(when, "date"), "ne", ac.date_literal("2000-05-20"))
    return d.where(late & spring & not_day & ac.filter_compare(ac.date_part(when, "year"), "lt", 2001))


def _page_by_key(j: Job) -> DataFrame:
    """Two pages over a text id: the second starts after the last id of the first."""
    parts = j.s.part.groupBy(F.col("p_type").alias("department"), F.col("p_brand").alias("brand")).agg(
        F.count(F.lit(1)).alias("parts")
    )
    d = parts.select(F.md5(F.concat("department", "brand")).alias("id"), "department", "brand", "parts")
    first = ac.page_by_key(d, page_size=20).agg(F.max("id"), F.count(F.lit(1))).head()
    return ac.page_by_key(d, after=ac.next_token(*first, page_size=20), page_size=20)


def _checks(j: Job) -> DataFrame:
    s = j.s
    return dq.all_checks(
        dq.dq_unique(s.orders, "o_orderkey"),
        dq.dq_unique(s.orders, "o_custkey"),
        dq.dq_unique(s.receipt, "company_document", "warn"),
    )


def _checks_in_one_pass(j: Job) -> DataFrame:
    s = j.s
    lines = dq.in_one_pass(
        s.lineitem,
        dq.Check("unique_combo", ("l_orderkey", "l_linenumber")),
        dq.Check("unique", ("l_orderkey",), severity="warn"),
        dq.Check("not_null", ("l_partkey",)),
        dq.Check("accepted_values", ("l_returnflag",), ("A", "N")),
    )
    orders = dq.in_one_pass(
        s.served_by_dates,
        dq.Check("unique", ("o_orderkey",)),
        dq.Check("not_null", ("settled",), severity="warn"),
        dq.Check("unique_combo", ("o_custkey", "settled"), severity="warn"),
        dq.Check("accepted_values", ("o_orderpriority",), ("1-URGENT", "2-HIGH"), "warn"),
    )
    return dq.all_checks(lines, orders).withColumnRenamed("check", "check_name")


# -- the registry ------------------------------------------------------------------------------------------------

_ITEM_MONTH = "month:d branch_id:i product_code:i"
_PROFIT = " ".join(
    f"{n}:n"
    for n in (
        "opening_quantity opening_cost closing_quantity closing_cost bought_quantity bought_value purchase_tax "
        "internal_quantity internal_gross internal_net sold_quantity sold_gross sold_net sales_discount sales_tax "
        "transformed_quantity breakage_quantity breakage_value"
    ).split()
)
_QUEUE = (
    "queue_key:s origin:s reason:s kind:s company_tax_id:s party_name:s party_document:s title_number:s "
    "document_type:s issue_date:d value:n parts:i parts_total:n last_due:d bank_account:s payment_means:s "
    "account_plan:s cost_centre:s competence:s note:s"
)
_ORDER = "id:i customer:i priority:s status:s value:n ordered_at:t settled:d"
_EXPENSE_KEY = "month:d branch_id:i expense_group:s account_plan:s department:s party:s"
_CHECK = "check_name:s severity:s violations:i"
_PIVOT = "pessoas administrativas embalagem financeira interveniencia manutencao marketing ocupacao".split()



QUERIES: dict[str, Query] = {
    # A: landing and synchronisation
    "normalize_text": Query(
        lambda j: landing.normalize_text(_padded_conversations(j)),
        "conv_id:i turn:i role:s text:s",
        sql=r"""SELECT conv_id, turn, CASE WHEN turn <> 0 THEN role END AS role,
                       rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(133))
                           AS text FROM conversations""",
    ),
    "widen_schema": Query(
        lambda j: landing.widen_schema(_narrow_parts(j)),
        "p_partkey:i p_size:i price:r exact:n large:b made:d name:s",
        sql="""SELECT p_partkey, p_size, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS price,
                      CAST(p_retailprice AS DECIMAL(10,2)) AS exact, p_size > 10 AS large,
                      DATE '1995-01-01' + p_size AS made, p_name AS name FROM part""",
    ),
    "source_projection": Query(
        lambda j: landing.source_projection(j.s.conversations, drop=["text"], add={"opening": F.col("turn") == 0}),
        "conv_id:i turn:i role:s opening:b",
        sql="SELECT conv_id, turn, role, turn = 0 AS opening FROM conversations",
    ),
    "publish_replace": Query(
        _publish,
        "step:i outcome:s rows:i",
        sql="""SELECT step, CASE step WHEN 1 THEN 'created' WHEN 2 THEN 'replaced' ELSE 'recreated' END AS outcome,
                      (SELECT count(*) FROM orders) AS rows FROM range(1, 4) t(step)""",
    ),
    "load_audit": Query(
        lambda j: publish.load_audit(j.s.load), "table_name:s latest_good:t rows:i failures:i", "o_load_audit"
    ),
    "flatten_titles": Query(
        lambda j: j.flattened_titles,
        "installment_id:s type:s due_date:d settled_date:d status:s value:n number:s party_name:s party_document:s "
        "company:s company_tax_id:s account:s payment_means:s cancelled:b payload:s",
        "o_titles",
    ),
    "flatten_cards": Query(
        lambda j: j.flattened_cards.withColumnRenamed("authorization", "authorization_code"),
        "installment_id:s card_id:s sale_date:d sale_time:s due_date:d settled_date:d company:s company_tax_id:s "
        "acquirer:s brand:s modality:s capture:s installment:i installments:i gross_value:n net_value:n fee:n nsu:s "
        "authorization_code:s cancelled:b reconciled:b payload:s",
        "o_cards",
    ),
    "split_windows": Query(_windows, "customer:i window_start:d window_end:d", "o_windows"),
    "completeness_check": Query(_incomplete_pages, "page:i landed:i announced:i", "o_incomplete_pages"),
    "completeness_check_ids": Query(_incomplete_ids, "event_type:s distinct_ids:i announced:i", "o_incomplete_ids"),
    "window_sync": Query(_window_sync, "title:i customer:i value:n due:d seen_at:d", "o_window_sync"),
    "sync_reads": Query(_sync_reads, "id:i kind:s issued:d due:d value:n seen_at:d", "o_sync_last"),
    "sync_partitions": Query(_sync_partitions, "id:i kind:s issued:d due:d value:n seen_at:d", "o_sync_last"),
    "sync_counts": Query(_sync_counts, "step:i inserted:i replaced:i deleted:i", "o_sync_counts"),
    "touched_partitions": Query(_touched, "month:s", "o_touched"),
    "register_upsert": Query(_first_lists, "code:i name:s touched_at:d", "o_register"),
    "land_pages": Query(
        _land_and_explode,
        "page:i id:i user_id:i event_type:s k:i",
        sql="""SELECT CAST(floor(event_id / 500) AS BIGINT) AS page, event_id AS id, user_id, event_type,
                      json_extract_string(props, '$.k') AS k FROM events""",
    ),
    "land_pages_replayed": Query(
        _land_replayed,
        "page:i id:i user_id:i event_type:s k:i",
        sql="""SELECT CAST(floor(event_id / 500) AS BIGINT) AS page, event_id AS id, user_id, event_type,
                      json_extract_string(props, '$.k') AS k FROM events""",
    ),
    "ids_to_refresh": Query(_refresh, "id:i", "o_refresh"),
    "ids_to_refresh_by_ledger": Query(_refresh_by_ledger, "id:i", "o_refresh"),
    "balance_pairs": Query(
        _balances,
        "event_id:i stock:i item:i",
        sql="""SELECT event_id, user_id AS stock, json_extract_string(props, '$.k') AS item FROM events
               WHERE event_id % 3 <> 2""",
    ),
    "insert_absent": Query(_insert_absent(False), "customer:i priority:s title:i old:b", "o_insert_absent"),
    "insert_absent_null_equal": Query(
        _insert_absent(True), "customer:i priority:s title:i old:b", "o_insert_absent_nulls"
    ),
    "dim_sync": Query(_dim_sync, "code:i name:s segment:s touched_at:d", "o_dim_sync"),
    # B: staging
    "stg_sales_item": Query(
        lambda j: j.sales,
        "id:i sale_id:i branch_id:i branch_name:s sequence_text:s sale_cancelled:b issued_at:t registered_at:t "
        "customer_document:s invoice_number:i invoice_series:s access_key:s invoice_status:i cancel_reason:s "
        "invoice_type:s item:i product_code:i item_cancelled:b quantity:n unit_price:n item_discount:n "
        "payment_discount:n item_surcharge:n payment_surcharge:n total:n icms:n fcp:n pis:n cofins:n",
        "o_sales",
    ),
    "stg_purchase_item": Query(
        lambda j: j.purchases,
        "id:i branch_id:i branch_name:s order_number:i operation_id:i operation_name:s supplier_document:s "
        "supplier_name:s access_key:s invoice_number:i invoice_series:s issued_at:t entered_at:t item:i product_code:i "
        "quantity:n units_per_box:n unit_price:n discount:n calculated_discount:n total:n icms:n fcp:n pis:n cofins:n "
        "item_status:s invoice_status:i changed_at:t",
        "o_purchases",
    ),
    "stg_daily_stock": Query(
        lambda j: j.daily,
        "date:d branch_id:i product_code:i quantity:n cost:n breakage_quantity:n breakage_value:n",
        "o_daily",
    ),
    "stg_branch": Query(
        lambda j: j.branches, "branch_id:i branch_name:s legal_name:s tax_id:s tax_id_formatted:s", "o_branch"
    ),
    "stg_inventory_item": Query(
        lambda j: j.inventory,
        "branch_id:i inventory_id:i reference_date:d processed_at:t processed:b selection_kind:i selection_code:s "
        "zeroes_uncounted:b product_code:i store_quantity:n deposit_quantity:n counted_quantity:n counted:b cost:n",
        "o_inventory",
    ),
    "stg_stock_movement": Query(
        lambda j: j.movements,
        "branch_id:i product_code:i operated_at:t operation_id:i inventory_adjustment:b quantity:n balance:n "
        "inventory_quantity:n price:n cost:n cancelled_at:t document:s",
        "o_movements",
    ),
    "stg_price": Query(
        lambda j: j.prices,
        "branch_id:i branch_name:s product_code:i description:s quantity:n cost:n sale_price:n entry_tax:n exit_tax:n",
        "o_prices",
    ),
    "stg_transformation": Query(
        lambda j: j.transformations,
        "branch_id:i transformation_id:i processed_at:t transformed_at:t source_product:i source_quantity:n "
        "target_product:i target_quantity:n",
        "o_transformations",
    ),
    "stg_title_allocation": Query(
        lambda j: j.title_allocations,
        "installment_id:s title_id:s installment_type:s status:s cancelled:b issue_date:d due_date:d settled_date:d "
        "company_tax_id:s party:s line_type:s competence:s cost_centre:s account_plan:s value:n",
        "o_title_allocations",
    ),
    "stg_card_allocation": Query(
        lambda j: j.card_allocations,
        "installment_id:s card_id:s installment_type:s status:s cancelled:b sale_date:d due_date:d settled_date:d "
        "company_tax_id:s acquirer:s brand:s line_type:s competence:s cost_centre:s account_plan:s value:n",
        "o_card_allocations",
    ),
    "stg_butcher_cost": Query(
        lambda j: j.butcher_cost, "year:i month_number:i product_code:i unit_cost:n last_cost_date:d", "o_butcher"
    ),
    # C: stock and profitability
    "month_calendar": Query(_segment_months, "segment:i month:d month_end:d", "o_segment_months"),
    "stock_validity": Query(
        lambda j: j.validity, "branch_id:i product_code:i date:d next_date:d quantity:n cost:n", "o_validity"
    ),
    "last_positive_cost": Query(
        lambda j: sk.last_positive_cost(j.daily), "branch_id:i product_code:i date:d cost:n positive_cost:n", "o_validity"
    ),
    "position_before_month": Query(
        lambda j: j.before_month, f"{_ITEM_MONTH} position_date:d quantity:n cost:n", "o_before_month"
    ),
    "first_inventory_of_month": Query(
        lambda j: j.first_inventory,
        f"{_ITEM_MONTH} inventory_id:i reference_date:d counted_quantity:n",
        "o_first_inventory",
    ),
    "opening_stock": Query(
        lambda j: j.opening,
        f"{_ITEM_MONTH} origin:s stock_date:d quantity:n cost:n inventory_id:i position_quantity:n position_date:d",
        "o_opening",
    ),
    "closing_stock": Query(
        lambda j: j.closing, f"{_ITEM_MONTH} position_date:d quantity:n cost:n positive_cost:n", "o_closing"
    ),
    "asof_cost": Query(
        _asof_cost, "id:i branch_id:i product_code:i issued_at:d cost:n positive_cost:n asof_cost:n", "o_asof_cost"
    ),
    "reference_branch_cost": Query(
        lambda j: j.reference_cost, "month:d product_code:i start_cost:n end_cost:n", "o_reference_cost"
    ),
    "product_reclass": Query(
        lambda j: j.products,
        "product_code:i department:s section:s original_department:s group_name:s description:s active:b",
        "o_products",
    ),
    "sales_by_month": Query(
        lambda j: j.monthly_sales,
        f"{_ITEM_MONTH} internal_quantity:n internal_gross:n internal_net:n sold_quantity:n sold_gross:n sold_net:n "
        "sales_discount:n sales_tax:n",
        "o_monthly_sales",
    ),
    "purchases_by_month": Query(
        lambda j: j.monthly_purchases, f"{_ITEM_MONTH} bought_quantity:n bought_value:n purchase_tax:n", "o_monthly_purchases"
    ),
    "transformations_by_month": Query(
        lambda j: j.monthly_transformations, f"{_ITEM_MONTH} transformed_quantity:n", "o_monthly_transformations"
    ),
    "breakage_by_month": Query(
        lambda j: j.monthly_breakage, f"{_ITEM_MONTH} breakage_quantity:n breakage_value:n", "o_monthly_breakage"
    ),
    "active_keys": Query(lambda j: j.active_keys, _ITEM_MONTH, "o_keys"),
    "item_base": Query(
        lambda j: j.base,
        f"{_ITEM_MONTH} department:s section:s original_department:s entry_tax:n exit_tax:n sale_price:n "
        f"opening_date:d opening_origin:s closing_date:d {_PROFIT}",
        "o_base",
    ),
    "refreshed_item_base": Query(
        _refreshed_base,
        f"{_ITEM_MONTH} department:s section:s original_department:s entry_tax:n exit_tax:n sale_price:n "
        f"opening_date:d opening_origin:s closing_date:d {_PROFIT}",
        "o_base",
    ),
    "simples_rate": Query(lambda j: j.rates, "month:d rate:r", "o_rates"),
    "item_measures": Query(
        lambda j: j.measures,
        f"{_ITEM_MONTH} stock_and_purchases_quantity:n stock_and_purchases_value:m total_sold_quantity:n total_sales:n "
        "cogs:m sales_tax_due:m purchase_tax_credit:n restated_breakage:m",
        "o_measures",
    ),
    "expenses": Query(
        lambda j: j.expenses,
        "source:s installment_id:s branch_id:i company_tax_id:s date:d year:i month_number:i expense_group:s "
        "account_plan:s party:s cost_centre:s department:s direct:b value:n",
        "o_expenses",
    ),
    # D: marts
    "department_weights": Query(
        lambda j: j.weights, "month:d branch_id:i department:s department_share:r", "o_weights"
    ),
    "allocate_expenses": Query(lambda j: j.allocated_expenses, f"{_EXPENSE_KEY} allocated:n", "o_allocated"),
    "expense_mart": Query(
        lambda j: j.expense_mart, f"id:s {_EXPENSE_KEY} year:i month_number:i allocated:n", "o_expense_mart"
    ),
    "expense_pivot": Query(
        lambda j: j.expense_pivot,
        "month:d branch_id:i department:s " + " ".join(f"{g}:n" for g in _PIVOT),
        "o_expense_pivot",
    ),
    "item_weight": Query(
        lambda j: j.weighted_items,
        f"{_ITEM_MONTH} department:s total_sales:n gross_margin:m net_tax:m item_share:r",
        "o_weighted",
    ),
    "allocate_to_items": Query(
        lambda j: j.items_with_expenses,
        f"{_ITEM_MONTH} margin_after_tax:m " + " ".join(f"cost_{g}:m" for g in _PIVOT),
        "o_items_with_expenses",
    ),
    "item_margin": Query(
        lambda j: j.item_margin,
        "id:s year:i month_number:i branch_name:s department:s total_sales:n cogs:m gross_margin:m net_tax:m "
        "margin_after_tax:m margin_after_breakage:m gross_margin_pct:r margin_after_tax_pct:r "
        "margin_after_breakage_pct:r cost_total:m margin_occupancy:m margin_people:m margin_administrative:m "
        "margin_packaging:m margin_maintenance:m margin_marketing:m margin_intermediation:m margin_final:m",
        "o_item_margin",
    ),
    # E: served views and reconciliations
    "stock_position": Query(
        lambda j: rc.stock_position(
            j.s.current_stock, j.s.branch, j.s.product, j.s.product_master, j.s.product_group, j.s.product_section
        ),
        "id:i branch_name:s product_code:i product:s package:s group_name:s section_name:s quantity:n average_cost:n "
        "price:n abc_class:s last_sale:t last_purchase:t",
        "o_stock_position",
    ),
    "receipt_payments": Query(
        lambda j: rc.receipt_payments(j.s.till_payment, j.s.till_receipt, j.s.branch, j.s.payment_form),
        "id:i date:d branch_name:s terminal:i receipt_id:i form_code:i form_name:s amount:n change:n installments:i",
        "o_receipt_payments",
    ),
    "sales_item_current": Query(
        lambda j: rc.sales_item_current(
            j.s.receipt_item, j.s.receipt, j.s.branch, j.s.product, j.s.product_master, j.s.product_group,
            j.s.product_section,
        ),
        "id:i date:d time:s branch_name:s terminal:i receipt_id:i item:i product_code:i product:s package:s "
        "group_name:s section_name:s quantity:n unit_price:n discount:n surcharge:n total:n net:n",
        "o_sales_item_current",
    ),
    "sales_item_legacy": Query(
        lambda j: rc.sales_item_legacy(
            j.s.legacy_item, j.s.legacy_receipt, j.s.legacy_branch, j.s.legacy_goods, j.s.legacy_unit, j.s.legacy_class
        ),
        "id:i date:d time:s branch_name:s terminal:i receipt_number:i item:i goods_code:i goods:s unit:s class_code:i "
        "class_name:s quantity:n unit_price:n discount:n surcharge:n total:n receipt_id:i goods_id:i",
        "o_sales_item_legacy",
    ),
    "product_catalog": Query(
        lambda j: j.catalog,
        "id:i origin:s product_code:i legacy_code:i internal_code:i default_code:i is_default:b description:s "
        "full_description:s package:s units_per_package:n unit:s cost_centre:s own_cost_centre:s department:s "
        "section:s group_name:s subgroup_name:s subgroup_margin:n sold_by_scale:b variable_weight:b sold_online:b "
        "active:b created_on:d deactivated_on:d changed_at:t refreshed_at:t",
        "o_catalog",
    ),
    "slip_tolerance_match": Query(
        lambda j: rc.slip_tolerance_match(j.s.slip, j.titles),
        "slip_number:s title_installment:s title_due_date:d title_status:s days_apart:i",
        "o_tolerance",
    ),
    "slip_tolerance_match_wide": Query(
        lambda j: rc.slip_tolerance_match(j.s.slip, j.titles, Decimal("50.00")),
        "slip_number:s title_installment:s title_due_date:d title_status:s days_apart:i",
        "o_tolerance_wide",
    ),
    "slip_reconciliation": Query(
        lambda j: j.slips,
        "id:s bank_number:s issue_date:d due_date:d value:n cancelled:b customer:s title_status:s title_settled:d "
        "title_value:n outcome:s",
        "o_slips",
    ),
    "title_rollup": Query(
        lambda j: j.title_rollup,
        "supplier_digits:s invoice:s supplier:s company:s issue_date:d value:n titles:i paid:b next_due:d merchandise:b",
        "o_title_rollup",
    ),
    "purchase_reconciliation": Query(
        lambda j: j.invoices,
        "id:s supplier:s supplier_document:s invoice:s issue_date:d entry_date:d erp_value:n finance_value:n company:s "
        "titles:i paid:b next_due:d outcome:s",
        "o_invoices",
    ),
    "card_reconciliation": Query(
        lambda j: j.card_days,
        "id:s date:d store:s erp_card:n finance_card:n card_difference:n erp_transfer:n finance_transfer:n fees:n "
        "card_sales:i unreconciled:i outcome:s",
        "o_card_days",
    ),
    "dedup_latest": Query(_latest_order, "customer:i title:i ordered_on:d", "o_latest_order"),
    # F: approval queue
    "queue_from_purchases": Query(lambda j: _parts_summary(j.purchase_queue), _QUEUE, "o_purchase_queue"),
    "installment_array": Query(
        _installments, "supplier_document:s invoice:s n:i due:d value:n barcode:s", "o_installments"
    ),
    "history_mode": Query(
        lambda j: qu.history_mode(j.titles), "supplier_document:s account_plan:s cost_centre:s uses:i", "o_history"
    ),
    "queue_from_slips": Query(lambda j: _parts_summary(j.slip_queue), _QUEUE, "o_slip_queue"),
    "queue_payload": Query(
        _payload,
        "queue_key:s problem:s company_tax_id:s kind:s title_number:s party:s details:s issued:s value:n document_type:s "
        "bank_account:s payment_means:s history:s parts:s lines:s",
        "o_payload_columns",
    ),
    "already_present": Query(
        lambda j: qu.already_present(j.reviewed_queue, j.finance_after), "queue_key:s kind:s present:b", "o_present"
    ),
    "queue_dispatch": Query(
        lambda j: qu.queue_dispatch(j.reviewed_queue, j.finance_after).withColumn(
            "has_payload", F.col("payload").isNotNull()
        ),
        "queue_key:s status:s error:s has_payload:b",
        "o_dispatch",
    ),
    "queue_confirm": Query(
        lambda j: qu.queue_confirm(j.reviewed_queue, j.finance_after, j.as_of),
        "queue_key:s status:s error:s result:s",
        "o_confirm",
    ),
    "queue_confirm_counts": Query(
        lambda j: qu.count_results(
            qu.queue_confirm(j.reviewed_queue, j.finance_after, j.as_of).where("result is not null")
        ),
        "result:s rows:i",
        "o_confirm_counts",
    ),
    "enqueue": Query(_enqueued, _QUEUE + " status:s", "o_enqueued"),
    # G: access
    "filter_compare": Query(
        _filter_compare,
        _ORDER,
        "o_filter_compare",
    ),
    "filter_text": Query(_filter_text, _ORDER, "o_filter_text"),
    "filter_date": Query(_filter_date, _ORDER, "o_filter_date"),
    "select_columns": Query(
        lambda j: ac.select_columns(_served_orders(j), ["value", "customer"]), "id:i value:n customer:i", "o_served"
    ),
    "page_by_offset": Query(
        lambda j: ac.page_by_offset(_served_orders(j), [("settled", "desc"), ("value", "asc")], top=150, skip=70),
        _ORDER,
        "o_page_by_offset",
    ),
    "page_by_offset_deep": Query(
        lambda j: ac.page_by_offset(
            _served_orders(j), [("settled", "desc"), ("value", "asc")], top=150, skip=j.s.orders.count() // 2, gathered=500
        ),
        _ORDER,
        "o_page_by_offset_deep",
    ),
    "page_by_key": Query(_page_by_key, "id:s department:s brand:s parts:i", "o_page_by_key"),
    "filtered_count": Query(
        lambda j: ac.filtered_count(_served_orders(j), ac.filter_compare(F.col("status"), "ne", "F")),
        "count:i",
        sql="SELECT count(*) AS count FROM orders WHERE o_orderstatus <> 'F'",
    ),
    "bounded_preview": Query(
        lambda j: ac.bounded_preview(_served_orders(j).where("status = 'P'"), 200),
        _ORDER + " truncated:b",
        "o_preview",
    ),
    "wire_format": Query(
        lambda j: ac.wire_format(_served_orders(j).withColumn("digest", F.unhex(F.md5(F.col("priority"))))),
        "id:i customer:i priority:s status:s value:m ordered_at:s settled:s digest:s",
        "o_wire",
    ),
    # H: data quality
    "dq_unique": Query(
        lambda j: _checks(j).withColumnRenamed("check", "check_name"),
        _CHECK,
        "o_dq_unique",
    ),
    "dq_not_null": Query(
        lambda j: dq.all_checks(
            dq.dq_not_null(j.s.orders, "o_orderkey"), dq.dq_not_null(j.butcher_cost, "unit_cost", "warn")
        ).withColumnRenamed("check", "check_name"),
        _CHECK,
        "o_dq_not_null",
    ),
    "dq_unique_combo": Query(
        lambda j: dq.all_checks(
            dq.dq_unique_combo(j.daily, ["date", "branch_id", "product_code"]),
            dq.dq_unique_combo(j.s.lineitem, ["l_orderkey", "l_linenumber"]),
            dq.dq_unique_combo(j.opening, ["month", "branch_id", "product_code"]),
        ).withColumnRenamed("check", "check_name"),
        _CHECK,
        "o_dq_combo",
    ),
    "dq_accepted_values": Query(
        lambda j: dq.all_checks(
            dq.dq_accepted_values(j.opening, "origin", ["inventory", "position"]),
            dq.dq_accepted_values(j.s.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"], "warn"),
        ).withColumnRenamed("check", "check_name"),
        _CHECK,
        "o_dq_accepted",
    ),
    "dq_in_one_pass": Query(_checks_in_one_pass, _CHECK, "o_dq_in_one_pass"),
    "publish_key_check": Query(
        lambda j: dq.all_checks(
            dq.publish_key_check(j.s.orders, "o_orderkey"),
            dq.publish_key_check(j.s.title_batch, "title"),
        ).withColumnRenamed("check", "check_name"),
        _CHECK,
        "o_dq_key",
    ),
}
