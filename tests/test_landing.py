from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillstone.sources import finance, landing, publish, sync
from tillstone.streaming import microbatch


def test_texts_lose_trailing_space_and_nul(spark, rows):
    df = spark.createDataFrame([("ABC   ", 1), ("x\x00y", 2), (None, 3), (" a\t\n", 4)], "` Name ` string, ID int")
    clean = landing.normalize_text(df)
    assert clean.columns == ["name", "id"]
    assert rows(clean) == [(" a", 4), ("ABC", 1), ("xy", 2), (None, 3)]


def test_schema_is_widened(spark):
    df = spark.range(1).select(
        F.lit(1).cast("byte").alias("A"), F.lit(1.5).cast("float").alias("B"), F.lit("1.25").cast("decimal(36,8)").alias("C"),
        F.current_date().alias("D"), F.lit(True).alias("E"), F.lit("x").alias("F"), F.array(F.lit(1)).alias("G"),
        F.lit("2001-01-01").cast("timestamp_ntz").alias("H"), F.current_timestamp().alias("I"),
    )
    types = [t for _, t in landing.widen_schema(df).dtypes]
    assert types == ["bigint", "double", "decimal(36,8)", "date", "boolean", "string", "string", "timestamp_ntz", "timestamp"]


def test_jdbc_options_split_a_query():
    options = landing.jdbc_options("jdbc:x", query="select 1", split=("id", 0, 100, 8))
    assert options["dbtable"] == "(select 1) source" and options["numPartitions"] == "8" and "query" not in options
    assert landing.jdbc_options("jdbc:x", table="t")["fetchsize"] == "2000"
    with pytest.raises(ValueError):
        landing.jdbc_options("jdbc:x")


def documents(spark, *items):
    return spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in items], "payload string")


TITLE = {"ParcelaId": "t-1", "Tipo": "Receita", "Vencimento": "2001-07-04"}


def test_title_documents(spark):
    full = TITLE | {
        "Liquidacao": "2001-07-05T23:59:00", "Status": "Liquidado", "ValorBruto": 0.07, "Numero": " A-5\n", "Conta": "till", "Cancelada": True,
        "MeioDePagamento": "cheque",
        "Rateio": [{"Tipo": "Despesa", "Competencia": "2001-06", "PlanoDeContas": "Rent", "Valor": 0.07, "More": 1}],
        "DadosDoTitulo": {"TituloId": "T", "Emissao": "2001-06-30T00:00:00", "Valor": 0.14, "NumeroDoTitulo": "never", "Empresa": {"Nome": "We", "Inscricao": "77"}, "ClienteFornecedor": {"Nome": "They"}},
    }
    numbered = TITLE | {"ParcelaId": "t-2", "Numero": "", "Liquidacao": "", "DadosDoTitulo": {"NumeroDoTitulo": "B6 \t"}, "Vencimento": ""}
    first, second = finance.flatten_titles(documents(spark, full, numbered)).orderBy("installment_id").collect()
    assert first[:14] == (
        "t-1", "Receita", date(2001, 7, 4), date(2001, 7, 5), "Liquidado", Decimal("0.07"), "A-5", "They", None, "We", "77", "till",
        "cheque", True,
    )
    assert (first.title_id, first.title_number, first.issue_date, first.issue_month, first.title_value) == (
        "T", "never", date(2001, 6, 30), date(2001, 6, 1), Decimal("0.14"),
    )
    assert [tuple(line) for line in first.lines] == [("Despesa", "2001-06", None, "Rent", Decimal("0.07"))] and second.lines is None
    assert (second.number, second.due_date, second.settled_date, second.value) == ("B6", None, None, None)
    assert json.loads(second.payload) == numbered


@pytest.mark.parametrize(
    "bad",
    [
        json.dumps(TITLE)[:-9],
        "no document",
        None,
        TITLE | {"ValorBruto": 1234567890123.5},
        TITLE | {"ValorBruto": "much"},
        TITLE | {"Rateio": [{"Valor": 1}, {"Valor": "much"}]},
        TITLE | {"Rateio": "none"},
        {k: v for k, v in TITLE.items() if k != "ParcelaId"},
        TITLE | {"Tipo": None},
        {k: v for k, v in TITLE.items() if k != "Vencimento"},
    ],
)
def test_a_bad_title_document_stops_the_load(spark, bad):
    rows = documents(spark, TITLE).union(spark.createDataFrame([(bad if isinstance(bad, str | None) else json.dumps(bad),)], "payload string"))
    with pytest.raises(Exception, match="(?i)malformed|document without"):
        finance.flatten_titles(rows).select("value", "number").collect()


def test_card_documents(spark):
    sale = {"NSU": 55, "DataDaVenda": "2001-06-01T18:00:00", "HoraDaVenda": "18:00"}
    full = {
        "ParcelaId": "k-1", "Vencimento": "2001-07-01", "ValorBruto": 50, "ValorLiquido": 48.5, "Taxa": 1.5, "Numero": "2", "Modalidade": "Debit",
        "DadosDoCartao": {"CartaoId": "k", "Cancelado": "FALSE", "ConciliadoComPDV": "True", "TotalDeParcelas": "six", "Vendas": [sale, {}]},
    }
    bare = {"ParcelaId": "k-2", "Cancelada": True, "DadosDoCartao": {"Vendas": [], "ConciliadoComPDV": "perhaps", "Hora": "07:00"}}
    first, second = finance.flatten_cards(documents(spark, full, bare)).orderBy("installment_id").collect()
    assert (first.sale_date, first.sale_time, first.nsu, first.installment, first.installments) == (date(2001, 6, 1), "18:00", "55", 2, None)
    assert (first.cancelled, first.reconciled, second.cancelled, second.reconciled) == (False, True, True, None)
    assert (second.sale_date, second.sale_time, second.nsu) == (None, "07:00", None)
    with pytest.raises(Exception, match="document without ParcelaId"):
        finance.flatten_cards(documents(spark, {"Numero": "1"})).select("fee").collect()


@pytest.mark.parametrize("payload", ['{"other": []}', '{"rows": [{"id": 1', '{"rows": null}', "[]", None])
def test_a_page_without_its_list_stops_the_load(spark, payload):
    pages = spark.createDataFrame([(1, '{"rows": []}'), (2, payload)], "page int, payload string")
    with pytest.raises(Exception, match="page without the list 'rows'"):
        landing.explode_pages(pages, "rows", "struct<id:bigint>", keep=["page"]).collect()


def test_pages_with_lists_and_the_gate(spark):
    pages = spark.createDataFrame([(1, '{"rows": []}'), (2, '{"rows": [{"id": 5}, {"id": 6}]}')], "page int, payload string")
    rows = landing.explode_pages(pages, "rows", "struct<id:bigint>", keep=["page"])
    assert sorted(tuple(r) for r in rows.collect()) == [(2, 5), (2, 6)]
    announced = spark.createDataFrame([(2, 3)], "page int, total int")
    wrong = landing.completeness_by_window(rows, announced, ["page"])
    with pytest.raises(landing.IncompleteRead, match="rows: .*'landed': 2, 'announced': 3"):
        landing.require_complete(wrong, "rows")
    landing.require_complete(wrong.where("announced < 0"), "rows")


def test_windows_are_contiguous(spark):
    df = spark.createDataFrame([(date(2026, 1, 1), date(2026, 3, 1))], "a date, b date")
    found = [(r.window_start, r.window_end) for r in sync.split_windows(df, "a", "b").orderBy("window_start").collect()]
    assert found[0] == (date(2026, 1, 1), date(2026, 1, 30)) and found[-1][1] == date(2026, 3, 1)
    assert all((b - a).days < 30 for a, b in found)
    assert all((found[i + 1][0] - found[i][1]).days == 1 for i in range(len(found) - 1))


def test_completeness_by_window_and_by_ids(spark, rows):
    landed = spark.createDataFrame([("w1", 1), ("w1", 2), ("w2", 2), ("w2", 3)], "w string, id int")
    announced = spark.createDataFrame([("w1", 5), ("w2", 2), ("w3", 1), ("w4", None)], "w string, total int")
    assert rows(landing.completeness_by_window(landed, announced, ["w"])) == [("w1", 2, 5), ("w3", 0, 1)]
    pages = spark.createDataFrame([(1, 4), (2, 4)], "page int, total int")
    assert rows(landing.completeness_by_ids(landed, "id", pages)) == [(3, 4)]
    assert landing.completeness_by_ids(landed, "id", pages.withColumn("total", F.lit(3))).count() == 0


def test_window_sync_keeps_outside_deletes_inside_and_takes_the_last(spark, rows):
    state = spark.createDataFrame(
        [("out", 1, date(2000, 1, 1), 0), ("gone", 1, date(2001, 1, 5), 0), ("moved", 1, date(2000, 1, 1), 0),
         ("undated", 1, None, 0)],
        "id string, v int, d date, seen_at int",
    )
    batch = spark.createDataFrame(
        [("moved", 2, date(2001, 1, 6), 1), ("new", 3, date(2001, 1, 7), 1), ("new", 4, date(2001, 1, 7), 2), (None, 9, None, 1)],
        "id string, v int, d date, n int",
    )
    scope = sync.between_days("d", date(2001, 1, 10), 9)
    after = sync.window_sync(state, batch, "id", scope, F.lit(7), [F.col("n").desc()])
    assert rows(after, "id", "v", "seen_at") == [("moved", 2, 7), ("new", 4, 7), ("out", 1, 0), ("undated", 1, 0)]


def test_insert_absent_null_keys(spark, rows):
    old = spark.createDataFrame([("a", None, 1)], "k string, s int, v int")
    new = spark.createDataFrame([("a", None, 2), ("b", None, 3), ("b", None, 4), ("a", 5, 6)], "k string, s int, v int")
    plain = sync.insert_absent(old, new, ["k", "s"], [F.col("v").asc()])
    equal = sync.insert_absent(old, new, ["k", "s"], [F.col("v").asc()], nulls_equal=True)
    assert [r[2] for r in rows(plain, "k", "s", "v")] and sorted(r[2] for r in rows(plain)) == [1, 2, 3, 4, 6]
    assert sorted(r[2] for r in rows(equal)) == [1, 3, 6]


def test_dim_sync_touches_only_changes_and_refuses_doubles(spark, rows):
    dim = spark.createDataFrame([(1, "A", "x", 0), (2, "B", "x", 0), (3, "C", "x", 0)], "k int, name string, g string, touched_at int")
    source = spark.createDataFrame([(1, " A ", "x"), (2, "B", "y"), (4, "D", None), (5, "  ", "x")], "k int, name string, g string")
    after = sync.dim_sync(dim, source, "k", "name", ["name", "g"], F.lit(9))
    assert rows(after) == [(1, "A", "x", 0), (2, "B", "y", 9), (3, "C", "x", 0), (4, "D", None, 9)]
    with pytest.raises(PySparkException, match="twice"):
        sync.dim_sync(dim, source.union(source), "k", "name", ["name", "g"], F.lit(9)).collect()


def test_refresh_of_animals_and_events(spark, rows):
    animals = spark.createDataFrame(
        [("a1", False, False), ("a2", True, False), ("a3", True, False), ("a4", False, True)], "id string, sold boolean, dead boolean"
    )
    extracted = spark.createDataFrame(
        [('{"id":"a1"}', "{}"), ('{"id":"a2"}', "[]"), ('{"id":"a4"}', '{"_failed":500}')], "parameters string, payload string"
    )
    found = landing.ids_to_refresh(animals, "id", ~(F.col("sold") | F.col("dead")), extracted, "id", "_failed")
    assert rows(found) == [("a1",), ("a3",), ("a4",)]


def test_balance_shapes(spark, rows):
    good = spark.createDataFrame([('[{"stock":1,"item":2}]',), ('{"results":[{"stock":3,"item":4,"x":0}]}',), ("[]",)], "payload string")
    assert rows(landing.balance_pairs(good)) == [(1, 2), (3, 4)]
    bad = spark.createDataFrame([('[{"estoque":1}]',)], "payload string")
    with pytest.raises(PySparkException, match="unexpected format"):
        landing.balance_pairs(bad).collect()


@pytest.mark.parametrize(
    "payload",
    [
        '[{"stock":1,"item":2},{"stock":3,"it',
        '{"results":[{"stock":1,"item":2}',
        '"text"',
        "17",
        '{"results":{"a":1}}',
        '{"results":null}',
        '{"lines":[]}',
        '[{"stock":1,"item":null}]',
        "[[1,2]]",
        "",
        None,
    ],
)
def test_a_balance_of_another_shape_stops_the_load(spark, payload):
    pages = spark.createDataFrame([(1, '[{"stock":1,"item":2}]'), (2, payload)], "page int, payload string")
    with pytest.raises(Exception, match="(?i)unexpected format|malformed"):
        landing.balance_pairs(pages).collect()


@pytest.mark.parametrize("payload", ['{"items":[{"id":1}', '[{"id":1}', '[{"id":1},', '"text"', "17", None])
def test_a_cut_response_has_no_first_list(spark, payload):
    df = spark.createDataFrame([('{"items":[]}',), (payload,)], "p string")
    with pytest.raises(Exception, match="(?i)malformed|without a payload"):
        df.select(landing.first_list(F.col("p"))).collect()


def test_first_list_of_a_response(spark):
    df = spark.createDataFrame([("[1]",), ('{"Total":3,"Itens":[{"a":1}],"Outros":[2]}',), ('{"a":1}',)], "p string")
    found = [r[0] for r in df.select(landing.first_list(F.col("p"))).collect()]
    assert found[0] == "[1]" and json.loads(found[1]) == [{"a": 1}] and found[2] is None


def test_publish_versions_and_keeps_the_old_one_on_a_bad_key(spark, tmp_path):
    table, place = "published_test", str(tmp_path)
    rows3 = spark.range(3)
    assert publish.publish_replace(rows3, table, place, key="id")["outcome"] == "created"
    assert publish.publish_replace(spark.range(6), table, place, key="id") == {"table": table, "outcome": "replaced", "rows": 6}
    with pytest.raises(RuntimeError):
        publish.publish_replace(rows3.union(rows3), table, place, key="id")
    assert spark.table(table).count() == 6
    changed = spark.range(2).withColumn("extra", F.lit("x"))
    assert publish.publish_replace(changed, table, place)["outcome"] == "recreated"
    assert spark.table(table).columns == ["id", "extra"]


def test_one_failed_load_does_not_stop_the_others(spark, tmp_path):
    def bad():
        raise RuntimeError("no route")

    place = str(tmp_path / "audit")
    with pytest.raises(publish.LoadsFailed, match="b"):
        publish.run_loads(spark, {"a": lambda: 3, "b": bad, "c": lambda: 4}, place)
    audit = {r.table_name: r for r in publish.load_audit(spark.read.parquet(place)).collect()}
    assert audit["a"].rows == 3 and audit["c"].rows == 4
    assert audit["b"].failures == 1 and audit["b"].latest_good is None


def _page(folder, name, *ids):
    page = {"run": "r", "endpoint": "e", "parameters": "{}", "extracted_at": "2001-01-01T00:00:00",
            "payload": json.dumps({"items": [{"id": i} for i in ids]})}
    (folder / name).write_text(json.dumps(page))


def test_stream_lands_each_page_once(spark, tmp_path, rows):
    incoming = tmp_path / "in"
    incoming.mkdir()
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    for name, ids in (("a.json", (1, 2)), ("b.json", (3,))):
        _page(incoming, name, *ids)
        microbatch.land_new_pages(spark, str(incoming), out, mark).awaitTermination(60)
    items = landing.explode_pages(spark.read.parquet(out), "items", "struct<id:bigint>")
    assert rows(items) == [(1,), (2,), (3,)]


def test_stream_applies_window_sync_per_batch(spark, tmp_path, rows):
    incoming, state_dir = tmp_path / "in", tmp_path / "state"
    incoming.mkdir()
    schema = "id string, v int, d date, n int"
    state = {"df": spark.createDataFrame([("old", 1, date(2001, 1, 2), 0)], "id string, v int, d date, seen_at int")}

    def step(batch, batch_id):
        after = sync.window_sync(
            state["df"], batch, "id", sync.between_days("d", date(2001, 1, 3), 5), F.lit(batch_id + 1), [F.col("n").desc()]
        )
        after.write.mode("overwrite").parquet(str(state_dir / str(batch_id)))
        state["df"] = spark.read.parquet(str(state_dir / str(batch_id)))

    (incoming / "1.json").write_text('{"id":"new","v":5,"d":"2001-01-03","n":1}')
    changes = spark.readStream.schema(schema).json(str(incoming))
    microbatch.apply_batches(changes, step, str(tmp_path / "mark")).awaitTermination(60)
    assert rows(state["df"], "id", "v", "seen_at") == [("new", 5, 1)]
    assert datetime.now()  # the stream has stopped by itself


def test_additions_alone(spark):
    target = spark.createDataFrame([(1, "x")], "k int, v string")
    new = spark.createDataFrame([(1, "y"), (2, "z"), (2, "a")], "k int, v string")
    added = sync.insert_absent(target, new, ["k"], [F.col("v").asc()], additions_only=True)
    assert [tuple(r) for r in added.collect()] == [(2, "a")]


def test_old_versions_are_removed(spark, tmp_path):
    place = str(tmp_path / "published")
    for n in range(4):
        publish.publish_replace(spark.range(n + 1), "versioned", place)
    assert len(publish.prune_versions(spark, "versioned", place, keep=2)) == 2
    assert spark.table("versioned").count() == 4
    with pytest.raises(RuntimeError):
        publish.publish_replace(spark.range(2).union(spark.range(2)), "versioned", place, key="id")
    assert len(list((tmp_path / "published" / "versioned").iterdir())) == 2


def test_audit_names_the_source_version(spark, tmp_path):
    place = str(tmp_path / "audit")
    publish.run_loads(spark, {"a": lambda: 1, "b": lambda: 2}, place, versions={"a": "v7"})
    assert {r.table_name: r.source_version for r in spark.read.parquet(place).collect()} == {"a": "v7", "b": None}
