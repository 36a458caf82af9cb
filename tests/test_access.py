from __future__ import annotations

import json
import random
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillstone.operators import access as ac
from tillstone.operators import quality as dq


@pytest.fixture(scope="module")
def table(spark):
    data = [(i, f"Item {i}%" if i % 2 else None, D(i) / 2, date(2026, 1, 1 + i % 28), i % 3 if i % 5 else None) for i in range(1, 51)]
    return spark.createDataFrame(data, "id long, name string, value decimal(18,2), day date, grade int")


def test_comparisons_and_null(table):
    grade = ac.column(table, "grade")
    assert table.where(ac.filter_compare(grade, "eq", None)).count() == 10
    assert table.where(ac.filter_compare(grade, "ne", None)).count() == 40
    assert table.where(ac.filter_compare(grade, "ne", 0)).count() == 27  # NULL rows drop too
    both = ac.filter_compare(ac.column(table, "id"), "ge", 10) & ~ac.filter_compare(ac.column(table, "id"), "gt", 12)
    assert [r.id for r in table.where(both).orderBy("id").collect()] == [10, 11, 12]
    for bad in (lambda: ac.filter_compare(grade, "gt", None), lambda: ac.column(table, "nope"), lambda: ac.filter_compare(grade, "like", 1)):
        with pytest.raises(ac.InvalidRequest):
            bad()


def test_text(table):
    name = ac.column(table, "name")
    assert table.where(ac.filter_text(name, "startswith", "ITEM 4")).count() == 5
    assert table.where(ac.filter_text(name, "endswith", "_%")).count() == 25  # wildcards in the value are active
    assert table.where(ac.filter_text(name, "contains", None)).count() == 25  # NULL acts as '', NULL names drop
    assert table.where(ac.transform_text(name, "toupper") == "ITEM 7%").count() == 1
    with pytest.raises(ac.InvalidRequest):
        ac.filter_text(name, "matches", "x")


def test_dates(spark, table):
    day = ac.column(table, "day")
    assert table.where(ac.filter_compare(day, "eq", ac.date_literal("2026-01-05"))).count() == 2
    assert table.where(ac.date_part(day, "day") == 5).count() == 2
    (moment,) = spark.range(1).select(ac.date_literal("2026-01-31T10:00:00-03:00")).first()
    assert moment == datetime(2026, 1, 31, 10)
    with pytest.raises(ac.InvalidRequest):
        ac.date_literal("soon")


def test_projection_puts_id_first(table):
    assert ac.select_columns(table, ["name"]).columns == ["id", "name"]
    assert ac.select_columns(table, ["name", "id"]).columns == ["name", "id"]
    with pytest.raises(ac.InvalidRequest):
        ac.select_columns(table, ["name", "secret"])


def test_key_pages_cover_everything_once(table):
    seen, after = [], None
    while True:
        page = [r.id for r in ac.page_by_key(table, after, page_size=20).collect()]
        seen += page
        after = ac.next_token(page[-1] if page else None, len(page), page_size=20)
        if after is None:
            break
    assert seen == list(range(1, 51))


def test_page_limits(table):
    assert ac.page_by_key(table, top=0).count() == 0 and ac.next_token(None, 0, top=0) is None
    assert ac.next_token(20, 20, top=20, page_size=20) is None and ac.next_token(20, 20, top=30, page_size=20) == 20
    texts = table.select(F.format_string("k%02d", "id").alias("id"))
    assert [r.id for r in ac.page_by_key(texts, "k48", page_size=20).collect()] == ["k49", "k50"]
    ordered = ac.page_by_offset(table, [("grade", "desc"), ("value", "asc")], top=3, skip=9)
    assert [r.id for r in ordered.collect()] == [50, 2, 8]  # ten NULL grades lead, as in the served database
    with pytest.raises(ac.InvalidRequest):
        ac.page_by_offset(table, [("grade", "sideways")])


def test_preview_says_when_there_is_more(table):
    cut, whole = ac.bounded_preview(table, 10).collect(), ac.bounded_preview(table, 50).collect()
    assert len(cut) == 10 and all(r.truncated for r in cut)
    assert len(whole) == 50 and not any(r.truncated for r in whole)
    assert len(ac.bounded_preview(table, 0).collect()) == 1


def test_wire_values(spark):
    df = spark.sql(
        "select cast(1.50 as decimal(9,2)) d, timestamp_ntz'2001-02-03 04:05:06.7' t, date'2001-02-03' e, X'0AFF' b, "
        "interval '26:03:04' hour to second i, cast(null as date) n, 'x' s"
    )
    assert json.loads(ac.wire_json(df).first()[0]) == {
        "d": 1.5, "t": "2001-02-03T04:05:06Z", "e": "2001-02-03", "b": "0aff", "i": "26:03:04", "n": None, "s": "x",
    }


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "c"), (None, "c"), (3, None)], "id int, kind string")
    count = lambda c: c.first()["violations"]
    assert count(dq.dq_unique(df, "id")) == 1
    assert count(dq.dq_not_null(df, "id")) == 2
    assert count(dq.dq_unique_combo(df, ["id", "kind"])) == 1
    assert count(dq.dq_accepted_values(df, "kind", ["a"])) == 2
    dq.require(dq.dq_unique(df, "id", "warn"))
    with pytest.raises(dq.CheckFailed, match="unique:id: 1"):
        dq.require(dq.publish_key_check(df))


def deep(spark, count):
    """Rows with NULLs and many ties in what they are ordered by."""
    rng = random.Random(2)
    kinds = [(i, rng.choice([None, 1.5, float("nan"), 2.5]), rng.choice([None, date(2001, 1, 1), date(2001, 5, 2)]), rng.choice(["a", "b", None])) for i in range(count)]
    rng.shuffle(kinds)
    return spark.createDataFrame(kinds, "id long, grade double, day date, name string").repartition(7)


@pytest.mark.parametrize("order", [[], [("grade", "desc"), ("day", "asc")], [("day", "desc"), ("name", "desc"), ("grade", "asc")], [("id", "desc")]])
def test_deep_pages_equal_the_whole_order(spark, monkeypatch, order):
    monkeypatch.setattr(ac, "RANGES", 6)
    df = deep(spark, 3000).cache()
    keys = [ac._sorted(name, way == "asc") for name, way in order] + [F.col("id").asc()]
    want = [r.id for r in df.orderBy(*keys).collect()]
    for skip, top in [(0, 10), (55, 30), (1000, 25), (1499, 1), (2950, 200), (2999, 5), (3000, 5), (10_000, 5)]:
        assert [r.id for r in ac.page_by_offset(df, order, top=top, skip=skip, gathered=60).collect()] == want[skip : skip + top], (skip, top)
    df.unpersist()


def test_times_as_borders(spark):
    df = spark.range(900).select("id", F.timestamp_micros(F.col("id") % 300 * 1_500_001).alias("at"))
    for kind in ("timestamp", "timestamp_ntz"):
        page = ac.page_by_offset(df.withColumn("at", F.col("at").cast(kind)), [("at", "desc")], top=4, skip=601, gathered=50)
        assert [r.id for r in page.collect()] == [399, 699, 98, 398]


def test_ids_that_repeat_still_give_a_page(spark):
    assert ac.page_by_offset(spark.range(400).select(F.lit(7).alias("id")), top=10, skip=300, gathered=50).count() == 10


def test_a_page_five_million_rows_down_meets_in_no_task(spark):
    df = spark.range(6_000_000).select((F.lit(6_000_000) - F.col("id")).alias("id"), (F.col("id") % 1000).alias("group"))
    order = [("group", True), ("id", True)]
    part, skip = ac._range_of_page(df, order, 5_000_000, 20)
    assert skip + 20 <= ac.GATHERED and part.count() < 2 * ac.GATHERED + 6_000_000 // 20
    page = ac.page_by_offset(df, [("group", "asc")], top=20, skip=5_000_000).collect()
    # 6,000 rows a group; group 833 from row 4,998,000 on
    assert [r.group for r in page] == [833] * 20
    ids = sorted(6_000_000 - i for i in range(833, 6_000_000, 1000))
    assert [r.id for r in page] == ids[2000:2020]


def test_checks_in_one_pass_equal_the_single_ones(spark):
    rows = [(1, "a", None), (1, "a", None), (2, "", "x"), (3, None, "x"), (None, None, ""), (None, "null", "y"), (4, "a", "y")]
    df = spark.createDataFrame(rows, "id int, name string, kind string").repartition(4)
    single = dq.all_checks(
        dq.dq_unique(df, "id"), dq.dq_not_null(df, "id", "warn"), dq.dq_unique_combo(df, ["name", "kind"]),
        dq.dq_accepted_values(df, "kind", ["x"]), dq.dq_unique(df, "name", "warn"),
    )
    fused = dq.in_one_pass(
        df, dq.Check("unique", ("id",)), dq.Check("not_null", ("id",), severity="warn"), dq.Check("unique_combo", ("name", "kind")),
        dq.Check("accepted_values", ("kind",), ("x",)), dq.Check("unique", ("name",), severity="warn"),
    )
    assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, single.collect()))
    assert [r.violations for r in dq.in_one_pass(df.limit(0), dq.Check("unique", ("id",)), dq.Check("not_null", ("id",))).collect()] == [0, 0]
    plan = dq.in_one_pass(df, dq.Check("unique", ("id",)), dq.Check("unique_combo", ("name", "kind")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1 and plan.count("Exchange hashpartitioning") == 1
