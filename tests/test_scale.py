"""Plans of the monthly marts on sessions that were made elsewhere, and what they keep in memory."""

from __future__ import annotations

import re
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import SMALL
from test_plans import above, physical
from tillstone.operators import expenses as ex
from tillstone.plans import session
from tillstone.plans.job import Job
from tillstone.plans.overlays import Sources

START, AS_OF, MONTH = date(2001, 1, 1), date(2001, 3, 31), date(2001, 2, 1)
BOOKED = "date date, branch_id int, expense_group string, account_plan string, department string, party string, direct boolean, value decimal(18,2)"
WEIGHTS = "month date, branch_id int, department string, department_share decimal(18,8)"


@pytest.fixture
def plain(spark):
    """A session as Spark makes it, on inputs of which nothing is small enough to broadcast."""
    plain = {"spark.sql.requireAllClusterKeysForCoPartition": "true", "spark.sql.sources.fileCompressionFactor": "1.0"}
    names = [*plain, "spark.sql.autoBroadcastJoinThreshold"]
    before = {name: spark.conf.get(name) for name in names}
    for name, value in (plain | {names[-1]: "-1"}).items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def test_items_by_month_are_neither_shuffled_nor_sorted_for_joins(plain):
    plan = physical(contract.queries()["item_base"](plain, SMALL))
    found = [m.start() for m in re.finditer("FileScan parquet spark_catalog.default.laid_out", plan)]
    assert len(found) == 5
    for at in found:
        assert "Exchange" not in above(plan, at) and "SortMergeJoin" not in above(plan, at), above(plan, at)
    assert plan[: plan.index("Union")].count("ShuffledHashJoin") == 4


def test_small_files_of_many_rows_are_not_broadcast(plain, tmp_path):
    plain.range(100_000).withColumn("k", F.col("id") % 7).write.parquet(f"{tmp_path}/t")
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    plain.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2 * size))
    join = lambda: physical(plain.range(10_000_000).join(plain.read.parquet(f"{tmp_path}/t"), "id"))
    assert "BroadcastHashJoin" in join()
    Sources(plain, SMALL)
    assert "BroadcastHashJoin" not in join()


def test_products_are_dealt_into_more_parts_as_they_grow(spark):
    daily = Job(Sources(spark, SMALL)).daily
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.parts(daily) == least < session.parts(daily, 1 << 10)
    assert session.dealt(daily, "product_code", count=31).rdd.getNumPartitions() == 31


def test_expenses_are_read_once_and_shuffled_before_they_are_spread(spark, rows, tmp_path):
    day = date(2001, 2, 20)
    spark.createDataFrame(
        [
            (day, 1, "G", "p", None, "x", False, D("100.00")),
            (day, 1, "G", "p", None, "x", False, D("100.00")),  # comes twice, counts twice
            (day, 1, None, "p", None, None, False, None),
            (day, None, "G", "p", "B", "x", True, D("7.00")),
            (day, 1, "G", "p", "B", "x", None, D("9.00")),  # neither direct nor indirect
            (date(2000, 5, 1), 1, "G", "p", "B", "x", True, D("9.00")),
        ],
        BOOKED,
    ).write.parquet(f"{tmp_path}/booked")
    weights = spark.createDataFrame([(MONTH, 1, "A", D("0.33333333")), (MONTH, 1, None, None)], WEIGHTS)
    booked = spark.read.parquet(f"{tmp_path}/booked")
    spread, third = ex.allocate_expenses(booked, weights, START, AS_OF), D("33.3333")
    assert spread.columns == [c for c in ex.EXPENSE_KEY if c not in ("department", "party")] + ["party", "department", "allocated"]
    assert rows(spread, "branch_id", "department", "allocated") == rows(
        spark.createDataFrame(
            [(1, "A", third), (1, "A", third), (1, "A", None), (1, None, None), (1, None, None), (1, None, None), (None, "B", D(7))],
            "branch_id int, department string, allocated decimal(22,4)",
        )
    )
    assert physical(spread).count("FileScan") == 1
    mart = ex.expense_mart(ex.allocate_expenses(booked, weights, START, AS_OF, session.dealt))
    assert rows(mart) == rows(ex.expense_mart(spread))
    plan = physical(mart)
    assert "Exchange" not in plan[: plan.index("Generate explode")]


def test_the_departments_read_what_the_items_have_settled(spark):
    job = Job(Sources(spark, SMALL))
    assert job.at_hand("monthly_purchases") is job.monthly_purchases
    settled = job.settled_monthly_purchases
    assert job.at_hand("monthly_purchases") is settled
