"""What the physical plans must (not) contain, whatever the data size."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import MIDDLE, SMALL
from tillstone.functions.relational import dedup_latest
from tillstone.plans.job import Job
from tillstone.plans.overlays import Sources


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Plan as on large inputs: nothing counts as small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(
    "name",
    [
        "stg_sales_item", "closing_stock", "position_before_month", "opening_stock", "asof_cost", "reference_branch_cost",
        "sales_by_month", "item_base", "item_weight", "allocate_to_items", "item_margin", "allocate_expenses", "slip_tolerance_match",
        "slip_reconciliation", "card_reconciliation", "already_present", "window_sync", "insert_absent_null_equal", "dim_sync",
    ],
)
def test_no_pairwise_joins_on_large_inputs(spark, large, name):
    sources = Sources(spark, SMALL)
    sources.title_document, sources.card_document  # noqa: B018 - landed before
    plan = physical(contract.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_dedup_cuts_groups_before_the_shuffle(spark):
    plan = physical(dedup_latest(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], [F.col("id").desc()]))
    partial, exchange = plan.rindex("WindowGroupLimit"), plan.rindex("Exchange")
    assert partial > exchange, plan  # printed from the top: the partial limit runs below the shuffle


def test_columns_and_filters_reach_the_scan(spark):
    plan = physical(contract.queries()["filtered_count"](spark, SMALL))
    assert re.search(r"PushedFilters: \[.*Not\(EqualTo\(o_orderstatus,F\)\)", plan)
    assert re.search(r"ReadSchema: struct<o_orderstatus:string>", plan)
    page = physical(contract.queries()["page_by_offset"](spark, SMALL))
    assert "TakeOrderedAndProject" in page
    narrow = physical(contract.queries()["source_projection"](spark, SMALL))
    assert "text:string" not in narrow


def above(plan: str, at: int) -> str:
    """The operators between the root of a plan and the line at ``at``: its ancestors only."""
    lines = plan[:at].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    now, path = depth(plan[plan.rindex("\n", 0, at) + 1 : plan.index("\n", at)]), []
    for line in reversed(lines[:-1] if plan[at - 1] != "\n" else lines):
        if depth(line) < now:
            path.append(line)
            now = depth(line)
    return "\n".join(path)


def test_stock_laid_out_by_product_is_not_shuffled(spark, large):
    """From the stored validity up, neither the as-of join, nor the stack of facts, nor the joins above it shuffle."""
    for name, scans in (("opening_stock", 2), ("reference_branch_cost", 2), ("item_base", 5)):
        plan = physical(contract.queries()[name](spark, SMALL))
        found = [m.start() for m in re.finditer("FileScan parquet spark_catalog.default.laid_out", plan)]
        assert len(found) == scans, (name, len(found))
        for at in found:
            assert "Exchange" not in above(plan, at), above(plan, at)


def test_facts_are_shuffled_once_more_after_their_month(spark, large):
    plan = physical(contract.queries()["item_base"](spark, SMALL))
    dealt = re.findall(r"Exchange hashpartitioning\((product_code#\d+L), \d+\), REPARTITION_BY_NUM", plan)
    assert len(dealt) == 5  # four facts and the inventories
    assert not any("month" in keys and "branch_id" in keys for keys in exchanges(plan[: plan.index("Union")]))


def test_tolerance_match_groups_are_bounded(spark):
    """The only windows run over (value, due date) rows already reduced to one per value and day."""
    plan = physical(contract.queries()["slip_tolerance_match"](spark, SMALL))
    assert plan.count("Window [") == 2 and "Join" in plan


@pytest.fixture
def small_limit(spark):
    """Plan as if only settled lists and marts were small: 256 KB, far below the facts."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)


def test_small_dimensions_cost_the_facts_no_shuffle(spark, small_limit):
    sources = Sources(spark, MIDDLE)
    sources.title_document, sources.card_document  # noqa: B018 - landed before
    for name in ("expenses", "title_rollup"):
        keys = " ".join(exchanges(physical(contract.queries()[name](spark, MIDDLE))))
        assert not re.search("account_plan|cost_centre|company_tax_id|company_digits", keys), (name, keys)


def test_items_are_not_shuffled_by_department(spark, small_limit):
    plan = physical(contract.queries()["allocate_to_items"](spark, SMALL))
    assert not any("department" in keys for keys in exchanges(plan)), exchanges(plan)


def test_card_history_is_cut_before_the_group(spark, large):
    plan = physical(contract.queries()["card_reconciliation"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(sale_date", plan)


def test_documents_are_parsed_once_when_they_land(spark):
    sources = Sources(spark, SMALL)
    sources.title_document, sources.card_document  # noqa: B018 - landed before
    for name in ("flatten_titles", "flatten_cards"):
        assert physical(contract.queries()[name](spark, SMALL)).count("from_json(") == 1, name
    readers = (
        "stg_title_allocation", "stg_card_allocation", "title_rollup", "purchase_reconciliation", "history_mode", "expenses",
        "card_reconciliation", "slip_reconciliation", "simples_rate",
    )
    for name in readers:
        plan = physical(contract.queries()[name](spark, SMALL))
        assert "from_json" not in plan and "get_json_object" not in plan and "payload" not in plan, name


def test_documents_are_not_stored_again_with_their_columns(spark):
    """Titles and cards are shuffled and kept without the documents, which lie where they landed."""
    sources = Sources(spark, SMALL)
    for columns in (Job(sources).titles, Job(sources).cards):
        assert "payload" not in columns.columns and "lines" in columns.columns
    for documents in (sources.title_document, sources.card_document):
        assert documents.inputFiles() and all(".zstd." in f for f in documents.inputFiles())


def test_stock_by_month_is_not_grouped(spark, large):
    """Months are expanded last: an item's months are neither grouped, sorted nor shuffled."""
    plan = physical(contract.queries()["opening_stock"](spark, SMALL))
    assert "Generate explode" in plan and "Aggregate(keys=[month" not in plan
    keys = physical(contract.queries()["active_keys"](spark, SMALL))
    top = keys[: keys.index("Generate explode")]
    assert "Exchange" not in top and "Aggregate" not in top


def test_months_of_titles_and_cards_are_pruned(spark):
    sources = Sources(spark, SMALL)
    sources.title_document, sources.card_document  # noqa: B018 - landed before
    cards = physical(contract.queries()["card_reconciliation"](spark, SMALL))
    assert re.search(r"PartitionFilters: \[[^\]]*sale_month#\d+ >= 2000-12-01", cards)
    invoices = physical(contract.queries()["purchase_reconciliation"](spark, SMALL))
    assert re.search(r"PartitionFilters: \[[^\]]*coalesce\(\(issue_month#\d+ >= 2001-05-01\), false\)", invoices)


def test_a_queue_asks_for_its_titles_only(spark):
    sources = Sources(spark, SMALL)
    sources.title_document, sources.card_document  # noqa: B018 - landed before
    for name in ("already_present", "queue_dispatch"):
        plan = physical(contract.queries()[name](spark, SMALL))
        scans = [line for line in plan.splitlines() if "FileScan" in line and "party_document" in line and "titles" in line]
        assert "LeftSemi" in plan and scans
