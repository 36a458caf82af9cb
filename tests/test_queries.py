"""Every registered query against its SQL, over the whole tables of the smallest scale factor."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import check
from conftest import SMALL
from tillstone.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_sql(spark, duck, name):
    good, text = check.compare(spark, duck, SMALL, name)
    assert good, text


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert "margin_final" in df.columns and df.limit(1).count() == 1
