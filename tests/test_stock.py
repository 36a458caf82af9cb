from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tillstone.functions.relational import asof_last
from tillstone.operators import stock as sk

DAILY = (
    "branch_id int, product_code bigint, date date, quantity decimal(18,4), cost decimal(18,4), "
    "breakage_quantity decimal(18,4), breakage_value decimal(18,2)"
)
INVENTORY = (
    "branch_id int, inventory_id int, reference_date date, processed boolean, zeroes_uncounted boolean, "
    "product_code bigint, counted_quantity decimal(18,4), counted boolean"
)
START, AS_OF = date(2001, 1, 1), date(2001, 4, 20)


@pytest.fixture
def daily(spark):
    from decimal import Decimal

    def build(*rows):
        return spark.createDataFrame(
            [(b, p, d, Decimal(q), None if c is None else Decimal(c), None, None) for b, p, d, q, c in rows], DAILY
        )

    return build


def test_last_positive_cost_is_null_before_the_first(daily):
    v = sk.stock_validity(
        daily((1, 1, date(2001, 1, 5), 1, 0), (1, 1, date(2001, 1, 9), 2, 7), (1, 1, date(2001, 2, 9), 3, 0), (1, 1, date(2001, 3, 9), 3, None))
    )
    found = [(r.next_date, r.positive_cost) for r in v.orderBy("date").collect()]
    assert [f[0] for f in found] == [date(2001, 1, 9), date(2001, 2, 9), date(2001, 3, 9), None]
    assert found[0][1] is None and [int(f[1]) for f in found[1:]] == [7, 7, 7]


def test_a_day_delivered_twice_stops_every_reader(daily):
    v = sk.stock_validity(daily((1, 1, date(2001, 1, 5), 1, 0), (1, 1, date(2001, 1, 5), 2, 7), (1, 2, date(2001, 1, 5), 2, 7)))
    for reader in (sk.position_before_month(v, START, AS_OF), sk.closing_stock(v, START, AS_OF), v.select("positive_cost", "date")):
        with pytest.raises(Exception, match="day delivered twice: 1 1 2001-01-05"):
            reader.collect()


def test_what_is_known_before_the_first_row_counts(spark, daily):
    known = daily((1, 1, date(2001, 1, 5), 1, 0), (1, 1, date(2001, 2, 5), 1, None), (1, 1, date(2001, 3, 5), 1, 2))
    known = known.withColumn("positive_cost", F.when(F.col("date") == "2001-01-05", F.lit(9).cast("decimal(18,4)")))
    assert [int(r.positive_cost) for r in sk.stock_validity(known).orderBy("date").collect()] == [9, 9, 2]


def test_month_boundaries(daily, rows):
    """A row dated on the 1st opens the next month only; a row whose next date is the 1st still opens that month."""
    v = sk.stock_validity(daily((1, 1, date(2001, 1, 31), 10, 1), (1, 1, date(2001, 2, 1), 20, 1), (1, 1, date(2001, 2, 28), 30, 1)))
    opening = rows(sk.position_before_month(v, START, AS_OF).select("month", F.col("quantity").cast("int")))
    closing = rows(sk.closing_stock(v, START, AS_OF).select("month", F.col("quantity").cast("int")))
    assert opening == [(date(2001, 2, 1), 10), (date(2001, 3, 1), 30), (date(2001, 4, 1), 30)]
    assert closing == [(date(2001, m, 1), q) for m, q in ((1, 10), (2, 30), (3, 30), (4, 30))]


def test_closing_of_the_current_month_is_as_of_today(daily, rows):
    v = sk.stock_validity(daily((1, 1, date(2001, 4, 10), 1, 1), (1, 1, date(2001, 4, 25), 2, 1)))
    assert rows(sk.closing_stock(v, START, AS_OF), "month", "position_date") == [(date(2001, 4, 1), date(2001, 4, 10))]


def test_expansion_equals_the_range_join(spark, daily, rows):
    random.seed(3)
    days = [START + timedelta(days=i) for i in range(-90, 160)]
    made = {(random.randint(1, 3), random.randint(1, 4), random.choice(days)) for _ in range(120)}
    v = sk.stock_validity(daily(*[(b, p, d, random.randint(0, 9), random.randint(0, 3)) for b, p, d in made]))
    calendar = sk.month_calendar(spark, START, AS_OF)
    before = calendar.join(v, F.expr("date < month and (next_date is null or next_date >= month)"))
    end = calendar.join(v, F.expr("date <= month_end and (next_date is null or next_date > month_end)"))
    key = ("month", "branch_id", "product_code", "date")
    out = ("month", "branch_id", "product_code", "position_date")
    assert rows(sk.position_before_month(v, START, AS_OF), *out) == rows(before, *key)
    assert rows(sk.closing_stock(v, START, AS_OF), *out) == rows(end, *key)


def test_inventory_wins_even_with_a_null_cost(spark, daily):
    from decimal import Decimal

    v = sk.stock_validity(daily((1, 1, date(2001, 1, 10), 50, 5), (1, 2, date(2001, 3, 1), 9, 4)))
    inventory = spark.createDataFrame(
        [
            (1, 12, date(2001, 2, 4), True, False, 1, Decimal(7), True),
            (1, 11, date(2001, 2, 3), True, False, 1, Decimal(6), True),  # the first in days 1..5 counts
            (1, 13, date(2001, 3, 6), True, False, 1, Decimal(5), True),  # day 6: too late
            (1, 14, date(2001, 2, 2), True, True, 2, None, False),  # not counted, zeroing: 0, no stock row yet
            (1, 15, date(2001, 3, 2), False, True, 1, Decimal(1), True),  # not processed
        ],
        INVENTORY,
    )
    o = {(r.month.month, r.product_code): r for r in sk.opening_stock(inventory, v, START, AS_OF).collect()}
    assert (o[2, 1].origin, int(o[2, 1].quantity), int(o[2, 1].position_quantity)) == ("inventory", 6, 50)
    assert o[2, 1].stock_date == date(2001, 2, 3) and int(o[2, 1].cost) == 5
    assert int(o[2, 2].quantity) == 0 and o[2, 2].cost is None and o[2, 2].position_quantity is None
    assert (o[3, 1].origin, o[3, 1].stock_date) == ("position", date(2001, 2, 28))
    assert set(o) == {(2, 1), (3, 1), (4, 1), (2, 2), (4, 2)}


@pytest.mark.parametrize("unique", [False, True])
def test_asof_against_brute_force(spark, unique):
    random.seed(8)
    states = {(random.randint(1, 3), random.randint(0, 60)): random.randint(0, 99) for _ in range(60)}
    asked = [(i, random.randint(1, 4), random.randint(-5, 70)) for i in range(80)]
    if unique:
        asked = list({(k, d): (i, k, d) for i, k, d in asked}.values())
    day = lambda n: START + timedelta(days=n)
    s = spark.createDataFrame([(k, day(d), v) for (k, d), v in states.items()], "k int, at date, v int")
    p = spark.createDataFrame([(i, k, day(d)) for i, k, d in asked], "i int, k int, on date")
    got = {r.i: r.v for r in asof_last(p, "on", s, "at", ["k"], ["v"], probes_unique=unique).collect()}
    want = {}
    for i, k, d in asked:
        earlier = [(at, v) for (key, at), v in states.items() if key == k and at <= d]
        want[i] = max(earlier)[1] if earlier else None
    assert got == want


def test_zero_cost_becomes_the_last_positive(spark, daily):
    v = sk.stock_validity(daily((1, 1, date(2001, 1, 1), 1, 8), (1, 1, date(2001, 2, 1), 1, 0)))
    probes = spark.createDataFrame([(1, 1, date(2001, 2, 5)), (9, 9, date(2001, 2, 5))], "branch_id int, product_code bigint, d date")
    found = {r.branch_id: r.asof_cost for r in sk.asof_cost(probes, "d", v).collect()}
    assert int(found[1]) == 8 and found[9] is None


@pytest.fixture
def odd_stock(spark, daily):
    """Positions and inventories of a few items, with missing branches, products and days, and inventories after ``AS_OF``."""
    from decimal import Decimal

    pick = random.Random(3)
    days = lambda n: date(2000, 12, 1) + timedelta(days=n)
    items = [(b, p) for b in (1, 2, None) for p in (1, 2, 3, None)]
    seen = {(b, p, days(pick.randrange(200))) for b, p in items for _ in range(pick.randrange(7))} | {(1, 1, None), (2, 3, None)}
    v = sk.stock_validity(daily(*[(b, p, d, pick.choice([0, 5, 8]), pick.choice([None, 0, 3, 4])) for b, p, d in sorted(seen, key=str)]))
    counts = [
        (b, n, days(pick.randrange(7) + 31 * m), pick.random() < 0.9, pick.random() < 0.5, p, pick.choice([None, Decimal(0), Decimal(7)]), pick.random() < 0.7)
        for n, (b, p, m) in enumerate((b, p, m) for b, p in items for m in range(9))
    ]
    return spark.createDataFrame(counts, INVENTORY), v


def test_opening_by_spans_equals_both_sides_grouped_by_month(odd_stock, rows):
    """The sides of every item and month stacked and grouped, as the item base does, against the spans."""
    inventory, v = odd_stock
    stacked = sk.opening_sides(inventory, v, START, AS_OF)
    grouped = stacked.groupBy(*sk.ITEM_MONTH).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in sk.ITEM_MONTH])
    expected = grouped.select(
        *sk.ITEM_MONTH, *[c.alias(n) for n, c in sk.opening_columns().items()], "inventory_id", "position_quantity", "position_date"
    )
    found = sk.opening_stock(inventory, v, START, AS_OF)
    assert found.columns == expected.columns and rows(found) == rows(expected)
    assert found.where("origin = 'inventory' and position_quantity is not null").count() > 3
    assert found.where((F.col("month") > AS_OF) & (F.col("origin") == "inventory")).count() > 0


def test_stocked_spans_cover_the_months_with_stock(odd_stock, rows):
    inventory, v = odd_stock
    stocks = [sk.opening_stock(inventory, v, START, AS_OF), sk.closing_stock(v, START, AS_OF)]
    expected = stocks[0].where("quantity <> 0").select(*sk.ITEM_MONTH).union(stocks[1].where("quantity <> 0").select(*sk.ITEM_MONTH)).distinct()
    spans = sk.stocked_spans(inventory, v, START, AS_OF)
    months = F.explode(F.expr("sequence(first, last, interval 1 month)")).alias("month")
    found = spans.select("branch_id", "product_code", months).select(*sk.ITEM_MONTH).distinct()
    assert rows(found) == rows(expected)
    assert spans.count() < found.count()
