from __future__ import annotations

import pytest
from corpus import frame

from tillstone.llm import mixing


def targets(sizes: list[int], weights=(5, 2, 1), most=3) -> list[float]:
    """Reshares what is over, again and again."""
    total, weight = sum(sizes), [weights[i % len(weights)] for i in range(len(sizes))]
    given, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(given[i] for i in range(len(sizes)) if i not in open_)
        share = {i: left * weight[i] / sum(weight[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > most * sizes[i]}
        for i in over or open_:
            given[i] = float(most * sizes[i]) if over else share[i]
        open_ -= over or open_
    return given


@pytest.mark.parametrize("sizes", [[100, 100, 100], [5, 1000, 10, 3000], [0, 7, 0], [1000], [1, 1, 1, 1, 10_000]])
def test_targets_like_resharing(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    found = [r.target for r in sorted(mixing.targets(df).collect())]
    assert found == pytest.approx(targets(sizes))


def test_mix(spark):
    docs = [(i, "w " * (i % 17), "en", f"s{i % 3}") for i in range(300)] + [(400, None, "en", None), (401, "a b", "en", None)]
    rows = mixing.mixed(frame(spark, docs)).collect()
    assert len(rows) == 302 and sum(r.mix_size for r in rows) == sum(len((d[1] or "").split()) for d in docs)
    for source in ("s0", "s1", "s2", None):
        mine = [r for r in rows if r.source == source]
        assert {r.mix_source_size for r in mine} == {sum(r.mix_size for r in mine)}
        assert sum(r.mix_taken for r in mine) == round(mine[0].mix_target)
    for r in rows:
        assert 0 <= r.mix_taken <= 3 * r.mix_size
        assert len(r.mix_positions) == (-(-r.mix_taken // r.mix_size) if r.mix_size else 0)
        assert all(0 <= x <= 1 for x in r.mix_positions) and r.mix_positions == sorted(r.mix_positions)
    again = mixing.mixed(frame(spark, docs[::-1])).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)


def test_schedules_shape_the_order(spark):
    """A falling schedule has most of its words early, a rising one late, and words due follow the integral."""
    docs = [(i, "w w w w", "en", f"s{i % 3}") for i in range(3000)]
    rows = mixing.mixed(frame(spark, docs)).collect()
    for source, early in (("s0", 0.625), ("s1", 0.5), ("s2", 0.375)):
        places = [p for r in rows if r.source == source for p in r.mix_positions]
        assert sum(p < 0.5 for p in places) / len(places) == pytest.approx(early, abs=0.01)


def test_due_time_inverts_the_integral(spark):
    knots = (0.0, 2.0, 0.5, 0.5)
    shares = [i / 50 for i in range(51)]
    df = spark.createDataFrame([(s,) for s in shares], "s double")
    times = [r[0] for r in df.select(mixing.due_time(df.s, knots)).collect()]

    def integral(t: float) -> float:
        total, step = 0.0, 1 / 3
        for i, (a, b) in enumerate(zip(knots, knots[1:], strict=False)):
            x = min(max(t - i * step, 0), step)
            total += a * x + (b - a) / (2 * step) * x * x
        return total

    assert [integral(t) / integral(1) for t in times] == pytest.approx(shares, abs=1e-9)


def test_odd_tables(spark):
    assert mixing.mixed(frame(spark, []).limit(0)).count() == 0
    assert [r.mix_taken for r in mixing.mixed(frame(spark, [(1, None), (2, "")])).collect()] == [0, 0]
    rows = mixing.mixed(frame(spark, [(None, "a b"), (None, "a b"), (7, "c"), (7, "c")])).collect()
    assert sum(r.mix_taken for r in rows) == 6
    own = "doc_id long, text string, source string, target double, mix_size string, _source int"
    row = mixing.mixed(spark.createDataFrame([(1, "a b", "s", 0.5, "x", 3)], own)).first()
    assert (row.target, row["_source"], row.mix_size, row.mix_taken) == (0.5, 3, 2, 2)


def test_by_position_is_sorted_across_partitions(spark):
    docs = [(i, "w w", "en", f"s{i % 2}") for i in range(500)]
    rows = mixing.by_position(mixing.mixed(frame(spark, docs))).collect()
    first = [r.mix_positions[0] if r.mix_positions else 2 for r in rows]
    assert first == sorted(first) and len(rows) == 500


def test_more_buckets_give_the_same_mix(spark, monkeypatch):
    """Ids that repeat, rows without an id, and as many digits as there are."""
    docs = [(None if i % 3 == 0 else i // 2, f"w{i} " * (1 + i % 7), "en", f"s{i % 4}") for i in range(600)]
    found = []
    for rows in (4096, 1 / 16**6, 1 / 16**2):
        monkeypatch.setattr(mixing, "IN_BUCKET", rows)
        mix = mixing.mixed(frame(spark, docs)).collect()
        found.append(sorted((str(r.doc_id), r.text, r.mix_taken, r.mix_positions) for r in mix))
    assert found[0] == found[1] == found[2]
