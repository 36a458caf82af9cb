from __future__ import annotations

import re

from corpus import frame, words

from tillstone.llm import quality


def base(text: str | None) -> tuple:
    text = text or ""
    w = words(text)
    windows: dict[tuple, list[int]] = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    repeated = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [line for line in text.split("\n") if words(line)]
    counts = (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
    return (*counts, len(w) < 20 or 100 * len(repeated) > 30 * len(w))


def found(df):
    rows = quality.judged(df).collect()
    return {r.doc_id: tuple(r[c] for c in [*quality.STATISTICS, "quality_base_failed"]) for r in rows}


GOOD = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))


def test_statistics_like_brute_force(spark):
    texts = [
        None, "", " \n\t ", "one", "a\n\na\n b\nb \na", "é" * 10, GOOD, GOOD + " " + GOOD, "x " * 400, GOOD.upper(),
        "a b c d e f g h i a b c d e f g h j", "#$% & <b> | * one\x0btwo\x1cthree", "\n".join([GOOD] * 3),
        " ".join(f"{i % 5000}" for i in range(20_000)), "a b c d e f g h " * 2 + GOOD,
    ]
    docs = list(enumerate(texts))
    assert found(frame(spark, docs)) == {i: base(text) for i, text in docs}


def test_each_rule_rejects_its_kind(spark):
    stutter = " ".join(w for w in GOOD.split() for _ in range(3))
    bad = {
        "symbols": " ".join(w + "$$" for w in GOOD.split()),
        "word_length": GOOD.replace(" ", "-"[:0] + "abcdefgh "),
        "duplicate_lines": "\n".join(["same old line here"] + ["same old line here", "other"] * 15 + GOOD.split()[:20]),
        "capitals": GOOD.upper(),
        "spelt_words": " ".join(f"{i * 7919 % 99991}" for i in range(150)),
        "stutter": stutter,
    }
    df = frame(spark, [(i, text) for i, text in enumerate([GOOD, *bad.values()])])
    kept = {r.doc_id: (r.quality_base_failed, r.quality_kept) for r in quality.judged(df).collect()}
    assert kept[0] == (False, True)
    named = {name: kept[i] for i, name in enumerate(bad, 1)}
    assert {name for name, (_, k) in named.items() if k} == set()
    assert {rule.name for rule in quality.rules()} == set(bad)


def test_order_changes_nothing_but_speed(spark):
    df = frame(spark, [(1, GOOD), (2, GOOD.upper()), (3, "a " * 50), (4, GOOD.replace(" ", " # "))])
    given = quality.judged(df, cascade=quality.rules()).collect()
    turned = quality.judged(df, cascade=quality.rules()[::-1]).collect()
    assert sorted(given) == sorted(turned) == sorted(quality.judged(df).collect())


def test_order_is_by_rejection_per_work(spark):
    many = [(i, " ".join(w + "$$" for w in GOOD.split())) for i in range(30)] + [(99, GOOD.upper())]
    names = [rule.name for rule in quality.order(frame(spark, many))]
    assert names[:2] == ["symbols", "capitals"] and len(names) == len(quality.rules())


def test_empty_table_and_clashing_columns(spark):
    assert quality.judged(frame(spark, []).limit(0)).count() == 0
    df = spark.createDataFrame([(None, GOOD, "k"), (None, GOOD, "k")], "doc_id long, text string, quality_kept string")
    assert [r.quality_kept for r in quality.judged(df).collect()] == [True, True]


def test_no_python_in_the_plan(spark):
    plan = quality.judged(frame(spark, [(1, GOOD)]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Exchange"))
