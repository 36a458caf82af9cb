from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from corpus import SMALL, frame, table, words

from tillstone.llm import periods, queries


def brute(w: list[str], shortest: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, every lag of every word."""
    found: dict[tuple[int, int], int] = {}
    for p in range(1, len(w) // times + 1):
        size = 0
        for i in range(p, len(w) + 1):
            if i < len(w) and w[i] == w[i - p]:
                size += 1
                continue
            if size + p >= max(shortest, times * p):
                found.setdefault((i - size - p, size + p), p)
            size = 0
    return sorted((start, length, p) for (start, length), p in found.items())


def collapsed(w: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for start, length, p in runs for i in range(start + p, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc: int | None, w: list[str]) -> list[str]:
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]


def digest(doc: int | None, text: str | None) -> tuple:
    w = planted(doc, words(text))
    runs = brute(w)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (
        doc, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs).encode()).hexdigest(),
    )


def made(seed: int) -> str:
    """Texts over few words, with nested and touching repetitions."""
    rng = random.Random(seed)
    out: list[str] = []
    while len(out) < rng.randrange(1, 250):
        part = [rng.choice("abcde"[: rng.choice([1, 2, 3, 5])]) for _ in range(rng.randrange(1, 30))]
        out += (part * 9)[: rng.randrange(len(part), 7 * len(part) + 1)] if rng.random() < 0.7 else part
        if rng.random() < 0.2:
            out += out[-rng.randrange(1, 40) :] * rng.randrange(1, 6)
    return "\n".join(out)


def told(spark, docs, **settings):
    rows = periods.periodic_runs(frame(spark, docs), **settings).collect()
    return {r.doc_id: (r.run_words, [tuple(x) for x in r.runs], r.run_text) for r in rows}


@pytest.mark.parametrize(("shortest", "times"), [(6, 4), (2, 4), (15, 5)])
def test_like_brute_force(spark, shortest, times):
    docs = [(i, made(i + 1000 * shortest)) for i in range(150)]
    found = told(spark, docs, shortest=shortest, times=times)
    for doc, text in docs:
        w = words(text)
        runs = brute(w, shortest, times)
        assert found[doc] == (len(w), runs, collapsed(w, runs)), text


def test_levels_are_disjoint_and_leave_no_period_out():
    for shortest, times in [(6, 4), (2, 4), (40, 4), (9, 7)]:
        seen = [q for low, high, _ in periods.levels(4000, shortest, times) for q in range(low, high + 1)]
        assert seen == list(range(1, len(seen) + 1))
        assert len(seen) >= 4000 // times


def test_odd_rows(spark):
    long = " ".join(f"w{i % 70_000}" for i in range(300_000))
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (6, "x " * 200_000), (7, long), (None, "é é é é é é b")]
    found = told(spark, docs)
    assert [found[i] for i in (1, 2, 3)] == [(0, [], "")] * 3
    assert found[4] == (5, [], "a a a a a")
    assert found[5] == (6, [(0, 6, 1)], "a")
    assert found[6] == (200_000, [(0, 200_000, 1)], "x")
    assert found[7] == (300_000, [(0, 300_000, 70_000)], " ".join(f"w{i}" for i in range(70_000)))
    assert found[None] == (7, [(0, 6, 1)], "é b")


def test_empty_tables_clashing_columns_and_repeated_rows(spark):
    assert periods.periodic_runs(frame(spark, []).limit(0)).count() == 0
    df = spark.createDataFrame([(1, "a a a a a a", 3, "n", "old")] * 2, "doc_id long, text string, runs int, `0` string, run_text string")
    rows = periods.periodic_runs(df).collect()
    assert [(r["0"], [tuple(x) for x in r.runs], r.run_text) for r in rows] == [("n", [(0, 6, 1)], "a")] * 2


def test_query_on_planted_texts(spark):
    got = {r.doc_id: tuple(r) for r in queries.op11_periods(spark, SMALL).collect()}
    docs = table(SMALL, "documents")
    assert len(got) == len(docs)
    assert sum(r[1] > 0 for r in got.values()) > len(docs) // 30
    for row in docs:
        if len(words(row["text"])) < 2000:
            assert got[row["doc_id"]] == digest(row["doc_id"], row["text"])


def test_query_of_odd_rows(spark, tmp_path):
    docs = [(i, made(i)) for i in range(40)] + [(None, "a b " * 9), (40, None), (41, ""), (42, "one")]
    frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in queries.op11_periods(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((digest(*d) for d in docs), key=str)
