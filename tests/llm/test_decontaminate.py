from __future__ import annotations

import hashlib
import random

import pytest
from corpus import MIDDLE, contaminated, frame, table

from tillstone.llm import decontaminate, queries

ITEMS = "item_id string, text string"


def found(spark, docs, items, **settings):
    rows = decontaminate.verdict(decontaminate.matches(frame(spark, docs), frame(spark, items, ITEMS), **settings)).collect()
    return sorted(((r.doc_id, r.hit_words, r.hit_count, r.hit_items, r.contaminated) for r in rows), key=str)


def made(seed: int):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(30)}"
    items = [(str(i), " ".join(word() for _ in range(rng.choice([1, 2, 12, 13, 14, 30])))) for i in range(1, 9)]
    docs = []
    for i in range(60):
        text = [word() if rng.random() < 0.5 else f"x{rng.randrange(999)}" for _ in range(rng.randrange(60))]
        part = rng.choice(items)[1].upper().split()
        a = rng.randrange(len(part))
        docs.append((i, ", ".join(text + part[a:] + text[:3])))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_like_brute_force(spark, seed):
    docs, items = made(seed)
    assert found(spark, docs, items) == sorted(contaminated(docs, items), key=str)


@pytest.mark.parametrize("size", [40, 8])  # one pass, and several
def test_many_shards_give_the_same(spark, size):
    docs, items = made(7)
    assert found(spark, docs, items, shard_words=size) == sorted(contaminated(docs, items), key=str)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(20))
    items = [("a", text), ("a", text), (None, " ".join(f"v{i}" for i in range(15))), ("n", None), ("e", "!?"), ("c", "é ß")]
    docs = [(1, None), (2, ""), (3, "..."), (4, text), (4, text), (None, text), (5, "v " * 50_000 + text), (6, "x É ß é ß")]
    docs += [(7, "y " + " ".join(f"v{i}" for i in range(15)))]
    assert found(spark, docs, items) == sorted(contaminated(docs, items), key=str)


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark, [(1, "a b")], []) == [(1, 2, 0, [], False)]
    assert decontaminate.matches(frame(spark, []).limit(0), frame(spark, [("a", "b")], ITEMS)).count() == 0
    own = "doc_id long, text string, hit_items int, name string, w double"
    df = spark.createDataFrame([(1, "a b c", 3, "n", 0.5)], own)
    row = decontaminate.matches(df, frame(spark, [("i", "b")], ITEMS)).first()
    assert (row.name, row.w, row.hit_items, row.hit_words) == ("n", 0.5, ["i"], 3)


def test_hit_spans_are_cut_out(spark):
    passage = " ".join(f"w{i}" for i in range(13))
    docs = frame(spark, [(1, f"Before it. {passage}, after\nit."), (2, None), (3, "clean")])
    found = decontaminate.verdict(decontaminate.matches(docs, frame(spark, [("a", passage.upper())], ITEMS)))
    rows = {r.doc_id: r.text for r in decontaminate.without_hits(found).collect()}
    assert rows == {1: "Before it. , after\nit.", 2: None, 3: "clean"}


def test_query(spark):
    rows = sorted(tuple(r) for r in queries.op3_decontaminate(spark, MIDDLE).collect())
    docs = [(r["doc_id"], r["text"]) for r in table(MIDDLE, "documents")]
    want = contaminated(docs, [(r["item_id"], r["text"]) for r in table(MIDDLE, "benchmark")])
    digest = lambda names: hashlib.sha256(",".join(names).encode()).hexdigest()
    assert rows == [(d, n, hit, len(names), digest(names), bad) for d, n, hit, names, bad in want]
