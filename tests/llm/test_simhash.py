from __future__ import annotations

import random

import numpy as np
import pytest
from corpus import MIDDLE, fingerprint, frame, linked, table

from tillstone.llm import queries, simhash


def found(df, **settings):
    rows = simhash.near_duplicates(df, **settings).withColumn("hex", simhash.as_hex("print")).collect()
    return sorted((r.doc_id, r.hex, r.component_id) for r in rows)


def expected(docs):
    prints = {i: fingerprint(text) for i, text in docs}
    root = linked(prints)
    return [(i, f"{prints[i]:016x}", root[i]) for i, _ in sorted(docs)]


def test_query(spark):
    rows = sorted(tuple(r) for r in queries.op4_simhash(spark, MIDDLE).collect())
    assert rows == expected([(r["doc_id"], r["text"]) for r in table(MIDDLE, "documents")])


def test_near_copies_and_odd_texts(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(200)}" for _ in range(300)]
    docs = [(0, None), (1, ""), (2, " \n"), (3, "One"), (4, "one"), (5, "one two three"), (6, "é" * 50_000)]
    for i in range(10, 60):
        copy = list(base)
        for _ in range(i % 6):
            copy[rng.randrange(len(copy))] = "changed"
        docs.append((i, " ".join(copy)))
    assert found(frame(spark, docs)) == expected(docs)


def test_empty_table_repeated_rows_and_missing_ids(spark):
    assert found(frame(spark, []).limit(0)) == []
    rows = simhash.near_duplicates(frame(spark, [(3, "a b"), (3, "a b"), (None, "a b"), (None, "alone in the world")])).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.component_id) for r in rows if r.component_id) == [
        (False, 3, 3), (False, 3, 3), (True, None, 3)]
    assert [r.doc_id for r in rows if r.component_id is None] == [None]


def test_one_of_each_group_stays(spark):
    docs = frame(spark, [(3, "a b"), (3, "a b"), (4, "a b"), (9, "other text"), (None, "a b")])
    kept = simhash.one_of_each(docs, simhash.near_duplicates(docs))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, "a b"), (9, "other text")]
    assert kept.columns == docs.columns


def test_repeated_and_missing_ids_are_told_apart_by_their_texts(spark):
    """A clean text under a repeated id stays, copies without an id go but for one, and reruns agree."""
    first, second, third = ("alpha beta gamma delta " * 5, "one two three four five six", "some quite different words stand in this one")
    rows = [(1, first), (1, second), (2, first), (2, second), (None, third), (None, third), (None, third + "!"), (None, first), (7, "seven"), (7, "seven")]
    kept = []
    for parts in (1, 5):
        docs = frame(spark, rows).repartition(parts)
        kept.append(sorted(((r.doc_id, r.text) for r in simhash.one_of_each(docs, simhash.near_duplicates(docs)).collect()), key=str))
    assert kept[0] == kept[1]
    texts = [t for _, t in kept[0]]
    assert sorted(texts) == sorted({first, second, "seven"} | {t for t in texts if t.startswith(third)}) and len(texts) in (4, 5)
    assert [i for i, t in kept[0] if t in (first, second, "seven")].count(1) == 2
    assert sum(t == third for t in texts) <= 1


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 5, "x"), (2, "a b", 6, "y")], "doc_id long, text string, print int, least string")
    assert [(r.doc_id, r.component_id) for r in sorted(simhash.near_duplicates(df).collect())] == [(1, 1), (2, 1)]


@pytest.mark.parametrize("spread", [3, 12, 64])
def test_trie_join_links_what_all_pairs_link(spread):
    """Dense and sparse sets: the forest's trees are the components of all pairs."""
    rng = np.random.default_rng(spread)
    base = rng.integers(0, 1 << 63, 8, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, min(spread, 51), (600, 6)).astype(np.uint64)
    values = base[rng.integers(0, 8, 600)] ^ np.bitwise_xor.reduce(flips, axis=1)
    values = np.unique((values & np.uint64((1 << 51) - 1)) | np.uint64(5 << 51))
    a, b = simhash.trie_join(values, np.array([0, len(values)]), 51, 4)
    assert len(a) < len(values)
    assert (np.bitwise_count(values[a] ^ values[b]) <= 4).all()
    roots = linked({i: int(v) for i, v in enumerate(values)})
    forest = simhash.Forest(len(values))
    forest.link(a, b)
    assert forest.label.tolist() == [roots[i] for i in range(len(values))]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (450, 500)], "a long, b long")
    rows = {r.node: r.root for r in simhash.components(edges).collect()}
    assert rows == {i: 0 for i in range(201)} | {400: 400, 450: 400, 500: 400}


@pytest.mark.parametrize("crowded", [0, 5])
def test_crowded_blocks_are_dealt_anew(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64) * np.uint64(2)
    flips = np.uint64(1) << rng.integers(0, 64, (500, 5)).astype(np.uint64)
    kept = rng.random((500, 5)) < 0.5
    values = np.unique(base[rng.integers(0, 12, 500)] ^ np.bitwise_xor.reduce(np.where(kept, flips, 0).astype(np.uint64), axis=1))
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "print long")
    got = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(prints).collect()}
    assert all(0 < (a ^ b).bit_count() <= 4 for a, b in got)
    want = linked({int(v): int(v) for v in values})
    root = {int(v): int(v) for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in got:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {v: find(v) for v in root} == want
