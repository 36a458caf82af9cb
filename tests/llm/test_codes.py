from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from corpus import SMALL, table
from pyspark.errors import PythonException

from tillstone.llm import codes, queries
from tillstone.llm.sql import SQL

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows: list[tuple], parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[list[tuple], list]:
    """(id, code, error, label) of the kept rows and the codebooks, all in Python's integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts if kept else 0
    piece = lambda v, p: v[p * width : (p + 1) * width]
    books = [[piece(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for step in range(rounds + 1):
        chosen = [[min((far(piece(v, p), c), k) for k, c in enumerate(books[p])) for p in range(parts)] for _, v, _ in kept]
        if step == rounds:
            break
        for p in range(parts):
            for k in range(len(books[p])):
                own = [piece(v, p) for (_, v, _), c in zip(kept, chosen, strict=True) if c[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, "".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c), label) for (i, _, label), c in zip(kept, chosen, strict=True)]
    return found, books


def made(seed: int, count: int, width: int = 8) -> list[tuple]:
    """Rows in groups, with repeated vectors, ids and labels, nulls and vectors that can't be used."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(12)]
    rows = []
    for i in range(count):
        v = [float(np.float32(x + rng.gauss(0, rng.choice([0, 0.001, 0.05])))) for x in rng.choice(centres)]
        if rng.random() < 0.02:
            v[rng.randrange(width)] = rng.choice([None, math.nan, math.inf, -math.inf])
        rows.append((rng.choice([i, i, i, i // 2, None]), None if rng.random() < 0.02 else v, rng.choice([None, 1, 1, 1, 2, 3])))
    return rows


def coded(spark, rows, partitions=3, **settings):
    df, books = codes.compressed(spark.createDataFrame(rows, SCHEMA).repartition(partitions), **settings)
    found = codes.with_label_error(df).collect()
    return sorted(((r.vec_id, r.code.hex(), r.code_error, r.label) for r in found), key=str), books, found


@pytest.mark.parametrize(("seed", "count", "settings"), [(1, 300, {"entries": 16, "cells": 400, "leaf": 4}), (2, 200, {"entries": 256, "leaf": 2}), (3, 120, {"entries": 5, "rounds": 2, "leaf": 1, "parts": 2}), (4, 30, {"leaf": 32}), (5, 700, {"entries": 64, "leaf": 8})])
def test_like_brute_force(spark, seed, count, settings):
    rows = made(seed, count)
    got, books, found = coded(spark, rows, **settings)
    want, want_books = brute(rows, **{k: v for k, v in settings.items() if k not in ("cells", "leaf")})
    assert books.tolist() == want_books
    assert got == sorted(want, key=str)
    for label in (None, 1, 2, 3):
        total = sum(error for _, _, error, one in want if one == label)
        assert {r.label_error for r in found if r.label == label} <= {total}


def test_more_partitions_than_a_task_reads(spark, monkeypatch):
    monkeypatch.setattr(codes, "FAN", 3)
    rows = made(6, 250)
    got, books, _ = coded(spark, rows, partitions=40, entries=10)
    assert books.tolist() == brute(rows, entries=10)[1]
    assert len(got) == len(brute(rows, entries=10)[0])


@pytest.mark.parametrize("seed", range(12))
def test_assignment_of_trees(seed):
    """Against all pairs, on tight groups, where whole nodes are assigned, and on ties."""
    rng = np.random.default_rng(seed)
    width, size = int(rng.integers(1, 6)), int(rng.integers(1, 900))
    spread = int(rng.choice([1, 3, 50, 100_000]))
    centres = rng.integers(-1000, 1000, (9, width)) * spread
    rows = (centres[rng.integers(0, 9, size)] + rng.integers(-3, 4, (size, width))).astype(np.int32)
    book = centres[rng.integers(0, 9, int(rng.integers(1, 257)))] + rng.integers(-20, 21, (1, width))
    tree, entries = codes.Tree.of(rows, 4), codes.Entries.of(book)
    code, sums, counts = codes.assigned(tree, entries)
    far = ((tree.rows[:, None].astype(np.int64) - book[None]) ** 2).sum(2)
    want = far.argmin(1)
    assert code.tolist() == want.tolist()
    assert counts.tolist() == np.bincount(want, minlength=len(book)).tolist()
    for k in range(len(book)):
        assert sums[k].tolist() == tree.rows[want == k].sum(0).tolist()


def test_whole_nodes_are_assigned_by_their_sums(monkeypatch):
    rng = np.random.default_rng(0)
    book = np.array([[0, 0], [10_000, 0], [0, 10_000], [10_000, 10_000]])
    rows = (book[rng.integers(0, 4, 5000)] + rng.integers(-50, 50, (5000, 2))).astype(np.int32)
    monkeypatch.setattr(codes, "nearest", lambda *a: pytest.fail("a leaf was compared"))
    tree = codes.Tree.of(np.concatenate([rows[(rows > 5000).dot([1, 2]) == k][:1024] for k in range(4)]), 32)
    code, _, counts = codes.assigned(tree, codes.Entries.of(book))
    assert counts.tolist() == [1024] * 4
    assert np.abs(tree.rows - book[code]).max() <= 50


def test_large_numbers_are_compared_exactly():
    rows = np.array([[(1 << 26) - 1] * 3, [-(1 << 26) + 1] * 3], np.int32)
    book = np.array([[(1 << 26) - 1, (1 << 26) - 1, (1 << 26) - 3], [(1 << 26) - 1, (1 << 26) - 2, (1 << 26) - 1], [0, 0, 0]])
    assert codes.nearest(rows, np.ones((2, 3), bool), book).tolist() == [1, 2]


def test_one_vector_a_third_of_all_and_clashing_columns(spark):
    v = [0.5] * 8
    rows = [(i, v if i % 3 else [i / 1000] * 8, None) for i in range(600)]
    got, _, _ = coded(spark, rows, partitions=5, entries=32)
    assert got == sorted(brute(rows, entries=32)[0], key=str)
    df = spark.createDataFrame([(1, "x", [1.0, 2.0, 3.0, 4.0], "old", 9)], "id int, `0` string, v array<double>, code string, parts int")
    found = codes.compressed(df, "id", "v")[0].collect()
    assert [(r.id, r["0"], r.parts, r.code.hex(), r.code_error) for r in found] == [(1, "x", 9, "00000000", 0)]


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1), (2, [1.0, None, 1.0, 1.0], 1)]):
        df, books = codes.compressed(spark.createDataFrame(rows, SCHEMA))
        assert codes.with_label_error(df).count() == 0
        assert books.shape[:2] == (4, 0)


@pytest.mark.parametrize("other", [[1.0] * 4, [], [1.0] * 7, [70_000.0] * 8])
def test_vectors_that_cannot_be_cut_fail(spark, other):
    with pytest.raises((PythonException, ValueError)):
        coded(spark, [(1, [1.0] * 8, 1), (2, other, 1)], partitions=1)


def test_query(spark, tmp_path):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table(SMALL, "embeddings")]
    want, books = brute(rows)
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    totals: dict = {}
    for _, _, error, label in want:
        totals[label] = totals.get(label, 0) + error
    got = sorted(tuple(r) for r in queries.op13_codes(spark, SMALL).collect())
    assert got == sorted((i, code, error, totals[label], digest) for i, code, error, label in want)


def test_query_of_odd_rows_like_sql(spark, tmp_path):
    spark.createDataFrame(made(9, 700), SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({SQL['op13_codes']})").fetchall()
    got = [tuple(r) for r in queries.op13_codes(spark, str(tmp_path)).select(*names).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
