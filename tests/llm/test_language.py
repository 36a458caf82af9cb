from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from corpus import MIDDLE, frame, table

from tillstone.llm import language, queries


def test_query_is_right_on_held_out_documents(spark):
    rows = {r.doc_id: r for r in queries.op7_language(spark, MIDDLE).collect()}
    docs = table(MIDDLE, "documents")
    assert len(rows) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1]
    assert {d["doc_id"] for d in held} == {i for i, r in rows.items() if r.held_out}
    right = sum(rows[d["doc_id"]].lang_pred == d["lang"] for d in held)
    assert right / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def learnt(spark):
    rng = random.Random(4)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(400))
    return {"aa": "abcde", "bb": "fghij", "cc": "éßñkl"}, make


def test_mixtures_of_languages(spark):
    letters, make = learnt(spark)
    model = language.learn(frame(spark, [(i, make(letters[name]), name, "s") for i, name in enumerate(letters)]))
    mixed = " ".join(make(letters["aa"]).split()[:100] + make(letters["bb"]).split()[:300])
    docs = frame(spark, [(1, mixed, None, "s"), (2, make(letters["cc"]), None, "s")])
    got = {r.doc_id: r for r in language.identified(docs, model, language.is_held_out()).collect()}
    assert got[1].lang_pred == "bb" and got[1].score == pytest.approx(0.75, abs=0.02)
    assert (got[2].lang_pred, got[2].score) == ("cc", 1)


def test_odd_texts_and_ids(spark):
    letters, make = learnt(spark)
    model = language.learn(frame(spark, [(i, make(letters[name]), name, "s") for i, name in enumerate(letters)]))
    docs = [(1, None), (2, ""), (3, "123 !? €"), (4, "é"), (4, "é"), (None, "abc"), (5, "fghij " * 100_000), (6, "\u4e2d")]
    got = [(r.doc_id, r.lang_pred, r.score, r.held_out) for r in language.identified(frame(spark, docs), model, language.is_held_out()).collect()]
    by_id = {g[0]: g for g in got}
    assert len(got) == 8
    assert all(by_id[i][1:3] == ("und", 0) for i in (1, 2, 3))
    assert by_id[4][1] == "cc" and by_id[5][1] == "bb" and by_id[None][1] == "aa" and by_id[None][3]
    assert by_id[6][1] in letters


def test_nothing_to_learn_from(spark):
    model = language.learn(frame(spark, [(1, None, "en", "s"), (2, "text", None, "s")]))
    docs = frame(spark, [(1, "text")])
    assert language.identified(docs, model, language.is_held_out()).first().lang_pred == "und"
    assert language.identified(docs.limit(0), model, language.is_held_out()).count() == 0


def test_expectation_maximisation_never_lowers_the_likelihood():
    rng = np.random.default_rng(0)
    likelihood, first = rng.random((500, 4)).astype(np.float32), np.array([0, 3, 200, 500])
    start = np.full((3, 4), 0.25, np.float32)
    fits = [language._mixture(likelihood, first, start, rounds)[1] for rounds in range(8)]
    assert all((b >= a - 1e-3).all() for a, b in zip(fits, fits[1:], strict=False))


def test_every_language_is_learnt(spark):
    """Two hundred languages, each of four letters of its own; the last of them has one document only."""
    rng = random.Random(6)
    letters = [[chr(0x4E00 + 4 * i + k) for k in range(4)] for i in range(200)]
    make = lambda i: " ".join("".join(rng.choice(letters[i]) for _ in range(4)) for _ in range(60))
    learnt_from = [(i, make(i), f"l{i:03}", "s") for i in range(200)] + [(200 + i, make(i), f"l{i:03}", "s") for i in range(199)]
    model = language.learn(frame(spark, learnt_from))
    assert len(model.languages) == 200
    docs = frame(spark, [(i, make(i), None, "s") for i in range(200)])
    got = {r.doc_id: r.lang_pred for r in language.identified(docs, model, language.is_held_out()).collect()}
    assert got == {i: f"l{i:03}" for i in range(200)}


def test_a_mixture_of_five_languages(spark):
    rng = random.Random(8)
    letters = {"aa": "abcd", "bb": "efgh", "cc": "ijkl", "dd": "mnop", "ee": "qrst", "ff": "uvwx"}
    make = lambda name, n: ["".join(rng.choice(letters[name]) for _ in range(5)) for _ in range(n)]
    model = language.learn(frame(spark, [(i, " ".join(make(name, 400)), name, "s") for i, name in enumerate(letters)]))
    mixed = make("cc", 120) + [word for name in ("aa", "bb", "dd", "ee") for word in make(name, 70)]
    got = language.identified(frame(spark, [(1, " ".join(mixed), None, "s")]), model, language.is_held_out()).first()
    assert got.lang_pred == "cc" and got.score == pytest.approx(0.3, abs=0.02)
