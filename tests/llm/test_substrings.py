from __future__ import annotations

import random

import numpy as np
import pytest
from corpus import MIDDLE, frame, table, without_repeats

from tillstone.llm import queries, substrings
from tillstone.llm.automaton import SuffixAutomaton
from tillstone.llm.words import Words


def found(df):
    cut = substrings.without_repeats(df)
    return sorted((r.doc_id, r.cut_words, r.cut_removed, r.cut_sha256) for r in cut.collect())


def passages(seed: int, count: int = 60) -> list[tuple]:
    """Few words, shared passages of all lengths, one common line, copies and repetitions inside a text."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    shared = [[word() for _ in range(rng.randrange(15, 60))] for _ in range(6)]
    line = [word() for _ in range(21)]
    docs = []
    for i in range(count):
        text = [word() for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            part = rng.choice(shared)
            a = rng.randrange(len(part))
            text += part[a : a + rng.randrange(10, 60)] + [word() for _ in range(rng.randrange(8))]
        if i % 3 == 0:
            text = line + text
        if i % 7 == 0:
            text += ["same"] * rng.randrange(50)
        docs.append((i, rng.choice([" ", "\n", "  \t"]).join(text)))
    return docs + [(count, docs[0][1]), (count + 1, docs[3][1] + " and more")]


@pytest.mark.parametrize("seed", range(4))
def test_like_brute_force(spark, seed):
    docs = passages(seed)
    assert found(frame(spark, docs)) == without_repeats(docs)


def test_crowded_shards_are_dealt_by_window(spark, monkeypatch):
    monkeypatch.setattr(substrings, "LARGEST", 1)
    docs = passages(9)
    assert found(frame(spark, docs)) == without_repeats(docs)


def test_nulls_empties_long_and_short(spark):
    long = " ".join(f"v{i % 7919}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, long), (6, long), (7, "x" * 300_000), (8, "é " * 25)]
    assert found(frame(spark, docs)) == without_repeats(docs)


def test_repeated_rows_keep_their_text(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = found(frame(spark, [(1, text), (1, text), (2, text)]))
    assert [(r[0], r[2]) for r in rows] == [(1, 0), (1, 0), (2, 30)]


def test_rows_without_id_come_last(spark):
    text = " ".join(f"w{i}" for i in range(30))
    cut = substrings.without_repeats(frame(spark, [(None, text), (5, text), (None, "other words")])).collect()
    assert {(r.doc_id, r.cut_removed) for r in cut} == {(None, 30), (5, 0), (None, 0)}


def test_empty_table_and_clashing_columns(spark):
    assert substrings.without_repeats(frame(spark, []).limit(0)).count() == 0
    text = " ".join(f"w{i}" for i in range(25))
    own = "doc_id long, text string, key string, spans int, cut_words string, place double"
    df = spark.createDataFrame([(1, text, "a", 1, "b", 0.5), (2, text + " end", "c", 2, "d", None)], own)
    rows = sorted(substrings.without_repeats(df).collect())
    assert [(r.doc_id, r.text, r.key, r.spans, r.place, r.cut_words, r.cut_removed) for r in rows] == [
        (1, text, "a", 1, 0.5, 25, 0),
        (2, "end", "c", 2, None, 26, 25),
    ]


def test_what_is_left_keeps_its_white_space(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = sorted(substrings.without_repeats(frame(spark, [(1, passage), (2, f"a\n\nb {passage}\nc  d")])).collect())
    assert rows[1].text == "a\n\nb c  d"


def test_query(spark):
    rows = sorted(tuple(r) for r in queries.op9_substrings(spark, MIDDLE).collect())
    assert rows == without_repeats([(r["doc_id"], r["text"]) for r in table(MIDDLE, "documents")])


def test_automaton_matches():
    rng = random.Random(3)
    texts = [[bytes([97 + rng.randrange(3)]) for _ in range(rng.randrange(1, 30))] for _ in range(8)]
    automaton = SuffixAutomaton()
    for text in texts[:6]:
        automaton.add(text)
    known = {tuple(t[i:j]) for t in texts[:6] for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for text in texts:
        _, lengths = automaton.matching(text)
        for at, length in enumerate(lengths, 1):
            assert length == max(k for k in range(at + 1) if not k or tuple(text[at - k : at]) in known)


def test_words_are_those_of_bytes_split():
    raw = "é a b\x0bc  d\x1ce".encode()
    words = Words.of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert words.text(0, len(words.start)).split(b" ") == raw.split()
    assert len(set(words.hashes().tolist())) == len(raw.split())
