from __future__ import annotations

import json
import random

import numpy as np
import public_tokenizers
import pytest
from corpus import MIDDLE, SMALL, frame, table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillstone.llm import queries, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(texts: list[str | None]) -> list[int]:
    return [len(e.ids) for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def counted(texts: list[str], tables: dict | None = None) -> list[int]:
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(d) for d in data])
    return tokens.counts(np.frombuffer(b"".join(data), np.uint8), offsets, tables or dict(tokens.compiled(PATH))).tolist()


ALPHABETS = ["ab '\nst", "'reveslltmd I", "<|endoftext|> a", "αβγ 12٣   x!?", "é漢字🙂 \t\r\n.,' \u0085", "aaaaaaab", "ABCabc123 --''", " ​　\x1c\x00"]


def drawn(seed: int) -> list[str]:
    rng, out = random.Random(seed), []
    for _ in range(60):
        letters = rng.choice(ALPHABETS)
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 80)))
        if rng.random() < 0.2:
            text += "<|endoftext|>" + text[:5] + "<|endoftext|><|endoftext|>"
        if rng.random() < 0.3:
            points = [rng.choice([rng.randrange(1, 0x300), rng.randrange(0x300, 0xD800), rng.randrange(0xE000, 0x110000)]) for _ in range(60)]
            text += "".join(map(chr, points))
        out.append(text)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_like_the_library(seed):
    texts = drawn(seed)
    assert counted(texts) == expected(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(texts):
    assert counted(texts) == expected(texts)


def test_every_token_of_the_vocabulary_and_pairs_of_them():
    with open(PATH, encoding="utf-8") as file:
        names = list(json.load(file)["model"]["vocab"].items())
    spelled = [LIBRARY.decode([number]) for _, number in names]
    rng = random.Random(3)
    texts = spelled + [rng.choice(spelled) + rng.choice(spelled) for _ in range(20_000)]
    assert counted(texts) == expected(texts)


@pytest.mark.parametrize("chunk", [1, 2, 7, 128, 4096])
def test_cuts_do_not_depend_on_the_chunks(chunk):
    symbol = np.random.default_rng(chunk).integers(0, 20, 3000).astype(np.uint8)
    state, cut = tokens.cutter()
    now, want = 0, []
    for s in symbol:
        want.append(bool(cut[s, now]))
        now = state[s, now]
    assert tokens.cuts(symbol, chunk).tolist() == want


def test_a_full_table_starts_anew_and_long_pieces_stay_linear():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(20_000)), "a" * 200_001, " " * 100_000 + "x", "!" * 99_999]
    tables = dict(tokens.compiled(PATH))
    tables["counter"] = tokens.Counter(tables, states=50)
    assert counted(texts, tables) == expected(texts)
    assert len(tables["counter"].entries) <= 51


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \n\t "), (4, "word " * 50_000), (None, "it's <|endoftext|> we'll"), (5, "é"), (5, "é")]
    rows = tokens.token_counts(frame(spark, docs).repartition(3), PATH).collect()
    got = sorted(((r.doc_id, r.token_bytes, r.token_count) for r in rows), key=str)
    want = [(d, len((t or "").encode()), n) for (d, t), n in zip(docs, expected([t for _, t in docs]), strict=True)]
    assert got == sorted(want, key=str)


def test_empty_tables_and_clashing_columns(spark):
    assert tokens.token_counts(frame(spark, []).limit(0), PATH).count() == 0
    df = spark.createDataFrame([("a b", 7, "n"), (None, 8, "m")], "text string, token_count int, `0` string")
    rows = tokens.token_counts(df, PATH).collect()
    assert sorted((r["0"], r.token_count, r.token_bytes) for r in rows) == [("m", 0, 0), ("n", 2, 3)]
    assert rows[0].__fields__ == ["text", "0", "token_bytes", "token_count"]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="plain"):
        tokens.compiled(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_query(spark, folder):
    docs = table(folder, "documents")
    want = {d["doc_id"]: n for d, n in zip(docs, expected([d["text"] for d in docs]), strict=True)}
    rows = queries.op12_tokens(spark, folder).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == want
    assert len(rows) == len(docs)
    sizes = {d["doc_id"]: len((d["text"] or "").encode()) for d in docs}
    assert all(r.over_limit == (r.n_tokens > 512) and r.n_bytes == sizes[r.doc_id] for r in rows)
