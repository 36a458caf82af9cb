from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus import MIDDLE, frame, lower, table, token_counts, words

from tillstone.llm import queries, scoring


def held(doc) -> bool:
    return zlib.crc32(str(doc).encode()) % 7 == 2


def check(rows, docs):
    """Everything but the score is fixed: compare with plain counting."""
    counted = token_counts([text for i, text in docs if i is not None and not held(i)])
    total, distinct = sum(counted.values()), len(counted)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in rows), key=str)
    want, base = [], {}
    for i, text in docs:
        sequence = [*words(lower(text or "")), ""]
        want.append((i, i is not None and held(i), len(sequence), sum(t in counted for t in sequence), total))
        base[(i, len(sequence))] = sum(math.log10((counted[t] + 1) / (total + distinct + 1)) for t in sequence)
    assert got == sorted(want, key=str)
    for r in rows:
        assert r.base_score == pytest.approx(base[(r.doc_id, r.n_tokens)], rel=1e-9)
        assert -math.inf < r.score < 0


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(MIDDLE, "documents")]
    rows = queries.op10_scoring(spark, MIDDLE).collect()
    check(rows, docs)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)  # the context helps


def test_rare_tokens_are_joined(spark, monkeypatch):
    monkeypatch.setattr(scoring, "HEAD", 5)
    monkeypatch.setattr(scoring, "WORDS", 3)
    docs = [(i, " ".join(f"w{(i * k) % 41}" for k in range(30))) for i in range(80)]
    check(scoring.scored(frame(spark, docs), scoring.is_held_out()).collect(), docs)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "A a É"), (3, "A a É"), (None, "a b"), (4, "z " * 50_000), (5, "x" * 100_000)]
    check(scoring.scored(frame(spark, docs), scoring.is_held_out()).collect(), docs)
    assert scoring.scored(frame(spark, docs).limit(0), scoring.is_held_out()).count() == 0
    alone = [(i, "a b") for i in range(200) if held(i)][:3]
    check(scoring.scored(frame(spark, alone), scoring.is_held_out()).collect(), alone)


def test_probabilities_sum_to_one():
    head = [(b"the", 50), (b"of", 20), (scoring.END, 10)]
    words_ = scoring.Vocabulary(head, {0: (30, 12), 7: (5, 5)}, 115, 20)
    network = scoring.Network.start(words_.noise)
    network.weights += np.random.default_rng(1).normal(0, 0.3, len(network.weights)).astype(np.float32)
    before = np.array([[0, 0], [1, 2], [500, 3]])
    assert np.exp(network.log_probabilities(before)).sum(1) == pytest.approx(1, abs=1e-4)


def test_training_learns_what_follows_what():
    """A cycle of three words: after each, the network gives the next most of the probability."""
    head = [(b"a", 100), (b"b", 100), (b"c", 100), (scoring.END, 1)]
    vocabulary = scoring.Vocabulary(head, {}, 301, 4)
    network = scoring.Network(scoring.Network.start(vocabulary.noise).weights.copy(), vocabulary.classes)
    classes = np.array([1, 2, 3] * 1000)
    before = scoring._contexts(classes, np.array([0, len(classes)]))
    squares, rng = np.zeros_like(network.weights), np.random.default_rng(0)
    for low in range(2, 2900, 100):
        for _ in range(4):
            network.learn(before[low : low + 100], classes[low : low + 100], vocabulary.noise, squares, rng)
    chances = np.exp(network.log_probabilities(np.array([[1, 3], [2, 1], [3, 2]])))
    assert (chances[[0, 1, 2], [2, 3, 1]] > 0.9).all()


def test_every_document_trains_the_network(spark):
    """What follows what is learnt from any document, whatever its id hashes to."""
    texts = [(i, " ".join("abc"[(i + k) % 3] for k in range(300))) for i in range(700)]
    some = frame(spark, texts).where("pmod(xxhash64(doc_id), 1000) >= 100")
    unseen = [r for r in scoring.scored(some, scoring.is_held_out()).collect() if r.held_out]
    assert unseen and all(r.score > 0.8 * r.base_score for r in unseen)


def test_words_in_groups_have_probabilities_of_their_own(spark, monkeypatch):
    """The vocabulary grows with the corpus; both levels sum to one; words that end alike are told apart."""
    head = [(f"w{i}".encode(), 2000 - i) for i in range(900)] + [(scoring.END, 10)]
    total = sum(n for _, n in head) + 1000
    words_ = scoring.Vocabulary(head, {3: (1000, 500)}, total, 1401)
    number = {t: int(words_.numbers[i]) for t, i in words_.places.items()}
    covered = sum(n for t, n in head if number[t] >= words_.classes or number[t] <= scoring.WORDS)
    assert covered >= scoring.COVERED * total and len(words_.noise) - words_.classes > 200
    network = scoring.Network(scoring.Network.start(words_.noise).weights, words_.classes)
    before = np.array([[0, 0], [len(words_.noise) - 1, 2]])
    chances = np.exp(network.log_probabilities(before))
    assert chances.sum(1) == pytest.approx(1, abs=1e-4)
    low, sums = words_.classes, 0
    while low < network.rows:
        high = min(low + network.size, network.rows)
        assert (network.class_of(np.arange(low, high)) == network.first + sums).all()
        assert np.exp(network.log_probabilities(before, low, high)).sum(1) == pytest.approx(1, abs=1e-4)
        low, sums = high, sums + 1
    assert network.first + sums == network.classes

    monkeypatch.setattr(scoring, "WORDS", 2)
    cycle = [f"{c}zz" for c in "abcdefghijkl"]
    texts = [(i, " ".join(cycle[(i + k) % 12] for k in range(400))) for i in range(1500)]
    unseen = [r for r in scoring.scored(frame(spark, texts), scoring.is_held_out()).collect() if r.held_out]
    assert unseen and sum(r.score for r in unseen) > 0.6 * sum(r.base_score for r in unseen)


def test_scores_are_the_two_level_softmax_by_hand(spark):
    """Every token of every text: its class among all, its word among its group's, or its share of the rest of its class."""
    rng = np.random.default_rng(8)
    word = lambda: f"w{int(1500 * rng.random() ** 2)}"
    docs = frame(spark, [(i, " ".join(word() for _ in range(int(rng.integers(0, 90))))) for i in range(150)] + [(900, None)]).coalesce(1)
    got = {r.doc_id: r.score for r in scoring.scored(docs, scoring.is_held_out()).collect()}
    learnt = docs.select("doc_id", scoring.is_held_out().alias("held_out"), "text").where("not held_out")
    counted = scoring.counts(learnt)
    known, words_ = {bytes(r.token): r.n for r in counted.collect()}, scoring.vocabulary(counted)
    network = scoring.Network(scoring.train(learnt, words_), words_.classes)
    assert network.rows > network.classes + 50  # there are groups

    def softmax(vector, low, high, at):
        scores = (network.out[low:high] @ vector + network.bias[low:high]).astype(float)
        return scores[at - low] - np.log(np.exp(scores - scores.max()).sum()) - scores.max()

    for row in docs.collect():
        total, before = 0.0, [0, 0]
        for token in scoring.tokens(row.text):
            at = words_.places.get(token)
            number = int(words_.numbers[at]) if at is not None else words_.ending(token)
            vector = network.into[before[0]] * network.place[0] + network.into[before[1]] * network.place[1]
            if number >= network.classes:
                group = (number - network.classes) // network.size
                low = network.classes + group * network.size
                total += softmax(vector, 0, network.classes, network.first + group)
                total += softmax(vector, low, min(low + network.size, network.rows), number)
            else:
                total += softmax(vector, 0, network.classes, number)
                if words_.endings <= number < network.first:
                    total += math.log(10) * (math.log10(known.get(token, 0) + 1) + words_.inside[number])
            before = [number, before[0]]
        assert got[row.doc_id] == pytest.approx(total / math.log(10), rel=1e-4, abs=1e-3), row.doc_id


def test_scores_are_worked_on_in_small_blocks(monkeypatch):
    """Whatever the block, and however large the scores: the same as all at once."""
    rng = np.random.default_rng(4)
    network = scoring.Network.start(np.full(300, 1 / 300))
    network.weights += rng.normal(0, 0.5, len(network.weights)).astype(np.float32)
    before, which, chosen = rng.integers(0, 300, (70, 2)), rng.integers(0, 70, 500), rng.integers(0, 300, 500)
    for scale in (1, 40):
        network.out[:] *= scale
        for low, high in ((0, 300), (100, 120)):
            mine = np.clip(chosen, low, high - 1)
            want = network.log_probabilities(before, low, high)[which, mine - low]
            for hot in (1, 1000, 1 << 20):
                monkeypatch.setattr(scoring, "HOT", hot)
                assert network.of_contexts(before, which, mine, low, high) == pytest.approx(want, rel=1e-4, abs=1e-3)


def test_contexts_are_normalised_by_what_each_token_gives(monkeypatch):
    """Exponentials are taken per token, not per context: kept, worked out by block, and in full where digits would be lost."""
    rng = np.random.default_rng(6)
    network = scoring.Network.start(np.full(300, 1 / 300))
    network.weights += rng.normal(0, 0.5, len(network.weights)).astype(np.float32)
    before = np.unique(rng.integers(0, 300, (900, 2)), axis=0)
    which, chosen = rng.integers(0, len(before), 2000), rng.integers(0, 300, 2000)
    taken, exp = [], np.exp
    for scale, lost in ((1, False), (40, True)):
        network.out[:] *= scale
        want = network.log_probabilities(before)[which, chosen]
        for kept in (1, 300 * 40, 300 * 300):
            for hot in (1, 5000):
                monkeypatch.setattr(scoring, "KEPT", kept)
                monkeypatch.setattr(scoring, "HOT", hot)
                network._hot = None
                assert network.of_classes(before, which, chosen) == pytest.approx(want, rel=1e-4, abs=1e-3)
                assert network.log_sums(before)[1].any() == (lost or kept < 300 * 299)
    network.out[:] /= 40
    network._hot = None
    monkeypatch.setattr(scoring.np, "exp", lambda x, **more: (taken.append(x.size), exp(x, **more))[1])
    network.of_classes(before, which, chosen)
    assert 0 < sum(taken) <= 2 * 300 * 300 < len(before) * 300


def test_words_are_cut_as_tokens_are():
    texts = [None, "", "  a  B ", "\ta\x0b\x0c b\r\n", "x\x1cy\x85 z\u3000w\x00", " ", "É A", "a"]
    for column in (pa.array(texts), pa.array(["left out", *texts]).slice(1), pa.array(texts, pa.large_string())):
        found, count = scoring._words(column)
        flat = iter(found.to_pylist())
        assert [[*(next(flat) for _ in range(n)), scoring.END] for n in count.tolist()] == [scoring.tokens(t) for t in texts]
    assert scoring._words(pa.array([], pa.string()))[1].tolist() == []
