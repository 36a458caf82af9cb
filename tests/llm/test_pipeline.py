"""The pipeline against the plain versions of its stages, one after the other, over whole tables."""

from __future__ import annotations

from collections import defaultdict

import check
import corpus_pipeline
import pytest
from corpus import MIDDLE, NORMAL, contaminated, fingerprint, frame, linked, lower, table, without_repeats, words
from test_mixing import targets

from tillstone.llm.sql import SQL


def cut(docs: dict[int, str | None], n: int = 20) -> dict[int, list[str]]:
    seen, out = set(), {}
    for doc in sorted(docs):
        w = words(docs[doc])
        gone = set()
        for i in range(len(w) - n + 1):
            window = tuple(w[i : i + n])
            if window in seen:
                gone |= set(range(i, i + n))
            seen.add(window)
        out[doc] = [x for i, x in enumerate(w) if i not in gone]
    return out


def without_hits(text: str, items: list[tuple]) -> str:
    found = list(NORMAL.finditer(lower(text)))
    w, hit = [x[0] for x in found], set()
    for _, item in items:
        parts = NORMAL.findall(lower(item or ""))
        windows = {tuple(parts[i : i + 13]) for i in range(max(1, len(parts) - 12) if parts else 0)}
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
    out, at = [], 0
    for i, x in enumerate(found):
        if i in hit:
            start = x.start() if i - 1 not in hit else at
            out.append(text[at:start] if i - 1 not in hit else "")
            at = x.end()
    return "".join(out) + text[at:]


def expected(folder: str) -> tuple[dict[int, list[str]], dict[int, str]]:
    """Words left per document after the first four stages, and the sources."""
    rows = {r["doc_id"]: r for r in table(folder, "documents")}
    cursor = check.connect(folder).execute(SQL["op2_quality"])
    at = [c[0] for c in cursor.description].index("kept")
    good = {r[0] for r in cursor.fetchall() if r[at]}
    root = linked({i: fingerprint(rows[i]["text"]) for i in good})
    left = cut({i: rows[i]["text"] for i in good if root[i] == i})
    items = [(r["item_id"], r["text"]) for r in table(folder, "benchmark")]
    verdicts = contaminated([(i, " ".join(w)) for i, w in left.items()], items)
    bad = {i for i, _, _, _, dirty in verdicts if dirty}
    partly = {i for i, _, hit, _, dirty in verdicts if hit and not dirty}
    clean = {i: words(without_hits(" ".join(w), items)) if i in partly else w for i, w in left.items() if i not in bad}
    return clean, {i: rows[i]["source"] for i in clean}


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "substring_dedup", "decontamination", "mix",
    ]


def test_whole_pipeline(spark):
    clean, source = expected(MIDDLE)
    rows = corpus_pipeline.run(spark, MIDDLE).collect()
    by_source = defaultdict(int)
    for i, w in clean.items():
        by_source[source[i]] += len(w)
    names = sorted(by_source)
    aims = dict(zip(names, targets([by_source[n] for n in names]), strict=True))
    assert len({r.doc_id for r in rows}) == len(rows)
    taken = defaultdict(int)
    for r in rows:
        assert words(r.text) == clean[r.doc_id] and r.size == len(clean[r.doc_id])
        assert (r.source_size, r.n_chars) == (by_source[r.source], len(r.text))
        assert r.target == pytest.approx(aims[r.source]) and 0 < r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert {n: t for n, t in taken.items()} == {n: round(aims[n]) for n in names if round(aims[n])}
    assert {i for i, w in clean.items() if w and aims[source[i]] >= by_source[source[i]]} <= {r.doc_id for r in rows}
    first = [r.positions[0] for r in rows]
    assert first == sorted(first)


def test_filtering_stages_keep_columns_and_take_odd_tables(spark, tmp_path):
    spark.createDataFrame([("i", "a b")], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    odd = frame(spark, [(1, None), (None, text), (2, ""), (3, text), (3, text), (4, "x " * 30_000)])
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.dtypes == docs.dtypes
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).columns[: len(docs.columns)] == docs.columns


def test_a_task_runs_one_python_worker(spark):
    """Workers of one task hold their memory at once, and stay with the executor when the next stage begins."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    plan = corpus_pipeline.decontamination(spark, docs, MIDDLE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_brute_force_agrees_with_itself():
    docs = {1: "a b c", 2: "x " + "a b c", 3: None}
    assert cut(docs, 3) == {1: ["a", "b", "c"], 2: ["x"], 3: []}
    assert [r[2] for r in without_repeats([(k, v) for k, v in docs.items()], 3)] == [0, 3, 0]
