"""Small tables and plain, slow versions of the operators to compare with."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow.parquet as pq
import xxhash

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"

WORD = re.compile("[^\x20\x09-\x0d]+")
NORMAL = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(folder: str, name: str) -> list[dict]:
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda found: found[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def frame(spark, rows, schema: str = DOCS):
    """Documents from (id, text) pairs, the other columns filled in; or rows as they are."""
    if schema == DOCS:
        rows = [(r[0], r[1], *(r[2:] or ("en", "a")), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(rows, schema)


def contaminated(docs: list[tuple], items: list[tuple], n: int = 13) -> list[tuple]:
    windows: dict[tuple, set] = {}
    for name, text in items:
        w = NORMAL.findall(lower(text or ""))
        for i in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(name) if name is not None else "null")
    out = []
    for doc, text in docs:
        w, hit, names = NORMAL.findall(lower(text or "")), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if found := windows.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    names |= found
        out.append((doc, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def fingerprint(text: str | None, k: int = 4) -> int:
    w = words(lower(text or ""))
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    votes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))


def linked(prints: dict[int, int], distance: int = 4) -> dict[int, int]:
    """Smallest id reachable, by id."""
    ids, root = sorted(prints), {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def without_repeats(docs: list[tuple], n: int = 20) -> list[tuple]:
    seen, out = set(), []
    for doc, text in sorted(docs):
        w = words(text)
        cut = [False] * len(w)
        for i in range(len(w) - n + 1):
            window = tuple(w[i : i + n])
            if window in seen:
                cut[i : i + n] = [True] * n
            seen.add(window)
        kept = " ".join(a for a, gone in zip(w, cut, strict=True) if not gone)
        out.append((doc, len(w), sum(cut), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def token_counts(texts: list[str | None]) -> Counter:
    return Counter(t for text in texts for t in [*words(lower(text or "")), ""])
