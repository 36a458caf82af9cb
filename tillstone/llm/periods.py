"""Periodic runs: stretches of consecutive words that repeat with a small period, by an online sparse diagonal DP.

A run is a stretch with smallest period q (words q apart are identical) of at least ``max(SHORTEST, TIMES * q)`` words
that no neighbouring word extends keeping the period.

Method
    A diagonal is a lag p; its match length at a word is the number of words up to there that equal the word p before.
    Each word looks up its earlier occurrence, which increments the match length of that lag; a diagonal that is not
    incremented by the next word ends there, and emits its run at once if it is long enough. Plain occurrences of a
    frequent word would touch a number of diagonals that grows with the square of the text, so a word is looked up
    together with the words before it, as a gram. A run of period q matches at least ``TIMES * q - q`` words long, so
    diagonals of at least period a lose nothing if the gram has ``L = max(SHORTEST - 1, 3 a)`` words (with the defaults).
    For periods up to ``(L + 2) / 2`` only the nearest earlier occurrence counts: were there one at a smaller lag p,
    the gram would have both periods, and by Fine and Wilf their common divisor too, and q would not be smallest. So
    every level of periods (1-3, 4-7, 8-13, ... each about 1.6 times the one before) has one active diagonal per word.
    The levels are disjoint, and n words cost n log n however often they repeat.

Plan: one narrow pass, no shuffle. A task holds a slice of about a megabyte of text, or one longer text.

Defined results
    Null and empty texts have no words and no run. Rows are judged one by one, so repeated rows and ids don't matter. Words
    and grams are compared by 64-bit hashes, and every run's words once more by the words' hashes, pair by pair. Columns of
    the result named like those of the input replace them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.words import Words, mix64, slices

SHORTEST = 6
TIMES = 4

RESULT = "run_words long, runs array<struct<start:long, length:long, period:long>>, run_text string"
_WORD = r"[^\x20\x09-\x0D]+"


def levels(longest: int, shortest: int = SHORTEST, times: int = TIMES) -> Iterator[tuple[int, int, int]]:
    """(first period, last period, words of a gram) of each level that a text of ``longest`` words can have runs in."""
    def match(q: int) -> int:
        """The least match length of a run of period q."""
        return max(shortest - q, (times - 1) * q)

    first = 1
    while max(shortest, times * first) <= longest:
        last, gram = first, match(first)
        while 2 * (last + 1) - 2 <= min(gram, match(last + 1)):
            last, gram = last + 1, min(gram, match(last + 1))
        yield first, last, gram
        first = last + 1


def _gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each ``size`` consecutive words, by doubling: log(size) passes."""
    power, whole, at = hashes, None, 0
    width = 1
    while True:
        if size & width:
            part = power[at:]
            whole = part.copy() if whole is None else mix64(whole[: len(part)] * np.uint64(0x9E3779B97F4A7C15) + part[: len(whole)])
            at += width
        width *= 2
        if width > size:
            return whole[: len(hashes) - size + 1]
        power = mix64(power[: -(width // 2)] * np.uint64(0x5851F42D4C957F2D) + power[width // 2 :])


def diagonals(hashes: np.ndarray, owner: np.ndarray, first: np.ndarray, gram: int, low: int, high: int) -> tuple[np.ndarray, ...]:
    """(word after the diagonal's end, match length, lag) of every diagonal of lag low to high that a gram matches on.

    ``owner`` numbers the text of each word, ``first`` is the first word of each text; grams don't cross texts.
    """
    none = (np.empty(0, np.int64),) * 3
    if len(hashes) <= gram:
        return none
    codes = _gram_hashes(hashes, gram)
    begin = np.flatnonzero(owner[: len(codes)] == owner[gram - 1 :])
    if not len(begin):
        return none
    codes = mix64(codes[begin] ^ mix64(first[owner[begin]].astype(np.uint64)))
    order = np.argsort(codes, kind="stable")
    same = np.flatnonzero(codes[order[1:]] == codes[order[:-1]])
    lag = np.zeros(len(hashes) + 1, np.int64)  # by last word of the gram; 0: nothing active
    at = begin[order[same + 1]]
    lag[at + gram - 1] = at - begin[order[same]]
    lag[(lag < low) | (lag > high)] = 0
    edge = np.flatnonzero(np.diff(lag, prepend=0))
    active = edge[lag[edge] > 0]
    ends = edge[np.searchsorted(edge, active, "right")]
    return ends, ends - active + gram - 1, lag[active]


def _found(words: Words, shortest: int, times: int) -> tuple[np.ndarray, ...]:
    """(text, start in the text, length, period) of all runs of a slice, by text, start and period."""
    hashes, sizes = words.hashes(), np.diff(words.first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out = [np.empty((0, 4), np.int64)]
    for low, high, gram in levels(int(sizes.max(initial=0)), shortest, times):
        long = sizes >= max(shortest, times * low)
        chosen = np.flatnonzero(long[owner])
        first = np.cumsum(np.where(long, sizes, 0)) - np.where(long, sizes, 0)
        part = hashes[chosen]
        ends, match, lag = diagonals(part, owner[chosen], first, gram, low, high)
        enough = match + lag >= np.maximum(shortest, times * lag)
        for end, size, p in zip(ends[enough].tolist(), match[enough].tolist(), lag[enough].tolist(), strict=True):
            if not np.array_equal(part[end - size : end], part[end - size - p : end - p]):
                raise ArithmeticError("two different grams have the same hash")
            text = owner[chosen[end - 1]]
            out.append(np.array([[text, end - size - p - first[text], size + p, p]]))
    rows = np.concatenate(out)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return tuple(rows.T)


def _judge(batches: Iterator[pa.RecordBatch], text: int, shortest: int, times: int) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        counts, offsets, parts, texts = [], [0], [], []
        for low, high, raw, edges in slices(batch.column(text)):
            words = Words.of(raw, edges)
            owner, start, length, period = _found(words, shortest, times)
            counts.append(np.diff(words.first))
            offsets += (offsets[-1] + np.searchsorted(owner, np.arange(high - low), "right")).tolist()
            parts.append((start, length, period))
            borders = np.searchsorted(owner, np.arange(high - low + 1)).tolist()
            for row, (a, b) in enumerate(zip(borders[:-1], borders[1:], strict=True)):
                pieces = bytes(raw[edges[row] : edges[row + 1]]).split()
                if a < b:
                    gone = np.zeros(len(pieces) + 1, np.int64)
                    np.add.at(gone, (start + period)[a:b], 1)
                    np.add.at(gone, (start + length)[a:b], -1)
                    pieces = [w for w, n in zip(pieces, np.cumsum(gone).tolist(), strict=False) if not n]
                texts.append(b" ".join(pieces).decode())
        flat = [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(3)]
        runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in flat], fields=list(kind)))
        total = np.concatenate(counts) if counts else np.empty(0, np.int64)
        arrays = [*batch.columns, pa.array(total, pa.int64()), runs, pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(len(arrays))])


def periodic_runs(docs: DataFrame, text_column: str = "text", shortest: int = SHORTEST, times: int = TIMES) -> DataFrame:
    """The rows of docs with ``run_words`` (words of the text), ``runs`` (by start, then period) and ``run_text`` (the
    words that no run holds after its first period, joined by one space)."""
    if times < 4 or shortest < 2:
        raise ValueError("a run must have at least four periods and two words")
    own = [c for c in docs.columns if c not in ("run_words", "runs", "run_text")]
    plain = docs.select([F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(own)])
    schema = T.StructType(list(plain.schema.fields))
    for i, field in enumerate(T._parse_datatype_string(RESULT).fields):
        schema = schema.add(str(len(own) + i), field.dataType)
    at = own.index(text_column)
    judged = plain.mapInArrow(lambda batches: _judge(batches, at, shortest, times), schema)
    return judged.toDF(*own, "run_words", "runs", "run_text")


def longest_run() -> Column:
    """Of ``runs`` the one with the greatest length, then the smallest start, then the smallest period."""
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    top = F.array_max(ranked)
    return F.when(F.size("runs") > 0, F.struct((-top["s"]).alias("start"), top["length"].alias("length"), (-top["p"]).alias("period")))


def runs_digest() -> Column:
    """SHA-256 of the lines ``start,length,period`` of ``runs``."""
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    return F.sha2(F.array_join(F.transform("runs", line), ""), 256)


def with_planted_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs, the texts of about a tenth of them periodic from some word on, all derived from the id: with h its CRC-32 and
    g = h // 10, if h % 10 = 0 word i from a = g % n on is word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8)."""
    h = F.crc32(F.col(id_column).cast("string"))
    drawn = docs.withColumn("_g", F.when(h % 10 == 0, F.floor(h / 10).cast("long")))
    words = F.when(F.col("_g").isNotNull(), F.regexp_extract_all(text_column, F.lit(_WORD), F.lit(0)))
    drawn = drawn.withColumn("_w", words).withColumn("_n", F.size("_w").cast("long"))
    drawn = drawn.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    drawn = drawn.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    places = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)
    moved = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    planted = F.array_join(F.transform(places, lambda i: F.get("_w", moved(i).cast("int"))), " ")
    return drawn.withColumn(text_column, F.when(F.col("_n") > 0, planted).otherwise(F.col(text_column))).select(docs.columns)
