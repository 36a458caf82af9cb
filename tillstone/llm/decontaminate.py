"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts are normalised: A-Z lower-cased, words are runs of letters, digits and anything beyond ASCII. A window is ``n``
consecutive words of an item; an item of fewer words, but not none, is one window. Every document word inside an
occurrence of a window is hit.

The automaton of a shard of items (at most ``SHARD_WORDS`` words and one item; more items make more shards, ``PER_PASS`` a pass)
is broadcast, and documents stream past it without a shuffle. Stretches whose neighbouring words never follow each other
in an item can't hold a match and are skipped by a bitmap; the automaton reads the others and tracks the longest match.

Defined results
    Null or wordless texts have no words and are clean; null or wordless items have no windows. Rows are judged one by
    one, so null or repeated doc_ids need no care. Items that share an id count as one; an item without id is named
    ``null``. Columns of the result named like those of the input replace them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.automaton import SuffixAutomaton
from tillstone.llm.words import Words, slices, windows
from tillstone.plans.session import settled

WINDOW = 13
#: Contaminated from this share of hit words on: one word in 20.
COVERAGE = 20
SHARD_WORDS = 200_000
PER_PASS = 4  # shards that a task holds at once; the corpus is written between passes only

#: Letters and digits stay, A-Z become a-z, other ASCII parts words, bytes beyond ASCII stay.
_NORMAL = np.array([b if chr(b).isalnum() or b > 127 else 32 for b in range(256)], np.uint8)
_NORMAL[65:91] += 32
_TABLE = _NORMAL.tobytes()
_BITS = 22


class Shard:
    """The automaton of some items, who holds each window, and bitmaps of what neighbours what."""

    def __init__(self, items: list[tuple[str, bytes]], n: int) -> None:
        self.n, self.automaton = n, SuffixAutomaton()
        words = [(name, text.translate(_TABLE).split()) for name, text in items]
        words = [(name, w) for name, w in words if w]
        for _, sequence in words:
            self.automaton.add(sequence)
        self.holders: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}  # whole items of fewer words, by state
        for name, sequence in words:
            states, _ = self.automaton.matching(sequence)
            if len(sequence) < n:
                self.short.setdefault(states[-1], []).append((len(sequence), name))
            for state in states[n - 1 :]:
                self.holders.setdefault(self.automaton.suffix(state, n), set()).add(name)
        self.least = min([n, *(len(w) for _, w in words)])
        raw = np.frombuffer(b"\n".join(b" ".join(w) for _, w in words), np.uint8)
        hashes = Words.of(raw, np.array([0, len(raw)])).hashes()
        self.words, self.pairs = _bitmap(hashes), _bitmap(windows(hashes, 2))

    def stretches(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """(text, first word, last word + 1) of stretches that may hold a match of the shortest window."""
        hashes = words.hashes()
        if not len(hashes):
            return
        known = self.words[hashes >> np.uint64(64 - _BITS)]
        follows = np.zeros(len(hashes), bool)  # the word goes on from the one before
        follows[1:] = known[1:] & known[:-1] & self.pairs[windows(hashes, 2) >> np.uint64(64 - _BITS)]
        inner = words.first[:-1]
        follows[inner[inner < len(follows)]] = False
        start = np.flatnonzero(known & ~follows)
        # a stretch ends before the next word that does not follow
        breaks = np.append(np.flatnonzero(~follows), len(hashes))
        end = breaks[np.searchsorted(breaks, start, "right")]
        long = end - start >= self.least
        text = np.searchsorted(words.first, start[long], "right") - 1
        yield from zip(text.tolist(), start[long].tolist(), end[long].tolist(), strict=True)

    def hits(self, sequence: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words of the sequence are hit, and the items whose windows occur."""
        hit, items = np.zeros(len(sequence), bool), set()
        automaton = self.automaton
        for at, (state, length) in enumerate(zip(*automaton.matching(sequence), strict=True), 1):
            if length >= self.n:
                hit[at - self.n : at] = True
                items |= self.holders[automaton.suffix(state, self.n)]
            while self.short and state > 0:
                for size, name in self.short.get(state, ()):
                    if size <= length:
                        hit[at - size : at] = True
                        items.add(name)
                state = automaton.link[state]
        return hit, items


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << _BITS, bool)
    bits[hashes >> np.uint64(64 - _BITS)] = True
    return bits


def _judge(batches: Iterator[pa.RecordBatch], shard: Shard, text: int, before: int | None) -> Iterator[pa.RecordBatch]:
    """Adds words, spans and items per row; before: where those of an earlier shard stand."""
    for batch in batches:
        counts, spans, items = [], [], []
        for low, high, raw, offsets in slices(batch.column(text)):
            words = Words.of(_NORMAL[raw], offsets)
            counts += np.diff(words.first).tolist()
            found: dict[int, tuple[list, set]] = {}
            for row, start, end in shard.stretches(words):
                part = [bytes(words.raw[s:e]) for s, e in zip(words.start[start:end], words.end[start:end], strict=True)]
                hit, names = shard.hits(part)
                if names:
                    at, all_names = found.setdefault(row, ([], set()))
                    edges = np.flatnonzero(np.diff(hit, prepend=False, append=False)) + start - words.first[row]
                    at += edges.reshape(-1, 2).tolist()
                    all_names |= names
            for row in range(high - low):
                at, names = found.get(row, ([], set()))
                if before is not None:
                    at = at + [[x["start"], x["end"]] for x in batch.column(before + 1)[low + row].as_py()]
                    names = names | set(batch.column(before + 2)[low + row].as_py())
                spans.append([{"start": a, "end": b} for a, b in _merged(at)])
                items.append(sorted(names))
        arrays = batch.columns[: before if before is not None else None]
        arrays += [pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(len(arrays))])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _merged(spans: list) -> list:
    out: list = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


RESULT = ["hit_words", "hit_spans", "hit_items"]


def matches(
    docs: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = WINDOW,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The rows of docs with hit_words (number of words), hit_spans (first, last + 1 of hit words) and hit_items."""
    spark = docs.sparkSession
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("name"), F.col(item_text).alias("text"))
    named = named.where("text is not null").distinct()
    # bytes bound words: a word and its separator take two
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / 2 / shard_words))
    own = [c for c in docs.columns if c not in RESULT]
    at, frame = own.index(text_column), docs.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)])
    plain = T.StructType([T.StructField(str(i), f.dataType) for i, f in enumerate(frame.schema.fields)])
    added = T._parse_datatype_string("w long, s array<struct<start: long, end: long>>, i array<string>")
    schema = T.StructType(plain.fields + [T.StructField(str(len(own) + i), f.dataType) for i, f in enumerate(added.fields)])
    for first in range(0, count, PER_PASS):
        shards = []
        for number in range(first, min(first + PER_PASS, count)):
            mine = named.where(F.pmod(F.xxhash64("name", "text"), F.lit(count)) == number)
            rows = [(r.name, r.text.encode()) for r in mine.toLocalIterator()]
            shards.append(spark.sparkContext.broadcast(cloudpickle.dumps(Shard(rows, n))))

        def judged(batches: Iterator[pa.RecordBatch], shards=shards, before=len(own) if first else None) -> Iterator[pa.RecordBatch]:
            for shard in shards:  # each goes on with what the one before has found
                batches, before = _judge(batches, cloudpickle.loads(shard.value), at, before), len(own)
            return batches

        frame = frame.mapInArrow(judged, schema)
        if first + PER_PASS < count:
            frame = settled(frame, "contamination")
    return frame.toDF(*own, *RESULT)


def verdict(found: DataFrame, coverage: int = COVERAGE) -> DataFrame:
    """Adds hit_count (words hit) and contaminated: hit words make up one in ``coverage`` or more."""
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    counted = found.withColumn("hit_count", hit)
    return counted.withColumn("contaminated", (F.col("hit_count") > 0) & (F.col("hit_count") * coverage >= F.col("hit_words")))


def items_digest(items_column: str = "hit_items"):
    return F.sha2(F.array_join(F.array_sort(items_column), ","), 256)


def _without(batches: Iterator[pa.RecordBatch], text: int, spans: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column, texts = batch.column(text), []
        for low, high, raw, offsets in slices(column):
            words = Words.of(_NORMAL[raw], offsets)
            for row in range(low, high):
                marks = batch.column(spans)[row].as_py()
                if not marks:
                    texts.append(column[row].as_py())
                    continue
                first, at, pieces = words.first[row - low], int(offsets[row - low]), []
                for span in marks:
                    pieces.append(bytes(raw[at : words.start[first + span["start"]]]))
                    at = int(words.end[first + span["end"] - 1])
                pieces.append(bytes(raw[at : offsets[row - low + 1]]))
                texts.append(b"".join(pieces).decode())
        arrays = [batch.column(i) for i in range(batch.num_columns) if i != spans]
        arrays[text] = pa.array(texts, column.type)
        yield pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(len(arrays))])


def without_hits(found: DataFrame, text_column: str = "text") -> DataFrame:
    """The text without its hit spans; other columns stay, those of the match go."""
    own = [c for c in found.columns if c not in (*RESULT, "hit_count", "contaminated")]
    frame = found.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)] + [F.col("hit_spans")])
    schema = T.StructType([T.StructField(str(i), f.dataType) for i, f in enumerate(frame.schema.fields[:-1])])
    at = own.index(text_column)
    return frame.mapInArrow(lambda batches: _without(batches, at, len(own)), schema).toDF(*own)


