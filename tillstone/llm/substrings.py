"""Substring deduplication with suffix automata of reference shards.

A window is ``n`` consecutive words of one document. Every word is removed that lies in a window whose words also start
earlier: in a document with a smaller id, or earlier in the same document. Windows are judged on the input.

How the work is dealt out
    Every window names an anchor: the run of ``ANCHOR`` words in it with the smallest hash (the leftmost of equals), so
    equal windows name equal anchors. Consecutive windows that name the same anchor form a run; one row per run (about
    one per seven words) goes to the shard of its anchor, but of equal runs that a task sees close together only the
    first does: the others are known to be repeats, and a passage met a million times doesn't fill its shard. A sorted pass over each shard drops anchors met once. Runs
    equal word for word need no more: all but the first are repeats. Where one anchor stands in different runs, at the
    rims of shared passages, the runs' words are the shard's reference: a suffix automaton takes the runs in document
    order, gives the matching length at every word, marks windows that reach ``n``, and then learns the run.
    A shard of more than ``LARGEST`` different runs (a common line that goes on differently in countless documents) is
    dealt anew by window instead of by anchor, which splits it without losing one.

Defined results
    Null and empty texts have no words. Texts of less than ``n`` words lose nothing. Rows without doc_id come last, by
    a hash of their text. Rows that repeat a doc_id count as one document: a word position removed in one is removed in
    all, and a plain repetition of a row removes nothing. Words are compared by 64-bit hashes where runs are equal, and
    byte by byte in the automata. Columns of the result named like those of the input replace them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.automaton import SuffixAutomaton
from tillstone.llm.words import Words, mix64, slices, windows
from tillstone.plans.session import settled

WINDOW = 20
ANCHOR = 8

#: Different runs that one automaton learns: about 70,000 words, some 50 MB of Python objects.
LARGEST = 2_000

REPEAT, RIM, CROWDED = 0, 1, 2
_RUN_BITS = 8


def document_key(id_column: str, text_column: str) -> Column:
    """The id; rows without one follow all others, told apart by their text."""
    last = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(F.col(text_column)), 3)
    return F.coalesce(F.col(id_column).cast("long"), last)


def _runs(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    per_window = n - ANCHOR + 1
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for low, high, raw, offsets in slices(batch.column(1)):
            words = Words.of(raw, offsets)
            if len(words.start) < n:
                continue
            hashes = words.hashes()
            grams, whole = windows(hashes, ANCHOR), windows(hashes, n)
            anchor = sliding_window_view(grams, per_window).argmin(1) + np.arange(len(whole))
            document = np.repeat(np.arange(high - low), np.diff(words.first))[: len(whole)]
            inside = np.flatnonzero(np.arange(len(whole)) + n <= words.first[document + 1])
            if not len(inside):
                continue
            at = np.flatnonzero(np.diff(anchor[inside], prepend=-1))
            size = np.diff(at, append=len(inside))
            start = inside[at]
            content = mix64(whole[start] + mix64(whole[start + size - 1] + size.astype(np.uint64)))
            place = (start - words.first[document[start]] << _RUN_BITS) + size
            key = ids[low + document[start]].astype(np.int64)
            yield _told(grams[anchor[start]].view(np.int64), content.view(np.int64), key, place.astype(np.int64))


def _told(anchor: np.ndarray, content: np.ndarray, key: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """The rows of a slice. Of equal runs only the first may be first of all, so only it goes to the anchor's shard; the
    others are repeats whatever the shard holds. They are dealt out by a hash of their place, marked by a negative one."""
    order = np.lexsort((place, key, content, anchor))
    anchor, content, key, place = (x[order] for x in (anchor, content, key, place))
    same = np.zeros(len(anchor), bool)
    same[1:] = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(anchor))))
    again = same & ((key != key[first]) | (place != place[first]))
    anchor[again] = mix64(key[again].view(np.uint64) ^ mix64(place[again].view(np.uint64))).view(np.int64)
    place[again] = -place[again]
    kept = ~same | again
    return pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (anchor, content, key, place)], ["anchor", "content", "key", "place"])


def runs(docs: DataFrame, n: int) -> DataFrame:
    """(anchor, content, key, place): one row per run; place holds its first word and its number of windows, and is
    negative if the run is known to repeat an earlier one."""
    return docs.mapInArrow(lambda batches: _runs(batches, n), "anchor long, content long, key long, place long")


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, content, key, place; keeps a few rows of state, whatever the size of a group."""
    before = None  # the row before: anchor, content, and the key and place that its content was first met at
    waiting = None  # the last first-met row, and whether the one before it has its anchor
    different = 0  # contents of the present anchor so far
    for batch in batches:
        anchor, content, key, place = (c.to_numpy() for c in batch.columns)
        told = place < 0
        if told.any():
            yield _verdicts(REPEAT, anchor[told], key[told], -place[told])
            anchor, content, key, place = (x[~told] for x in (anchor, content, key, place))
        if not len(anchor):
            continue
        same_anchor = np.empty(len(anchor), bool)
        same = np.empty(len(anchor), bool)
        same_anchor[1:] = anchor[1:] == anchor[:-1]
        same[1:] = same_anchor[1:] & (content[1:] == content[:-1])
        same_anchor[0] = before is not None and before[0] == anchor[0]
        same[0] = bool(same_anchor[0]) and before[1] == content[0]
        met = np.flatnonzero(~same)
        source = np.maximum.accumulate(np.where(same, -1, np.arange(len(anchor))))
        first_key, first_place = key[source], place[source]
        if before is not None:
            first_key, first_place = (np.where(source < 0, x, y) for x, y in ((before[2], first_key), (before[3], first_place)))
        again = same & ((key != first_key) | (place != first_place))
        yield _verdicts(REPEAT, anchor[again], key[again], place[again])
        before = (anchor[-1], content[-1], first_key[-1], first_place[-1])

        rows = [anchor[met], key[met], place[met]]
        linked = same_anchor[met]
        if waiting is not None:
            rows = [np.concatenate([[x], y]) for x, y in zip(waiting[0], rows, strict=True)]
            linked = np.concatenate([[waiting[1]], linked])
        if len(linked) == 0:
            continue
        rim = linked.copy()
        rim[:-1] |= linked[1:]
        waiting = [x[-1] for x in rows], bool(linked[-1])
        yield _verdicts(RIM, *(x[:-1][rim[:-1]] for x in rows))
        # count the contents of each anchor, the present one going on in the next batch
        new = linked[1:] if len(linked) > len(met) else linked
        heads = np.flatnonzero(np.concatenate([[True], ~new]) if len(new) else [True])
        counts = np.diff(heads, append=len(new) + 1)
        counts[0] += different - 1
        names = np.concatenate([[rows[0][0]], anchor[met]])[heads]
        crowded = counts > LARGEST
        if different > LARGEST:
            crowded[0] = False  # already told
        yield _verdicts(CROWDED, names[crowded], names[crowded], names[crowded])
        different = int(counts[-1])
    if waiting is not None and waiting[1]:
        yield _verdicts(RIM, *(np.array([x]) for x in waiting[0]))


def _verdicts(kind: int, anchor: np.ndarray, key: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(anchor), kind, np.int32)), *(pa.array(x.astype(np.int64)) for x in (anchor, key, place))],
        ["kind", "anchor", "key", "place"],
    )


def _contexts(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(0).to_pylist()
        for low, high, raw, offsets in slices(batch.column(1)):
            out: tuple[list, list, list, list] = [], [], [], []
            words = Words.of(raw, offsets)
            whole = windows(words.hashes(), n)
            for row in range(low, high):
                first, last = words.first[row - low : row - low + 2]
                part = [bytes(raw[s:e]) for s, e in zip(words.start[first:last].tolist(), words.end[first:last].tolist(), strict=True)]
                for run in batch.column(2)[row].as_py():
                    start, size = run["place"] >> _RUN_BITS, run["place"] & (1 << _RUN_BITS) - 1
                    if start + size + n - 1 > len(part):
                        continue  # another row of this doc_id has the run
                    if not run["crowded"]:
                        pieces = [(run["anchor"], start, start + size + n - 1)]
                    else:
                        named = whole[first + start : first + start + size].view(np.int64).tolist()
                        pieces = [(name, i, i + n) for i, name in enumerate(named, start)]
                    for shard, begin, end in pieces:
                        for column, value in zip(out, (shard, keys[row], begin, b" ".join(part[begin:end])), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())], ["shard", "key", "start", "words"]
            )


def _match(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    shard, automaton = None, SuffixAutomaton()
    for batch in batches:
        keys, starts, ends = [], [], []
        for name, key, start, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if name != shard:
                shard, automaton = name, SuffixAutomaton()
            words = text.split(b" ")
            _, lengths = automaton.matching(words)
            covered = 0
            for at, length in enumerate(lengths, 1):
                if length >= n:
                    begin = max(at - length, covered)
                    covered = at
                    keys.append(key)
                    starts.append(start + begin)
                    ends.append(start + at)
            if lengths[-1] < len(words):
                automaton.add(words)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, starts, ends)], ["key", "start", "end"])


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = WINDOW) -> DataFrame:
    """(key, spans): per document with repeats, its repeated words as (first, last + 1). key: see ``document_key``."""
    if not ANCHOR <= n < ANCHOR + (1 << _RUN_BITS) - 1:
        raise ValueError(f"n must be {ANCHOR} to {ANCHOR + (1 << _RUN_BITS) - 2}")
    texts = docs.select(document_key(id_column, text_column).alias("key"), F.col(text_column).alias("text"))
    dealt = runs(texts, n).repartition("anchor").sortWithinPartitions("anchor", "content", "key", "place")
    judged = settled(dealt.mapInArrow(_judge, "kind int, anchor long, key long, place long"), "substring-runs")
    crowded = judged.where(F.col("kind") == CROWDED).select("anchor", F.lit(True).alias("crowded")).distinct()
    rims = judged.where(F.col("kind") == RIM).join(crowded, "anchor", "left")
    lists = rims.groupBy("key").agg(
        F.collect_list(F.struct("anchor", "place", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("runs")
    )
    contexts = (
        texts.join(lists, "key")
        .select("key", "text", "runs")
        .mapInArrow(lambda batches: _contexts(batches, n), "shard long, key long, start long, words binary")
    )
    matched = (
        contexts.repartition("shard")
        .sortWithinPartitions("shard", "key", "start")
        .mapInArrow(lambda batches: _match(batches, n), "key long, start long, end long")
    )
    start = F.shiftright("place", _RUN_BITS)
    size = F.col("place").bitwiseAND((1 << _RUN_BITS) - 1)
    repeats = judged.where(F.col("kind") == REPEAT).select("key", start.alias("start"), (start + size + (n - 1)).alias("end"))
    return repeats.union(matched).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


CUT = "cut_words long, cut_removed long, cut_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch], text: int, spans: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column, marks = batch.column(text), batch.column(spans)
        for low, high, raw, offsets in slices(column):
            texts, counts, removed, digests = [], [], [], []
            words = Words.of(raw, offsets)
            for row in range(low, high):
                first, last = words.first[row - low : row - low + 2]
                cut = np.zeros(last - first, bool)
                for span in marks[row].as_py() or ():
                    cut[span["start"] : span["end"]] = True
                kept = np.flatnonzero(~cut)
                counts.append(len(cut))
                removed.append(len(cut) - len(kept))
                part = bytes(raw[offsets[row - low] : offsets[row - low + 1]])
                digests.append(hashlib.sha256(b" ".join(_pick(part.split(), cut))).hexdigest())
                if len(kept) == len(cut):
                    texts.append(column[row].as_py())
                else:
                    edges = np.flatnonzero(np.diff(~cut, prepend=False, append=False)).reshape(-1, 2) + first
                    texts.append(" ".join(bytes(raw[words.start[a] : words.end[b - 1]]).decode() for a, b in edges))
            arrays = [batch.column(i).slice(low, high - low) for i in range(batch.num_columns) if i != spans]
            arrays[text] = pa.array(texts, column.type)
            arrays += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(len(arrays))])


def _pick(words: list[bytes], cut: np.ndarray) -> list[bytes]:
    return [w for w, gone in zip(words, cut.tolist(), strict=True) if not gone] if cut.any() else words


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = WINDOW) -> DataFrame:
    """The rows of docs, text cut to what is kept (pieces joined by one space), and the columns of ``CUT``:
    words before, words removed, and the SHA-256 of the kept words joined by one space."""
    spans = repeated_spans(docs, id_column, text_column, n)
    own = [c for c in docs.columns if c not in ("cut_words", "cut_removed", "cut_sha256")]
    plain = docs.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)])
    at = own.index(text_column)
    keyed = plain.withColumn("key", document_key(f"c{own.index(id_column)}", f"c{at}"))
    joined = keyed.join(spans, "key", "left").select(*plain.columns, "spans")
    schema = T.StructType([T.StructField(str(i), f.dataType) for i, f in enumerate(plain.schema.fields)])
    for i, field in enumerate(T._parse_datatype_string(CUT).fields):
        schema = schema.add(str(len(own) + i), field.dataType)
    cut = joined.mapInArrow(lambda batches: _cut(batches, at, len(own)), schema)
    return cut.toDF(*own, "cut_words", "cut_removed", "cut_sha256")
