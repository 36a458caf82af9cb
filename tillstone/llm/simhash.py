"""Near duplicates by SimHash, linked by a binary-trie self-join on Hamming distance.

Fingerprints
    Words are lower-cased (A-Z); shingles of ``k`` consecutive words, repeats included, vote with their XXH64; a bit is 1 if
    over half the shingles have it. A text of fewer words is one shingle; one without words has fingerprint zero.

Links
    Fingerprints that differ in at most ``distance`` bits. Of ``distance + 1`` blocks of bits, two such fingerprints share
    one, so every fingerprint is dealt out once per block, turned so that the block leads; equal blocks meet in a task. A
    block shared by more than ``CROWDED`` fingerprints is dealt anew by the blocks of the remaining bits, of which such a
    pair shares one too, so no pair is lost.
    There the sorted fingerprints are a binary trie whose nodes are ranges. The join walks pairs of nodes from the top,
    adds a differing bit where the two take different branches, and drops the pair once the budget is spent. Node pairs
    whose leaves are all linked to each other already are dropped too, so that a dense group of copies costs about its
    size. Small node pairs are settled by counting bits. Each task hands on a spanning forest of its links, never the
    links, and only fingerprints, not documents, take part: exact copies count once.

Components
    Alternating large-star and small-star rounds on the forests, until nothing changes.

Defined results
    Null texts have no words. A null doc_id takes part but is never a component's name unless it has no other (then
    null). Repeated rows share a fingerprint and a component. Columns besides id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.plans.session import settled

SHINGLE = 4
DISTANCE = 4
SEED = 42  # fixed value: seed of the shingles' XXH64

#: Node pairs walked at once, and pairs of leaves compared at once: bounds a task's memory.
FRONTIER = 1 << 17
LEAVES = 64
#: Fingerprints joined in one go (or one block's, if more).
GATHER = 1 << 16
#: Fingerprints that share a block, at most, before they are dealt anew by a block of their remaining bits.
CROWDED = 1 << 18


def _fingerprint(text: bytes, k: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    if len(words) <= k:
        return xxhash.xxh64_intdigest(plain, SEED)
    gaps = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(plain)]
    hashed, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    total = len(words) - k + 1
    for low in range(0, total, 1 << 15):
        span = range(low, min(low + (1 << 15), total))
        values = np.fromiter((hashed(plain[starts[i] : ends[i + k - 1]], SEED) for i in span), "<u8", len(span))
        votes += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * votes > total).tolist()))


def _fingerprints(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [_fingerprint(text.encode() if text else b"", k) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], ["doc_id", "print"]
        )


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = SHINGLE) -> DataFrame:
    """(doc_id, print): the fingerprint's 64 bits as a long."""
    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return own.mapInArrow(lambda batches: _fingerprints(batches, k), "doc_id long, print long")


def as_hex(print_column: str) -> Column:
    return F.lower(F.lpad(F.hex(print_column), 16, "0"))


def blocks(distance: int, width: int = 64) -> list[tuple[int, int]]:
    """(first bit, bits) of distance + 1 blocks that make up ``width`` bits."""
    edges = [round(width * i / (distance + 1)) for i in range(distance + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


class Forest:
    """Union-find over positions; ``label`` names the smallest position of each tree after ``settle``."""

    def __init__(self, size: int) -> None:
        self.label = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join the ends of links; returns the tree edges this took."""
        kept_a, kept_b = [], []
        while len(a):
            x, y = self.label[a], self.label[b]
            open_ = x != y
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            if not len(a):
                break
            high, low = np.maximum(x, y), np.minimum(x, y)
            order = np.lexsort((low, high))
            first = order[np.diff(high[order], prepend=-1) != 0]  # each root hooks once
            kept_a.append(a[first])
            kept_b.append(b[first])
            self.label[high[first]] = low[first]
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up
        return (np.concatenate(kept_a), np.concatenate(kept_b)) if kept_a else (a[:0], b[:0])


def trie_join(turned: np.ndarray, groups: np.ndarray, depth: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs within ``distance``, as positions. turned: sorted within each group, distinct; groups:
    the edges of ranges that agree on all bits above ``depth``, which stays to be walked."""
    forest = Forest(len(turned))
    ones_from = [np.concatenate([[0], np.cumsum((turned >> np.uint64(d)) & np.uint64(1), dtype=np.int32)]) for d in range(depth)]
    edges_a, edges_b = [], []
    low, high = groups[:-1], groups[1:]
    root = np.stack([low, high, low, high, np.zeros(len(low), np.int64)])
    stack = [(depth, root[:, high - low > 1])]
    change = None
    while stack:
        bits, pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            stack += [(bits, pairs[:, FRONTIER:]), (bits, pairs[:, :FRONTIER])]
            continue
        if change is None:
            change = np.concatenate([[0], np.cumsum(forest.label[1:] != forest.label[:-1])])
        a, b, c, d, _ = pairs
        alone = (change[a] == change[b - 1]) & (change[c] == change[d - 1]) & (forest.label[a] == forest.label[c])
        pairs = pairs[:, ~alone]
        a, b, c, d, spent = pairs
        small = (bits == 0) | ((b - a) * (d - c) <= LEAVES)
        if small.any():
            x, y = _leaves(turned, pairs[:4, small], distance)
            x, y = forest.link(x, y)
            if len(x):
                edges_a.append(x)
                edges_b.append(y)
                change = None
        pairs = pairs[:, ~small]
        if not pairs.shape[1]:
            continue
        a, b, c, d, spent = pairs
        own = (a == c) & (b == d)
        ones = ones_from[bits - 1]
        m, n = b - (ones[b] - ones[a]), d - (ones[d] - ones[c])
        cross = np.stack([a, m, n, d, spent + 1])
        other = np.stack([m, b, c, n, spent + 1])[:, ~own]
        same = np.concatenate([np.stack([a, m, c, n, spent]), np.stack([m, b, n, d, spent])], 1)
        for children in (np.concatenate([cross, other], 1), same):  # the same branch first: it links neighbours
            useful = (children[0] < children[1]) & (children[2] < children[3]) & (children[4] <= distance)
            lone = (children[0] == children[2]) & (children[1] - children[0] == 1) & (children[3] == children[1])
            if (children := children[:, useful & ~lone]).shape[1]:
                stack.append((bits - 1, children))
    none = np.empty(0, np.int64)
    return (np.concatenate(edges_a), np.concatenate(edges_b)) if edges_a else (none, none)


def _leaves(turned: np.ndarray, pairs: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d = pairs
    wide = d - c
    count = (b - a) * wide
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    x = np.repeat(a, count) + at // np.repeat(wide, count)
    y = np.repeat(c, count) + at % np.repeat(wide, count)
    near = (x != y) & (np.bitwise_count(turned[x] ^ turned[y]) <= distance)
    return x[near], y[near]


def _turn(values: np.ndarray, first: int, width: int = 64) -> np.ndarray:
    """The lowest ``width`` bits turned left by first, so that a block beginning there leads them; turning by width - first
    undoes it."""
    if first % width == 0:
        return values
    mask = np.uint64((1 << width) - 1)
    low = values & mask
    return (values & ~mask) | (((low << np.uint64(first)) | (low >> np.uint64(width - first))) & mask)


def _layouts(distance: int) -> list[tuple[int, int, int, int]]:
    """(first bit, bits, first bit and bits of a block of the rest) by code. Codes that are multiples of distance + 2 have
    no second block, those after them the blocks of the rest."""
    out = []
    for first, bits in blocks(distance):
        out += [(first, bits, 0, 0), *((first, bits, *part) for part in blocks(distance, 64 - bits))]
    return out


def _join(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (code, turned): joins whole groups of equal leading bits, ``GATHER`` fingerprints at a time."""
    layouts, held_code, held_turned = _layouts(distance), np.empty(0, np.int64), np.empty(0, np.uint64)
    leading = np.array([bits + more for _, bits, _, more in layouts], np.uint64)

    def joined(code: np.ndarray, turned: np.ndarray) -> Iterator[pa.RecordBatch]:
        for number in np.unique(code).tolist():
            first, bits, second, more = layouts[number]
            own = turned[code == number]
            lead = own >> np.uint64(64 - bits - more)
            groups = np.concatenate([[0], np.flatnonzero(lead[1:] != lead[:-1]) + 1, [len(own)]])
            x, y = trie_join(own, groups, 64 - bits - more, distance)
            width = 64 - bits
            ends = [_turn(_turn(own[i], width - second, width), 64 - first) for i in (x, y)]
            yield pa.RecordBatch.from_arrays([pa.array(e.view(np.int64)) for e in ends], ["a", "b"])

    for batch in batches:
        code = np.concatenate([held_code, batch.column(0).to_numpy().astype(np.int64)])
        # sorted as signed numbers; with the leading bit flipped that is the order of the unsigned ones
        turned = np.concatenate([held_turned, batch.column(1).to_numpy().view(np.uint64) ^ np.uint64(1 << 63)])
        held_code, held_turned = code, turned
        if len(code) >= GATHER:
            lead = turned >> (np.uint64(64) - leading[code])
            cuts = np.flatnonzero((lead[1:] != lead[:-1]) | (code[1:] != code[:-1])) + 1
            if len(cuts):
                yield from joined(code[: cuts[-1]], turned[: cuts[-1]])
                held_code, held_turned = code[cuts[-1] :], turned[cuts[-1] :]
    if len(held_code):
        yield from joined(held_code, held_turned)


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): per task, a spanning forest of the pairs of distinct fingerprints within ``distance`` bits."""
    parts = []
    for number, (first, bits) in enumerate(blocks(distance)):
        value = F.col("print")
        if first:
            value = F.shiftleft(value, first).bitwiseOR(F.shiftrightunsigned(value, 64 - first))
        code = F.lit(number * (distance + 2)).alias("code")
        parts.append(F.struct(code, value.alias("turned"), F.shiftrightunsigned(value, 64 - bits).alias("lead")))
    turned = prints.select(F.explode(F.array(*parts)).alias("x")).select("x.*")
    crowded = turned.groupBy("code", "lead").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).drop("n")
    marked = turned.join(crowded.withColumn("crowded", F.lit(True)), ["code", "lead"], "left")

    def again(code: int, first: int, bits: int, second: int, more: int) -> Column:
        """A row of a crowded block, dealt by a block of its remaining bits."""
        width, value = 64 - bits, F.col("turned")
        low = value.bitwiseAND((1 << width) - 1)
        if second:
            low = F.shiftleft(low, second).bitwiseOR(F.shiftrightunsigned(low, width - second)).bitwiseAND((1 << width) - 1)
        whole = F.shiftleft(F.shiftrightunsigned(value, width), width).bitwiseOR(low)
        return F.struct(F.lit(code).alias("code"), whole.alias("turned"), F.shiftrightunsigned(whole, width - more).alias("lead"))

    own = F.array(F.struct("code", "turned", "lead"))
    layouts = _layouts(distance)
    for code in range(0, len(layouts), distance + 2):
        dealt = F.array(*[again(i, *layouts[i]) for i in range(code + 1, code + distance + 2)])
        own = F.when(F.col("crowded") & (F.col("code") == code), dealt).otherwise(own)
    spread = marked.select(F.explode(own).alias("x")).select("x.*")
    sorted_ = spread.select("code", "lead", F.col("turned").bitwiseXOR(F.lit(-(1 << 63))).alias("turned"))
    dealt = sorted_.repartition("code", "lead").sortWithinPartitions("code", "turned").select("code", "turned")
    return dealt.mapInArrow(lambda batches: _join(batches, distance), "a long, b long").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node with a link: root is the smallest node it reaches."""
    edges = settled(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), name)
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        stars = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # each node now points to smaller ones: point them all to the smallest
        lowest = stars.groupBy("a").agg(F.min("b").alias("m"))
        small = stars.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
        edges = settled(small.union(lowest.select("a", F.col("m").alias("b"))).distinct(), name)
        # a star forest no longer changes, and is what a round leaves as it is
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b")).distinct())
        mark = tuple(seen)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """(doc_id, print, component_id, root) per row of docs; component_id is the smallest doc_id reachable over links, null if
    none of those rows has one, and root a print that names the component in any case."""
    prints = settled(fingerprints(docs, id_column, text_column, k), "simhash")
    classes = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("print"), distance), "simhash-links")
    rooted = classes.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(named, "root").select("print", "component_id", "root")
    return prints.join(known, "print").select("doc_id", "print", "component_id", "root")


def one_of_each(
    docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = SHINGLE
) -> DataFrame:
    """One row of docs for each component: that with the smallest doc_id, null last, then the smallest print, then the smallest
    hash of the text. ``found``: what ``near_duplicates`` gives for docs.

    Where that doc_id is one row's, the id tells which; rows that share it, or have none, are told apart by their own prints,
    which are computed once more for them alone.
    """
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")).alias("f"))
    first = settled(first.select("f.*"), "keepers")
    named = first.where("not none").select("doc_id", "print")
    times = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("times"))
    by_id, shared = (named.join(times.where(which), "doc_id", "left_semi") for which in ("times = 1", "times > 1"))
    shared = settled(shared, "shared-keepers")  # few, as a rule: then the planner sees it, and docs is not shuffled for them
    id_ = docs[id_column].cast("long")
    kept = docs.join(by_id.select(F.col("doc_id").alias("_keeper")), id_ == F.col("_keeper"), "left_semi")

    repeated = docs.join(shared.select(F.col("doc_id").alias("_id")).distinct(), id_ == F.col("_id"), "left_semi")
    alike = repeated.unionByName(docs.where(id_.isNull())).withColumn("_row", F.monotonically_increasing_id())
    alike = settled(alike, "shared-ids")
    shared = shared.unionByName(first.where("none").select("doc_id", "print")).toDF("_id", "_print")
    prints = fingerprints(alike, "_row", text_column, k).select(F.col("doc_id").alias("_row"), F.col("print").alias("_own"))
    meant = F.col(id_column).cast("long").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_print"))
    told = alike.join(prints, "_row").join(shared, meant)
    least = F.min(F.struct(F.xxhash64(text_column).alias("_hash"), *[F.col(f"`{c}`") for c in docs.columns])).alias("least")
    rest = told.groupBy("_id", "_print").agg(least).select(*[F.col(f"least.`{c}`") for c in docs.columns])
    return kept.unionByName(rest)
