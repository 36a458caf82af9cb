"""Compression of vectors to codes: a codebook per part of the vector, improved by Lloyd rounds on two trees.

Method
    Components become integers, floor(scale * x), and vectors are cut into equal consecutive parts. Each part position has a
    codebook, which starts as that part of the vectors with the smallest ids. A round gives every part its nearest entry
    (squared Euclidean distance, ties to the lower index) and moves each entry to its parts' componentwise floor(sum / count).

    The parts of a block of vectors stand in a tree, halved along the widest side of each node, whose boxes and sums are
    made once and stored with the block. The entries of a codebook stand in a tree of their own, made anew each round. Pairs of
    a node of parts and a node of entries are walked down together: an entry node is out where its least distance to the
    box of parts is above the greatest distance of another. Where one entry is left, the node of parts is assigned as a whole and
    its stored sum is added to the entry's. Leaves with several candidates left compare integers, part by part.

Plan: one narrow pass writes the blocks, as a table in the shared folder. Each round is a narrow pass over it and a sum
    by cell of the codebooks with map-side combine; the driver and the tasks get the codebooks, ``parts * entries`` rows
    of a part's width whatever the data. The vectors with the smallest ids are found by partition, then by groups of ``FAN``
    partitions, so no task reads more than ``FAN * entries`` rows.

Defined results
    A null vector, or one with a null, infinite or not-a-number component, is left out. Rows with a null id or equal ids stay; null ids
    come last and equal ids by vector where the codebooks start. Fewer vectors than entries give as many entries as
    vectors. All vectors must have the same length, a multiple of the parts, and components under 2^26 / scale in size: else
    the task that meets one fails. Columns of the result named like those of the input replace them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.plans.session import settled

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024

CELLS = 1 << 19  # components in a block
LEAF = 32  # parts in a leaf
LARGEST = 1 << 26
FAN = 32
_EXACT = 1 << 53


# -- trees -----------------------------------------------------------------------------------------------------


def edges(size: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin, and the end of the last."""
    return np.arange((1 << level) + 1) * size >> level


def depth(size: int, leaf: int) -> int:
    """The last level of a tree whose nodes still have ``leaf`` rows."""
    return max(0, (size // leaf).bit_length() - 1)


@dataclass
class Tree:
    """Rows in tree order. ``low``, ``high`` and ``sums`` have the boxes and sums of all nodes, level after level."""

    order: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray
    levels: int

    @classmethod
    def of(cls, rows: np.ndarray, leaf: int) -> Tree:
        size, last = len(rows), depth(len(rows), leaf)
        order = np.arange(size)
        low, high = [], []
        for level in range(last + 1):
            begin = edges(size, level)
            low.append(np.minimum.reduceat(rows[order], begin[:-1]))
            high.append(np.maximum.reduceat(rows[order], begin[:-1]))
            if level < last:
                widest = np.argmax(high[-1] - low[-1], 1)
                node = np.repeat(np.arange(len(widest)), np.diff(begin))
                order = order[np.lexsort((rows[order, widest[node]], node))]
        placed = rows[order]
        sums = [np.add.reduceat(placed, edges(size, last)[:-1], dtype=np.int64)]
        while len(sums[-1]) > 1:
            sums.append(sums[-1][::2] + sums[-1][1::2])
        return cls(order, placed, np.concatenate(low), np.concatenate(high), np.concatenate(sums[::-1]), last)

    def box(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice((1 << level) - 1, (2 << level) - 1)
        return self.low[at], self.high[at]


@dataclass
class Entries:
    """A codebook's tree. Entries equal to one with a lower index are never nearest and don't stand in it."""

    book: np.ndarray
    tree: Tree
    index: np.ndarray  # of the entries in tree order

    @classmethod
    def of(cls, book: np.ndarray) -> Entries:
        first = np.sort(np.unique(book, axis=0, return_index=True)[1])
        tree = Tree.of(book[first], 1)
        return cls(book, tree, first[tree.order])

    def steps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(children of each node of the step before, low, high) from the root down to single entries."""
        for level in range(self.tree.levels + 1):
            yield np.full(1 << level >> 1 or 1, 2 if level else 1), *self.tree.box(level)
        yield np.diff(edges(len(self.index), self.tree.levels)), self.tree.rows, self.tree.rows


def bounds(low: np.ndarray, high: np.ndarray, entry_low: np.ndarray, entry_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of any part of a node and any entry of a node, for all pairs of nodes."""
    above = entry_low[None] - high[:, None]
    below = low[:, None] - entry_high[None]
    least = np.maximum(np.maximum(above, below), 0)
    most = np.maximum(entry_high[None] - low[:, None], high[:, None] - entry_low[None])
    return np.einsum("ijk,ijk->ij", least, least), np.einsum("ijk,ijk->ij", most, most)


def nearest(rows: np.ndarray, allowed: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest allowed entry of each row, in integers: doubles hold them exactly below 2^53, else 64-bit ones are used."""
    some = np.flatnonzero(allowed.any(0))
    entries = book[some]
    reach = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * reach * reach * max(1, rows.shape[1]) < _EXACT else np.int64
    a, b = rows.astype(kind), entries.astype(kind)
    far = (b * b).sum(1) - 2 * (a @ b.T)  # without the square of the row itself, which is the same for all entries
    far[~allowed[:, some]] = np.inf if kind is np.float64 else np.iinfo(np.int64).max
    return some[np.argmin(far, 1)]


def assigned(tree: Tree, entries: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of each part in tree order, sums by entry, parts by entry)."""
    size = len(tree.rows)
    code = np.empty(size, np.int64)
    sums, counts = np.zeros(entries.book.shape, np.int64), np.zeros(len(entries.book), np.int64)
    steps, single = entries.steps(), False
    nodes, open_ = np.zeros(1, np.int64), np.ones((1, 1), bool)
    for level in range(tree.levels + 1):
        low, high = (side[nodes].astype(np.int64) for side in tree.box(level))
        for _ in range(2 if level else 3):  # entries go down two levels for one of the parts
            step = next(steps, None)
            if step is not None:
                children, entry_low, entry_high = step
                open_ = np.repeat(open_, children, 1)
                single = entry_low is entry_high  # the last step
            least, most = bounds(low, high, entry_low, entry_high)
            most[~open_] = np.iinfo(np.int64).max
            open_ &= least <= most.min(1)[:, None]
            if step is None:
                break
        begin = edges(size, level)
        if single:
            sure = open_.sum(1) == 1
            to = entries.index[np.argmax(open_[sure], 1)]
            for node, entry in zip(nodes[sure].tolist(), to.tolist(), strict=True):
                code[begin[node] : begin[node + 1]] = entry
            np.add.at(sums, to, tree.sums[(1 << level) - 1 + nodes[sure]])
            np.add.at(counts, to, begin[nodes[sure] + 1] - begin[nodes[sure]])
            nodes, open_ = nodes[~sure], open_[~sure]
        if not len(nodes):
            return code, sums, counts
        if level < tree.levels:
            nodes, open_ = (2 * nodes[:, None] + [0, 1]).ravel(), np.repeat(open_, 2, 0)
    for children, _, _ in steps:  # a tree of parts with fewer levels than the entries'
        open_ = np.repeat(open_, children, 1)

    begin = edges(size, tree.levels)
    lengths = begin[nodes + 1] - begin[nodes]
    leaf = np.repeat(np.arange(len(nodes)), lengths)
    at = np.arange(len(leaf)) - np.repeat(np.cumsum(lengths) - lengths - begin[nodes], lengths)
    allowed = np.zeros((len(nodes), len(entries.book)), bool)
    allowed[:, entries.index] = open_
    for low_row in range(0, len(at), 2048):
        some = at[low_row : low_row + 2048]
        code[some] = nearest(tree.rows[some], allowed[leaf[low_row : low_row + 2048]], entries.book)
    order = at[np.argsort(code[at], kind="stable")]
    held, first, many = np.unique(code[order], return_index=True, return_counts=True)
    sums[held] += np.add.reduceat(tree.rows[order], first, dtype=np.int64)
    counts[held] += many
    return code, sums, counts


# -- blocks ----------------------------------------------------------------------------------------------------

_STORED = [("parts", "int"), ("width", "int"), ("order", "binary"), ("rows", "binary"), ("low", "binary"), ("high", "binary"), ("sums", "binary")]
_KINDS = {"order": np.int32, "rows": np.int32, "low": np.int32, "high": np.int32, "sums": np.int64}


def _integers(vectors: pa.Array, parts: int, scale: int) -> np.ndarray:
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    width = int(lengths[0])
    if (lengths != width).any() or width % parts or not width:
        raise ValueError(f"vectors must have the same length, a multiple of {parts}")
    cells = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if (np.abs(cells) >= LARGEST).any():
        raise ArithmeticError(f"a component is {LARGEST // scale} or more")
    return cells.astype(np.int32).reshape(len(lengths), width)


def _blocks(batches: Iterator[pa.RecordBatch], vector: int, parts: int, scale: int, cells: int, leaf: int) -> Iterator[pa.RecordBatch]:
    """A row per block: the other columns as a list, and the trees of its parts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = _integers(batch.column(vector), parts, scale)
        rest = pa.StructArray.from_arrays([c for i, c in enumerate(batch.columns) if i != vector], [str(i) for i in range(batch.num_columns - 1)])
        size = max(leaf, cells // max(1, whole.shape[1]))
        for at in range(0, len(whole), size):
            block = whole[at : at + size]
            width = block.shape[1] // parts
            trees = [Tree.of(block[:, p * width : (p + 1) * width], leaf) for p in range(parts)]
            stored = [pa.array([parts], pa.int32()), pa.array([width], pa.int32())]
            for name, kind in _KINDS.items():
                stored.append(pa.array([b"".join(getattr(t, name).astype(kind).tobytes() for t in trees)], pa.binary()))
            listed = rest.slice(at, len(block))
            lists = pa.ListArray.from_arrays(pa.array([0, len(block)], pa.int32()), pa.concat_arrays([listed]))
            yield pa.RecordBatch.from_arrays([lists, *stored], ["rest", *[name for name, _ in _STORED]])


def _trees(block: dict, leaf: int) -> list[Tree]:
    """The trees of a stored block."""
    parts, width = block["parts"], block["width"]
    size = len(block["order"]) // 4 // parts
    last = depth(size, leaf)
    out = []
    whole = {}
    for name, kind in _KINDS.items():
        shape = (parts, size) if name == "order" else (parts, size if name == "rows" else (2 << last) - 1, width)
        whole[name] = np.frombuffer(block[name], kind).reshape(shape)
    for p in range(parts):
        out.append(Tree(*[whole[name][p] for name in _KINDS], last))
    return out


def _stored(batches: Iterator[pa.RecordBatch], leaf: int) -> Iterator[tuple[pa.Array | None, list[Tree]]]:
    """(the other columns, the trees) of each block."""
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            row = {name: batch.column(names.index(name))[i].as_py() for name, _ in _STORED}
            rest = batch.column(names.index("rest"))[i].values if "rest" in names else None
            yield rest, _trees(row, leaf)


# -- rounds ----------------------------------------------------------------------------------------------------


def _codebooks(books: np.ndarray, width: int) -> list[Entries]:
    if books.shape[2] != width:
        raise ValueError("vectors must have the same length")
    return [Entries.of(book) for book in books]


def _round(batches: Iterator[pa.RecordBatch], books: np.ndarray, leaf: int) -> Iterator[pa.RecordBatch]:
    """Sums of the components and, as one component more, the number of parts, by cell of the codebooks."""
    total, entries = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64), None
    for _, trees in _stored(batches, leaf):
        entries = entries or _codebooks(books, trees[0].rows.shape[1])
        for p, tree in enumerate(trees):
            _, sums, counts = assigned(tree, entries[p])
            total[p, :, :-1] += sums
            total[p, :, -1] += counts
    used = np.broadcast_to(total[:, :, -1:] > 0, total.shape).ravel()
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(used)), pa.array(total.ravel()[used])], ["cell", "total"])


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray, leaf: int) -> Iterator[pa.RecordBatch]:
    entries = None
    for rest, trees in _stored(batches, leaf):
        entries = entries or _codebooks(books, trees[0].rows.shape[1])
        size = len(trees[0].rows)
        codes, error = np.empty((size, len(trees)), np.uint8), np.zeros(size, np.int64)
        for p, tree in enumerate(trees):
            code, _, _ = assigned(tree, entries[p])
            away = tree.rows - books[p][code]
            codes[tree.order, p] = code
            error[tree.order] += (away * away).sum(1)
        flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(trees)), size, [None, pa.py_buffer(codes.tobytes())]).cast(pa.binary())
        arrays = [*rest.flatten(), flat, pa.array(error)]
        yield pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(len(arrays))])


def _first(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    """The ``count`` rows with the smallest ids of all (null last, then by vector)."""
    best = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        best = _smallest(table if best is None else pa.concat_tables([best, table]), count)
    if best is not None:
        yield from best.combine_chunks().to_batches()


def _smallest(table: pa.Table, count: int) -> pa.Table:
    if len(table) > count:
        by_id = pc.sort_indices(table["id"], sort_keys=[("id", "ascending")], null_placement="at_end")
        border = table["id"][by_id[count - 1].as_py()]
        least = pc.is_valid(table["id"])
        if border.is_valid:  # a null at the border lets all pass
            table = table.filter(pc.fill_null(pc.and_(least, pc.less_equal(table["id"], border)), False))
    rows = table["vector"].to_pylist()
    ids = table["id"].to_pylist()
    order = sorted(range(len(rows)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, rows[i]))
    return table.take(pa.array(order[:count], pa.int64()))


def _start(blocks: DataFrame, id_at: int, kind: T.DataType, parts: int, entries: int, leaf: int) -> np.ndarray:
    """The first codebooks: parts of the vectors with the smallest ids."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole() -> Iterator[pa.RecordBatch]:
            for rest, trees in _stored(batches, leaf):
                vectors = np.empty((len(rest), parts * trees[0].rows.shape[1]), np.int32)
                for p, tree in enumerate(trees):
                    width = tree.rows.shape[1]
                    vectors[tree.order, p * width : (p + 1) * width] = tree.rows
                at = pa.array(np.arange(len(rest) + 1) * vectors.shape[1], pa.int32())
                lists = pa.ListArray.from_arrays(at, pa.array(vectors.ravel()))
                yield pa.RecordBatch.from_arrays([rest.flatten()[id_at], lists], ["id", "vector"])

        yield from _first(whole(), entries)

    schema = T.StructType([T.StructField("id", kind), T.StructField("vector", T.ArrayType(T.IntegerType()))])
    found, tasks = blocks.mapInArrow(spread, schema), blocks.rdd.getNumPartitions()
    while tasks > FAN:
        tasks = -(-tasks // FAN)
        found = found.repartition(tasks).mapInArrow(lambda batches: _first(batches, entries), schema)
    chosen = _smallest(found.toArrow(), entries)
    vectors = chosen["vector"].to_pylist()
    if len({len(v) for v in vectors}) > 1:
        raise ValueError("vectors must have the same length")
    cells = np.array(vectors, np.int64).reshape(len(vectors), parts, -1 if vectors else 0)
    return cells.transpose(1, 0, 2)


def _moved(books: np.ndarray, totals: pa.Table) -> np.ndarray:
    """The codebooks after a round: entries at the floor of their parts' mean; unused ones stay."""
    cells = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
    cells.ravel()[totals["cell"].to_numpy()] = totals["total"].to_numpy()
    many = cells[:, :, -1:]
    return np.where(many > 0, cells[:, :, :-1] // np.maximum(many, 1), books)


def finite(vector: str) -> F.Column:
    """Whether a vector and all its components are there and finite."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))), F.lit(False))


def compressed(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    cells: int = CELLS,
    leaf: int = LEAF,
) -> tuple[DataFrame, np.ndarray]:
    """The kept rows with ``code`` (a byte per part) and ``code_error`` (squared distance to what the code stands for)
    in place of the vector; and the codebooks, by part, entry and position."""
    if not 1 <= entries <= 256:
        raise ValueError("a byte per part stands for at most 256 entries")
    own = [c for c in vectors.columns if c not in ("code", "code_error")]
    rest = [c for c in own if c != vector_column]
    plain = vectors.where(finite(f"`{vector_column}`")).select([F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(own)])
    fields = [T.StructField(str(i), plain.schema[str(own.index(c))].dataType) for i, c in enumerate(rest)]
    schema = T.StructType([T.StructField("rest", T.ArrayType(T.StructType(fields)))])
    for name, kind in _STORED:
        schema = schema.add(name, T._parse_datatype_string(kind))
    at = own.index(vector_column)
    blocks = settled(plain.mapInArrow(lambda batches: _blocks(batches, at, parts, scale, cells, leaf), schema), "vector-blocks")

    place = rest.index(id_column)
    books = _start(blocks, place, fields[place].dataType, parts, entries, leaf)
    trees = blocks.select(*[name for name, _ in _STORED])
    for _ in range(rounds):
        summed = trees.mapInArrow(lambda batches, books=books: _round(batches, books, leaf), "cell long, total long")
        books = _moved(books, summed.groupBy("cell").agg(F.sum("total").alias("total")).toArrow())
    result = T.StructType([*fields, T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    coded = blocks.mapInArrow(lambda batches: _coded(batches, books, leaf), result).toDF(*rest, "code", "code_error")
    return coded, books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in order, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``label_error``: ``code_error`` summed over equal labels, nulls together.

    The sums are settled, so that they are broadcast if they are known to be small, and a frequent label is split otherwise."""
    coded = settled(coded, "codes")
    total = settled(coded.groupBy(F.col(label).alias("_label")).agg(F.sum("code_error").alias("label_error")), "label-errors")
    return coded.join(total, F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")
