"""Language-model scores: a log-bilinear network over words, trained by noise-contrastive estimation.

Tokens are the lower-cased (A-Z) words of a text and one end.

Counts
    Every token of every text to learn from is counted (a shuffle whose size follows the corpus). The most
    frequent ones that make up ``COVERED`` of the corpus are the network's words, so their number grows with it. The
    first ``WORDS`` of them and the end are classes by themselves; the others are dealt by frequency into groups of equal
    size, as many as a group has words, and a group is a class. Tokens outside share ``ENDINGS`` classes by their last two
    bytes; within such a class a token has the probability (count + 1) / (tokens + distinct tokens + 1).

Network
    The two tokens before predict a vector, the weighted sum of their vectors (a word has its own, other tokens their
    class's); its product with an output vector, plus a bias, is a log-score. Classes have output vectors, and so have the
    words in groups. Training tells real next classes from noise drawn by frequency, and real next words likewise. It
    runs where the data is, on every document once: the documents are dealt into ``ROUNDS`` rounds by hash of the text;
    in a round each task trains from the same start, and the tasks' weights are averaged by their tokens, the vectors of a
    class or word over the tasks that met it.

Scoring
    Documents stream by. Each different context of a slice is normalised over all classes, as sums of products of what its two
    tokens give each class, and for the words of a group over the group by a matrix product; both are exact. Counts of the ``HEAD`` most frequent tokens are broadcast (or of the words, if they are more); rarer tokens
    are joined to the counts by a shuffle, since only their count is missing.

Defined results
    Null texts are empty: one end. With nothing to learn from, all counts are 0 and the network is even. Rows without an
    id are scored, and never learnt from. Rows are scored one by one, repeated ones alike.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.plans.session import settled

WORDS = 448
COVERED = 0.8
ENDINGS = 63
HEAD = 200_000
ROUNDS = 2
DIMENSIONS = 16
NOISE = 64
BATCH = 512
RATE = 0.15
CONTEXT = 2
END = b""  # no word is empty

#: Distinct tokens a task holds before it hands on its counts; tokens trained on and scored at once.
HELD = 400_000
CUT_AT_ONCE = 1024  # texts cut into words at once
SLICE = 1 << 18
SCORED_AT_ONCE = 1 << 19  # more than in training: a context's work is done once
#: Scores worked on at once, few enough to stay in a core's cache.
HOT = 1 << 17
#: Shares kept of the most frequent tokens, for each place before; the least sum of products of shares that is trusted.
KEPT = 1 << 22
LEAST = 1e-20
_FIXED = 1 << 24  # weights are summed as whole numbers, so that the order of sums doesn't matter


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of some texts without the ends, and how many each text has."""
    parted = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    every = parted.flatten().cast(pa.binary())
    real = pc.binary_length(every).to_numpy(zero_copy_only=False) > 0  # white space at a text's rim leaves empty parts
    edges = parted.offsets.to_numpy()
    before = np.append(0, np.cumsum(real))
    return every.filter(pa.array(real)), np.diff(before[edges - edges[0]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def told() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["token", "n"]
        )
        held.clear()
        return out

    for batch in batches:
        for text in batch.column(0).to_pylist():
            held.update(tokens(text))
            if len(held) > HELD:
                yield told()
    if held:
        yield told()


def counts(texts: DataFrame, text_column: str = "text") -> DataFrame:
    """(token, n): how often each token occurs in all texts."""
    parts = texts.select(text_column).mapInArrow(_count, "token binary, n long")
    return settled(parts.groupBy("token").agg(F.sum("n").alias("n")), "token-counts")


def _own(counts: np.ndarray, times: np.ndarray, total: int) -> int:
    """How many of the most frequent words make up COVERED of all tokens; counts: in descending order, each so many times."""
    before = np.cumsum(counts * times) - counts * times
    left = COVERED * total - before
    return int(np.clip(np.ceil(left / counts), 0, times).sum())


class Vocabulary:
    """Frequent tokens with their counts, and the numbers of all tokens: classes first, then the words in groups."""

    def __init__(self, head: list[tuple[bytes, int]], rest: dict[int, tuple[int, int]], total: int, distinct: int) -> None:
        ranked = [(token, n) for token, n in head if token != END]
        heard = np.array([n for _, n in ranked], np.float64)
        words = max(_own(heard, np.ones(len(heard)), total), min(WORDS, len(ranked)))
        own = [END, *[token for token, _ in ranked[:WORDS]]]
        grouped = heard[WORDS:words]
        self.endings, self.size = 1 + WORDS, math.isqrt(max(len(grouped) - 1, 0)) + 1
        first = self.endings + ENDINGS
        self.classes = first + -(-len(grouped) // self.size)
        number = {token: i for i, token in enumerate(own)}
        number |= {token: self.classes + i for i, (token, _) in enumerate(ranked[WORDS:words])}
        #: places of the tokens in the head, and by place their numbers and log10(count + 1)
        counted = dict(head)
        self.counted = END in counted
        every = [*counted, *([] if self.counted else [END])]
        self.places = {token: i for i, token in enumerate(every)}
        self.head, self.end = pa.array(every, pa.binary()), self.places[END]
        self.numbers = np.array([number[t] if t in number else self.ending(t) for t in every])
        self.logs = np.log10(np.array([counted.get(t, 0) for t in every], np.float64) + 1)
        #: log10 of a token's share of its class, without log10(count + 1)
        self.inside = np.zeros(self.classes)
        weight = np.full(self.classes, 0.5)
        counts = dict(head)
        weight[: len(own)] += [counts.get(token, 0) for token in own]
        for i in range(ENDINGS):
            n, different = rest.get(i, (0, 0))
            self.inside[self.endings + i] = -math.log10(n + different + 1)
            weight[self.endings + i] += n
        if len(grouped):
            weight[first:] += np.add.reduceat(grouped, np.arange(0, len(grouped), self.size))
        #: shares of the classes, and of the words in groups among themselves
        self.noise = np.concatenate([weight / weight.sum(), grouped / max(grouped.sum(), 1)])
        self.base = -math.log10(total + distinct + 1)
        self.total = total

    @staticmethod
    def ending(token: bytes) -> int:
        return 1 + WORDS + zlib.crc32(token[-2:]) % ENDINGS

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "places"}  # tasks look up in the head

    def looked_up(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """How many words each text has, their places in the head, or -1, and those outside in order."""
        words, count = _words(texts)
        at = pc.fill_null(pc.index_in(words, value_set=self.head), -1).to_numpy()
        return count, at, words.filter(pa.array(at < 0))

    def of(self, at: np.ndarray, outside: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Number and log10(count + 1) of each token, NaN for those outside the head, and these in order. at, outside: as
        looked up, without the ends; first: where texts begin, each with its end."""
        inner = np.ones(first[-1], bool)
        inner[first[1:] - 1] = False
        places = np.full(first[-1], self.end)
        places[inner] = at
        numbers, logs, rare, missing = self.numbers.take(places), self.logs.take(places), outside.to_pylist(), places < 0
        numbers[missing] = [self.ending(token) for token in rare]
        logs[missing] = math.nan
        return numbers, logs, rare


def vocabulary(counted: DataFrame) -> Vocabulary:
    """counted: (token, n). The head, how many tokens have each count, and the sums per class go to the driver."""
    first = counted.where(F.col("token") == F.lit(END)).collect()
    ending = (F.crc32(F.expr("substring(token, -2, 2)")) % ENDINGS).cast("int")
    sums = counted.groupBy(ending.alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("different")).collect()
    rest = {row.ending: [row.n, row.different] for row in sums}
    total, distinct = sum(n for n, _ in rest.values()), sum(d for _, d in rest.values())
    worded = counted.where(F.col("token") != F.lit(END))
    times = worded.groupBy("n").agg(F.count("*").alias("times")).orderBy(F.desc("n")).toArrow()
    words = max(_own(times["n"].to_numpy().astype(float), times["times"].to_numpy(), total), WORDS)
    # Whole levels of counts, so that nothing is sorted in one task; the few that are in turn are sorted here.
    levels = np.cumsum(times["times"].to_numpy()) <= max(HEAD, words)
    least = int(times["n"].to_numpy()[levels].min()) if levels.any() else 0
    best = worded.where(F.col("n") >= least).toArrow() if least else worded.limit(0).toArrow()
    head = sorted(zip(best["token"].to_pylist(), best["n"].to_pylist(), strict=True), key=lambda word: (-word[1], word[0]))
    words = min(words, len(head))
    for token, n in [*head[:words], *[(bytes(row.token), row.n) for row in first]]:
        mine = rest[zlib.crc32(token[-2:]) % ENDINGS]
        mine[0] -= n
        mine[1] -= 1
    return Vocabulary(head + [(bytes(row.token), row.n) for row in first], {k: tuple(v) for k, v in rest.items()}, total, distinct)


def _step(weights: np.ndarray, squares: np.ndarray, rows: list[np.ndarray], slopes: list[np.ndarray], count: int) -> None:
    """One step on the rows that have slopes; those of a row are added up."""
    which = np.concatenate(rows)
    bits = len(which).bit_length()
    keys = np.sort((which << bits) + np.arange(len(which)))  # as a stable sort of which would have it
    order, which = keys & ((1 << bits) - 1), keys >> bits
    begin = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    met = which[begin]
    slope = np.add.reduceat(np.concatenate(slopes).take(order, 0), begin)
    slope /= count
    more = squares.take(met, 0)
    more += slope * slope
    squares[met] = more
    more += 1e-6
    np.sqrt(more, out=more)
    slope *= RATE
    slope /= more
    slope += weights.take(met, 0)
    weights[met] = slope


class Network:
    """Vectors of the classes and of the words in groups, as context and as output, weights of the two contexts, biases."""

    def __init__(self, weights: np.ndarray, classes: int) -> None:
        rows = (len(weights) - CONTEXT * DIMENSIONS) // (2 * DIMENSIONS + 1)
        self.weights, self.classes, self.rows = weights, classes, rows
        #: per row: vector as context; vector as output with the bias. Each lies in one piece, so that rows are taken fast.
        self.into = weights[: rows * DIMENSIONS].reshape(rows, -1)
        self.output = weights[rows * DIMENSIONS : rows * (2 * DIMENSIONS + 1)].reshape(rows, -1)
        self.out, self.bias = self.output[:, :DIMENSIONS], self.output[:, DIMENSIONS]
        self.place = weights[rows * (2 * DIMENSIONS + 1) :].reshape(CONTEXT, DIMENSIONS)
        self.size = math.isqrt(max(rows - classes - 1, 0)) + 1
        self.first = classes - -(-(rows - classes) // self.size)  # the first group's class
        self._noise = self._hot = None

    @classmethod
    def start(cls, noise: np.ndarray) -> Network:
        rng, n = np.random.default_rng(5), len(noise)
        vectors = rng.normal(0, 0.1, (n, 2 * DIMENSIONS))
        output = np.concatenate([vectors[:, DIMENSIONS:], np.log(noise)[:, None]], 1)
        parts = [vectors[:, :DIMENSIONS].ravel(), output.ravel(), np.full(CONTEXT * DIMENSIONS, 1 / CONTEXT)]
        return cls(np.concatenate(parts).astype(np.float32), n)

    def class_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.where(numbers < self.classes, numbers, self.first + (numbers - self.classes) // self.size)

    def context(self, before: np.ndarray) -> np.ndarray:
        """One vector per row of before, the numbers of the tokens before (the nearest first)."""
        return sum(self.into.take(before[:, i], 0) * self.place[i] for i in range(CONTEXT))

    def log_probabilities(self, before: np.ndarray, low: int = 0, high: int | None = None) -> np.ndarray:
        """Natural logarithms of the probabilities of all classes (or of rows low to high - 1 among themselves),
        normalised, one row per context."""
        high = self.classes if high is None else high
        scores = self.context(before) @ self.out[low:high].T + self.bias[low:high]
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))

    def of_contexts(self, before: np.ndarray, which: np.ndarray, chosen: np.ndarray, low: int, high: int) -> np.ndarray:
        """The logarithm for each token: which says its row in before, chosen its number from low to high - 1."""
        out, vectors = np.empty(len(which)), self.context(before)
        facing, bias = np.ascontiguousarray(self.out[low:high].T), self.bias[low:high]
        length = lambda rows: np.sqrt((rows**2).sum(1).max())
        small = length(vectors) * length(facing.T) + np.abs(bias).max() < 60  # no score overflows
        vectors, facing = np.column_stack([vectors, np.ones(len(vectors), np.float32)]), np.vstack([facing, bias])
        step = max(HOT // (high - low), 1)
        held = np.empty((min(step, len(before)), high - low), np.float32)
        order = np.argsort(which, kind="stable")
        edges = np.searchsorted(which[order], np.arange(0, len(before) + step, step))
        for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            if a == b:
                continue
            some = vectors[i * step : (i + 1) * step]
            scores = np.matmul(some, facing, out=held[: len(some)])
            if not small:
                scores -= scores.max(1, keepdims=True)
            these, mine = order[a:b], which[order[a:b]] - i * step
            own = scores[mine, chosen[these] - low]
            np.exp(scores, out=scores)
            out[these] = own - np.log(scores.sum(1))[mine]
        return out

    def _shares(self, place: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What these rows as contexts at a place give to all classes, as factors of at most 1, and the logarithm over it.
        The biases go with the last place."""
        scores = (self.into.take(rows, 0) * self.place[place]) @ self.out[: self.classes].T
        if place == CONTEXT - 1:
            scores += self.bias[: self.classes]
        most = scores.max(1)
        scores -= most[:, None]
        return np.exp(scores, out=scores), most

    def log_sums(self, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logarithm of the sum over all classes, per row of before (two tokens, sorted), and whether it is left out. A
        class's share is the product of those that both tokens give it, so exponentials are taken per token and not
        per context. Shares of the first rows, the most frequent, are kept (the weights stay as they are from then on);
        those of a rarer one are worked out once a block. Left out are contexts of two rarer tokens, for which nothing is
        saved, and those whose tokens favour so different classes that digits are lost."""
        if self._hot is None:
            first = np.arange(min(KEPT // self.classes + 1, self.rows))
            self._hot = len(first), [self._shares(i, first) for i in range(CONTEXT)]
        hot, kept = self._hot
        out, step = np.zeros(len(before), np.float32), max(HOT // self.classes, 1)
        cold = before >= hot
        left = cold.all(1)
        for rarer in (None, *range(CONTEXT)):
            mine = np.flatnonzero((cold == (np.arange(CONTEXT) == rarer)).all(1))
            if rarer:
                mine = mine[np.argsort(before[mine, rarer], kind="stable")]
            for low in range(0, len(mine), step):
                some = mine[low : low + step]
                total, sides = np.zeros(len(some), np.float32), []
                for i in range(CONTEXT):
                    rows, (shares, most) = before[some, i], kept[i]
                    if rarer == i:
                        new = np.append(True, rows[1:] != rows[:-1])
                        (shares, most), rows = self._shares(i, rows[new]), np.cumsum(new) - 1
                    sides.append(shares.take(rows, 0))
                    total += most[rows]
                sums = np.einsum("ij,ij->i", *sides)
                left[some] = lost = ~(sums > LEAST)
                sums[lost] = 1
                out[some] = total + np.log(sums)
        return out, left

    def of_classes(self, before: np.ndarray, which: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """The logarithm for each token's class: which says its row in before (sorted), chosen its class."""
        sums, left = self.log_sums(before)
        own = np.einsum("ij,ij->i", self.context(before).take(which, 0), self.out.take(chosen, 0)) + self.bias[chosen]
        out = (own - sums[which]).astype(float)
        mine = np.flatnonzero(left[which])
        if len(mine):
            place = np.cumsum(left) - 1
            out[mine] = self.of_contexts(before[left], place[which[mine]], chosen[mine], 0, self.classes)
        return out

    def learn(self, before: np.ndarray, numbers: np.ndarray, noise: np.ndarray, squares: np.ndarray, rng) -> None:
        """One step on a batch: real next classes against NOISE classes drawn for the batch, each as if drawn for all; and
        so the real next words in groups against words."""
        if self._noise is not noise:
            self._noise, c = noise, self.classes
            self._drawn = [np.cumsum(noise[:c]), np.cumsum(noise[c:])]
            self._log = np.log(noise * NOISE).astype(np.float32)
        contexts = [before[:, i] for i in range(CONTEXT)]
        into = [self.into.take(rows, 0) for rows in contexts]
        vectors = np.ones((len(before), DIMENSIONS + 1), np.float32)  # the last column meets the bias
        np.multiply(into[0], self.place[0], out=vectors[:, :-1])
        for i in range(1, CONTEXT):
            vectors[:, :-1] += into[i] * self.place[i]
        back = np.zeros((len(before), DIMENSIONS), np.float32)
        rows, slopes = [], []
        grouped = np.flatnonzero(numbers >= self.classes)
        for level, (mine, real) in enumerate(((None, self.class_of(numbers)), (grouped, numbers[grouped]))):
            if not len(real):
                continue
            sums = self._drawn[level]
            drawn = np.minimum(sums.searchsorted(rng.random(NOISE) * sums[-1], "right"), len(sums) - 1) + level * self.classes
            these = vectors if mine is None else vectors.take(mine, 0)
            out, false_out = self.output.take(real, 0), self.output.take(drawn, 0)
            up = np.einsum("ij,ij->i", these, out) - self._log[real]
            false_out[:, -1] -= self._log[drawn]
            down = these @ false_out.T
            up = 1 / (1 + np.exp(np.clip(up, -30, 30)))
            # -1 / (1 + exp(-x)) as -(1 + tanh(x / 2)) / 2
            down *= 0.5
            np.tanh(down, out=down)
            down += 1
            down *= -0.5
            up = up[:, None]
            rows += [real, drawn]
            slopes += [up * these, down.T @ these]
            more = down @ false_out[:, :-1]
            more += up * out[:, :-1]
            if mine is None:
                back += more
            else:
                back[mine] += more
        held = Network(squares, self.classes)
        slope = np.stack([np.einsum("ij,ij->j", back, rows_) for rows_ in into]) / len(numbers)
        _step(self.output, held.output, rows, slopes, len(numbers))
        _step(self.into, held.into, contexts, [back * self.place[i] for i in range(CONTEXT)], len(numbers))
        held.place[:] += slope**2
        self.place[:] += RATE * slope / np.sqrt(held.place + 1e-6)


def _contexts(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Numbers of the tokens before each token of some texts; before a text's first token stands an end (class 0)."""
    place = np.arange(len(classes)) - np.repeat(first[:-1], np.diff(first))
    out = np.zeros((len(classes), CONTEXT), np.int64)
    for i in range(CONTEXT):
        out[i + 1 :, i] = classes[: -i - 1]
        out[place <= i, i] = 0
    return out


def _texts(
    batches: Iterator[pa.RecordBatch], column: int, vocabulary: Vocabulary, most: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """(some rows of a batch, where their texts begin, and ``Vocabulary.of`` their tokens): about so many tokens at a time,
    or one longer text."""
    for batch in batches:
        if not len(batch):
            continue
        found = [vocabulary.looked_up(batch.column(column).slice(i, CUT_AT_ONCE)) for i in range(0, len(batch), CUT_AT_ONCE)]
        count, at, outside = (list(x) for x in zip(*found, strict=True))
        count, at, outside, low, met = np.concatenate(count), np.concatenate(at), pa.concat_arrays(outside), 0, 0
        begin, ended = np.append(0, np.cumsum(count)), np.append(0, np.cumsum(count + 1))
        while low < len(batch):
            high = min(int(np.searchsorted(ended, ended[low] + most)), len(batch))
            some, first = at[begin[low] : begin[high]], ended[low : high + 1] - ended[low]
            n = np.count_nonzero(some < 0)
            yield batch.slice(low, high - low), first, *vocabulary.of(some, outside.slice(met, n), first)
            low, met = high, met + n


def _train(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    network, seen = Network(weights.copy(), vocabulary.classes), 0
    squares, rng = np.zeros_like(weights), np.random.default_rng(11)
    for _, first, numbers, _, _ in _texts(batches, 0, vocabulary, SLICE):
        order = rng.permutation(len(numbers))
        before, numbers = _contexts(numbers, first).take(order, 0), numbers.take(order)
        for low in range(0, len(order), BATCH):
            network.learn(before[low : low + BATCH], numbers[low : low + BATCH], vocabulary.noise, squares, rng)
        seen += len(numbers)
    if seen:
        moves = Network(squares, vocabulary.classes)
        met = np.flatnonzero((moves.into != 0).any(1) | (moves.output != 0).any(1))
        place = np.append(network.place.ravel(), 0)
        moved = np.concatenate([np.concatenate([network.into[met], network.output[met]], 1), place[None]]).astype(np.float64) * _FIXED
        times = -(-seen >> 10)  # in thousands, so that the sums of very large corpora fit
        moved = np.rint(moved).astype(np.int64) * times
        columns = [np.append(met, network.rows), np.full(len(met) + 1, times), *moved.T]
        for low in range(0, len(met) + 1, 1 << 14):
            yield pa.RecordBatch.from_arrays([pa.array(c[low : low + (1 << 14)]) for c in columns], ["i", "seen", *MOVED])


MOVED = [f"v{i}" for i in range(2 * DIMENSIONS + 1)]  # also holds the weights of the contexts, in a row of their own


def train(texts: DataFrame, vocabulary: Vocabulary, text_column: str = "text", rounds: int = ROUNDS) -> np.ndarray:
    """The network's weights, trained on all given texts, each in one round."""
    weights = Network.start(vocabulary.noise).weights
    context = texts.sparkSession.sparkContext
    dealt = F.pmod(F.xxhash64(text_column), F.lit(rounds))
    for i in range(rounds):
        sent = context.broadcast(cloudpickle.dumps((vocabulary, weights)))
        parts = texts.where(dealt == i).select(text_column).mapInArrow(
            lambda batches, sent=sent: _train(batches, *cloudpickle.loads(sent.value)), ", ".join(f"{c} long" for c in ("i", "seen", *MOVED))
        )
        summed = parts.groupBy("i").agg(*[(F.sum(c) / F.sum("seen")).alias(c) for c in MOVED]).toArrow()
        if summed.num_rows:
            rows, mean = summed["i"].to_numpy(), np.stack([summed[c].to_numpy() for c in MOVED], 1) / _FIXED
            network = Network(weights.copy(), vocabulary.classes)
            last = rows == network.rows
            network.into[rows[~last]], network.output[rows[~last]] = mean[~last, :DIMENSIONS], mean[~last, DIMENSIONS:]
            network.place[:] = mean[last][0, :-1].reshape(CONTEXT, DIMENSIONS)
            weights = network.weights
        sent.unpersist()
    return weights


def _score(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    network, number = Network(weights, vocabulary.classes), 0
    task = TaskContext.get()
    start = (task.partitionId() if task else 0) << 40
    for batch, first, numbers, logs, rare in _texts(batches, 2, vocabulary, SCORED_AT_ONCE):
        before, classes = _contexts(numbers, first), network.class_of(numbers)
        contexts, which = np.unique(before[:, 0] * network.rows + before[:, 1], return_inverse=True)
        pairs = np.stack([contexts // network.rows, contexts % network.rows], 1)
        chosen = network.of_classes(pairs, which, classes)
        grouped = np.flatnonzero(numbers >= network.classes)
        grouped = grouped[np.argsort(classes[grouped].astype(np.min_scalar_type(network.classes)), kind="stable")]
        for mine in np.split(grouped, np.flatnonzero(np.diff(classes[grouped])) + 1) if len(grouped) else ():
            group = network.classes + (int(classes[mine[0]]) - network.first) * network.size
            end = min(group + network.size, network.rows)
            chosen[mine] += network.of_contexts(before[mine], np.arange(len(mine)), numbers[mine], group, end)
        missing = np.isnan(logs)
        logs[missing] = 0
        single = (classes < vocabulary.endings) | (classes >= network.first)
        score = chosen / math.log(10) + np.where(single, 0, logs + vocabulary.inside[classes])
        unknown_ends = 0 if vocabulary.counted else 1
        gone = np.add.reduceat(missing, first[:-1])
        rest, at = [], 0
        for n in gone.tolist():
            rest.append([{"token": t, "times": k} for t, k in Counter(rare[at : at + n]).items()])
            at += n
        count = np.diff(first)
        arrays = [
            pa.array(start + number + np.arange(len(batch))),
            batch.column(0),
            batch.column(1),
            pa.array(count),
            pa.array(count - gone - unknown_ends),
            pa.array(np.add.reduceat(logs, first[:-1]) + count * vocabulary.base),
            pa.array(np.add.reduceat(score, first[:-1])),
            pa.array(rest, pa.list_(pa.struct([("token", pa.binary()), ("times", pa.int64())]))),
        ]
        number += len(batch)
        yield pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"])


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double,"
    " rare array<struct<token: binary, times: long>>"
)


def is_held_out(id_column: str = "doc_id", parts: int = 7, part: int = 2) -> Column:
    """The id's CRC-32 falls into the part kept for testing; null for rows without an id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % parts == part


def scored(docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of docs, learnt from the rows that
    are not held out. Scores are log10 probabilities of whole texts, by single tokens and by the network."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_column).alias("text")
    )
    learnt = rows.where(~F.col("held_out"))
    counted = counts(learnt)
    words = vocabulary(counted)
    sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps((words, train(learnt, words))))
    every = rows.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "text")
    first = settled(every.mapInArrow(lambda batches: _score(batches, *cloudpickle.loads(sent.value)), SCORED), "token-scores")
    rare = first.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.times")
    found = rare.join(counted, "token").groupBy("row").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more")
    )
    joined = first.drop("rare").join(found, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
