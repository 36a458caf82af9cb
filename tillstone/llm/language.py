"""Language identification as inference of each document's mixture of languages.

Model
    Per language, probabilities of byte trigrams inside words (with the spaces around them), counted over all documents
    to learn from and smoothed. Trigrams fall into 2^16 buckets. A word's likelihood in a language is the product of its
    trigrams'.

Inference
    Expectation-maximisation finds the proportions of languages that make the document's words likeliest. The languages
    are then taken in the order of their proportions; of the sets of the first one, two, three ..., as long as that helps, the one with the best
    likelihood less ``PENALTY`` times the logarithm of the number of words, per language beyond the first, is the
    document's. The prediction is the language with the largest proportion in it, the score that proportion.

Every language is learnt. The model holds only the trigrams that occur in it: at most 2^16 numbers a language, and one for
the others. Its rows are filled in for ``BLOCK`` languages at a time.

Defined results
    Null texts, and texts without a letter, are ``und`` with score 0; so is everything when there is nothing to learn
    from. Ties go to the first language by name. Rows without an id are never learnt from. Rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstone.llm.words import SLICE_BYTES, Words, slices

BITS = 16
#: Languages whose rows of 2^BITS numbers are held at once.
BLOCK = 128
SMOOTHING = 0.5
ROUNDS = 12
#: Sets of up to so many languages are weighed for every document, larger ones while the last one was better.
ALWAYS_WEIGHED = 3
PENALTY = 2.0
UNKNOWN = "und"

#: Letters stay, A-Z become a-z, bytes beyond ASCII stay; the rest parts words.
_LETTERS = np.array([b if chr(b).isalpha() or b > 127 else 32 for b in range(256)], np.uint8)
_LETTERS[65:91] += 32


def trigrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram that ends at each letter of the words, and at the space after each; where each word begins."""
    size = words.end - words.start
    at = np.cumsum(size + 1) - size - 1
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    letters = np.full(int((size + 1).sum()) + 2, 32, np.uint32)
    letters[np.repeat(at, size) + place + 2] = words.raw[np.repeat(words.start, size) + place]
    # the letter before a word's first is a space, and so is the one before that
    two_before = letters[:-2].copy()
    two_before[at] = 32
    code = (two_before << np.uint32(16)) | (letters[1:-1] << np.uint32(8)) | letters[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BITS), at


def _count(batches: Iterator[pa.RecordBatch], number: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """Cells (language number << BITS | bucket) that occur, with their counts; holds the counts of BLOCK languages."""
    held: dict[int, np.ndarray] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for language, total in held.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen | (language << BITS)), pa.array(total[seen])], ["cell", "n"])
        held.clear()

    for batch in batches:
        language = np.array([number[name] for name in batch.column(0).to_pylist()], np.int64)
        for low, high, raw, offsets in slices(batch.column(1)):
            words = Words.of(_LETTERS[raw], offsets)
            if not len(words.start):
                continue
            grams, at = trigrams(words)
            owner = np.repeat(np.repeat(language[low:high], np.diff(words.first)), np.diff(at, append=len(grams)))
            present = np.unique(language[low:high])
            for i in range(0, len(present), BLOCK):
                block = present[i : i + BLOCK]
                mine = slice(None) if len(present) <= BLOCK else (owner >= block[0]) & (owner <= block[-1])
                cells = (np.searchsorted(block, owner[mine]) << BITS) | grams[mine]
                totals = np.bincount(cells, minlength=len(block) << BITS).reshape(len(block), -1)
                if len(held.keys() | set(block.tolist())) > BLOCK:
                    yield from told()
                for name, total in zip(block.tolist(), totals, strict=True):
                    if name in held:
                        held[name] += total
                    else:
                        held[name] = total.copy()
    yield from told()


class Model:
    """Logarithms of trigram probabilities: per language those of the buckets seen, and one for all others."""

    def __init__(self, languages: list[str], cells: np.ndarray, logs: np.ndarray, unseen: np.ndarray) -> None:
        self.languages, self.cells, self.logs, self.unseen = languages, cells, logs, unseen
        self._block: tuple[int, np.ndarray] | None = None

    def table(self, low: int) -> np.ndarray:
        """One row per language of the block that begins at low."""
        if self._block is None or self._block[0] != low:
            rows = np.repeat(self.unseen[low : low + BLOCK, None], 1 << BITS, 1)
            a, b = np.searchsorted(self.cells, [low << BITS, (low + len(rows)) << BITS])
            rows.reshape(-1)[self.cells[a:b] - (low << BITS)] = self.logs[a:b]
            self._block = (low, rows)
        return self._block[1]

    def words(self, words: Words) -> np.ndarray:
        """Log-likelihood of each word (rows) in each language (columns)."""
        grams, at = trigrams(words)
        blocks = range(0, len(self.languages), BLOCK)
        return np.stack([np.add.reduceat(row[grams], at) for low in blocks for row in self.table(low)], 1)


def learn(docs: DataFrame, language_column: str = "lang", text_column: str = "text") -> Model:
    """From all rows of docs with a language and a text."""
    known = docs.select(F.col(language_column).cast("string").alias("lang"), F.col(text_column).alias("text")).where(
        "lang is not null and text is not null"
    )
    languages = sorted(row.lang for row in known.select("lang").distinct().collect())
    number = {name: i for i, name in enumerate(languages)}
    cells, n = np.empty(0, np.int64), np.empty(0)
    if languages:
        counted = known.mapInArrow(lambda batches: _count(batches, number), "cell long, n long")
        found = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most 2^16 cells a language
        order = np.argsort(found["cell"].to_numpy())
        cells, n = found["cell"].to_numpy()[order], found["n"].to_numpy()[order].astype(np.float64)
    owner = cells >> BITS
    total = np.bincount(owner, n, len(languages)) + SMOOTHING * (1 << BITS)
    logs = (np.log(n + SMOOTHING) - np.log(total)[owner]).astype(np.float32)
    return Model(languages, cells, logs, (np.log(SMOOTHING) - np.log(total)).astype(np.float32))


def _mixture(likelihood: np.ndarray, first: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions per document after some rounds, and the mean log of what the words sum to under them. likelihood: words
    by languages, scaled to 1 at each word's best; share: where to start, languages at 0 stay out."""
    count = np.diff(first)
    owner = np.repeat(np.arange(len(count)), count)
    total = np.empty(len(likelihood), np.float32)
    for _ in range(rounds + 1):
        part = likelihood * share[owner]
        total = part.sum(1)
        np.maximum(total, 1e-30, out=total)
        last, share = share, np.add.reduceat(part / total[:, None], first[:-1]) / count[:, None]
    return last, np.add.reduceat(np.log(total), first[:-1])


def mixtures(model: Model, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(language number, proportion) for each text that has words."""
    logs = model.words(words)
    best = logs.max(1)
    likelihood = np.exp(logs - best[:, None])
    first, languages = words.first[np.concatenate([np.diff(words.first) > 0, [True]])], len(model.languages)
    count = np.diff(first)
    share, _ = _mixture(likelihood, first, np.full((len(count), languages), 1 / languages, np.float32), ROUNDS)
    order = np.argsort(-share, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    single = np.add.reduceat(logs - best[:, None], first[:-1])[np.arange(len(count)), order[:, 0]]
    chosen, value = order[:, 0].copy(), np.ones(len(count))
    top = single.astype(np.float64)
    rising = np.arange(len(count))  # documents that a larger set may still suit better
    for size in range(2, languages + 1):
        mine = slice(None) if len(rising) == len(count) else np.repeat(np.isin(np.arange(len(count)), rising), count)
        start = np.where(rank[rising] < size, np.maximum(share[rising], 1e-3), 0).astype(np.float32)
        edges = np.concatenate([[0], np.cumsum(count[rising])])
        fitted, fit = _mixture(likelihood[mine], edges, start / start.sum(1, keepdims=True), ROUNDS // 3)
        fit = fit - PENALTY * (size - 1) * np.log(count[rising])
        better = fit > top[rising]
        these = rising[better]
        top[these] = fit[better]
        chosen[these] = fitted.argmax(1)[better]
        value[these] = fitted.max(1)[better]
        if size >= ALWAYS_WEIGHED:
            rising = these
        if not len(rising):
            break
    return chosen, value


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    size = SLICE_BYTES * BLOCK // max(BLOCK, len(model.languages))  # a slice has a number per word and language
    for batch in batches:
        names, scores = [], []
        for low, high, raw, offsets in slices(batch.column(2), size):
            normal = _LETTERS[raw]
            words = Words.of(normal, offsets)
            name, score = np.full(high - low, -1), np.zeros(high - low)
            worded = np.flatnonzero(np.diff(words.first))
            if len(worded) and model.languages:
                name[worded], score[worded] = mixtures(model, words)
            # ASCII letters tell at once; without them, look at the characters
            plain = np.concatenate([[0], np.cumsum((normal > 96) & (normal < 123))])
            for row in np.flatnonzero((np.diff(plain[offsets]) == 0) & (name >= 0)).tolist():
                if not _has_letter(bytes(raw[offsets[row] : offsets[row + 1]])):
                    name[row], score[row] = -1, 0
            names += [UNKNOWN if i < 0 else model.languages[i] for i in name.tolist()]
            scores += np.clip(score, 0, 1).tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
            ["doc_id", "held_out", "lang_pred", "score"],
        )


def is_held_out(id_column: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    """The id's CRC-32 falls into the part kept for testing; rows without an id always do."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % parts == part, F.lit(True))


def identified(
    docs: DataFrame, model: Model, held_out: Column, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.cells, model.logs, model.unseen))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_column).alias("text"))
    return rows.mapInArrow(
        lambda batches: _predict(batches, Model(*sent.value)), "doc_id long, held_out boolean, lang_pred string, score double"
    )
