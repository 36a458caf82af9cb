"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Two base rules (too few words, too much of the text in repeated windows) come first. The others are tried in an order
found on a sample of about ``SAMPLE`` rows: next comes the rule that rejects most of what the rules before it left, per
unit of work. Work counts the characters or words that a rule goes through on a row. The order is a matter of speed only:
a document is kept if no rule rejects it. The rules are branches of one CASE, so a row that a rule rejects is not shown to
the next; all rows are judged in one narrow pass, without a shuffle.

Defined results
    Null and wordless texts have no words, all counts are 0, and the base rule rejects them. Rows are judged one by one,
    so null or repeated ids need no care. An empty table gives no rows, its rules stand in the order given. Columns of the
    result named like those of the input replace them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 20
REPEAT_WINDOW = 8
#: At most this percentage of words may stand in repeated windows.
REPEAT_PERCENT = 30

#: Rows that the order of the rules is found on, about.
SAMPLE = 2_000
SEED = 7

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

STATISTICS = ["quality_words", "quality_word_chars", "quality_symbols", "quality_dup_lines", "quality_repeat_words"]
RESULT = [*STATISTICS, "quality_base_failed", "quality_kept"]


@dataclass(frozen=True)
class Rule:
    """fails and work may use the text (_text), its words (_words), their hashes (_hashes) and the statistics."""

    name: str
    fails: Column
    work: Column


def rules() -> list[Rule]:
    words, chars = F.col("quality_words"), F.length("_text")
    letters, capitals = F.regexp_count("_text", F.lit(r"\p{L}")), F.regexp_count("_text", F.lit(r"\p{Lu}"))
    spelt = F.size(F.filter("_words", lambda w: F.length(F.regexp_substr(w, F.lit(r"\p{L}"))) > 0))
    again = F.size(F.filter("_hashes", lambda h, i: (i > 0) & (h == F.get("_hashes", i - 1))))
    none = F.lit(1)
    return [
        Rule("symbols", F.col("quality_symbols") * 10 > words, none),
        Rule("word_length", ~F.col("quality_word_chars").between(3 * words, 10 * words), none),
        Rule("duplicate_lines", F.col("quality_dup_lines") * 2 > F.size(F.split("_text", "\n")), chars),
        Rule("capitals", capitals * 10 > letters * 3, 2 * chars),
        Rule("spelt_words", spelt * 10 < words * 8, words + chars),
        Rule("stutter", again * 5 > words, 2 * words),
    ]


def _prepared(docs: DataFrame, text_column: str) -> DataFrame:
    own = [f"c{i}" for i, c in enumerate(docs.columns) if c not in RESULT]
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    named = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in RESULT]
    split = docs.select(*named, text.alias("_text"), F.array_remove(F.split(text, SPACES), "").alias("_words"))
    hashed = split.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    count = F.size("_hashes")
    window = F.transform(
        F.sequence(F.lit(0), count - REPEAT_WINDOW),
        lambda i: F.xxhash64(*[F.get("_hashes", i + j) for j in range(REPEAT_WINDOW)]),
    )
    windows = hashed.withColumn("_windows", F.when(count >= REPEAT_WINDOW, window))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = windows.withColumn("_sorted", F.when(repeats, ordered))
    twins = F.filter(
        "_sorted",
        lambda x, i: (x["h"] == F.get("_sorted", i - 1)["h"]) | (x["h"] == F.get("_sorted", i + 1)["h"]),
    )
    starts = sorted_.withColumn("_starts", F.sort_array(F.transform(twins, lambda x: x["i"])))
    # a window covers its words up to where the next repeated one begins
    covered = F.aggregate(
        F.transform("_starts", lambda x, i: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get("_starts", i + 1) - x, F.lit(REPEAT_WINDOW)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    lines = F.filter(F.split("_text", "\n"), lambda line: F.length(F.translate(line, " \t\x0b\f\r", "")) > 0)
    lined = starts.withColumn("_lines", lines)
    found = F.struct(
        F.col("_text"),
        F.col("_words"),
        F.col("_hashes"),
        F.size("_words").cast("long").alias("quality_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("quality_word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("quality_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("quality_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("quality_repeat_words"),
    )
    # A row generator is where pushed filters stop. Pushed further they would be rewritten in terms of the text, with
    # whole arrays made anew for each of their elements.
    return lined.select(*own, F.inline(F.array(found)))


def _base_failed() -> Column:
    return (F.col("quality_words") < MIN_WORDS) | (F.col("quality_repeat_words") * 100 > F.col("quality_words") * REPEAT_PERCENT)


def order(docs: DataFrame, text_column: str = "text", sample: int = SAMPLE) -> list[Rule]:
    """The rules by rejection per work, each judged on what the ones before it leave of the sample."""
    cascade = rules()
    share = min(1.0, sample / max(1, docs.count()))
    some = _prepared(docs.select(F.col(f"`{text_column}`").alias("text")).sample(share, SEED), "text").where(~_base_failed())
    flags = [F.coalesce(rule.fails, F.lit(False)).alias(f"f{i}") for i, rule in enumerate(cascade)]
    work = [rule.work.cast("double").alias(f"w{i}") for i, rule in enumerate(cascade)]
    # one row per combination of verdicts: at most 2 to the number of rules
    seen = some.select(*flags, *work).groupBy(*[f"f{i}" for i in range(len(cascade))])
    groups = seen.agg(F.count("*").alias("n"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(cascade))]).collect()
    ordered, left = [], list(range(len(cascade)))
    while left:
        rows = [g for g in groups if not any(g[f"f{i}"] for i in ordered)]

        def gain(i: int, rows=rows) -> float:
            return sum(g.n for g in rows if g[f"f{i}"]) / (1 + sum(g[f"w{i}"] for g in rows))

        best = max(left, key=lambda i: (gain(i), -i))
        ordered.append(best)
        left.remove(best)
    return [cascade[i] for i in ordered]


def judged(docs: DataFrame, text_column: str = "text", cascade: list[Rule] | None = None) -> DataFrame:
    """The rows of docs with the columns of ``RESULT``."""
    verdict = F.when(F.col("quality_base_failed"), False)
    for rule in order(docs, text_column) if cascade is None else cascade:
        verdict = verdict.when(rule.fails, False)
    own = {c: f"c{i}" for i, c in enumerate(docs.columns) if c not in RESULT}
    based = _prepared(docs, text_column).withColumn("quality_base_failed", _base_failed())
    kept = verdict.otherwise(True).alias("quality_kept")
    return based.select(*own.values(), *STATISTICS, "quality_base_failed", kept).toDF(*own, *RESULT)
