"""Mixing sources to target weights along a time-varying curriculum.

Targets
    Sources in the order of their names (by code point, null last) weigh 5, 2, 1, 5, 2, 1 ... and share as many words as the
    corpus has. No source gives more than ``MOST`` times its words; what is over goes to the others by weight, until
    none is over. That level is found in closed form: with sources sorted by room per weight, each place has the level
    at which the sources before it are full; the highest that the source at its place has room for is right.

Curriculum
    Each source has a schedule: its weight over training time 0 to 1, linear between knots. Integrated and scaled to the
    source's target it tells how many of its words are due by a time; inverted, it gives the time at which a document's
    first word is due. Documents of a source follow each other in the order of the MD5 of their id, again and again as
    long as words are due, the last one cut where the target ends. Copies are range-sorted by their time.

How the work is dealt out
    The running number of words within a source is not one window per source: documents fall into buckets by the first digits of
    their MD5, of about ``IN_BUCKET`` rows each, so many as the table needs; rows without an id by the hash of their
    text. Buckets are summed first, then within the ``COARSE`` digits that they begin with, and only documents of one
    source and bucket meet in a window.

Defined results
    A null or wordless text has size 0 and is taken 0 words. Rows with a null id share one place in the order, as rows that
    repeat an id do; ties are broken by the text's hash. A source without words has target 0. An empty table gives none.
    Columns of the result named like those of the input replace them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillstone.plans.session import settled

WEIGHTS = (5, 2, 1)
MOST = 3
COARSE = 3  # hexadecimal digits
IN_BUCKET = 4096

#: Weight at equally spaced times, one schedule for each of the WEIGHTS: falling, even, rising.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))

SPACES = r"[\x20\x09-\x0D]+"
RESULT = ["mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_positions"]


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """sizes: one row per source (source, source_size). Adds its place in the cycle of weights and its target."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("cycle", (place % len(weights)).cast("int")).withColumn("weight", F.get(cycle, F.col("cycle")))
    ranked = ranked.withColumn("room", F.col("source_size") * F.lit(float(most)))
    by_room = W.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    full = F.coalesce(F.sum("room").over(by_room.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum("weight").over(by_room.rowsBetween(0, W.unboundedFollowing))
    levels = ranked.withColumn("level", (total - full) / open_)
    fits = F.when(F.col("level") <= F.col("room") / F.col("weight"), F.col("level"))
    level = F.coalesce(F.max(fits).over(everything), F.lit(0.0))
    return levels.withColumn("target", F.least(F.col("room"), level * F.col("weight"))).select(
        "source", "source_size", "cycle", "target"
    )


def due_time(share: Column, knots: Sequence[float]) -> Column:
    """The time by which that share of a schedule's integral is due."""
    step = 1 / (len(knots) - 1)
    areas = [(a + b) / 2 * step for a, b in zip(knots, knots[1:], strict=False)]
    whole, before, out = sum(areas), 0.0, None
    for i, (a, b, area) in enumerate(zip(knots, knots[1:], areas, strict=False)):
        rest = share * F.lit(whole) - F.lit(before)
        # a x + (b - a) / (2 step) x^2 = rest, in the form that also holds for a = b
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(a * a) + F.lit(2 * (b - a) / step) * rest))
        time = F.lit(i * step) + F.when(rest <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * rest / (F.lit(a) + root))
        before += area
        last = i == len(areas) - 1
        out = (out.otherwise(time) if out is not None else time) if last else (F if out is None else out).when(share * F.lit(whole) <= before, time)
    return out


def mixed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
) -> DataFrame:
    """The rows of docs with the columns of ``RESULT``: size, its source's size and target, words taken (repeats
    counted), and the time of each copy taken."""
    own = {c: f"c{i}" for i, c in enumerate(docs.columns) if c not in RESULT}
    digest = F.coalesce(F.md5(F.col(id_column).cast("string")), F.lit(""))
    tie = F.xxhash64(F.col(text_column))
    more = math.ceil(math.log(max(1, docs.count() / IN_BUCKET / 16**COARSE), 16))
    digits = COARSE + min(COARSE, more)
    # In the order of digest and tie: rows without an id come first, by the tie's first digits with its sign turned.
    placed = F.when(digest == "", F.substring(F.lpad(F.hex(tie.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), 1, digits))
    keyed = docs.select(
        *[F.col(f"`{c}`").alias(name) for c, name in own.items()],
        F.col(source_column).alias("_source"),
        digest.alias("_digest"),
        F.coalesce(F.concat(F.lit("!"), placed), F.substring(digest, 1, digits)).alias("_bucket"),
        tie.alias("_tie"),  # here, so that the order doesn't need the text
        n_words(F.col(text_column)).alias("mix_size"),
    )
    sums = settled(keyed.groupBy("_source", "_bucket").agg(F.sum("mix_size").alias("words")), "mix-sizes")
    sizes = sums.groupBy(F.col("_source").alias("source")).agg(F.sum("words").alias("source_size"))
    aims = targets(sizes, weights, most)
    past = lambda *keys, order: F.coalesce(
        F.sum("words").over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    fine = sums.withColumn("_coarse", F.when(F.startswith(F.col("_bucket"), F.lit("!")), F.substring("_bucket", 1, COARSE + 1)).otherwise(F.substring("_bucket", 1, COARSE)))
    coarse = fine.groupBy("_source", "_coarse").agg(F.sum("words").alias("words"))
    coarse = coarse.select(F.col("_source").alias("_cs"), F.col("_coarse").alias("_cc"), past("_source", order="_coarse").alias("_far"))
    fine = fine.select("_source", "_bucket", "_coarse", past("_source", "_coarse", order="_bucket").alias("_near"))
    offsets = fine.join(coarse, F.col("_source").eqNullSafe(F.col("_cs")) & (F.col("_coarse") == F.col("_cc"))).select(
        "_source", "_bucket", (F.col("_far") + F.col("_near")).alias("_before")
    )
    offsets = offsets.join(aims, F.col("_source").eqNullSafe(F.col("source"))).select(
        F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), "_before", "source_size", "cycle", "target"
    )
    joined = keyed.join(offsets, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    row = W.partitionBy("_source", "_bucket").orderBy("_digest", "_tie")
    begin = F.col("_before") + F.sum("mix_size").over(row.rowsBetween(W.unboundedPreceding, 0)) - F.col("mix_size")
    placed = joined.withColumn("_begin", begin).withColumn("_due", F.round("target").cast("long"))
    whole = F.when(F.col("source_size") > 0, F.expr("_due div source_size")).otherwise(F.lit(0).cast("long"))
    placed = placed.withColumn("_whole", whole).withColumn("_rest", F.col("_due") - F.col("_whole") * F.col("source_size"))
    cut = F.greatest(F.lit(0), F.least(F.col("mix_size"), F.col("_rest") - F.col("_begin")))
    placed = placed.withColumn("_cut", cut)
    copies = F.col("_whole") + F.when(F.col("_cut") > 0, 1).otherwise(0)

    def time(turn: Column) -> Column:
        share = (turn * F.col("source_size") + F.col("_begin")) / F.col("_due")
        out = F.when(F.col("cycle") == 0, due_time(share, schedules[0]))
        for i in range(1, len(weights)):
            out = out.when(F.col("cycle") == i, due_time(share, schedules[i % len(schedules)]))
        return out

    times = F.transform(F.sequence(F.lit(0).cast("long"), copies - 1), time)
    mix = placed.select(
        *own.values(),
        "mix_size",
        "source_size",
        "target",
        F.col("_whole") * F.col("mix_size") + F.col("_cut"),
        F.when((F.col("mix_size") > 0) & (copies > 0), times).otherwise(F.array().cast("array<double>")),
    )
    return mix.toDF(*own, *RESULT)


def by_position(mix: DataFrame) -> DataFrame:
    """Rows of a mix, range-sorted by the time of their first copy, equal ones by a hash of the row, so that many of them
    (documents that aren't taken, which come last) are still dealt out to many partitions."""
    first = F.coalesce(F.get("mix_positions", F.lit(0)), F.lit(2.0))
    tie = F.xxhash64(*[F.col(f"`{name}`") for name, kind in mix.dtypes if "map<" not in kind])
    # range bounds are sampled from a stored table: the mix isn't made twice for that
    stored = settled(mix.withColumns({"_first": first, "_tie": tie}), "mix")
    return stored.repartitionByRange("_first", "_tie").sortWithinPartitions("_first", "_tie").drop("_first", "_tie")
