"""Corpus pipeline: quality rules, near duplicates, repeated substrings, benchmark passages, mixing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.llm import decontaminate, mixing, quality, simhash, substrings
from tillstone.plans.session import settled


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.judged(docs).where("quality_kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return simhash.one_of_each(docs, simhash.near_duplicates(docs))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages met earlier go; every document stays, with what is left of its text."""
    cut = substrings.without_repeats(docs)
    return cut.withColumn("n_chars", _n_chars(docs, cut)).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; in the others, the hit words go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.verdict(decontaminate.matches(docs, items)).where(~F.col("contaminated"))
    # Finding and cutting take a Python worker each: in one task, both would hold memory on the executor, in later stages too.
    clean = decontaminate.without_hits(settled(found, "clean-documents"))
    return clean.withColumn("n_chars", _n_chars(docs, clean)).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of, in the order of their first position, with size, source_size, target,
    taken and positions. Those it takes none of go."""
    taken = mixing.by_position(mixing.mixed(docs).where("mix_taken > 0"))
    return taken.withColumnsRenamed({name: name.removeprefix("mix_") for name in mixing.RESULT})


def _n_chars(docs: DataFrame, now: DataFrame):
    return F.length("text").cast(docs.schema["n_chars"].dataType)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
]

#: SimHash and XXH64 have no counterpart in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
