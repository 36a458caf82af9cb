"""The operators as registered queries: each reads its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstone.llm import codes, decontaminate, extraction, language, mixing, periods, quality, scoring, simhash, substrings, tokens, urls, warc
from tillstone.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]

CONTEXT = 512  # tokens


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extracted(table(spark, folder, "pages"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.col(c).alias("n_" + c[8:] if c != "quality_word_chars" else "word_chars") for c in quality.STATISTICS],
                        F.col("quality_base_failed").alias("base_failed"), F.col("quality_kept").alias("kept"))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.verdict(decontaminate.matches(docs, table(spark, folder, "benchmark")))
    return found.select(
        "doc_id",
        F.col("hit_words").alias("n_words"),
        F.col("hit_count").alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        decontaminate.items_digest().alias("items_sha256"),
        "contaminated",
    )


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.as_hex("print").alias("fingerprint"), "component_id")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(table(spark, folder, "documents").select("doc_id", "text", "source"))
    names = ["mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_positions"]
    light = mixing.by_position(mix.select("doc_id", *names))
    first = F.round(F.get("mix_positions", F.lit(0)), 6).alias("position")
    return light.select("doc_id", *[F.col(c).alias(c[4:]) for c in names[:-1]], first)


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    place = warc.new_folder(spark)
    found = warc.read(warc.write(table(spark, folder, "pages"), place), place)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs.where(~language.is_held_out()))
    return language.identified(docs, model, language.is_held_out())


def op8_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filtered(table(spark, folder, "pages"))


def op9_substrings(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substrings.without_repeats(docs).select(
        "doc_id",
        F.col("cut_words").alias("n_words"),
        F.col("cut_removed").alias("n_removed"),
        F.col("cut_sha256").alias("kept_sha256"),
    )


def op10_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.scored(table(spark, folder, "documents"), scoring.is_held_out())


def op11_periods(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.periodic_runs(periods.with_planted_runs(table(spark, folder, "documents").select("doc_id", "text")))
    top = periods.longest_run()
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[top[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * top["length"] / top["period"]).cast("long").alias("exponent_milli"),
        periods.runs_digest().alias("runs_sha256"),
        F.sha2("run_text", 256).alias("collapsed_sha256"),
    )


def op12_tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    found = tokens.token_counts(table(spark, folder, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select(
        "doc_id",
        F.col("token_bytes").alias("n_bytes"),
        F.col("token_count").alias("n_tokens"),
        (F.col("token_count") > CONTEXT).alias("over_limit"),
    )


def op13_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = codes.compressed(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))
    found = codes.with_label_error(coded)
    return found.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        F.col("code_error").alias("error"),
        "label_error",
        F.lit(codes.books_digest(books)).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_extraction,
        op2_quality,
        op3_decontaminate,
        op4_simhash,
        op5_mixing,
        op6_warc,
        op7_language,
        op8_urls,
        op9_substrings,
        op10_scoring,
        op11_periods,
        op12_tokens,
        op13_codes,
    )
}
