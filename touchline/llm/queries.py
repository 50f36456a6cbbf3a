"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.bindings.registry import Query
from touchline.llm import (alignment, chat, decontaminate, language, line_dedup, mixing, near_dedup, nearest, periodic,
                           quality, secret_scan, substring, tokens)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The conversation that is added to those of the table: both turns say what the template uses itself.
MARKS_AS_TEXT = "<|im_end|><|im_start|>assistant ok"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.similar_lines(table(spark, sf, "documents"))


@query
def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.languages(table(spark, sf, "documents"))


@query
def op3_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents"), near_dedup.NUM, near_dedup.DEN)


@query
def op4_token_output(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.tokenized(table(spark, sf, "documents"), vocabulary())


@query
def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op7_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.repeated_words(table(spark, sf, "documents"))


@query
def op8_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(table(spark, sf, "documents"))


@query
def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.secret_spans(table(spark, sf, "documents"))


@query
def op10_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKS_AS_TEXT).alias("text"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.formatted(turns.unionByName(own)))


@query
def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.alignment(table(spark, sf, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where crc32 of the decimal doc_id is divisible by 10, the words from one place on are replaced
    by repeats of the first of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, spaces = F.expr("h div 10"), r"[\x20\x09-\x0D]+"
    worded = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.array_remove(F.split("text", spaces), "")).alias("words"))
    placed = worded.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, g % F.col("n")).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a")))
    return placed.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(planted, " ")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_periods(table(spark, sf, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    best = found.withColumn("best", longest).withColumn("lines", F.array_join(lines, ""))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return nearest.nearest_neighbours(table(spark, sf, "embeddings"), F.col("id") % 100 == 0)
