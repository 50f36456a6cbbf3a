"""A corpus from raw documents to token ids: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir), is written as Parquet in the shared folder and read again, so a lost
executor costs a stage at most. All but the last return the columns of ``documents``; the last one writes the
token files and returns (doc_id, start, n_tokens, ids_crc32) as read back from them. Documents that the mix takes
twice have two rows.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import decontaminate, mixing, near_dedup, quality, tokens
from touchline.llm.queries import table, vocabulary
from touchline.llm.tables import written


#: So many rows go to a Python worker at a time, if the session does not say fewer. An executor holds a batch of whole
#: texts several times over: as Arrow on both sides of the pipe, and while its buffers grow.
BATCH_ROWS = 1_000
BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(stage):
    """A stage whose Python workers get at most BATCH_ROWS rows at a time. Results do not depend on batches. The session
    keeps the setting, as what a stage returns is lazy."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        now = int(spark.conf.get(BATCHES, "0"))
        spark.conf.set(BATCHES, str(min(now, BATCH_ROWS) if now > 0 else BATCH_ROWS))
        return stage(spark, docs, sf_dir)
    return run


@small_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


@small_batches
def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_near_duplicates(docs)


@small_batches
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


@small_batches
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


@small_batches
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.tokenized(docs, vocabulary(), lean=True)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_output),
]

#: Token ids cannot be expressed in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
