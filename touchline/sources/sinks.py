"""Landing, logs, rejects and flat exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchline.operators.incremental import replace_by_key
from touchline.session import exists

RUN_LOG = ("run_id string, stage string, status string, finished_at string, duration_s double, "
           "rows bigint, message string")
MESSAGE_LIMIT = 500
BYTE_ORDER_MARK = "﻿"


def land(df: DataFrame, folder: str, partition_by: list[str] | None = None) -> int:
    """Replace a table, with all its partitions; the row count is observed while it is written."""
    seen = Observation()
    writer = (df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
              .option("partitionOverwriteMode", "static"))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    return seen.get["rows"]


def land_all(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    return {name: land(df, f"{folder}/{name}") for name, df in tables.items()}


def append_log(df: DataFrame, folder: str) -> None:
    """Append rows; the first append creates the log."""
    df.write.mode("append").parquet(folder)


def land_partitions(batch: DataFrame, folder: str, key: str) -> None:
    """Replace only the key values the batch holds; other partitions stay untouched."""
    (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(key).parquet(folder))


def land_new_version(spark: SparkSession, batch: DataFrame, key: str, current: str | None, target: str) -> str:
    """Replace by key into a new folder and return it; readers keep the old one until then.

    For keys with too many values to be partitions, such as run ids.
    """
    if current is None or not exists(spark, current):
        batch.write.parquet(target)
    else:
        replace_by_key(spark.read.parquet(current), batch, key).write.parquet(target)
    return target


def record_runs(entries: DataFrame, folder: str) -> None:
    """Append pipeline runs as JSON lines; long messages are cut."""
    (entries.withColumn("message", F.substring("message", 1, MESSAGE_LIMIT))
     .withColumn("duration_s", F.round("duration_s", 2))
     .write.mode("append").option("ignoreNullFields", False).json(folder))


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every recorded run; blank lines are skipped, no log reads as empty."""
    if not exists(spark, folder):
        return spark.createDataFrame([], RUN_LOG)
    return spark.read.schema(RUN_LOG).option("mode", "FAILFAST").json(folder)


def write_rejects(rejects: DataFrame, folder: str) -> None:
    rejects.write.mode("overwrite").option("header", True).csv(folder)


def flat(df: DataFrame) -> DataFrame:
    """Booleans as 0 and 1, for consumers that read CSV."""
    return df.select(*[F.col(c).cast("int").alias(c) if kind == "boolean" else F.col(c)
                       for c, kind in df.dtypes])


def export_csv(tables: dict[str, DataFrame], folder: str, mark: bool = True) -> None:
    """One folder of CSV parts per table, timestamps in UTC.

    The byte-order mark spreadsheets want is part of the first header, hence of every part.
    """
    for name, df in tables.items():
        out = flat(df)
        if mark:
            out = out.withColumnRenamed(out.columns[0], BYTE_ORDER_MARK + out.columns[0])
        (out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8")
         .option("timeZone", "UTC").option("timestampFormat", "yyyy-MM-dd HH:mm:ssxxx").csv(f"{folder}/{name}"))


def read_export(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("enforceSchema", True)
    return (reader.schema(schema) if schema else reader).csv(folder)


def stamped(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssxxx")
