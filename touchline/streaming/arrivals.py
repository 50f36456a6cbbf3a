"""Drive the match cleaning by newly arrived files.

The batch rule is "skip files already in the manifest, always take the live one". With a
file stream its checkpoint keeps the list of processed files; ``availableNow`` drains the
new ones and stops, so a scheduler can call it every few hours.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARRIVED = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, folder: str, pattern: str = "*.csv", nested: bool = False) -> DataFrame:
    """Stream of files that arrived or were written again: path, size and time; their bytes are not read."""
    files = (spark.readStream.format("binaryFile").schema(ARRIVED).option("recursiveFileLookup", str(nested).lower())
             .option("pathGlobFilter", pattern).load(folder))
    return files.select("path", "modificationTime", "length")


def on_arrival(spark: SparkSession, folder: str, checkpoint: str,
               handle: Callable[[DataFrame, int], None], pattern: str = "*.csv", nested: bool = False) -> int:
    """Hand each batch of new files to ``handle`` and return the number of batches.

    ``handle`` may see a batch again after a failure, so it should replace what it writes
    (by season), not append.
    """
    handled = []

    def counted(batch: DataFrame, number: int) -> None:
        handle(batch, number)
        handled.append(number)

    query = (new_files(spark, folder, pattern, nested).writeStream.foreachBatch(counted)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return len(handled)


def seasons_in(batch: DataFrame) -> DataFrame:
    """Seasons whose file arrived."""
    return batch.select(F.regexp_extract("path", r"_([0-9]{4})\.csv$", 1).alias("season")).distinct()
