"""Change detection and incremental loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import fingerprint
from touchline.operators.joins import small_side


def signatures(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return df.select(key, fingerprint(*columns).alias("signature"))


def needing_refresh(current: DataFrame, previous: DataFrame, key: str,
                    stored: DataFrame | None = None) -> DataFrame:
    """Keys that are new, whose signature moved, or that have no stored history."""
    before = previous.select(F.col(key).alias("_key"), F.col("signature").alias("_before"))
    joined = current.join(before, F.col(key) == F.col("_key"), "left")
    changed = ~F.col("signature").eqNullSafe(F.col("_before"))
    if stored is not None:
        have = stored.select(F.col(key).alias("_stored")).distinct()
        joined = joined.join(have, F.col(key) == F.col("_stored"), "left")
        changed = changed | F.col("_stored").isNull()
    return joined.filter(changed).select(key)


def commit_snapshot(current: DataFrame, folder: str, fetch_all) -> None:
    """Store the new snapshot as the last action: a fetch that dies halfway must not mark
    its unfetched members as fresh."""
    fetch_all()
    current.write.mode("overwrite").parquet(folder)


def high_water_mark(periods: DataFrame, period: str, done: Column, last: Column) -> DataFrame:
    """One row: newest finished period, the stored one, and whether there is new work.

    Nothing finished means no work; nothing stored means work.
    """
    newest = periods.agg(F.max(F.when(done, F.col(period))).alias("latest"))
    behind = F.col("last_processed").isNull() | (F.col("latest") > F.col("last_processed"))
    return newest.withColumn("last_processed", last.cast("bigint")).select(
        F.col("latest").cast("bigint").alias("latest"), "last_processed",
        (F.col("latest").isNotNull() & behind).alias("should_refresh"))


def load_summary(matches: DataFrame, live: Column, day: str, facts: DataFrame, period: str,
                 refreshed_at: Column) -> DataFrame:
    """One row about a load: row counts, newest period and newest live day (as text)."""
    left = matches.agg(F.count(F.lit(1)).alias("total_matches"), F.count_if(live).alias("live_matches"),
                       F.date_format(F.max(F.when(live, F.col(day))), "yyyy-MM-dd").alias("latest_match_date"))
    right = facts.agg(F.count(F.lit(1)).alias("player_fixture_rows"),
                      F.max(period).cast("int").alias("latest_gameweek"))
    return left.join(F.broadcast(right)).select(
        refreshed_at.alias("refreshed_at"), "total_matches", "live_matches", "player_fixture_rows",
        "latest_gameweek", "latest_match_date")


def latest_entry(log: DataFrame, at: str, *ties: str) -> DataFrame:
    """The newest row; ``ties`` say which of several rows of one time is meant, the greatest first."""
    return log.orderBy(F.desc_nulls_last(at), *[F.desc_nulls_last(c) for c in ties]).limit(1)


def replace_by_key(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The stored rows without the keys of the batch, plus the batch.

    Keys such as a year have few values, so shuffling the stored rows by them would pile up;
    the batch's keys are counted and broadcast when few.
    """
    keys = small_side(batch.select(F.col(key).alias("_key")).distinct())
    return (stored.join(keys, F.col(key) == F.col("_key"), "left_anti")
            .unionByName(batch.select(*stored.columns)))


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row summaries side by side, and whether their row counts agree."""
    return left.join(F.broadcast(right)).withColumn(
        "agree", F.col("left_rows") == F.col("right_rows"))
