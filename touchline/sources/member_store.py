"""Stored histories of members, of which a refresh reads and rewrites only what changed.

A member's entries lie in the bucket of its id. A refresh compares the members' signatures with those of the last one,
reads the files of members that are due, and writes anew only the buckets that hold one of them; every other bucket
keeps its files. Entries and signatures are published in one step at the end, so a refresh that dies halfway has marked
nobody as fresh. A due member without a file keeps the entries it has and stays due.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.incremental import needing_refresh, signatures
from touchline.operators.joins import small_side
from touchline.session import known_rows, materialize
from touchline.sources import versions
from touchline.sources.game_documents import HISTORY, history_documents, member_files

BUCKETS = 64
LISTED_FILES = 10_000  # so many due files are read by name; beyond that all are read and the due ones kept
HISTORIES, SIGNATURES = "member_histories", "member_signatures"


def bucket_of(member: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(member), F.lit(buckets)).cast("int")


def due_members(spark: SparkSession, store: str, members: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(ids that are new, moved or have no stored entries; the signatures they were judged by), both written."""
    now = materialize(signatures(members, "id", columns))
    tables = versions.published(spark, store)
    if SIGNATURES not in tables:
        return materialize(now.select("id")), now
    stored = versions.open_table(spark, store, tables[HISTORIES]).select("id").distinct()
    return materialize(needing_refresh(now, versions.open_table(spark, store, tables[SIGNATURES]), "id", stored)), now


def refresh_histories(spark: SparkSession, folder: str, store: str, members: DataFrame, columns: list[str],
                      prefix: str = "player_", entry: str = "history", schema: str = HISTORY, buckets: int = BUCKETS) -> DataFrame:
    """Bring the store up to the files of changed members; returns the entries of all known members, as
    ``game_documents.histories`` does."""
    due, now = due_members(spark, store, members, columns)
    before = versions.published(spark, store).get(HISTORIES)
    if known_rows(due) or before is None:
        few = []
        if before:
            files = member_files(spark, folder, prefix, paths=True).join(small_side(due), "id", "left_semi")
            few = [r["path"] for r in files.select("path").limit(LISTED_FILES + 1).collect()]
        listed = before is not None and len(few) <= LISTED_FILES
        fresh = history_documents(spark, few if listed else folder, prefix, entry, schema)
        if before and not listed:
            fresh = fresh.join(small_side(due), "id", "left_semi")
        fresh = materialize(fresh.withColumn("bucket", bucket_of(F.col("id"), buckets)))
        arrived = materialize(fresh.select("id").distinct())
        changed = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
        if changed or before is None:
            rows = fresh
            if before:
                old = versions.open_table(spark, store, before).filter(F.col("bucket").isin(changed))
                rows = old.join(small_side(arrived), "id", "left_anti").unionByName(fresh)
            table = versions.stage_parts(rows, store, HISTORIES, "bucket", changed)
            # A due member whose file did not come gets no new signature, hence stays due.
            missed = due.join(small_side(arrived), "id", "left_anti")
            marks = versions.stage(now.join(missed, "id", "left_anti"), store, SIGNATURES)
            versions.publish(spark, store, table, marks)
            versions.vacuum(spark, store, [HISTORIES, SIGNATURES])
    known = small_side(members.select(F.col("id").alias("_id")))
    rows = versions.read(spark, store, HISTORIES).filter("_e IS NOT NULL")
    rows = rows.join(known, F.col("id") == F.col("_id"), "left_semi")
    return rows.select(F.col("id").alias("fpl_element_id"), "_place", "_e.*")
