"""Dense 1..n keys in sort order, and ranks over result sets of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import known_rows, materialize, with_known_rows

SMALL_ROWS = 100_000
_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def fits(df: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """True when ``df``, which must be materialized, has at most ``max_rows`` rows."""
    rows = known_rows(df)
    return rows is not None and rows <= max_rows


def number_rows(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Number a table of any size 1..n by ``order``, which must be unique.

    One range exchange sorts the rows across the cluster; a hot leading value is split
    because the whole sort key sets the ranges, and AQE may merge small neighbours. The sorted rows are written to the shared
    folder, so that both readers below see the same partitions, and each partition's
    offset (one row per partition, hence broadcast) turns local positions into the key.
    """
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()))
    chunk = F.shiftrightunsigned("_place", _POSITION_BITS)
    in_order = Window.orderBy("_chunk")
    offsets = (
        placed.groupBy(chunk.alias("_chunk")).agg(F.count(F.lit(1)).alias("_rows"))
        .select("_chunk", (F.sum("_rows").over(in_order) - F.col("_rows")).alias("_offset")))
    local = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_chunk", chunk)
        .join(F.broadcast(offsets), "_chunk")
        .select((F.col("_offset") + local + 1).alias(name), *df.columns))


def number_members(df: DataFrame, order: list[Column | str], name: str,
                   small_rows: int = SMALL_ROWS) -> DataFrame:
    """Number the members of a dimension 1..n; one sort when they are few, else as above."""
    members = materialize(df)
    rows = known_rows(members)
    if not fits(members, small_rows):
        return with_known_rows(number_rows(members, order, name), rows, members)
    key = F.row_number().over(Window.orderBy(*order)).cast("long")
    return with_known_rows(members.select(key.alias(name), *df.columns), rows, members)


def competition_rank(df: DataFrame, by: list[str], name: str,
                     small_rows: int = SMALL_ROWS) -> DataFrame:
    """RANK over the whole result set, ``by`` descending: ties share a rank and the next
    rank is skipped.

    Beyond ``small_rows`` rows the set is numbered across the cluster; the rank of a tie is
    its smallest number, found with one aggregate per distinct sort key.
    """
    rows = materialize(df)
    order = [F.col(c).desc_nulls_last() for c in by]
    if fits(rows, small_rows):
        return rows.withColumn(name, F.rank().over(Window.orderBy(*order)).cast("long"))
    # The hash of the whole row splits the range of a tie that many rows share.
    numbered = number_rows(rows, [*order, F.xxhash64(*df.columns)], "_number")
    ties = numbered.groupBy(*[F.col(c).alias(f"_tie_{c}") for c in by]).agg(
        F.min("_number").alias(name))
    same = [F.col(c).eqNullSafe(F.col(f"_tie_{c}")) for c in by]
    return numbered.join(ties, same).select(*df.columns, name)
