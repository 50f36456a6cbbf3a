"""Ordered windows that survive a partition key holding a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.joins import small_side
from touchline.session import known_rows, materialize

HOT_ROWS = 5_000_000


def running(df: DataFrame, partition: list[str], order: list[str], sums: dict[str, Column],
            number: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Running totals (ROWS UNBOUNDED PRECEDING) and the row number within a group, along
    ``order``, which must be unique within a group.

    Groups of more than ``hot_rows`` rows are looked for first, with one narrow aggregate.
    Without any, one window does it all. A hot group is cut into chunks, see ``_chunked``.
    """
    measures = dict(sums)
    if number:
        measures[number] = F.lit(1)
    hot = materialize(df.groupBy(*partition).agg(F.count(F.lit(1)).alias("_rows"))
                      .filter(F.col("_rows") > hot_rows)
                      .select(*[F.col(c).alias(f"_h_{c}") for c in partition]))
    if known_rows(hot) == 0:
        return _windowed(df, partition, order, measures)
    # At most rows / hot_rows groups are hot; the list is broadcast if that proves few.
    is_hot = [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in partition]
    hot = small_side(hot)
    cold_rows = _windowed(df.join(hot, is_hot, "left_anti"), partition, order, measures)
    return cold_rows.unionByName(_chunked(df.join(hot, is_hot, "left_semi"), partition, order, measures))


def _windowed(df, partition, order, measures):
    up_to_here = (Window.partitionBy(*partition).orderBy(*order)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.select(*df.columns, *[F.sum(c).over(up_to_here).alias(n) for n, c in measures.items()])


def _chunked(df, partition, order, measures):
    """Running totals of groups too large for a task.

    The rows are range-partitioned by group and order, so partitions are even however the
    rows are spread, and are written once to fix the cut. Each (group, chunk) is windowed on
    its own; totals of earlier chunks, at most one row per chunk, are added on top.
    """
    values = {f"_v_{n}": c for n, c in measures.items()}
    cut = materialize(df.withColumns(values).repartitionByRange(*partition, *order)
                      .withColumn("_chunk", F.spark_partition_id()))
    before = (Window.partitionBy(*partition).orderBy("_chunk")
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = (cut.groupBy(*partition, "_chunk").agg(*[F.sum(v).alias(v) for v in values])
               .select(*[F.col(c).alias(f"_c_{c}") for c in [*partition, "_chunk"]],
                       *[F.sum(v).over(before).alias(f"_before{v}") for v in values]))
    local = _windowed(cut, [*partition, "_chunk"], order, {f"_in{v}": F.col(v) for v in values})
    same = [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in [*partition, "_chunk"]]
    totals = [_added(F.col(f"_in_v_{n}"), F.col(f"_before_v_{n}")).alias(n) for n in measures]
    return local.join(carried, same, "left").select(*df.columns, *totals)


def _added(here: Column, before: Column) -> Column:
    """The sum of two totals, either of which is NULL while all its values are."""
    return F.when(here.isNull(), before).when(before.isNull(), here).otherwise(here + before)


def trailing_sum(df: DataFrame, partition: list[str], period: str, sums: dict[str, str],
                 span: int = 4) -> DataFrame:
    """Sums over the current period and the ``span`` period numbers before it.

    Rows are first summed to one per entity and period, so a doubled period counts once, a
    missing one still uses a slot, and an entity's window is bounded by the period count.
    """
    per_period = df.groupBy(*partition, period).agg(*[F.sum(c).alias(c) for c in dict.fromkeys(sums.values())])
    window = Window.partitionBy(*partition).orderBy(period).rangeBetween(-span, Window.currentRow)
    return per_period.select(*partition, period, *[F.sum(c).over(window).alias(n) for n, c in sums.items()])


def islands(df: DataFrame, partition: list[str], order: list[str], holds: Column, at: str,
            hot_rows: int = HOT_ROWS) -> DataFrame:
    """Unbroken runs of rows for which ``holds``: length, first and last ``at``.

    A run is named by the number of breaks before it, which is a running total and so keeps
    the protection against hot groups; the runs themselves are a plain aggregate.
    """
    broken = F.when(F.col("_holds"), 0).otherwise(1)
    numbered = running(df.withColumn("_holds", holds), partition, order, {"_island": broken}, hot_rows=hot_rows)
    return (numbered.filter("_holds").groupBy(*partition, "_island")
            .agg(F.count(F.lit(1)).alias("streak_length"), F.min(at).alias("started"),
                 F.max(at).alias("ended"))
            .drop("_island"))
