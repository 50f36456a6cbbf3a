"""Reshaping: two-sided facts, spines, set operations, pivots, column presence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_sided(df: DataFrame, home: dict[str, Column], away: dict[str, Column],
              shared: list[str]) -> DataFrame:
    """One row per side of every row, from a single scan.

    ``home`` and ``away`` name the same output columns, with the measures swapped.
    """
    sides = F.array(*[F.struct(*[c.alias(n) for n, c in side.items()]) for side in (home, away)])
    return df.select(*shared, F.explode(sides).alias("_side")).select(
        *shared, *[F.col(f"_side.{n}").alias(n) for n in home])


def distinct_union(parts: list[DataFrame], name: str) -> DataFrame:
    """Distinct non-NULL values of one-column inputs. Each input is made distinct first, so
    only distinct values are shuffled."""
    slim = [p.toDF(name).filter(F.col(name).isNotNull()).distinct() for p in parts]
    return reduce(DataFrame.unionByName, slim).distinct()


def stack_columns(df: DataFrame, ids: list[str], columns: list[str], name: str) -> DataFrame:
    """Stack columns under each other, one scan."""
    return df.select(*ids, F.explode(F.array(*columns)).alias(name))


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not hold (NULL equals NULL)."""
    return left.distinct().subtract(right.distinct())


def both_differences(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    tag = lambda df, side: df.withColumn("only_in", F.lit(side))
    return tag(set_difference(left, right), left_name).unionByName(
        tag(set_difference(right, left), right_name))


def spine(bounds: DataFrame, low: str, high: str, name: str) -> DataFrame:
    """Every whole number or day from ``low`` to ``high``; no rows for an empty span."""
    known = F.col(low).isNotNull() & (F.col(low) <= F.col(high))
    return bounds.filter(known).select(F.explode(F.sequence(F.col(low), F.col(high))).alias(name))


def with_unknown_member(dim: DataFrame, unknown: dict) -> DataFrame:
    """Prepend one fixed member, such as id 0 named Unknown."""
    row = dim.sparkSession.range(1).select(
        *[F.lit(unknown[c]).cast(t).alias(c) for c, t in dim.dtypes])
    return row.unionByName(dim)


def pivot_mean(df: DataFrame, rows: str, columns: str, values: list, measure: str,
               prefix: str = "p") -> DataFrame:
    """Mean of ``measure`` per row entity and period, one column per listed period, plus the
    mean of the period means (periods without rows are left out of it).

    The long form is aggregated first, so the pivot sees one row per entity and period.
    """
    means = (df.filter(F.col(columns).isin(values)).groupBy(rows, columns)
             .agg(F.avg(measure).alias("_mean")))
    wide = [F.max(F.when(F.col(columns) == v, F.col("_mean"))).alias(f"{prefix}{v}") for v in values]
    return means.groupBy(rows).agg(*wide, F.avg("_mean").alias("mean"))


def column_presence(headers: DataFrame, file: str, column: str) -> DataFrame:
    """For each column: how many files have it, of how many, and whether all do.

    ``headers`` holds one row per file and column. No list of files is built, however many there are.
    """
    files = headers.agg(F.count_distinct(file).alias("files"))
    per_column = headers.groupBy(column).agg(F.count_distinct(file).alias("present"))
    return per_column.join(F.broadcast(files)).select(
        column, "present", "files", (F.col("present") == F.col("files")).alias("stable"))


def missing_columns(headers: DataFrame, file: str, column: str) -> DataFrame:
    """One row per file and column that the file lacks and another one has.

    Files are compared by their set of columns, and there are few such sets.
    """
    sets = headers.groupBy(file).agg(F.array_sort(F.collect_set(column)).alias("_has"))
    known = sets.select("_has").distinct().select(F.explode("_has").alias(column)).distinct()
    every = known.agg(F.collect_list(column).alias("_all"))
    return sets.join(F.broadcast(every)).select(file, F.explode(F.array_except("_all", "_has")).alias(column))
