"""Grouped aggregates the analyses share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import as_column, percent


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; NULL (not 0) over no rows at all."""
    return F.sum(F.when(condition, 1).otherwise(0))


def latest(value: str, *keys: str) -> Column:
    """Value at the greatest key; rows without a value are skipped. Give enough keys to
    make the order unique, or ties leave the choice open."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*keys)))


def ordered_text(df: DataFrame, group: list[str], text: str, name: str, separator: str = ", ") -> DataFrame:
    return df.groupBy(*group).agg(ordered_list(text, separator).alias(name))


def ordered_list(text: str, separator: str = ", ") -> Column:
    """The group's texts in sort order, repeats kept. For groups of bounded length."""
    return F.array_join(F.array_sort(F.collect_list(text)), separator)


def mean_of_means(df: DataFrame, group: list[str], measures: list[str]) -> DataFrame:
    """One row: the unweighted mean over groups of each group's mean."""
    per_group = df.groupBy(*group).agg(*[F.avg(m).alias(m) for m in measures])
    return per_group.agg(*[F.avg(m).alias(m) for m in measures])


def value_counts(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("rows"))


def value_split(df: DataFrame, value: str, categories: list) -> DataFrame:
    """Share of each listed category in percent of all rows, in the listed order; a category
    without rows has a NULL share."""
    counts = value_counts(df, value)
    total = counts.agg(F.sum("rows").alias("_total"))
    listed = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(c) for c in categories])).alias("position", "_category"))
    return (listed.join(counts, F.col("_category") == F.col(value), "left")
            .join(F.broadcast(total))
            .select((F.col("position") + 1).alias("position"), F.col("_category").alias(value),
                    "rows", percent(F.col("rows"), F.col("_total"), 6).alias("share_pct")))


def length_histogram(df: DataFrame, text: Column | str) -> DataFrame:
    return df.filter(as_column(text).isNotNull()).groupBy(F.length(text).alias("length")).agg(
        F.count(F.lit(1)).alias("rows"))


def repeated(df: DataFrame, key: list[str], name: str = "rows") -> DataFrame:
    """Keys with more than one row and how many they have."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def most_frequent(df: DataFrame, value: str, at_least: int) -> DataFrame:
    """The most frequent value, its count, and whether it reaches ``at_least``."""
    return (value_counts(df, value).orderBy(F.desc("rows"), F.col(value).asc_nulls_last()).limit(1)
            .withColumn("concentrated", F.col("rows") >= at_least))


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Top n. ``order`` should end in a unique column; each task keeps only n rows."""
    return df.orderBy(*order).limit(n)
