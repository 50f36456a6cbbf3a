"""Warehouse tests. Each returns the failing rows, so an empty result passes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.joins import with_one_row
from touchline.operators.reshape import spine


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are ignored."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1"))


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def orphans(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Keys without a parent row, one row each with the rows behind it; NULL keys pass.

    Keys are counted before the join, so a hot key is one row in it.
    """
    keys = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return keys.join(parent.select(F.col(field).alias("_parent")), F.col(column) == F.col("_parent"), "left_anti")


def not_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return (df.filter(~F.col(column).isin(values)).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")))


def outside(column: str, low=None, high=None) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return bad


def out_of_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows outside the closed range; NULL passes."""
    return df.filter(outside(column, low, high))


def repeated_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def calendar_gaps(df: DataFrame, day: str) -> DataFrame:
    """One row (days, first, last) when the calendar does not hold every day of its span."""
    span = df.agg(F.count(F.lit(1)).alias("days"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return span.filter(F.col("days") != F.datediff("last_day", "first_day") + 1)


def missing_periods(df: DataFrame, period: str) -> DataFrame:
    """Period numbers between the first and the last that no row has."""
    bounds = df.agg(F.min(period).alias("lo"), F.max(period).alias("hi"))
    seen = df.select(F.col(period).alias("_seen")).distinct()
    return spine(bounds, "lo", "hi", period).join(seen, F.col(period) == F.col("_seen"), "left_anti")


def missing_periods_by(df: DataFrame, group: str, period: str) -> DataFrame:
    """As above for every member of a group, against the span of the whole table.

    Each period a member has looks at the one before and after it; only the gaps between them are spelt out, so
    what is there is never multiplied by what could be.
    """
    bounds = df.agg(F.min(period).alias("_lo"), F.max(period).alias("_hi"))
    in_order = Window.partitionBy(group).orderBy(F.col(period).asc_nulls_first())
    seen = df.select(group, period).distinct().withColumns({
        "_before": F.lag(period).over(in_order), "_after": F.lead(period).over(in_order)})
    here, none = F.col(period), F.col(period).isNull()
    first = F.when(none, F.col("_lo")).otherwise(F.coalesce(F.col("_before") + 1, F.col("_lo")))
    until = F.when(none & F.col("_after").isNull(), F.col("_hi")).when(~none, here - 1)
    last = F.when(~none & F.col("_after").isNull(), here + 1)
    gaps = F.array(F.struct(first.alias("start"), until.alias("end")), F.struct(last.alias("start"), F.col("_hi").alias("end")))
    spans = with_one_row(seen, bounds).select(group, F.explode(gaps).alias("_gap")).filter("_gap.start <= _gap.end")
    kind = dict(df.dtypes)[period]
    return spans.select(group, F.explode(F.sequence("_gap.start", "_gap.end").cast(f"array<{kind}>")).alias(period))


@dataclass(frozen=True)
class Test:
    __test__ = False  # not a pytest class
    model: str
    column: str
    kind: str
    values: tuple = ()


def failing_rows(test: Test, models: dict[str, DataFrame]) -> DataFrame:
    df = models[test.model]
    if test.kind == "unique":
        return not_unique(df, test.column)
    if test.kind == "not_null":
        return is_null(df, test.column)
    if test.kind == "relationships":
        parent, field = test.values
        return orphans(df, test.column, models[parent], field)
    if test.kind == "accepted_values":
        return not_accepted(df, test.column, list(test.values))
    if test.kind == "accepted_range":
        return out_of_range(df, test.column, *test.values)
    if test.kind == "unique_combination":
        return repeated_combination(df, list(test.values))
    if test.kind == "no_gaps":
        return calendar_gaps(df, test.column)
    if test.kind == "contiguous":
        return missing_periods(df, test.column)
    raise ValueError(f"unknown test kind {test.kind}")


def row_condition(test: Test) -> Column | None:
    """The failing condition of a test that looks at single rows, else None."""
    if test.kind == "not_null":
        return F.col(test.column).isNull()
    if test.kind == "accepted_range":
        return outside(test.column, *test.values)
    return None


def run_tests(tests: list[Test], models: dict[str, DataFrame]) -> DataFrame:
    """One row per declared test with the number of failing rows. All tests of a model that
    look at single rows share one pass over it."""
    rows, single = [], {}
    for test in tests:
        if row_condition(test) is None:
            counted = failing_rows(test, models).agg(F.count(F.lit(1)).alias("failures"))
            rows.append(counted.select(*labels(test), "failures"))
        else:
            single.setdefault(test.model, []).append(test)
    for model, group in single.items():
        totals = models[model].agg(*[F.count_if(row_condition(t)).alias(f"t{i}") for i, t in enumerate(group)])
        results = F.array(*[F.struct(*labels(t), F.col(f"t{i}").alias("failures")) for i, t in enumerate(group)])
        rows.append(totals.select(F.explode(results).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, rows)


def labels(test: Test) -> list[Column]:
    return [F.lit(test.model).alias("model"), F.lit(test.column).alias("column_name"), F.lit(test.kind).alias("test")]
