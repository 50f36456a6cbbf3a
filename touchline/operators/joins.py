"""Dimension lookups. A side is broadcast only after its row count was checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import as_column
from touchline.operators.keys import SMALL_ROWS, fits
from touchline.session import known_bytes, known_rows, materialize

SPARE_KEYS = 64
SMALL_BYTES = 64_000_000
_STAND_IN = {"string": "", "int": 0, "bigint": 0}


class UnmappedName(KeyError):
    """A name or id has no canonical counterpart."""


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Hint a broadcast for a join side only if it proves small enough, in rows and in bytes. A
    side that was not measured yet is computed once, which measures it; one with nested columns has
    no size in bytes, so it is left to the planner and not computed again."""
    side = df if known_rows(df) is not None else materialize(df)
    size = known_bytes(side)
    return F.broadcast(side) if fits(side, max_rows) and size is not None and size <= max_bytes else side


def require(df: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str]) -> DataFrame:
    """Inner lookup: rows whose key the dimension does not know are dropped.

    ``on`` maps fact columns to dimension columns, ``take`` dimension columns to new names.
    """
    return _look_up(df, dim, on, take, "inner")


def look_up(df: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str],
            default=None, spread_missing: bool = False) -> DataFrame:
    """Left lookup: NULL on a miss, or ``default`` (the Unknown member) when one is given.

    ``spread_missing`` is for facts that often lack the key: rows without one match nothing,
    so they take one of many spare join keys instead of piling up in one shuffle partition.
    """
    out = _look_up(df, dim, on, take, "left", spread_missing)
    if default is None:
        return out
    return out.withColumns({new: F.coalesce(F.col(new), F.lit(default)) for new in take.values()})


def _look_up(df, dim, on, take, how, spread_missing=False):
    side = dim.select(
        *[F.col(c).alias(f"_on_{i}") for i, c in enumerate(on.values())],
        *[F.col(c).alias(f"_take_{new}") for c, new in take.items()])
    keyed, condition = df, [F.col(c) == F.col(f"_on_{i}") for i, c in enumerate(on)]
    if spread_missing:
        first = next(iter(on))
        stand_in = F.lit(_STAND_IN[dict(df.dtypes)[first]])
        spare = F.when(F.col(first).isNull(), F.pmod(F.spark_partition_id(), F.lit(SPARE_KEYS)) + 1)
        keyed = df.withColumns({"_spare": F.coalesce(spare, F.lit(0)),
                                "_first": F.coalesce(F.col(first), stand_in)})
        side = side.withColumn("_none", F.lit(0))
        condition = [F.col("_first") == F.col("_on_0"), F.col("_spare") == F.col("_none"),
                     *condition[1:]]
    return keyed.join(side, condition, how).select(
        *df.columns, *[F.col(f"_take_{new}").alias(new) for new in take.values()])


def respelled(name: Column | str, names: dict[str, str]) -> Column:
    """Canonical spelling of a name, the name itself when it is not mapped."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(table[F.trim(as_column(name))], as_column(name))


def fail_unless_mapped(name: Column | str, names: dict[str, str], source: str) -> Column:
    """False for a mapped name; the job fails on any other, naming it."""
    shown = F.coalesce(F.trim(as_column(name)), F.lit("NULL"))
    failure = F.raise_error(F.concat(F.lit(f"Unmapped {source} name: "), shown))
    return F.when(is_mapped(name, names), F.lit(False)).otherwise(failure.cast("boolean"))


def canonical(name: Column | str, names: dict[str, str], source: str) -> Column:
    """Canonical spelling of a name; the job fails on a name that is not mapped."""
    return F.when(~fail_unless_mapped(name, names, source), respelled(name, names))


def is_mapped(name: Column | str, names: dict[str, str]) -> Column:
    return F.coalesce(F.trim(as_column(name)).isin(list(names)), F.lit(False))


def strict_look_up(df: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str],
                   what: str) -> DataFrame:
    """Left lookup that fails the job on a key the mapping does not hold."""
    out = _look_up(df, dim.withColumn("_found", F.lit(True)), on, {**take, "_found": "_found"}, "left")
    key = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in on])
    failed = F.raise_error(F.concat(F.lit(f"Unknown {what}: "), key))
    kinds = dict(out.dtypes)
    return out.withColumns({
        new: F.when(F.col("_found"), F.col(new)).otherwise(failed.cast(kinds[new]))
        for new in take.values()}).drop("_found")


def require_mapped(df: DataFrame, column: str, names: dict[str, str], source: str) -> None:
    """Stop before any work is done when a name is not mapped, saying how many and the first of them."""
    missed = unmapped(df, column, names).agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first")).first()
    if missed["n"]:
        raise UnmappedName(f"{missed['n']} unmapped {source} names, the first: {missed['first']}")


def unmapped(df: DataFrame, column: str, names: dict[str, str]) -> DataFrame:
    """Every distinct name without a canonical spelling, NULL shown as such."""
    shown = F.coalesce(F.trim(F.col(column)), F.lit("NULL")).alias("name")
    return df.filter(~is_mapped(column, names)).select(shown).distinct()


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a global aggregate (exactly one row by construction) to every row."""
    return df.join(F.broadcast(one_row))


def without_match(df: DataFrame, other: DataFrame, on: dict[str, str]) -> DataFrame:
    side = other.select(*[F.col(c).alias(f"_on_{i}") for i, c in enumerate(on.values())])
    return df.join(side, [F.col(c) == F.col(f"_on_{i}") for i, c in enumerate(on)], "left_anti")


def dropped_keys(df: DataFrame, dim: DataFrame, on: dict[str, str]) -> DataFrame:
    """What an inner lookup loses: unknown keys and the rows behind each. Rows are counted
    per key before the join."""
    return without_match(df.groupBy(*on).agg(F.count(F.lit(1)).alias("rows")), dim, on)
