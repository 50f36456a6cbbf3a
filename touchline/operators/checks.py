"""Data contracts: DataFrames in, one (name, passed, detail) row per check out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import score_result
from touchline.operators.reshape import stack_columns

SHOWN = 100  # failing members that a detail names; the quarantine has them all


class ContractFailure(Exception):
    """At least one contract does not hold."""


@dataclass(frozen=True)
class RowCheck:
    """A check that one pass over a table can answer next to others.

    ``measures`` are aggregates; ``passed`` and ``detail`` are built from the struct of them.
    """
    name: str
    measures: dict[str, Column]
    passed: Callable[[Column], Column]
    detail: Callable[[Column], Column]


def run_row_checks(df: DataFrame, checks: list[RowCheck]) -> DataFrame:
    """All checks of a table from one aggregate."""
    measures = [c.alias(f"m{i}_{n}") for i, k in enumerate(checks) for n, c in k.measures.items()]
    totals = df.agg(*measures)
    rows = []
    for i, check in enumerate(checks):
        scope = F.struct(*[F.col(f"m{i}_{n}").alias(n) for n in check.measures])
        rows.append((check, f"s{i}", scope))
    scoped = totals.select(*[scope.alias(name) for _, name, scope in rows])
    results = F.array(*[
        F.struct(F.lit(check.name).alias("name"), check.passed(F.col(name)).alias("passed"),
                 check.detail(F.col(name)).alias("detail"))
        for check, name, _ in rows])
    return scoped.select(F.explode(results).alias("r")).select("r.name", "r.passed", "r.detail")


def count_rows(condition: Column) -> Column:
    """Rows for which the condition is true (a NULL condition is not)."""
    return F.count_if(condition)


def bad_rows_check(name: str, bad: Column, words: str) -> RowCheck:
    return RowCheck(name, {"n": count_rows(bad)}, lambda s: s["n"] == 0,
                    lambda s: F.concat(s["n"].cast("string"), F.lit(f" {words}")))


def no_nulls(columns: list[str]) -> RowCheck:
    def detail(s):
        parts = F.array(*[F.when(s[c] > 0, F.concat(F.lit(f"'{c}': "), s[c].cast("string"))) for c in columns])
        text = F.array_join(F.filter(parts, lambda p: p.isNotNull()), ", ")
        return F.when(text == "", "clean").otherwise(F.concat(F.lit("nulls: {"), text, F.lit("}")))
    return RowCheck("no nulls in required columns",
                    {c: count_rows(F.col(c).isNull()) for c in columns},
                    lambda s: reduce(lambda a, b: a & b, [s[c] == 0 for c in columns]), detail)


def result_agrees(home: str, away: str, result: str) -> RowCheck:
    wrong = ~score_result(home, away).eqNullSafe(F.col(result))
    return bad_rows_check("result agrees with scoreline", wrong, "disagree")


def none_after(day: str, as_of: Column) -> RowCheck:
    return bad_rows_check("no future-dated matches", F.col(day) > as_of, "rows")


def in_range(name: str, column: str, low, high, words: str) -> RowCheck:
    """Closed range; NULL passes."""
    return bad_rows_check(name, (F.col(column) < low) | (F.col(column) > high), words)


def row_count_within(cap: int) -> RowCheck:
    return RowCheck(f"live season within 0..{cap}", {"n": F.count(F.lit(1))},
                    lambda s: s["n"] <= cap, lambda s: F.concat(s["n"].cast("string"), F.lit(" matches")))


def unique_key(df: DataFrame, key: list[str], name: str = "natural key is unique") -> DataFrame:
    """Counts the rows beyond the first of every key."""
    extra = (df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("extra"))
             .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n")))
    return extra.select(F.lit(name).alias("name"), (F.col("n") == 0).alias("passed"),
                        F.concat(F.col("n").cast("string"), F.lit(" duplicates")).alias("detail"))


def named(failing: DataFrame, order: list[str], text: Callable[[Column], Column], name: str, ok: str,
          before: str, after: str) -> DataFrame:
    """The result of a check whose failing members are rows: the first SHOWN of them by ``order`` are in the
    detail, further ones are counted there."""
    counted = failing.agg(F.count(F.lit(1)).alias("n"))
    first = failing.select(F.struct(*order).alias("m")).orderBy("m").limit(SHOWN).agg(F.array_sort(F.collect_list("m")).alias("first"))
    more = F.when(F.col("n") > SHOWN, F.concat(F.lit(", and "), (F.col("n") - SHOWN).cast("string"), F.lit(" more"))).otherwise("")
    listed = F.concat(F.lit(before), F.array_join(F.transform("first", text), ", "), more, F.lit(after))
    return counted.join(F.broadcast(first)).select(
        F.lit(name).alias("name"), (F.col("n") == 0).alias("passed"), F.when(F.col("n") == 0, ok).otherwise(listed).alias("detail"))


def shown(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("'"), value.cast("string"), F.lit("'")), F.lit("NULL"))


def quarantined(failures: dict[str, DataFrame]) -> DataFrame:
    """(check, member, value) for every failing member of the named checks; ``failures`` have a member and a value."""
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(check).alias("check"), F.col("member").cast("string"), F.col("value").cast("bigint"))
        for check, df in failures.items()])


def wrong_counts(df: DataFrame, group: str, expected: int) -> DataFrame:
    """Groups without exactly ``expected`` rows and how many they have; NULL is a group like any other."""
    return (df.groupBy(F.col(group).alias("member")).agg(F.count(F.lit(1)).alias("value"))
            .filter(F.col("value") != expected))


def count_name(expected: int) -> str:
    return f"completed seasons have {expected} matches"


def group_counts(df: DataFrame, group: str, expected: int) -> DataFrame:
    """Every group present has exactly ``expected`` rows. An absent group is not noticed."""
    return named(wrong_counts(df, group, expected), ["member", "value"],
                 lambda m: F.concat(shown(m["member"]), F.lit(": "), m["value"].cast("string")),
                 count_name(expected), "all complete", "off: {", "}")


def member_counts(df: DataFrame, group: str, roles: list[str], expected: int) -> DataFrame:
    """Every member appears ``expected`` times per group over all its roles."""
    played = stack_columns(df, [group], roles, "member").filter(
        F.col(group).isNotNull() & F.col("member").isNotNull())
    wrong = (played.groupBy(group, "member").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") != expected).agg(F.count(F.lit(1)).alias("n")))
    return wrong.select(F.lit(f"every team plays {expected}").alias("name"),
                        (F.col("n") == 0).alias("passed"),
                        F.when(F.col("n") == 0, "balanced")
                        .otherwise(F.concat(F.col("n").cast("string"), F.lit(" off"))).alias("detail"))


def count_spread(df: DataFrame, roles: list[str], allowed: int) -> DataFrame:
    """The busiest and the idlest member differ by at most ``allowed``; no rows pass."""
    played = stack_columns(df, [], roles, "member").filter(F.col("member").isNotNull())
    spread = (played.groupBy("member").agg(F.count(F.lit(1)).alias("n"))
              .agg((F.max("n") - F.min("n")).alias("spread")))
    return spread.select(
        F.lit("fixture spread within tolerance").alias("name"),
        F.coalesce(F.col("spread") <= allowed, F.lit(True)).alias("passed"),
        F.coalesce(F.concat(F.lit("spread "), F.col("spread").cast("string"), F.lit(f", allowed {allowed}")),
                   F.lit("no matches yet")).alias("detail"))


SQUAD = "enough players per position for a legal squad"


def short_categories(df: DataFrame, required: DataFrame, category: str, minimum: str) -> DataFrame:
    """Categories with fewer rows than required, how many they have and need; an absent one has none."""
    have = df.groupBy(F.col(category).alias("_have")).agg(F.count(F.lit(1)).alias("n"))
    value = F.coalesce(F.col("n"), F.lit(0))
    return (required.join(have, F.col(category) == F.col("_have"), "left").filter(value < F.col(minimum))
            .select(F.col(category).alias("member"), value.alias("value"), F.col(minimum).alias("needed")))


def category_minimum(df: DataFrame, required: DataFrame, category: str, minimum: str) -> DataFrame:
    """Every category has at least its required number of rows."""
    return named(short_categories(df, required, category, minimum), ["member", "needed"],
                 lambda m: F.concat(F.coalesce(m["member"].cast("string"), F.lit("NULL")), F.lit(": "), m["needed"].cast("string")),
                 SQUAD, "ok", "short: {", "}")


def unknown_members(known: DataFrame, members: DataFrame) -> DataFrame:
    """Members that are not NULL and not among the known ones, and how many rows name each."""
    column = members.columns[0]
    named_by = members.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("member")).agg(F.count(F.lit(1)).alias("value"))
    side = known.toDF("_known").distinct()
    return named_by.join(side, F.col("member") == F.col("_known"), "left_anti")


def members_reconcile(known: DataFrame, members: DataFrame, name: str, ok: str, label: str) -> DataFrame:
    """Every non-NULL member appears among the known ones; the reverse is not asked."""
    return named(unknown_members(known, members), ["member"], lambda m: shown(m["member"]), name, ok, f"{label}: [", "]")


def union_results(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def stop_on_failure(results: DataFrame) -> list:
    """Collect the (few) result rows; raise when a check failed, naming all that did."""
    rows = results.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        listed = "; ".join(f"{r['name']} ({r['detail']})" for r in failed)
        raise ContractFailure(f"{len(failed)} data quality check(s) failed: {listed}")
    return rows
