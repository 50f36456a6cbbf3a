"""Row validation with a reject channel: ordered rules, the first failure names the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.joins import SMALL_BYTES, small_side
from touchline.session import known_bytes, known_rows, materialize

REASON = "reject_reason"
KEYS_BROADCAST = 1_000_000  # so many repeated keys are broadcast, if their counted bytes allow it


def first_failure(rules: list[tuple[str, Column]]) -> Column:
    """Reason of the first rule that holds, NULL when none does.

    A rule whose condition is NULL does not hold; write ``coalesce(condition, lit(True))``
    where missing data must fail. Later rules are not evaluated on rows that failed before.
    """
    return F.coalesce(*[F.when(condition, F.lit(reason)) for reason, condition in rules])


def first_members(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Key and order columns of the first row of every key. NULL keys are equal.

    An aggregate, not a window: a key with a third of all rows is reduced before the
    shuffle. ``order`` must be unique within a key.
    """
    if len(order) == 1:
        return df.groupBy(*key).agg(F.min(order[0]).alias(order[0]))
    first = df.groupBy(*key).agg(F.min(F.struct(*order)).alias("_first"))
    return first.select(*key, *[F.col(f"_first.{c}").alias(c) for c in order])


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Drop every row of a key but its first: one scan, and copies fall away before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    first = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return first.select(*[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def later_copies(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Every row of a key but its first. The join includes the unique order columns, so no
    task receives a whole group."""
    columns = key + order
    side = first_members(df, key, order).select(*[F.col(c).alias(f"_f_{c}") for c in columns])
    return df.join(side, [F.col(c).eqNullSafe(F.col(f"_f_{c}")) for c in columns], "left_anti")


def flag_rejects(df: DataFrame, rules: list[tuple[str, Column]], key: list[str] | None = None,
                 order: list[str] | None = None, duplicate_reason: str | None = None) -> DataFrame:
    """Add the reject reason to every row. Duplicates are looked for among survivors only.

    ``order`` says which copy comes first and must be unique within a key. Rows are parsed and
    judged once and written with a number of their own. Keys are counted by a narrow aggregate;
    only the copies of those that repeat are put in order. As long as the repeated keys can be broadcast, with the
    number of their first row, no row is moved however many copies there are; else the copies are found again by number.
    """
    flagged = df.withColumn(REASON, first_failure(rules))
    if key is None:
        return flagged
    rows = materialize(flagged.withColumn("_row", F.monotonically_increasing_id()))
    alive = rows.filter(F.col(REASON).isNull())
    again = alive.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    again = materialize(again.select(*[F.col(c).alias(f"_k_{c}") for c in key]))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key]
    copies = alive.select(*dict.fromkeys([*key, *order, "_row"])).join(repeated_keys(again), same, "left_semi")
    firsts = copies.groupBy(*key).agg(F.min_by("_row", F.struct(*order)).alias("_first"))
    duplicate = F.lit(duplicate_reason)
    if repeated_keys_fit(again):
        firsts = F.broadcast(firsts.select(*[F.col(c).alias(f"_k_{c}") for c in key], "_first"))
        later = F.col(REASON).isNull() & F.col("_first").isNotNull() & (F.col("_row") != F.col("_first"))
        return rows.join(firsts, same, "left").select(*df.columns, F.when(later, duplicate).otherwise(F.col(REASON)).alias(REASON))
    later = copies.join(firsts.select("_first"), F.col("_row") == F.col("_first"), "left_anti")
    later = small_side(later.select(F.col("_row").alias("_later")))
    return rows.join(later, F.col("_row") == F.col("_later"), "left").select(
        *df.columns, F.when(F.col("_later").isNotNull(), duplicate).otherwise(F.col(REASON)).alias(REASON))


def repeated_keys_fit(again: DataFrame) -> bool:
    """Whether the written keys that repeat may be broadcast, a number with each."""
    rows, size = known_rows(again), known_bytes(again)
    return rows is not None and size is not None and rows <= KEYS_BROADCAST and size + 16 * rows <= SMALL_BYTES


def repeated_keys(again: DataFrame) -> DataFrame:
    return F.broadcast(again) if repeated_keys_fit(again) else again


def kept(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col(REASON).isNotNull())


def reject_counts(flagged: DataFrame) -> DataFrame:
    return (rejected(flagged).groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), REASON))


def count_rejects(df: DataFrame, rules: list[tuple[str, Column]], key: list[str], duplicate_reason: str) -> DataFrame:
    """Rows per reject reason, as from flagging and counting, without saying which copy of a key goes: all but one do.

    One narrow aggregate; rejected rows share a group per reason, and a key is reduced before the shuffle.
    """
    reason = first_failure(rules)
    judged = df.select(reason.alias(REASON), *[F.col(c) for c in key])
    alive = F.col(REASON).isNull()
    # A key column may be NULL in rows that pass, so the group says which kind it is by its reason.
    sizes = judged.groupBy(REASON, *[F.when(alive, F.col(c)).alias(c) for c in key]).agg(F.count(F.lit(1)).alias("_n"))
    rows = F.when(alive, F.col("_n") - 1).otherwise(F.col("_n"))
    counts = sizes.select(F.coalesce(REASON, F.lit(duplicate_reason)).alias(REASON), rows.alias("rows")).groupBy(REASON).agg(
        F.sum("rows").alias("rows"))
    return counts.filter("rows > 0").orderBy(F.desc("rows"), REASON)
