"""Statistics: moments, exact quantiles, correlation, least squares, intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.expressions import percent, round_half_away
from touchline.operators.joins import with_one_row
from touchline.session import materialize


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over complete pairs; NULL when a side does not vary."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.try_divide(F.covar_pop(a, b), F.nullif(spread, F.lit(0.0)))


def slope(x: str, y: str) -> Column:
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.try_divide(F.covar_pop(a, b), F.nullif(F.var_pop(a), F.lit(0.0)))


def intercept(x: str, y: str) -> Column:
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return F.avg(F.when(both, F.col(y))) - slope(x, y) * F.avg(F.when(both, F.col(x)))


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: the least-squares line of y on x, the correlation and its square."""
    r = correlation(x, y)
    return df.agg(F.count(F.lit(1)).alias("n"), slope(x, y).alias("slope"),
                  intercept(x, y).alias("intercept"), r.alias("r"), (r * r).alias("r_squared"))


def with_residuals(df: DataFrame, x: str, y: str, min_rows: int = 0) -> DataFrame:
    """Expected value on the line and the residual; NULL below ``min_rows`` rows."""
    line = fit_line(df, x, y).select("n", "slope", "intercept")
    expected = F.when(F.col("n") >= min_rows, F.col("intercept") + F.col("slope") * F.col(x))
    return with_one_row(df, line).select(
        *df.columns, expected.alias("expected"), (F.col(y) - expected).alias("residual"))


def correlation_with(df: DataFrame, target: str, others: list[str], digits: int = 6) -> DataFrame:
    """Correlation of every other column with ``target``, from one aggregate, highest first."""
    wide = df.agg(*[correlation(target, o).alias(o) for o in others])
    pairs = F.array(*[F.struct(F.lit(o).alias("measure"), F.col(o).alias("r")) for o in others])
    return wide.select(F.explode(pairs).alias("p")).select(
        "p.measure", round_half_away(F.col("p.r"), digits).alias("r"),
    ).orderBy(F.desc_nulls_last("r"), "measure")


def correlation_matrix(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Every pair once, as rows, from one aggregate."""
    names = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[correlation(a, b).alias(f"{a}|{b}") for a, b in names])
    pairs = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"),
                               F.col(f"`{a}|{b}`").alias("r")) for a, b in names])
    return wide.select(F.explode(pairs).alias("p")).select(
        "p.first", "p.second", round_half_away(F.col("p.r"), digits).alias("r"))


def mean_interval(df: DataFrame, group: list[str], value: str, small_sample: int = 60,
                  digits: int = 6) -> DataFrame:
    """Mean, sample deviation, rough 95% interval, and a flag for small samples."""
    n, mean, sd = F.col("n"), F.col("_mean"), F.col("_sd")
    half = F.lit(1.96) * sd / F.sqrt(n)
    show = lambda c: round_half_away(c, digits)
    return (df.groupBy(*group)
            .agg(F.count(value).alias("n"), F.avg(value).alias("_mean"),
                 F.stddev_samp(value).alias("_sd"), F.var_samp(value).alias("_var"))
            .select(*group, "n", show(mean).alias("mean"), show(F.col("_var")).alias("variance"),
                    show(sd).alias("sd"), show(mean - half).alias("low"),
                    show(mean + half).alias("high"), (n < small_sample).alias("small_sample")))


def exact_quantiles(df: DataFrame, group: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group, without ever sorting a group in one task.

    1. Count every distinct value (combined before the shuffle).
    2. Range-partition the counts by group and value and add them up per partition: at most
       one row per group and partition, enough to tell which partitions hold the wanted ranks.
    3. Number only the values in those partitions.
    """
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*group, F.col(value).cast("double").alias("_v"))
              .agg(F.count(F.lit(1)).alias("_n")))
    placed = materialize(counts.repartitionByRange(*group, "_v")
                         .withColumn("_b", F.spark_partition_id()))
    up_to = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group)
    filled = (placed.groupBy(*group, "_b").agg(F.sum("_n").alias("_in"))
              .withColumn("_before", F.sum("_in").over(up_to) - F.col("_in"))
              .withColumn("_total", F.sum("_in").over(whole)))
    ranks = F.array(*[F.struct(F.lit(n).alias("name"),
                               (F.lit(float(q)) * (F.col("_total") - 1)).alias("at"))
                      for n, q in quantiles.items()])
    wanted = (filled.select("*", F.explode(ranks).alias("_r"))
              .select(*group, "_b", "_in", "_before", F.col("_r.name").alias("_name"), F.col("_r.at").alias("_at"))
              .withColumn("_lo", F.floor("_at")).withColumn("_hi", F.ceil("_at"))
              # The partition holds the lower or the upper neighbour of the wanted rank.
              .filter(((F.col("_lo") >= F.col("_before")) & (F.col("_lo") < F.col("_before") + F.col("_in")))
                      | ((F.col("_hi") >= F.col("_before")) & (F.col("_hi") < F.col("_before") + F.col("_in")))))
    parts = wanted.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_b").alias("_bb"),
                            "_before", "_name", "_at", "_lo", "_hi")
    on = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col("_b") == F.col("_bb")]
    inside = (Window.partitionBy(*group, "_name", "_b").orderBy("_v")
              .rowsBetween(Window.unboundedPreceding, 0))
    numbered = (placed.join(parts, on)
                .withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
                .withColumn("_start", F.col("_end") - F.col("_n")))
    holds = lambda r: (F.col(r) >= F.col("_start")) & (F.col(r) < F.col("_end"))
    ends = numbered.groupBy(*group, "_name").agg(
        F.max(F.when(holds("_lo"), F.col("_v"))).alias("_a"),
        F.max(F.when(holds("_hi"), F.col("_v"))).alias("_z"),
        F.max(F.col("_at") - F.col("_lo")).alias("_part"))
    point = F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("_part")
    return ends.groupBy(*group).agg(
        *[F.max(F.when(F.col("_name") == n, point)).alias(n) for n in quantiles])


def describe(df: DataFrame, group: list[str], value: str, digits: int = 6) -> DataFrame:
    """Count, mean, deviation, quartiles and maximum per group."""
    moments = df.groupBy(*group).agg(
        F.count(value).alias("count"), round_half_away(F.avg(value), digits).alias("mean"),
        round_half_away(F.stddev_samp(value), digits).alias("std"), F.max(value).alias("max"))
    quartiles = exact_quantiles(df, group, value, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    side = quartiles.select(*[F.col(g).alias(f"_d_{g}") for g in group],
                            *[round_half_away(F.col(q), digits).alias(q) for q in ("q25", "median", "q75")])
    same = [F.col(g).eqNullSafe(F.col(f"_d_{g}")) for g in group]
    return moments.join(side, same, "left").select(*group, "count", "mean", "std", "q25", "median", "q75", "max")


def headline(df: DataFrame, best: str, middle: str) -> DataFrame:
    """One row: how many rows, the best value of one column, the exact median of another."""
    totals = df.agg(F.count(F.lit(1)).alias("shown"), F.max(best).alias("best"))
    return totals.join(F.broadcast(exact_quantiles(df, [], middle, {"median": 0.5})), how="left")


def usage_share(members: DataFrame, facts: DataFrame, fact_key: str, key: str, group: str,
                amount: str, floor: int = 90) -> DataFrame:
    """Per group: members, those never used, those under the floor and their share.

    Facts are summed to one row per member before the join; no facts at all means never.
    """
    used = facts.groupBy(F.col(fact_key).alias("_key")).agg(F.sum(amount).alias("_used"))
    total = F.col("_used")
    return (members.join(used, F.col(key) == F.col("_key"), "left").groupBy(group)
            .agg(F.count(F.lit(1)).alias("members"),
                 F.sum(F.when(total.isNull() | (total == 0), 1).otherwise(0)).alias("never_used"),
                 F.sum(F.when(F.coalesce(total, F.lit(0)) < floor, 1).otherwise(0)).alias("under_floor"))
            .withColumn("pct_under", percent(F.col("under_floor"), F.col("members"), 0)))
