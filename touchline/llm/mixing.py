"""Temperature mixing of sources, realised as budgeted block permutations.

A source's share p of the words becomes p**a / sum(p**a). The exponent a is the largest of 0 to 1 whose weights reach
TARGET_ENTROPY of the greatest entropy there is, or, if that repeats a document of some source too often, the least that keeps to
MAX_REPEATS. It is found by sections over a table of one row per source; only sums come to the driver.

Each source is dealt into about sqrt(n) blocks by a hash. An epoch takes its blocks in an order of its own, and the
budget ends within one block, where single documents are taken in hashed order until it is reached. So the only
running sums are over the blocks of a source and over the documents of one block. ``position`` in [0, 1) says how
far into its source's budget a block comes; ordered by it, the sources are mixed evenly. Documents of one block follow
each other by ``in_block``, a hash of the row and the epoch, so (position, in_block) is the whole permutation; equal rows, which
are one and the same document, share both.

Without a given budget it is as large as it must be for every document to be taken once at least. A document weighs its
words, one at least. Null texts have no words; a null source is a source of its own. Equal rows (doc_id and text) share
their fate. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.tables import small, written

TARGET_ENTROPY = 0.97
MAX_REPEATS = 2.0
SEED = 20
SECTIONS, ROUNDS = 32, 5


def source_key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))


def n_tokens() -> Column:
    return F.greatest(F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)), F.lit(1)).cast("long")


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the names this module adds, all beginning with _mix."""
    return docs.withColumns({"_mix_source": source_key(), "_mix_tokens": n_tokens(), "_mix_row": F.xxhash64("doc_id", "text")})


def temperature(shares: DataFrame, entropy: float, repeats: float, scale: float | None = None) -> float:
    """The exponent for the shares ``p`` of a table. With ``scale``, the budget over all tokens, a source repeats
    scale * w / p times; without, w / p over its least value."""
    n, low_p, high_p = shares.agg(F.count(F.lit(1)), F.min("p"), F.max("p")).first()
    if n < 2:
        return 1.0
    goal = entropy * math.log(n)

    def enough(sums, a: float) -> bool:
        z, s = sums
        return math.log(z) - a * s / z >= goal - 1e-12

    def fits(sums, a: float) -> bool:
        most = scale * low_p ** (a - 1) / sums[0] if scale else (low_p / high_p) ** (a - 1)
        return most <= repeats + 1e-12

    def section(holds, low: float, high: float, rising: bool) -> float:
        """Where ``holds`` changes between two exponents; ``rising`` if it holds above."""
        for _ in range(ROUNDS):
            grid = np.linspace(low, high, SECTIONS + 1)
            row = shares.agg(*[f for a in map(float, grid) for f in (F.sum(F.pow("p", F.lit(a))), F.sum(F.pow("p", F.lit(a)) * F.ln("p")))]).first()
            held = [holds((row[2 * i], row[2 * i + 1]), float(a)) for i, a in enumerate(grid)]
            if all(held):
                return low if rising else high
            if not any(held):
                return high if rising else low
            i = held.index(True) if rising else SECTIONS - held[::-1].index(True)
            low, high = (grid[i - 1], grid[i]) if rising else (grid[i], grid[i + 1])
        return float(high if rising else low)

    return max(section(enough, 0.0, 1.0, False), section(fits, 0.0, 1.0, True))


def weights(rows: DataFrame, entropy: float, repeats: float, budget: int | None) -> DataFrame:
    """One row per source: its tokens, share, weight and budget in tokens."""
    totals = written(rows.groupBy("_mix_source").agg(F.sum("_mix_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")))
    everything = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = totals.withColumn("p", F.col("tokens") / F.lit(float(max(everything, 1))))
    a = temperature(shares, entropy, repeats, budget / everything if budget and everything else None)
    z, least = shares.agg(F.sum(F.pow("p", F.lit(a))), F.min(F.pow("p", F.lit(a - 1)))).first()
    shares = shares.withColumn("weight", F.pow("p", F.lit(a)) / F.lit(z or 1.0))
    if budget is None:
        # In units of the source that is repeated least, which is taken once.
        share = F.round(F.col("tokens") * F.pow("p", F.lit(a - 1)) / F.lit(least or 1.0)).cast("long")
        return written(shares.withColumn("budget", F.greatest(share, "tokens")))
    return written(shares.withColumn("budget", F.round(F.col("weight") * budget).cast("long")))


def block_plan(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """For each source, epoch and block that is reached: its place and the tokens there is room for."""
    blocks = rows.groupBy("_mix_source", "_mix_block").agg(F.sum("_mix_tokens").alias("_mix_size"))
    named = blocks.join(sources.select("_mix_source", "tokens", "budget"), "_mix_source")
    epochs = named.withColumn("_mix_epoch", F.explode(F.sequence(F.lit(0), F.ceil(F.col("budget") / F.col("tokens")).cast("int"))))
    order = Window.partitionBy("_mix_source", "_mix_epoch").orderBy(
        F.xxhash64("_mix_block", "_mix_epoch", F.lit(SEED)), "_mix_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_mix_epoch") * F.col("tokens") + F.coalesce(F.sum("_mix_size").over(order), F.lit(0))
    placed = epochs.withColumn("before", before).withColumn("_mix_room", F.col("budget") - F.col("before"))
    return placed.filter("_mix_room > 0").select(
        "_mix_source", "_mix_block", "_mix_epoch", "_mix_size", "_mix_room", (F.col("before") / F.col("budget")).alias("_mix_position"))


def mixed(docs: DataFrame, entropy: float = TARGET_ENTROPY, repeats: float = MAX_REPEATS, budget: int | None = None) -> DataFrame:
    """Each taken document once per epoch: the columns of ``docs``, none of which may begin with _mix_, and _mix_tokens,
    _mix_epoch, _mix_position, _mix_in_block, _mix_weight."""
    if taken_names := [c for c in docs.columns if c.lower().startswith("_mix_")]:
        raise ValueError(f"columns of the result: {', '.join(taken_names)}")
    rows = written(keyed(docs).select("_mix_source", "_mix_tokens", "_mix_row"))
    sources = weights(rows, entropy, repeats, budget)

    def blocked(frame: DataFrame) -> DataFrame:
        counts = small(sources.select("_mix_source", F.col("n").alias("_mix_n"), F.col("weight").alias("_mix_weight")), 64)
        block = F.pmod(F.xxhash64("_mix_row", F.lit(SEED)), F.ceil(F.sqrt("_mix_n")).cast("long"))
        return frame.join(counts, "_mix_source").withColumn("_mix_block", block).drop("_mix_n")

    rows = blocked(rows)
    plan = written(block_plan(rows, sources))
    reached = small(plan, 64)
    # The one block of a source that the budget does not cover: its documents in hashed order, as far as it goes.
    last = rows.join(reached.filter("_mix_room < _mix_size"), ["_mix_source", "_mix_block"])
    equal = last.groupBy("_mix_source", "_mix_epoch", "_mix_row", "_mix_room").agg(F.sum("_mix_tokens").alias("tokens"))
    order = Window.partitionBy("_mix_source", "_mix_epoch").orderBy(
        F.xxhash64("_mix_row", "_mix_epoch", F.lit(SEED)), "_mix_row").rowsBetween(Window.unboundedPreceding, -1)
    chosen = equal.withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0))).filter("before < _mix_room")
    chosen = small(written(chosen.select("_mix_source", "_mix_epoch", "_mix_row", F.lit(True).alias("_mix_chosen"))), 64)
    taken = blocked(keyed(docs)).join(reached, ["_mix_source", "_mix_block"])
    taken = taken.join(chosen, ["_mix_source", "_mix_epoch", "_mix_row"], "left").filter("_mix_room >= _mix_size OR _mix_chosen")
    in_block = F.xxhash64("_mix_row", "_mix_epoch", F.lit(SEED))
    return taken.select(*[taken[c] for c in docs.columns], "_mix_tokens", "_mix_epoch", "_mix_position", in_block.alias("_mix_in_block"), "_mix_weight")


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The documents of the mix, each as often as it is taken, in the columns of ``docs``."""
    given = docs.columns
    plain = [f"given{c}" if c.lower().startswith("_mix_") else c for c in given]
    return mixed(docs.toDF(*plain), **params).select(plain).toDF(*given)


def mixture(docs: DataFrame, **params) -> DataFrame:
    """(doc_id, source, n_tokens, epoch, position, in_block, weight) of every taken document, once per epoch."""
    return mixed(docs.select("doc_id", "text", "source"), **params).select(
        "doc_id", "source", F.col("_mix_tokens").alias("n_tokens"), F.col("_mix_epoch").cast("int").alias("epoch"),
        F.col("_mix_position").alias("position"), F.col("_mix_in_block").alias("in_block"), F.col("_mix_weight").alias("weight"))
