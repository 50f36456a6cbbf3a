"""Blocks of keys that hold several components: few copies of a row, and no link lost."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import linking

KEYED = "key long, id long, component long, n long"


def dealt(spark, rows):
    members = spark.createDataFrame(rows, KEYED)
    return members, linking.block_rows(members.drop("n").join(linking.dealt_keys(members), "key"))


def test_members_of_the_main_component_meet_only_the_others(spark, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK_ROWS", 20)
    rows = [(7, i, 0, 5) for i in range(2_000)] + [(7, 5_000, 5_000, 5)]
    rows += [(8, i, 0, 5) for i in range(100)]  # one component: never dealt
    rows += [(9, i, i % 2, 5) for i in range(10)]  # fits into a block
    members, blocks = dealt(spark, rows)
    copies = {r.key: r.n for r in blocks.groupBy("key").agg(F.count("*").alias("n")).collect()}
    # Each linked member once, the other one once for each of the 100 blocks and once for its own.
    assert copies == {7: 2_000 + 100 + 1, 9: 10}
    assert not blocks.filter("key = 7 AND low = high AND component = 0").count()


def test_every_pair_of_components_meets_once(spark, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK_ROWS", 8)
    rng = random.Random(3)
    rows = [(k, i, rng.choice([0, 0, 0, 1, 2, i]), rng.randrange(1, 9)) for k in range(6) for i in range(10 * k + 1)]
    members, blocks = dealt(spark, rows)
    met = blocks.alias("x").join(blocks.alias("y"), ["key", "low", "high"]).filter(
        "x.id < y.id AND x.component != y.component AND (low = high OR x.block != y.block)")
    got = sorted((r.key, r.a, r.b) for r in met.selectExpr("key", "x.id AS a", "y.id AS b").collect())
    held = [(k, i, c) for k, i, c, _ in rows]
    assert got == sorted((k, i, j) for k, i, c in held for q, j, d in held if k == q and i < j and c != d)


@pytest.mark.parametrize("rows_in_block", [4, 512])
def test_groups_equal_brute_force(spark, monkeypatch, rows_in_block):
    monkeypatch.setattr(linking, "BLOCK_ROWS", rows_in_block)
    rng = np.random.default_rng(11)
    sets = {}
    for i in range(120):  # one key for all; most are near copies of one set, the rest of a few others
        base = np.arange(20) + 1_000 * int(rng.choice([0, 0, 0, 0, 1, 2, 3]))
        sets[i] = np.unique(np.append(rng.choice(base, 17 + int(rng.integers(0, 4)), replace=False), 10**6 + int(rng.integers(0, 3)))).astype(np.uint64)
    forest = linking.Forest()
    for i in sets:
        for j in range(i):
            shared = linking.common(sets[i], sets[j])
            if 5 * shared >= 4 * (len(sets[i]) + len(sets[j]) - shared):
                forest.join(i, j)
    keys = spark.createDataFrame([(5, i) for i in sets], "key long, id long")
    frame = spark.createDataFrame([(i, len(s), b"", bytearray(s.tobytes())) for i, s in sets.items()], "id long, n long, regs binary, items binary")
    got = {i: i for i in sets} | {r.id: r.component for r in linking.linked_groups(linking.crowded(keys), frame, 4, 5).collect()}
    assert got == {i: forest.root(i) for i in sets}
    assert len(set(got.values())) > 1
