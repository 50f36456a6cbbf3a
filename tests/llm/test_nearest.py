"""Nearest neighbours against brute force: every stated query against all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import nearest, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, no string, cell string, low string, far string, id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *["clash"] * 5) for i, v in rows], SCHEMA).repartition(4)


def usable(rows):
    length = max({len(v) for _, v in rows if v}, key=lambda n: (sum(len(v or ()) == n for _, v in rows), -n))
    return [(i, v) for i, v in rows if i is not None and v and len(v) == length and all(x is not None and math.isfinite(x) for x in v) and any(v)]


def brute(rows, k=10, step=100):
    """{(query id, its vector): [(distance, id)]} over the distinct usable rows."""
    rows = sorted({(i, tuple(v)) for i, v in usable(rows)})
    at, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    out = {}
    for i, v in rows:
        if i % step == 0:
            far = np.sqrt(((at - np.array(v)) ** 2).sum(1))
            other = ids != i
            out[i] = sorted(zip(far[other].tolist(), ids[other].tolist(), strict=True))[:k]
    return out


def found(result):
    out = {}
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return out


def recall(got, want):
    hits = sum(len({i for _, i in got.get(q, [])} & {i for _, i in near}) for q, near in want.items())
    return hits / sum(map(len, want.values()))


def clusters(count, width=24, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, width))
    return [(i, (centres[i % 12] + 0.4 * rng.standard_normal(width)).tolist()) for i in range(count)]


def test_quantile():
    assert abs(nearest.chi_square_quantile(0.99, 8) - 20.0902) < 1e-3
    assert abs(nearest.chi_square_quantile(0.95, 2) - 5.9915) < 1e-3
    draws = (np.random.default_rng(1).standard_normal((200_000, 8)) ** 2).sum(1)
    assert abs((draws <= nearest.chi_square_quantile(0.9, 8)).mean() - 0.9) < 0.005


def test_tree_gives_leaves_in_order():
    low = np.random.default_rng(2).standard_normal((1_000, 8))
    tree, point = nearest.Tree(low), np.zeros(8)
    leaves = list(tree.leaves(point))
    assert sorted(np.concatenate([rows for _, rows in leaves]).tolist()) == list(range(1_000))
    assert [away for away, _ in leaves] == sorted(away for away, _ in leaves)
    assert all((low[rows] ** 2).sum(1).min() >= away - 1e-12 for away, rows in leaves)
    assert len(nearest.Tree(np.ones((500, 8))).nodes) == 1


def test_cells_hold_their_rows():
    low = np.random.default_rng(3).standard_normal((2_000, 8))
    cells = nearest.Cells(low[:500], 4)
    of = cells.of(low)
    assert set(of) == set(range(16)) and np.bincount(of).max() < 400
    assert all((cells.low[c] <= p).all() and (p <= cells.high[c]).all() for c, p in zip(of, low, strict=True))


@pytest.mark.parametrize("cell, leaf_slice", [(4_096, 20_000), (40, 3)])
def test_recall_and_scores(spark, monkeypatch, cell, leaf_slice):
    """One block; and many cells, each in blocks, with queries in slices."""
    monkeypatch.setattr(nearest, "CELL", cell)
    monkeypatch.setattr(nearest, "SLICE", leaf_slice)
    rows = clusters(1_500)
    want, got = brute(rows, step=20), found(nearest.nearest_neighbours(frame(spark, rows), F.col("id") % 20 == 0))
    assert set(got) == set(want) and all(len(near) == 10 for near in got.values())
    assert recall(got, want) >= 0.95
    vectors = dict(rows)
    for q, near in got.items():
        assert near == sorted(near) and q not in {i for _, i in near}
        assert np.allclose([s for s, _ in near], [math.dist(vectors[q], vectors[i]) for _, i in near], rtol=1e-12)


def test_whole_tables(spark):
    docs = queries.table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in docs]
    got = found(queries.op13_nearest_neighbours(spark, SF))
    assert set(got) == set(brute(rows)) and recall(got, brute(rows)) >= 0.9
    everyone = brute(rows, step=1)
    assert recall(found(nearest.nearest_neighbours(frame(spark, rows), F.lit(True))), everyone) >= 0.95


def test_copies_ties_and_rows_that_take_no_part(spark):
    rows = clusters(300, 6)
    rows += [(1_000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(400)]  # a third and more are one vector
    rows += [(2_000, None), (2_100, []), (2_200, [0.0] * 6), (2_300, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2_400, [1.0] * 7),
             (2_500, [float("nan")] + [1.0] * 5), (2_600, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (2_700, [0.0] * 5 + [-0.5])]
    rows += rows[:30] + rows[300:330]  # repeated rows
    got, want = found(nearest.nearest_neighbours(frame(spark, rows), F.col("id") % 100 == 0)), brute(rows)
    assert set(got) == set(want) == {0, 100, 200, 1_000, 1_100, 1_200, 1_300, 2_700}
    for q in (1_000, 1_100, 1_200, 1_300):
        assert got[q] == want[q] == [(0.0, i) for i in range(1_000, 1_011) if i != q][:10]
    assert recall(got, want) >= 0.9


def test_one_id_with_several_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.0, 1.1])]
    got = nearest.nearest_neighbours(frame(spark, rows), F.col("id") == 0)
    assert sorted((r["rank"], r.vec_id) for r in got.collect()) == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_few_or_no_rows(spark):
    assert nearest.nearest_neighbours(frame(spark, []), F.col("id") % 100 == 0).count() == 0
    assert nearest.nearest_neighbours(frame(spark, [(0, None)]), F.col("id") % 100 == 0).count() == 0
    assert nearest.nearest_neighbours(frame(spark, [(0, [1.0, 2.0])]), F.col("id") % 100 == 0).count() == 0
    assert nearest.nearest_neighbours(frame(spark, [(1, [1.0, 2.0])]), F.col("id") % 100 == 0).count() == 0
    got = nearest.nearest_neighbours(frame(spark, [(0, [3.0, 4.0]), (7, [3.0, 0.0]), (5, [0.0, 4.0])]), F.col("id") % 100 == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 5, 3.0), (0, 2, 7, 4.0)]
