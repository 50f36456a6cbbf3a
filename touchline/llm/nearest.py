"""Nearest neighbours by stable projections: kd-trees over few dimensions, and a chi-square test that ends a search.

Each vector is projected on PROJECTIONS random Gaussian directions. For two vectors at distance D the squared distance
of their projections over D * D follows a chi-square law with that many degrees of freedom. A search takes projected
neighbours in ascending order, verifies each on the original vectors, and stops when the next projected distance, squared,
over the squared distance of the k-th best so far is beyond the law's quantile CERTAIN: a neighbour that is still missing
would have to lie that far out, which happens to one in a hundred of them.

The top of the tree is cut on the driver over a sample of at most SAMPLE projections, into cells of about CELL rows by its
estimate; every row is indexed in its cell, and a cell with more rows is dealt into blocks by row number. A task holds one
block with its own kd-tree and the queries that come to it. Queries first search the cell they fall in; the distance found
there bounds which other cells the test still admits, and only those are searched. Where very many queries come to a
block, they are cut in slices of SLICE, each with a copy of that block. The sample only sets where the cells are cut.

Equal vectors are one point that carries the k + 1 smallest ids, which is all that any query can need of them; equal
query vectors are searched once and go back to their rows at the end, the most frequent by broadcast.

Vectors that are null, all zero, of another length than most, or hold a null or non-finite component take no part, nor do
rows without id. Repeated rows count once; an id with several vectors is a row for each, none its own neighbour. Ties go
to the smaller id. An empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.tables import joined_to_rows, written
from touchline.session import known_rows

PROJECTIONS, SEED = 8, 20
CERTAIN = 0.99
SAMPLE = 100_000
CELL, LEAF = 4_096, 64
SAMPLED_A_CELL = 8  # a cell is cut over at least so many rows of the sample
SLICE = 20_000
POINT = "no long, vec array<double>, ids array<long>, cell int, low array<double>"


def chi_square_quantile(p: float, degrees: int) -> float:
    """The quantile for an even number of degrees, whose law is a short sum."""
    def beyond(x: float) -> float:
        term = total = np.exp(-x / 2)
        for j in range(1, degrees // 2):
            term *= x / 2 / j
            total += term
        return total
    low, high = 0.0, 1e3
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if beyond(middle) > 1 - p else (low, middle)
    return high


def directions(length: int, projections: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng([SEED, length]).standard_normal((length, projections))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


class Cells:
    """The top of the kd-tree: a full binary tree of cuts, and the box of each of its cells."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        width = sample.shape[1]
        self.depth, inner = depth, 2**depth - 1
        self.axis, self.cut = np.zeros(inner, np.int64), np.zeros(inner)
        low, high = np.full((2 * inner + 1, width), -np.inf), np.full((2 * inner + 1, width), np.inf)
        parts = {0: sample}
        for node in range(inner):
            part = parts.pop(node)
            axis = int(np.argmax(part.max(0) - part.min(0)))
            cut = np.median(part[:, axis])
            self.axis[node], self.cut[node] = axis, cut
            left, right = 2 * node + 1, 2 * node + 2
            for child in (left, right):
                low[child], high[child] = low[node], high[node]
            high[left, axis] = low[right, axis] = cut
            below = part[:, axis] < cut
            # A cut between equal values can leave one side without sample rows; its cell is then an empty box's.
            parts[left], parts[right] = (part[below] if below.any() else part[:1]), (part[~below] if not below.all() else part[:1])
        self.low, self.high = low[inner:], high[inner:]

    def of(self, points: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(points), np.int64), np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[rows, self.axis[node]] >= self.cut[node])
        return node - len(self.axis)

    def squared_distances(self, point: np.ndarray) -> np.ndarray:
        out = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        return np.einsum("ij,ij->i", out, out)


class Tree:
    """A kd-tree over the projections of one block; the boxes are those of the rows in them."""

    def __init__(self, low: np.ndarray, leaf: int = LEAF) -> None:
        self.points, self.nodes, waiting = low, [], [(np.arange(len(low)), None)]
        while waiting:
            rows, parent = waiting.pop()
            part = low[rows]
            least, most = part.min(0), part.max(0)
            node = len(self.nodes)
            self.nodes.append([least, most, None, None])
            if parent is not None:
                self.nodes[parent][3].append(node)
            axis = int(np.argmax(most - least))
            if len(rows) <= leaf or most[axis] == least[axis]:
                self.nodes[node][2] = rows
                continue
            self.nodes[node][3], half = [], len(rows) // 2
            order = rows[np.argpartition(part[:, axis], half)]
            waiting += [(order[:half], node), (order[half:], node)]

    def away(self, node: int, point: np.ndarray) -> float:
        least, most = self.nodes[node][:2]
        out = np.maximum(np.maximum(least - point, point - most), 0)
        return float(out @ out)

    def leaves(self, point: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(squared distance of its box, rows) of the leaves, nearest first."""
        heap = [(self.away(0, point), 0)]
        while heap:
            away, node = heapq.heappop(heap)
            rows, children = self.nodes[node][2:]
            if rows is not None:
                yield away, rows
            else:
                for child in children:
                    heapq.heappush(heap, (self.away(child, point), child))


class Block:
    """The rows of one block: vectors, the ids that each stands for, and the tree over their projections."""

    def __init__(self, vectors: np.ndarray, ids: pa.Array, low: np.ndarray) -> None:
        self.vectors, self.tree = vectors, Tree(low)
        self.ids = ids.flatten().to_numpy()
        self.first = np.r_[0, np.cumsum(ids.value_lengths().to_numpy())]

    def search(self, vector: np.ndarray, low: np.ndarray, k: int, bound: float, quantile: float) -> tuple[np.ndarray, np.ndarray]:
        """The distances and ids of the k nearest found; ``bound`` is a squared distance that k others already meet."""
        far, ids, kth = np.zeros(0), np.zeros(0, np.int64), bound
        for away, rows in self.tree.leaves(low):
            if away > kth * quantile:
                break
            offset = self.tree.points[rows] - low
            rows = rows[np.einsum("ij,ij->i", offset, offset) <= kth * quantile]
            offset = self.vectors[rows] - vector
            squares = np.einsum("ij,ij->i", offset, offset)
            near = squares <= kth
            rows, squares = rows[near], squares[near]
            if not len(rows):
                continue
            sizes = self.first[rows + 1] - self.first[rows]
            places = np.arange(sizes.sum()) + np.repeat(self.first[rows] - (np.cumsum(sizes) - sizes), sizes)
            far, ids = np.r_[far, np.repeat(squares, sizes)], np.r_[ids, self.ids[places]]
            if len(far) > k:
                best = np.lexsort((ids, far))[:k]
                far, ids = far[best], ids[best]
            if len(far) == k:
                kth = min(kth, float(far.max()))
        return far, ids


def usable(vectors: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """(id, vec) of the rows that take part, vec in doubles, and the vectors' length."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vec").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    length = lengths[0]["length"] if lengths else 0
    return rows.where(F.size("vec") == length), length


def with_projections(rows: DataFrame, length: int) -> DataFrame:
    """The rows and the array ``low`` of their projections."""
    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        along = directions(length)
        for batch in batches:
            low = matrix(batch.column("vec"), length) @ along
            low = pa.FixedSizeListArray.from_arrays(pa.array(low.ravel()), PROJECTIONS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, low], [*batch.schema.names, "low"])

    schema = ", ".join(f"{c} {kind}" for c, kind in rows.dtypes)
    return rows.mapInArrow(project, f"{schema}, low array<double>")


def in_cells(rows: DataFrame, cells: Cells) -> DataFrame:
    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = pa.array(cells.of(matrix(batch.column("low"), PROJECTIONS)), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, cell], [*batch.schema.names, "cell"])

    schema = ", ".join(f"{c} {kind}" for c, kind in rows.dtypes)
    return rows.mapInArrow(place, f"{schema}, cell int")


def numbered(rows: DataFrame) -> DataFrame:
    return written(rows.withColumn("no", F.monotonically_increasing_id()))


def cut_cells(points: DataFrame) -> Cells:
    """The cells for the counted rows of ``points``, cut over at most SAMPLE of them."""
    rows = known_rows(points)
    sample = points.select("low", F.xxhash64("no").alias("h"), "no").orderBy("h", "no").limit(SAMPLE).select("low").toArrow()
    sample = matrix(sample.column("low").combine_chunks(), PROJECTIONS)
    cells = max(1, min(-(-rows // CELL), len(sample) // SAMPLED_A_CELL))
    return Cells(sample, int(np.ceil(np.log2(cells))))


def admitted(requests: DataFrame, cells: Cells, quantile: float) -> DataFrame:
    """Each request once for every other cell that the test does not rule out at its distance so far."""
    def cross(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, home = matrix(batch.column("low"), PROJECTIONS), batch.column("cell").to_pylist()
            bounds, lists = batch.column("bound").to_numpy(), []
            for point, own, bound in zip(low, home, bounds, strict=True):
                near = np.flatnonzero(cells.squared_distances(point) <= bound * quantile)
                lists.append(near[near != own])
            offsets = np.r_[0, np.cumsum([len(x) for x in lists])]
            found = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(lists) if lists else [], pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "others"])

    schema = ", ".join(f"{c} {kind}" for c, kind in requests.dtypes)
    return requests.mapInArrow(cross, f"{schema}, others array<int>").withColumn("cell", F.explode("others")).drop("others")


def searched(points: DataFrame, blocks: DataFrame, requests: DataFrame, length: int, k: int, quantile: float) -> DataFrame:
    """(no, far, id): the k nearest of each request in each block of its cell, far being a squared distance.

    ``points`` have a block, ``blocks`` are (cell, n_blocks), ``requests`` are (no, vec, low, cell, bound).
    """
    asked = requests.groupBy("cell").agg(F.count(F.lit(1)).alias("asked"))
    plan = blocks.join(asked, "cell").withColumn("slices", F.ceil(F.col("asked") / SLICE).cast("int"))
    held = points.join(plan.select("cell", "slices"), "cell").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    sent = requests.join(plan.select("cell", "slices", "n_blocks"), "cell")
    sent = sent.withColumn("slice", F.pmod(F.xxhash64("no"), F.col("slices")).cast("int"))
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    key = ["cell", "block", "slice"]

    def answer(points: pa.Table, wanted: pa.Table) -> pa.Table:
        out = {"no": [np.zeros(0, np.int64)], "far": [np.zeros(0)], "id": [np.zeros(0, np.int64)]}
        if len(points) and len(wanted):
            column = lambda table, name, width: matrix(table.column(name).combine_chunks(), width)
            block = Block(column(points, "vec", length), points.column("ids").combine_chunks(), column(points, "low", PROJECTIONS))
            vectors, lows = column(wanted, "vec", length), column(wanted, "low", PROJECTIONS)
            for no, vector, low, bound in zip(wanted.column("no").to_pylist(), vectors, lows, wanted.column("bound").to_pylist(), strict=True):
                far, ids = block.search(vector, low, k, bound, quantile)
                out["no"].append(np.full(len(far), no, np.int64))
                out["far"].append(far)
                out["id"].append(ids)
        return pa.table({name: np.concatenate(parts) for name, parts in out.items()})

    left = held.select(*key, "vec", "ids", "low").groupBy(*key)
    return left.cogroup(sent.select(*key, "no", "vec", "low", "bound").groupBy(*key)).applyInArrow(answer, "no long, far double, id long")


def best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("no").orderBy("far", "id"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def nearest_neighbours(vectors: DataFrame, wanted: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows for which ``wanted`` holds of the column ``id``: the k nearest found
    among all other rows, by Euclidean distance on the original vectors."""
    spark, quantile = vectors.sparkSession, chi_square_quantile(CERTAIN, PROJECTIONS)
    rows, length = usable(vectors, vec_id, vector)
    result = "query_id long, rank int, vec_id long, score double"
    if not length:
        return spark.createDataFrame([], result)
    rows = written(rows.distinct())
    smallest = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    kinds = rows.withColumn("place", smallest).where(F.col("place") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    points = numbered(with_projections(kinds, length))
    cells = cut_cells(points)
    points = in_cells(points, cells)
    blocks = points.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (2 * CELL)).cast("int").alias("n_blocks"))
    blocks = written(blocks)  # a row a cell, of which there are at most SAMPLE / SAMPLED_A_CELL * 2
    points = points.join(F.broadcast(blocks), "cell").withColumn("block", F.pmod(F.xxhash64("no"), F.col("n_blocks")).cast("int")).drop("n_blocks")

    queries = rows.where(wanted)
    asked = numbered(in_cells(with_projections(queries.groupBy("vec").agg(F.count(F.lit(1)).alias("n")), length), cells))
    requests = asked.withColumn("bound", F.lit(float("inf")))
    # One more than k, since a row finds itself.
    home = written(best(searched(points, blocks, requests, length, k + 1, quantile), k + 1).drop("place"))
    bounds = home.groupBy("no").agg(F.count(F.lit(1)).alias("n_found"), F.max("far").alias("far"))
    bound = F.when(F.col("n_found") > k, F.col("far")).otherwise(float("inf"))
    requests = admitted(asked.join(bounds, "no", "left").withColumn("bound", bound).drop("n_found", "far"), cells, quantile)
    there = searched(points, blocks, requests, length, k + 1, quantile)
    found = best(home.unionByName(there), k + 1)
    lists = found.groupBy("no").agg(F.array_sort(F.collect_list(F.struct("far", "id"))).alias("near"))
    lists = asked.select("no", "vec", "n").join(lists, "no").select("vec", "n", "near")

    answered = joined_to_rows(queries.select("vec", F.col("id").alias("query_id")), written(lists), "vec", "n")
    others = F.slice(F.filter("near", lambda r: r["id"] != F.col("query_id")), 1, k)
    ranked = answered.select("query_id", F.posexplode(others).alias("place", "one"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("one.id").alias("vec_id"), F.sqrt("one.far").alias("score"))
