"""Groups of similar rows from shared keys, without all pairs of a group.

1. Every key that several ids share names one of them its centre; members are verified against the centre.
2. Verified links go through a distributed union-find.
3. Where a key still holds several components, the members outside its largest one are compared, in bounded blocks
   and only across components, with each other and with the largest one; what they link joins the components.

So a key shared by thousands of near copies costs a star, and pairs are compared only where that star leaves
the answer open. No link between two ids that share a key is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import chunks
from touchline.llm.tables import small, written
from touchline.session import known_rows

BLOCK_ROWS = 512
BLOCK_BYTES = 16_000_000
SET_BYTES = 4_000_000  # of sets that are looked at together
EDGE = "child long, parent long"
Decode = Callable[[pa.Array], list[np.ndarray]]
Screen = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


class Forest:
    """Union-find over whole numbers; the smallest member is the root."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(up, up)
            x = up
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y

    def edges(self) -> pa.RecordBatch:
        rows = [(x, self.root(x)) for x in list(self.parent)]
        rows = [(x, r) for x, r in rows if x != r]
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.int64())], ["child", "parent"])


def spanning(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as a spanning forest: fewer edges than ids."""
    forest = Forest()
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(x, y)
    yield forest.edges()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (two long columns); the component is its smallest id.

    Each task first reduces its links to a forest; then rounds of large and small stars, each written to the
    shared folder, until nothing changes. Only aggregates and joins move data, so one component may be huge.
    """
    stars, seen = written(links.toDF("child", "parent").mapInArrow(spanning, EDGE)), None
    while known_rows(stars):
        mark = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("child", "parent"))).first()
        if mark == seen:
            break
        seen = mark
        both = stars.select(F.col("child").alias("a"), F.col("parent").alias("b")).union(stars.select("parent", "child"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("child"), F.col("low").alias("parent")).distinct()
        low = large.groupBy("child").agg(F.min("parent").alias("low"))
        tied = large.join(low, "child")
        moved = tied.select("parent", "low").filter("parent != low").union(low)
        stars = written(moved.toDF("child", "parent").distinct())
    members = stars.select(F.col("child").alias("id"), F.col("parent").alias("component"))
    roots = stars.select(F.col("parent").alias("id"), F.col("parent").alias("component")).distinct()
    return members.union(roots)


def crowded(keys: DataFrame) -> DataFrame:
    """Rows (key, id) whose key holds two ids or more, with the key's centre, as a written table.

    The centre is the id that comes first in an order of the key's own, so that a group that shares many keys
    has many centres. Only (key, least, greatest) is aggregated, before the shuffle first.
    """
    turned = F.col("id").bitwiseXOR(F.col("key"))
    ends = keys.groupBy("key").agg(F.min(turned).alias("least"), F.max(turned).alias("most"))
    shared = written(ends.filter("least < most").select("key", F.col("least").bitwiseXOR(F.col("key")).alias("centre")))
    return written(keys.join(small(shared, 16), "key").distinct())


def as_items(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def similar(shared, sizes_a, sizes_b, num: int, den: int):
    """Whether den * intersection >= num * union, from the size of the intersection."""
    return den * shared >= num * (sizes_a + sizes_b - shared)


def registers_of(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint16).reshape(len(column), -1)


def verify_pairs(num: int, den: int, screen: Screen | None, decode: Decode):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "items_a", SET_BYTES):
            x, y = decode(batch.column("items_a")), decode(batch.column("items_b"))
            sizes_a, sizes_b = np.array([len(v) for v in x]), np.array([len(v) for v in y])
            fits = similar(np.minimum(sizes_a, sizes_b), sizes_a, sizes_b, num, den)
            if screen:
                fits &= screen(registers_of(batch.column("regs_a")), registers_of(batch.column("regs_b")), sizes_a, sizes_b)
            for i in np.flatnonzero(fits):
                fits[i] = similar(common(x[i], y[i]), sizes_a[i], sizes_b[i], num, den)
            kept = batch.filter(pa.array(fits))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["child", "parent"])
    return run


def intersections(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of a block, by products of their incidence matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count >= 2
    number, owner = np.cumsum(shared) - 1, owner[shared[column]]
    column = number[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def common(x: np.ndarray, y: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    both = np.concatenate((x, y))
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def link_block(forest: Forest, groups: np.ndarray, sides: np.ndarray | None, sets: list[np.ndarray], registers: np.ndarray | None,
               num: int, den: int, screen: Screen | None) -> None:
    """Join the components of similar rows of one block, or, with ``sides``, of one block and another."""
    groups = np.array([forest.root(g) if g in forest.parent else g for g in groups.tolist()])
    sizes = np.array([len(s) for s in sets])
    fits = np.triu(groups[:, None] != groups[None, :], 1)
    if sides is not None:
        fits &= sides[:, None] != sides[None, :]
    fits &= similar(np.minimum(sizes[:, None], sizes[None, :]), sizes[:, None], sizes[None, :], num, den)
    if screen:
        for i in np.flatnonzero(fits.any(1)):
            j = np.flatnonzero(fits[i])
            fits[i, j] = screen(np.broadcast_to(registers[i], (len(j), registers.shape[1])), registers[j], np.full(len(j), sizes[i]), sizes[j])
    left, right = np.nonzero(fits)
    if len(left) > 50:
        held = intersections(sets)[left, right]
    else:
        held = np.array([common(sets[i], sets[j]) for i, j in zip(left, right, strict=True)])
    for k in np.flatnonzero(similar(held, sizes[left], sizes[right], num, den)) if len(left) else ():
        forest.join(int(groups[left[k]]), int(groups[right[k]]))


def compare_blocks(num: int, den: int, screen: Screen | None, decode: Decode):
    """Links between components within blocks; the rows of a block come one after another."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, held = Forest(), None

        def work(rows: pa.Table) -> None:
            rows = rows.combine_chunks()
            key, low, high, groups, sides = (rows.column(c).to_numpy() for c in ("key", "low", "high", "component", "block"))
            sets = decode(rows.column("items").combine_chunks())
            registers = registers_of(rows.column("regs")) if screen else None
            for a, b in zip((heads := heads_of(key, low, high)), [*heads[1:], len(key)], strict=True):
                link_block(forest, groups[a:b], sides[a:b] if low[a] != high[a] else None, sets[a:b],
                           registers[a:b] if screen else None, num, den, screen)

        for batch in chunks(batches, "items", SET_BYTES):
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            last = heads_of(*(rows.column(c).to_numpy() for c in ("key", "low", "high")))[-1]
            if last:
                work(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None:
            work(held)
        yield forest.edges()
    return run


def heads_of(*columns: np.ndarray) -> list[int]:
    """Where a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new).tolist()


def dealt_keys(sized: DataFrame) -> DataFrame:
    """(key, main, blocks, main_blocks) of the keys whose members (key, id, component, n) are of several components.

    ``main`` is the component with the most members of the key, the smallest of several; they are dealt into blocks of
    their own, the others into ``blocks``. A key that fits into one block has no blocks of its main component.
    """
    def parts(rows, size):
        return F.ceil(F.greatest(F.col(rows) / BLOCK_ROWS, F.col(size) / BLOCK_BYTES)).cast("int")

    held = sized.groupBy("key", "component").agg(F.count(F.lit(1)).alias("rows"), (F.sum("n") * 8).alias("size"))
    keys = held.groupBy("key").agg(
        F.count(F.lit(1)).alias("held"), F.sum("rows").alias("rows"), F.sum("size").alias("size"),
        F.max(F.struct("rows", (-F.col("component")).alias("turned"), "size")).alias("most")).filter("held > 1")
    keys = keys.select("key", (-F.col("most.turned")).alias("main"), "rows", "size", F.col("most.rows").alias("main_rows"),
                       F.col("most.size").alias("main_size"))
    keys = keys.withColumns({"other_rows": F.col("rows") - F.col("main_rows"), "other_size": F.col("size") - F.col("main_size")})
    whole = parts("rows", "size") == 1
    return keys.select("key", "main", F.when(whole, 1).otherwise(F.greatest(F.lit(1), parts("other_rows", "other_size"))).alias("blocks"),
                       F.when(whole, 0).otherwise(F.greatest(F.lit(1), parts("main_rows", "main_size"))).alias("main_blocks"))


def block_rows(rows: DataFrame) -> DataFrame:
    """Rows (key, id, component, block, low, high): each member once for every pair of blocks it is compared in.

    Blocks of a key's main component meet only the blocks of the others, never each other: what they hold is linked.
    """
    is_main = (F.col("main_blocks") > 0) & (F.col("component") == F.col("main"))
    place = F.when(is_main, F.col("blocks") + F.pmod(F.xxhash64("id"), F.greatest("main_blocks", F.lit(1)))).otherwise(
        F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int")
    met = F.col("blocks") + F.when(is_main, F.lit(0)).otherwise(F.col("main_blocks"))
    rows = rows.withColumn("block", place).withColumn("other", F.explode(F.sequence(F.lit(0), met - 1)))
    return rows.select("key", "id", "component", "block", F.least("block", "other").alias("low"),
                       F.greatest("block", "other").alias("high"))


def linked_groups(members: DataFrame, sets: DataFrame, num: int, den: int, screen: Screen | None = None,
                  decode: Decode = as_items) -> DataFrame:
    """(id, component) of the ids that some chain of verified links joins to another one.

    ``members``: the written (key, id, centre) of :func:`crowded`. ``sets``: (id, n, regs, items) for those ids,
    items being what ``decode`` turns into the sorted distinct 64-bit values of the set.
    """
    pairs = members.filter("id != centre").select(
        F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    for side in "ab":
        own = sets.select(F.col("id").alias(side), F.col("regs").alias(f"regs_{side}"), F.col("items").alias(f"items_{side}"))
        pairs = pairs.join(own, side)
    # Written, as two Python steps in one stage would take two workers a task, and executors keep both.
    verified = written(pairs.mapInArrow(verify_pairs(num, den, screen, decode), EDGE))
    first = written(components(verified))
    others = members.filter("id != centre").join(small(first, 16), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    open_keys = written(dealt_keys(others.join(sets.select("id", "n"), "id")))
    if not known_rows(open_keys):
        return first
    rows = block_rows(others.join(small(open_keys, 24), "key")).join(sets.select("id", "regs", "items"), "id")
    block = ["key", "low", "high"]
    more = written(rows.repartition(*block).sortWithinPartitions(*block).mapInArrow(compare_blocks(num, den, screen, decode), EDGE))
    if not known_rows(more):
        return first
    return written(components(first.filter("id != component").toDF("child", "parent").union(more)))
