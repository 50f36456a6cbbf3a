"""Near duplicates by HyperMinHash.

A document's set holds its distinct shingles of five lower-cased words. One 64-bit hash per shingle names one of
256 buckets and a value; a bucket keeps its least value as a register of 16 bits: six for the count of leading
zeros, ten for the mantissa after them. Bands of six registers (empty ones borrow from another bucket) give the
keys under which documents meet. Documents with equal sets meet first and go on as one. Before two sets are
compared in full, their registers must estimate a similarity near the limit, corrected for the registers that
agree by chance.

Empty texts, nulls and texts without words have an empty set and link with nothing. Rows without a doc_id take no
part: their component is null and they are kept. Rows that repeat a doc_id are linked each by its own set; a
component is named by its least doc_id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from touchline.llm.arrays import (BASES, NOT_SPACE, U64, between, chunks, mix, row_of, running, span_hashes, spans,
                                  text_bytes)
from touchline.llm.linking import crowded, linked_groups
from touchline.llm.tables import small, written
from touchline.session import known_rows

SHINGLE = 5
NUM, DEN = 85, 100  # of op3
STAGE_NUM, STAGE_DEN = 80, 100  # of the pipeline's stage
BUCKETS, BANDS, BAND = 256, 42, 6
MANTISSA = 10
EMPTY = np.uint16(0xFFFF)
SET, GROUP, PLACE = ("_near_mark", "_near_mark2"), "_near_group", "_near_place"  # beside the columns of documents
SURE = 5.0  # standard deviations of the estimate below the limit that are still compared in full


def shingle_sets(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each row, one row after another, and each row's first place."""
    data, offsets = text_bytes(text)
    starts, ends, first = spans(NOT_SPACE[data], offsets)
    words = span_hashes(data, starts, ends, fold=True)
    counts = np.diff(first)
    sums = running(words, BASES[1])
    n_windows = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    places = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(n_windows, out=places[1:])
    row = np.repeat(np.arange(len(counts)), n_windows)
    at = first[row] + np.arange(places[-1]) - places[row]
    values = between(sums, at, np.minimum(at + SHINGLE, first[row + 1]))
    fresh = np.ones(len(values), bool)
    for a, b in zip(places[:-1], places[1:], strict=True):
        own = values[a:b]
        own.sort()
        np.not_equal(own[1:], own[:-1], out=fresh[a + 1:b])
    kept = np.zeros(len(values) + 1, np.int64)
    np.cumsum(fresh, out=kept[1:])
    return values[fresh], kept[places]


def registers(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A row of 256 compressed registers for each set."""
    n, row = len(places) - 1, row_of(places)
    spread = mix(values ^ U64(0x5851F42D4C957F2D))
    least = np.full(n * BUCKETS, ~U64(0))
    np.minimum.at(least, row * BUCKETS + (spread >> U64(56)).astype(np.int64), (spread << U64(8)) | U64(0x7F))
    return compress(least).reshape(n, BUCKETS)


def compress(least: np.ndarray) -> np.ndarray:
    top = least >> U64(11)  # 53 bits, exact as a double
    zeros = 53 - np.frexp(top.astype(np.float64))[1]
    mantissa = (top << zeros.astype(np.uint64)) >> U64(52 - MANTISSA) & U64((1 << MANTISSA) - 1)
    out = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)
    return np.where(least == ~U64(0), EMPTY, out)


@cache
def lenders() -> np.ndarray:
    """For each bucket, an order of all buckets to borrow from."""
    return np.argsort(np.random.default_rng(77).random((BUCKETS, BUCKETS)), axis=1)


@cache
def band_codes() -> np.ndarray:
    return np.random.default_rng(78).integers(1, 2**63, (BANDS, BAND), dtype=np.uint64) * U64(2) + U64(1)


def filled(regs: np.ndarray) -> np.ndarray:
    """Registers with the empty ones borrowed, so that small sets are banded as well."""
    out = regs.copy()
    open_rows = np.flatnonzero((regs == EMPTY).any(1) & (regs != EMPTY).any(1))
    for step in range(BUCKETS):
        if not len(open_rows):
            break
        own = out[open_rows]
        lent = regs[open_rows][:, lenders()[:, step]]
        own = np.where(own == EMPTY, lent, own)
        out[open_rows] = own
        open_rows = open_rows[(own == EMPTY).any(1)]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    parts = filled(regs)[:, :BANDS * BAND].reshape(-1, BANDS, BAND).astype(np.uint64) + U64(1)
    return mix((parts * band_codes()).sum(2) + np.arange(BANDS, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)).view(np.int64)


@cache
def chance(size: float) -> float:
    """The share of 256 registers on which two unlike sets of ``size`` values agree by chance."""
    zeros, part = np.arange(54)[:, None], np.arange(1 << MANTISSA)[None, :]
    scale = 2.0 ** -(zeros + 1)
    low, high = scale * (1 + part / 2**MANTISSA), scale * (1 + (part + 1) / 2**MANTISSA)
    held = np.exp(size * np.log1p(-low / BUCKETS)) - np.exp(size * np.log1p(-high / BUCKETS))
    return float((held**2).sum())


def estimate(x: np.ndarray, y: np.ndarray, sizes_x: np.ndarray, sizes_y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The estimated similarity of each pair of register rows, and on how many buckets it rests."""
    used = ((x != EMPTY) | (y != EMPTY)).sum(1)
    agree = ((x == y) & (x != EMPTY)).sum(1)
    classes = np.round(np.log2(np.sqrt(np.maximum(sizes_x, 1) * np.maximum(sizes_y, 1.0))) * 2) / 2
    by_chance = np.zeros(len(classes))
    for c in np.unique(classes):
        by_chance[classes == c] = BUCKETS * chance(float(2.0**c))
    return (agree - by_chance) / np.maximum(used, 1), used


def near_limit(x: np.ndarray, y: np.ndarray, sizes_x: np.ndarray, sizes_y: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether the estimate leaves the limit num / den within reach."""
    if not len(x):
        return np.zeros(0, bool)
    found, used = estimate(x, y, sizes_x, sizes_y)
    limit = num / den
    return found >= limit - SURE * np.sqrt(limit * (1 - limit) / np.maximum(used, 1)) - 2 / np.maximum(used, 1)


def row_sums(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return (total[places[1:]] - total[places[:-1]]).view(np.int64)


def set_marks(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share."""
    return row_sums(mix(values ^ U64(0x2545F4914F6CDD1D)), places), row_sums(mix(values + U64(0xDA942042E4DD58B5)), places)


def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        values, places = shingle_sets(batch.column("text"))
        one, two = set_marks(values, places)
        keys = band_keys(registers(values, places)).reshape(-1)
        keys = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS), pa.array(keys))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(places)), pa.array(one), pa.array(two), keys],
            ["doc_id", "n_shingles", "mark", "mark2", "keys"])


def full_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        values, places = shingle_sets(batch.column("text"))
        one, two = set_marks(values, places)
        regs = [r.tobytes() for r in registers(values, places)]
        items = [values[a:b].tobytes() for a, b in zip(places[:-1], places[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(places)), pa.array(one), pa.array(two),
             pa.array(regs, pa.binary()), pa.array(items, pa.binary())],
            ["id", "n", "mark", "mark2", "regs", "items"])


def linked_rows(docs: DataFrame, num: int, den: int) -> DataFrame:
    """(doc_id, n_shingles, mark, mark2, component_id, set_group) of every row of ``docs`` (doc_id, text).

    What is linked are distinct sets, by a number of their own. ``set_group`` is the number of the component of a
    row's set; null where no other row has that set or one that is linked to it.
    """
    docs = docs.select("doc_id", "text")
    rows = written(docs.mapInArrow(sketch, "doc_id long, n_shingles long, mark long, mark2 long, keys array<long>"))
    able = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    same = able.groupBy("mark", "mark2").agg(F.min("doc_id").alias("doc_id"), (F.count(F.lit(1)) > 1).alias("again"))
    same = written(same.withColumn("id", F.monotonically_increasing_id()))
    places = ["doc_id", "mark", "mark2"]
    alone = able.join(same.drop("again"), places).select("id", F.explode("keys").alias("key"))
    members = crowded(alone.select("key", "id"))
    wanted = written(members.select("id").distinct())
    marks = written(same.join(small(wanted, 8), "id", "left_semi").drop("again"))
    texts = docs.join(small(marks, 32), "doc_id", "left_semi")
    sets = texts.mapInArrow(full_sets, "id long, n long, mark long, mark2 long, regs binary, items binary")
    sets = sets.withColumnRenamed("id", "doc_id").join(small(marks, 32), places)
    sets = written(sets.dropDuplicates(["id"]).select("id", "n", "regs", "items"))
    groups = linked_groups(members, sets, num, den, partial(near_limit, num=num, den=den))
    grouped = same.join(small(groups, 16), "id", "left").filter("again OR component IS NOT NULL")
    least = written(grouped.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least")))
    decided = grouped.join(small(least, 16), "component", "left").select(
        "mark", "mark2", F.coalesce("least", "doc_id").alias("least"), F.coalesce("component", "id").alias("set_group"))
    found = rows.drop("keys").join(decided, ["mark", "mark2"], "left")
    shared = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    component = F.when(shared, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", "mark", "mark2", component.alias("component_id"),
                        F.when(shared, F.col("set_group")).alias("set_group"))


def near_duplicates(docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text), linked at num / den."""
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return linked_rows(docs, num, den).select("doc_id", "n_shingles", "component_id", kept)


def marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        for column, name in zip(set_marks(*shingle_sets(batch.column("text"))), SET, strict=True):
            batch = batch.append_column(name, pa.array(column))
        yield batch


def without_near_duplicates(docs: DataFrame, num: int = STAGE_NUM, den: int = STAGE_DEN) -> DataFrame:
    """The documents of ``docs``, one of each group linked at num / den. Of rows that share a doc_id and have equal or
    linked sets, the text that sorts first stays; rows without a doc_id all stay."""
    found = linked_rows(docs, num, den).filter("doc_id IS NOT NULL").withColumn("kept", F.expr("doc_id = component_id"))
    found = written(found.select("doc_id", *(F.col(c).alias(n) for c, n in zip(("mark", "mark2", "set_group"), (*SET, GROUP), strict=True)), "kept"))
    ids = written(found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1 OR NOT kept"))
    dropped, again = (written(ids.filter(rows).select("doc_id")) for rows in ("NOT kept", "kept"))
    stay = docs.join(small(dropped, 8), "doc_id", "left_anti").select(docs.columns)
    if not known_rows(again):
        return stay
    sets = found.join(small(again, 8), "doc_id", "left_semi").filter("kept").select("doc_id", *SET, GROUP).distinct()
    own = [F.when(F.col(GROUP).isNull(), F.col(name)) for name in SET]
    order = Window.partitionBy("doc_id", GROUP, *own).orderBy("text")
    with_marks = T.StructType([*docs.schema.fields, *(T.StructField(name, T.LongType()) for name in SET)])
    once = stay.join(small(again, 8), "doc_id", "left_semi").select(docs.columns).mapInArrow(marked, with_marks)
    once = once.join(sets, ["doc_id", *SET]).withColumn(PLACE, F.row_number().over(order)).filter(F.col(PLACE) == 1)
    return stay.join(small(again, 8), "doc_id", "left_anti").select(docs.columns).unionByName(once.select(docs.columns))
