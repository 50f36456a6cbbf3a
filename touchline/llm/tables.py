"""Where the corpus operators put what they reuse, and when a side may be broadcast."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.keys import number_rows
from touchline.session import known_rows, materialize

#: A broadcast side has at most this many rows of this many bytes, as counted when it was written.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64_000_000


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, with its row count known."""
    return materialize(df)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Hint a broadcast for a written side of fixed-size rows whose counted size fits; else leave it as it is."""
    rows = known_rows(df)
    fits = rows is not None and rows <= min(BROADCAST_ROWS, BROADCAST_BYTES // row_bytes)
    return F.broadcast(df) if fits else df


def as_batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


#: Keys that hold at least one row in so many are joined by broadcast; there are at most so many of them.
HOT_SHARE = 200


def joined_to_rows(rows: DataFrame, values: DataFrame, key: str, count: str) -> DataFrame:
    """The rows with the values of their key, which are unique by key and say in ``count`` how many rows have it.

    The keys of one row in HOT_SHARE and more are at most HOT_SHARE keys whatever the table holds; they go by
    broadcast, so that no task of the join has more than its share of one key.
    """
    total = values.agg(F.sum(count)).first()[0] or 0
    hot = values.where(F.col(count) * HOT_SHARE >= total).drop(count)
    warm = rows.join(F.broadcast(hot), key)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(values.where(F.col(count) * HOT_SHARE < total).drop(count), key)
    return warm.unionByName(cold)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column has it."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def with_place(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a long for each document that sorts as doc_ids do, and the name of that column.

    Where no doc_id repeats, it is the doc_id. Else rows of one doc_id with different texts are documents of their own,
    in the order of the texts' SHA-256; equal rows are one document. Rows without a doc_id have none.
    """
    name = free_name(docs, "_place")
    again = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not again.limit(1).count():
        return docs.withColumn(name, F.col("doc_id").cast("long")), name
    mark = free_name(docs, "_text_sha256")
    rows = docs.withColumn(mark, F.sha2(F.coalesce("text", F.lit("")), 256))
    kinds = rows.filter("doc_id IS NOT NULL").select("doc_id", mark).distinct()
    numbers = number_rows(kinds, ["doc_id", mark], name)
    return written(rows.join(numbers, ["doc_id", mark], "left").select(*docs.columns, name)), name
