"""Near-duplicate lines by MinHash: of each group of similar lines only the first one stays.

A line is what stands between two line feeds, without white space at its ends, A-Z lower-cased; lines without a
word are not looked at and never removed. Its set holds its shingles of eight characters (a shorter line is one
shingle). Each of 56 buckets keeps the least hash of the shingles that fall into it; 14 bands of four buckets miss
about 1 in 800 pairs of short lines at the limit of 0.8 and 1 in 3,000 of longer ones; pairs are then compared in full.

Null and empty texts have no lines. Rows without a doc_id take no part. Rows that repeat a doc_id with other texts are
documents of their own, in the order of the texts' SHA-256; equal rows count as one document. Other columns are ignored.
Lines whose 64-bit ids collide stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import (BASES, LOWER, NOT_SPACE, SPACES, U64, chunks, code_points, mix, row_of, spans, text_bytes,
                                  within)
from touchline.llm.linking import crowded, linked_groups
from touchline.llm.tables import BROADCAST_ROWS, free_name, small, with_place, written
from touchline.session import known_rows

SHINGLE = 8
NUM, DEN = 80, 100
BANDS, BAND = 14, 4
BUCKETS = BANDS * BAND


def trimmed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without the white space at their ends; a blank span ends where it starts."""
    starts, ends = starts.copy(), ends.copy()
    for _ in range(4):
        blank = (starts < ends) & SPACES[data[np.minimum(starts, len(data) - 1)]]
        starts[blank] += 1
        blank = (starts < ends) & SPACES[data[ends - 1]]
        ends[blank] -= 1
    rest = np.flatnonzero((starts < ends) & (SPACES[data[np.minimum(starts, len(data) - 1)]] | SPACES[data[ends - 1]]))
    if len(rest):
        solid = np.flatnonzero(NOT_SPACE[data])
        low, high = np.searchsorted(solid, starts[rest]), np.searchsorted(solid, ends[rest])
        some = high > low
        ends[rest[~some]] = starts[rest[~some]]
        starts[rest[some]], ends[rest[some]] = solid[low[some]], solid[high[some] - 1] + 1
    return starts, ends


def line_shingles(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingle hashes of each lower-cased line, one line after another, and each line's first place."""
    import xxhash

    raw, points = data.tobytes(), code_points(data)
    chars = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    low, sizes = points[starts], points[ends] - points[starts]
    counts = np.maximum(sizes - SHINGLE + 1, 1)
    places = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=places[1:])
    # Hashes of 1, 2, 4 and 8 characters from each place, the last ones padded with zeros.
    hashes, width = np.append(chars, np.zeros(SHINGLE, np.uint32)).astype(np.uint64) * U64(BASES[1]), 1
    while width < SHINGLE:
        hashes = hashes[:-width] * U64(pow(BASES[0], width, 2**64)) + hashes[width:]
        width *= 2
    values = mix(hashes[within(low, counts)])
    for i in np.flatnonzero(sizes < SHINGLE):
        values[places[i]] = xxhash.xxh3_64_intdigest(raw[starts[i]:ends[i]])
    return values, places


def sets_of(column: pa.Array) -> list[np.ndarray]:
    """The shingle sets of a column of lower-cased lines."""
    known = column.dictionary_encode()  # a centre comes with many partners
    data, offsets = text_bytes(known.dictionary)
    values, places = line_shingles(data, offsets[:-1], offsets[1:])
    sets = [distinct(values[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)]
    return [sets[i] for i in known.indices.to_pylist()]


def distinct(values: np.ndarray) -> np.ndarray:
    values.sort()
    return values[np.append(True, values[1:] != values[:-1])]


class Lines:
    """The lines of a chunk of texts that hold a word."""

    def __init__(self, text: pa.Array) -> None:
        data, offsets = text_bytes(text)
        starts, ends, first = spans(data != 0x0A, offsets)
        breaks, rows = np.flatnonzero(data == 0x0A), row_of(first)
        number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[rows])
        starts, ends = trimmed(data, starts, ends)
        worded = ends > starts
        self.row, self.number, self.starts, self.ends = rows[worded], number[worded], starts[worded], ends[worded]
        self.data = LOWER[data]

    def choose(self, chosen: np.ndarray) -> None:
        self.row, self.number, self.starts, self.ends = (x[chosen] for x in (self.row, self.number, self.starts, self.ends))

    def texts(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)]

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each line; the first is its id."""
        import xxhash

        both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.texts())), np.int64)
        return both[0::2], both[1::2]


@cache
def lenders() -> np.ndarray:
    return np.argsort(np.random.default_rng(31).random((BUCKETS, BUCKETS)), axis=1)


@cache
def band_codes() -> np.ndarray:
    return np.random.default_rng(32).integers(1, 2**63, (BANDS, BAND), dtype=np.uint64) * U64(2) + U64(1)


def signatures(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The least hash of each bucket, empty buckets filled from others. One half of a hash names the bucket, the
    other is what is compared."""
    none, n = np.uint32(0xFFFFFFFF), len(places) - 1
    least = np.full(n * BUCKETS, none)
    bucket = ((values >> U64(32)) * U64(BUCKETS) >> U64(32)).astype(np.int64)
    bucket += row_of(places) * BUCKETS
    np.minimum.at(least, bucket, values.astype(np.uint32))
    least = least.reshape(n, BUCKETS)
    out, open_rows = least.copy(), np.flatnonzero((least == none).any(1))
    for step in range(BUCKETS):
        if not len(open_rows):
            break
        own = out[open_rows]
        own = np.where(own == none, least[open_rows][:, lenders()[:, step]], own)
        out[open_rows] = own
        open_rows = open_rows[(own == none).any(1)]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(-1, BANDS, BAND).astype(np.uint64) + U64(1)
    return mix((parts * band_codes()).sum(2) + np.arange(BANDS, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)).view(np.int64)


def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        lines = Lines(batch.column("text"))
        if not len(lines.row):
            continue
        one, two = lines.marks()
        keys = band_keys(signatures(*line_shingles(lines.data, lines.starts, lines.ends))).reshape(-1)
        keys = pa.ListArray.from_arrays(pa.array(np.arange(len(one) + 1, dtype=np.int32) * BANDS), pa.array(keys))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(lines.row)), pa.array(lines.number), pa.array(one), pa.array(two), keys],
            ["doc_id", "line", "id", "mark", "keys"])


def full_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the lines whose numbers are listed; their sets are made where they are compared."""
    for batch in chunks(batches):
        lines, listed = Lines(batch.column("text")), batch.column("lines")
        wanted = np.repeat(np.arange(batch.num_rows), listed.value_lengths().to_numpy(zero_copy_only=False)) << 32
        wanted += listed.flatten().to_numpy(zero_copy_only=False)
        lines.choose(np.isin((lines.row << 32) + lines.number, wanted))
        if not len(lines.row):
            continue
        points = code_points(lines.data)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(lines.row)), pa.array(lines.number), pa.array(lines.marks()[0]),
             pa.array(points[lines.ends] - points[lines.starts]), pa.array(lines.texts(), pa.binary())],
            ["doc_id", "line", "id", "n", "items"])


def line_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All lines (doc_id, line, id, mark), and for each id that repeats or has a similar one, the first line of
    its group: (id, mark, first_doc, first_line)."""
    docs = docs.select("doc_id", "text").filter("doc_id IS NOT NULL")
    lines = written(docs.mapInArrow(sketch, "doc_id long, line long, id long, mark long, keys array<long>"))
    place = F.struct("doc_id", "line")
    same = written(lines.groupBy("id").agg(
        F.min(place).alias("place"), F.max(place).alias("last"), F.min("mark").alias("mark"), F.max("mark").alias("mark2"))
        .filter("mark = mark2").select("id", "mark", "place.doc_id", "place.line", (F.col("place") < F.col("last")).alias("again")))
    members = crowded(lines.select(F.explode("keys").alias("key"), "id"))
    wanted = written(members.select("id").distinct())
    places = same.join(small(wanted, 8), "id", "left_semi").select("id", "doc_id", "line")
    places = written(places)
    holders = places.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))
    holders = F.broadcast(holders) if known_rows(places) <= BROADCAST_ROWS else holders
    found = docs.join(holders, "doc_id").mapInArrow(full_sets, "doc_id long, line long, id long, n long, items binary")
    sets = written(found.join(small(places, 24), ["id", "doc_id", "line"], "left_semi").dropDuplicates(["id"])
                   .select("id", "n", F.lit(b"").alias("regs"), "items"))
    groups = linked_groups(members, sets, NUM, DEN, decode=sets_of)
    grouped = same.join(small(groups, 16), "id", "left").filter("again OR component IS NOT NULL").withColumn(
        "component", F.coalesce("component", "id"))
    firsts = grouped.groupBy("component").agg(F.min(place).alias("first"))
    decided = grouped.join(firsts, "component").select(
        "id", "mark", F.col("first.doc_id").alias("first_doc"), F.col("first.line").alias("first_line"))
    return lines.drop("keys"), decided


def removed_lines(docs: DataFrame) -> tuple[DataFrame, str, DataFrame]:
    """``docs`` with their places, the name of that column, and by place (place, n_lines, n_removed, removed)."""
    docs, place = with_place(docs)
    lines, decided = line_groups(docs.select(F.col(place).alias("doc_id"), "text"))
    later = (F.col("doc_id") != F.col("first_doc")) | (F.col("line") != F.col("first_line"))
    told = lines.join(decided, ["id", "mark"], "left").select("doc_id", "line", F.coalesce(later, F.lit(False)).alias("removed"))
    gone = F.sort_array(F.collect_set(F.when(F.col("removed"), F.col("line"))))
    counts = told.groupBy("doc_id").agg(F.size(F.collect_set("line")).alias("n_lines"), gone.alias("gone")).select(
        F.col("doc_id").alias(place), F.col("n_lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"),
        F.array_join(F.col("gone").cast("array<string>"), ",").alias("removed"))
    return docs, place, counts


def similar_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) of each document: how many lines with a word it has, how many of them
    repeat an earlier line or resemble one, and their numbers from 0, ascending, comma-joined."""
    rows, place, counts = removed_lines(docs.select("doc_id", "text"))
    return rows.select("doc_id", place).distinct().join(counts, place, "left").select(
        "doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("removed", F.lit("")).alias("removed"))


def cut_lines(removed: str):
    """The rows without the lines whose numbers the column ``removed`` lists."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = []
            for text, numbers in zip(batch.column("text").to_pylist(), batch.column(removed).to_pylist(), strict=True):
                if text and numbers:
                    gone = set(map(int, numbers.split(",")))
                    text = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
                texts.append(text)
            kept = batch.drop_columns([removed])
            yield kept.set_column(kept.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
    return run


def without_similar_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed lines cut from their texts; other columns stay as they are."""
    rows, place, counts = removed_lines(docs)
    name = free_name(rows, "_lines_removed")
    decided = counts.select(place, F.col("removed").alias(name))
    return rows.join(decided, place, "left").select(*docs.columns, name).mapInArrow(cut_lines(name), docs.schema)
