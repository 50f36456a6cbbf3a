"""Substring deduplication: of each run of 20 words or more that texts share, only the earliest stays.

Seeds are winnowed anchors: of the 15 six-word grams in a window of 20 words the leftmost one of least hash, so
equal windows hold the same anchor. Documents meet on anchors that occur twice or more. A match is extended both
ways from there as far as windows have this anchor. If the whole stretch is the same as in an earlier document (the
64 bits of the anchor and 64 of the stretch agree), all its windows start earlier. Only where an anchor
has several stretches, the earliest document of each is looked at window by window, by 128 bits. The windows that
start earlier elsewhere join into maximal repeats, and their words go. What is grouped is
(anchor, least document), counted before it is shuffled, so a passage in every document makes no pairs.

Null and empty texts have no words. Rows without a doc_id take no part and keep their words. Rows that repeat a
doc_id with other texts are documents of their own, in the order of the texts' SHA-256; equal rows count as one document.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import (BASES, NOT_SPACE, between, chunks, row_of, running, span_hashes, spans, text_bytes,
                                  window_hashes, within)
from touchline.llm.tables import free_name, with_place, written

WINDOW, GRAM = 20, 6
REACH = WINDOW - GRAM + 1  # grams in a window


class Words:
    """The words of a chunk of texts, and the places where a window of 20 begins."""

    def __init__(self, text: pa.Array) -> None:
        self.data, offsets = text_bytes(text)
        self.starts, self.ends, self.first = spans(NOT_SPACE[self.data], offsets)
        self.rows = row_of(self.first)
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        n = max(len(self.starts) - WINDOW + 1, 0)
        self.at = np.flatnonzero(self.rows[:n] == self.rows[WINDOW - 1:]) if n else np.zeros(0, np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchor of each window (its leftmost gram of least hash), and the hashes of all grams."""
        grams = window_hashes(self.hashes, GRAM)
        if not len(self.at):
            return self.at, grams
        best, span = np.arange(len(grams)), 1
        while span < REACH:
            step = min(span, REACH - span)
            left, right = best[:-step], best[step:]
            best = np.where(grams[right] < grams[left], right, left)
            span += step
        return best[self.at], grams

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each window that begins at one of the places."""
        other = span_hashes(self.data, self.starts, self.ends, seed=3)
        one, two = window_hashes(self.hashes, WINDOW), window_hashes(other, WINDOW, seed=1)
        return one[at].view(np.int64), two[at].view(np.int64)


def seed_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each anchor: its hash, that of the stretch its windows cover, document, word number, first and last window."""
    for batch in chunks(batches):
        words = Words(batch.column("text"))
        anchors, grams = words.anchors()
        if not len(anchors):
            continue
        heads = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
        low, high, at = words.at[heads], words.at[np.append(heads[1:], len(anchors)) - 1], anchors[heads]
        stretch = between(running(words.hashes, BASES[0]), low, high + WINDOW)
        rows = words.rows[at]
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams[at].view(np.int64)), pa.array(stretch.view(np.int64)), batch.column("doc_id").take(pa.array(rows)),
             *[pa.array((x - words.first[rows]).astype(np.int32)) for x in (at, low, high)]],
            ["seed", "stretch", "doc_id", "at", "low", "high"])


def listed(column: pa.Array, first: np.ndarray) -> np.ndarray:
    """The word numbers of a list column as places in the chunk; a null list is empty."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return flat.astype(np.int64) + np.repeat(first[:-1], sizes)


def marks_of(column: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the marks of each row: the places of its anchors, and the first and last window of each stretch to go."""
    sizes, flat = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), column.flatten()
    base = np.repeat(first[:-1], sizes)
    at, low, high = (flat.field(name).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("at", "low", "high"))
    later = flat.field("later").to_numpy(zero_copy_only=False).astype(bool)
    return (at + base)[at >= 0], (low + base)[later], (high + base)[later]


def extended(words: Words, seeds: np.ndarray) -> np.ndarray:
    """Places of the windows whose anchor is one of the places ``seeds``."""
    chosen = np.zeros(len(words.starts) + 1, bool)
    chosen[seeds] = True
    return words.at[chosen[words.anchors()[0]]]


def first_in_row(one: np.ndarray, two: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether a window is the first of its kind in its row; places ascend."""
    order = np.lexsort((np.arange(len(one)), two, one, rows))
    out = np.ones(len(one), bool)
    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    out[order[1:][same]] = False
    return out


def extend(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct windows of a document that hold a shared anchor."""
    for batch in chunks(batches):
        words = Words(batch.column("text"))
        at = extended(words, listed(batch.column("seeds"), words.first))
        one, two = words.windows(at)
        own = first_in_row(one, two, words.rows[at])
        at = at[own]
        yield pa.RecordBatch.from_arrays(
            [pa.array(one[own]), pa.array(two[own]), batch.column("doc_id").take(pa.array(words.rows[at])),
             pa.array((at - words.first[words.rows[at]]).astype(np.int32))], ["one", "two", "doc_id", "at"])


def repeated(words: Words, marks: pa.Array) -> np.ndarray:
    """Which words a window covers that starts earlier, elsewhere or in the same document."""
    seeds, low, high = marks_of(marks, words.first)
    at = extended(words, seeds)
    one, two = words.windows(at)
    again = at[~first_in_row(one, two, words.rows[at])]
    edge = np.zeros(len(words.starts) + 1, np.int64)
    for begin, end in ((again, again), (low, high)):
        np.add.at(edge, begin, 1)
        np.add.at(edge, end + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def kept_words(words: Words, removed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the kept words, each followed by a space, and each row's offset."""
    kept = np.flatnonzero(~removed)
    sizes = words.ends[kept] - words.starts[kept] + 1
    places = np.zeros(len(kept) + 1, np.int64)
    np.cumsum(sizes, out=places[1:])
    out = words.data[np.minimum(within(words.starts[kept], sizes), max(len(words.data) - 1, 0))]
    out[places[1:] - 1] = 0x20
    return out, places[np.searchsorted(words.rows[kept], np.arange(len(words.first)))]


def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        words = Words(batch.column("text"))
        removed = repeated(words, batch.column("_marks"))
        data, places = kept_words(words, removed)
        total = np.zeros(len(removed) + 1, np.int64)
        np.cumsum(removed, out=total[1:])
        digests = [hashlib.sha256(data[a:max(b - 1, a)]).hexdigest() for a, b in zip(places[:-1], places[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(words.first)), pa.array(total[words.first[1:]] - total[words.first[:-1]]),
             pa.array(digests, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def rewrite(marks: str):
    """The rows without repeated words; the column ``marks`` tells which those are."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            removed = repeated(words, batch.column(marks))
            data, places = kept_words(words, removed)
            total = np.zeros(len(removed) + 1, np.int64)
            np.cumsum(removed, out=total[1:])
            touched = total[words.first[1:]] > total[words.first[:-1]]
            texts = [data[places[i]:max(places[i + 1] - 1, places[i])].tobytes().decode() if touched[i] else text
                     for i, text in enumerate(batch.column("text").to_pylist())]
            kept = batch.drop_columns([marks])
            yield kept.set_column(kept.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
    return run


def marked(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the marks of each: (at, low, high, later) of its shared anchors, and of windows that go; and
    the name of that column. A mark belongs to a place, so it meets no other row of its doc_id."""
    docs, place = with_place(docs)
    named = docs.select(F.col(place).alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    seeds = named.mapInArrow(seed_rows, "seed long, stretch long, doc_id long, at int, low int, high int")
    shared = written(seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed"))
    met = written(seeds.join(shared, "seed"))
    firsts = written(met.groupBy("seed", "stretch").agg(F.min("doc_id").alias("first")))
    several = written(firsts.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed"))
    placed = met.join(firsts, ["seed", "stretch"])
    # Where the stretches of an anchor differ, windows within them can still be the same.
    heads = written(placed.filter("doc_id = first").join(several, "seed", "left_semi").select("doc_id", "at"))
    by_doc = heads.groupBy("doc_id").agg(F.collect_set("at").alias("seeds"))
    windows = written(named.join(by_doc, "doc_id").mapInArrow(extend, "one long, two long, doc_id long, at int"))
    earliest = windows.groupBy("one", "two").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    gone = windows.join(earliest.drop("last"), ["one", "two"]).filter("doc_id > first")
    marks = placed.select("doc_id", "at", "low", "high", (F.col("doc_id") > F.col("first")).alias("later")).union(
        gone.select("doc_id", F.lit(None).cast("int"), F.col("at"), F.col("at"), F.lit(True)))
    name = free_name(docs, "_marks")
    listed = marks.groupBy(F.col("doc_id").alias(place)).agg(F.collect_list(F.struct("at", "low", "high", "later")).alias(name))
    return docs.join(listed, place, "left"), name


def repeated_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    found = marked(docs.select("doc_id", "text"))[0].select("doc_id", "text", "_marks")
    return found.mapInArrow(judge, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated words cut; a text that loses words is its kept words, joined by one space."""
    found, marks = marked(docs)
    return found.select(*docs.columns, marks).mapInArrow(rewrite(marks), docs.schema)
