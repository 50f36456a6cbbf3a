"""Benchmark decontamination: documents that hold 13-word windows of benchmark items.

Words are runs of a-z, 0-9 and bytes from 0x80 on, after A-Z are lower-cased. An item of fewer words than a window
is one window. The windows go to every task as sorted hashes of at most PART_BYTES of item text; a larger
benchmark is scanned in several parts, and the documents' hits are put together. Equal items count once, and an item
longer than an eighth of a part is dealt in stretches that share all but one word of a window, so parts keep to their size
whatever the items are. A hash hit counts only after the words themselves were compared.

A null or empty text has no words and is clean; an item without words has no window. Rows without an item_id count
as an item named "". Repeated rows are judged one by one. Other columns are ignored, or kept as they are where the
documents themselves are returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import (LOWER, U64, binary_array, chunks, per_row, row_of, span_hashes, spans, text_bytes,
                                  window_hashes, within)
from touchline.llm.tables import small, written

WINDOW = 13
PART_BYTES = 8_000_000
STRETCHES = 8  # of a part, at least, unless thirteen words are longer
FILTER_BITS = 20
WORD = np.ones(256, bool)
WORD[:0x30] = WORD[0x3A:0x61] = WORD[0x7B:0x80] = False


@dataclass
class Text:
    """A chunk of texts, lower-cased, with its words and their hashes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    words: np.ndarray


def read(column: pa.Array) -> Text:
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = spans(WORD[data], offsets)
    return Text(data, starts, ends, first, span_hashes(data, starts, ends, seed=2))


@dataclass
class Windows:
    """All windows of ``width`` words of a part of the benchmark, each distinct text once."""

    width: int
    hashes: np.ndarray  # sorted
    words: np.ndarray  # number of the first word in the part's texts
    first: np.ndarray  # of each window the place of its first member
    members: np.ndarray  # numbers of the items that have it
    likely: np.ndarray  # by the first bits of a hash


@dataclass
class Part:
    text: Text
    windows: list[Windows]
    names: list[str]

    def items(self, windows: Windows, entry: int) -> list[str]:
        return [self.names[i] for i in windows.members[windows.first[entry]:windows.first[entry + 1]].tolist()]


def index_items(ids: list[str], column: pa.Array) -> Part:
    """Index the windows of some items. Distinct windows of one hash are kept side by side."""
    text, names = read(column), sorted(set(ids))
    number, counts = {name: i for i, name in enumerate(names)}, np.diff(text.first)
    item_of, widths, out = np.array([number[i] for i in ids], np.int64), np.minimum(counts, WINDOW), []
    for width in sorted(set(widths.tolist()) - {0}):
        rows = np.flatnonzero(widths == width)
        windows = counts[rows] - width + 1
        at, item = within(text.first[:-1][rows], windows), np.repeat(item_of[rows], windows)
        hashes = window_hashes(text.words, width)[at]
        order = np.lexsort((at, hashes))
        at, item, hashes = at[order], item[order], hashes[order]
        own = np.append(True, hashes[1:] != hashes[:-1])
        head = np.maximum.accumulate(np.where(own, np.arange(len(at)), 0))
        # A window that has the hash of another one and not its words is an entry too.
        unlike = ~same_words(text, at, text, at[head], width)
        fresh = own | unlike
        entry = np.cumsum(fresh) - 1
        entry = np.where(unlike, entry, entry[head])
        members = np.unique(entry * len(names) + item)
        keys = hashes[fresh]
        likely = np.zeros(1 << FILTER_BITS, bool)
        likely[(keys >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
        first = np.searchsorted(members // len(names), np.arange(len(keys) + 1))
        out.append(Windows(width, keys, at[fresh].astype(np.int32), first.astype(np.int32), (members % len(names)).astype(np.int32), likely))
    light = Text(text.data, text.starts.astype(np.int32), text.ends.astype(np.int32), text.first, np.zeros(0, np.uint64))
    return Part(light, out, names)


def same_words(text: Text, at: np.ndarray, other: Text, there: np.ndarray, width: int) -> np.ndarray:
    """Whether ``width`` words from each place equal those at the other place, compared byte by byte."""
    out = np.ones(len(at), bool)
    for i in range(width):
        live = np.flatnonzero(out)
        a, b = at[live] + i, there[live] + i
        sizes = text.ends[a] - text.starts[a]
        equal = sizes == other.ends[b] - other.starts[b]
        out[live[~equal]] = False
        live, a, b, sizes = live[equal], a[equal], b[equal], sizes[equal]
        unlike = text.data[within(text.starts[a], sizes)] != other.data[within(other.starts[b], sizes)]
        out[live[np.unique(np.repeat(np.arange(len(live)), sizes)[unlike])]] = False
    return out


def hits(text: Text, part: Part) -> Iterator[tuple[np.ndarray, np.ndarray, Windows]]:
    """For each window length: places where a window stands, which window, and the windows."""
    rows = row_of(text.first)
    for windows in part.windows:
        hashes, width = window_hashes(text.words, windows.width), windows.width
        at = np.flatnonzero(windows.likely[(hashes >> U64(64 - FILTER_BITS)).astype(np.int64)])
        at = at[rows[at] == rows[at + width - 1]]
        low, high = (np.searchsorted(windows.hashes, hashes[at], side) for side in ("left", "right"))
        entry, at = within(low, high - low), np.repeat(at, high - low)
        true = same_words(text, at, part.text, windows.words[entry], width)
        yield at[true], entry[true], windows


def mark(text: Text, part: Part) -> tuple[np.ndarray, list[set[str]]]:
    """Which words are hit, and the items found in each row."""
    edge, items = np.zeros(len(text.starts) + 1, np.int64), [set() for _ in range(len(text.first) - 1)]
    rows = row_of(text.first)
    for at, entry, windows in hits(text, part):
        np.add.at(edge, at, 1)
        np.add.at(edge, at + windows.width, -1)
        for row, e in np.unique(np.stack([rows[at], entry], 1), axis=0) if len(at) else ():
            items[row].update(part.items(windows, e))
    return np.cumsum(edge[:-1]) > 0, items


def digest(items: Iterable[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def is_contaminated(n_hit, n_words):
    return (n_hit > 0) & (20 * n_hit >= n_words)


def verdict_batch(ids: pa.Array, n_words: np.ndarray, n_hit: np.ndarray, items: list[set[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_words), pa.array(n_hit), pa.array([len(i) for i in items], pa.int64()),
         pa.array([digest(i) for i in items], pa.string()), pa.array(is_contaminated(n_hit, n_words))],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


VERDICT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def report(part: Part):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text = read(batch.column("text"))
            hit, items = mark(text, part)
            yield verdict_batch(batch.column("doc_id"), np.diff(text.first), per_row(hit, text.first), items)
    return run


def found_in_part(part: Part):
    """For one part of a large benchmark: the hit words and items of the rows that have any."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text = read(batch.column("text"))
            hit, items = mark(text, part)
            rows = [i for i, found in enumerate(items) if found]
            words = [np.flatnonzero(hit[text.first[i]:text.first[i + 1]]) for i in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row").take(pa.array(rows, pa.int64())), pa.array(words, pa.list_(pa.int64())),
                 pa.array([sorted(items[i]) for i in rows], pa.list_(pa.string()))], ["_row", "words", "items"])
    return run


def join_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        text = read(batch.column("text"))
        hit = [len({w for part in words or () for w in part}) for words in batch.column("words").to_pylist()]
        items = [{i for part in found or () for i in part} for found in batch.column("items").to_pylist()]
        verdicts = verdict_batch(batch.column("doc_id"), np.diff(text.first), np.array(hit, np.int64), items)
        yield verdicts.append_column("_row", batch.column("_row"))


def stretches(limit: int):
    """(item, text) with texts beyond ``limit`` bytes cut between words. Stretches of an item share twelve words, so each
    window of the item is a window of one of them, and none has fewer words than a window."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            items, texts = [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = text.encode()
                words = read(pa.array([text])) if len(raw) > limit else None
                if words is None or len(words.starts) <= WINDOW:
                    items.append(item)
                    texts.append(text)
                    continue
                low, n = 0, len(words.starts)
                while True:
                    high = max(int(np.searchsorted(words.ends, words.starts[low] + limit, "right")), low + WINDOW)
                    items.append(item)
                    texts.append(raw[words.starts[low]:words.ends[min(high, n) - 1]].decode())
                    if high >= n:
                        break
                    low = high - WINDOW + 1
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(texts, pa.string())], ["item", "text"])
    return run


class Parts:
    """The parts of a benchmark, one at a time in memory: their number is known, each is indexed when it is asked for.

    Stretches are dealt into small buckets by a hash; neighbouring buckets make a part as long as they fit. Only the
    buckets' sizes come to the driver. A bucket that does not fit has a single stretch, or there are too few buckets.
    """

    def __init__(self, benchmark: DataFrame) -> None:
        named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
        cut = named.filter("text IS NOT NULL").mapInArrow(stretches(max(PART_BYTES // STRETCHES, 1)), "item string, text string")
        self.items = written(cut.distinct())
        total = self.items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.buckets = 1 if total <= PART_BYTES else 4 * STRETCHES * -(-total // PART_BYTES)
        while True:
            sizes = sorted(self.items.groupBy(self.bucket()).agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).collect())
            if all(size <= PART_BYTES or rows == 1 for _, size, rows in sizes):
                break
            self.buckets *= 2
        self.ends, held = [0], 0
        for bucket, size, _ in sizes:
            if held and held + size > PART_BYTES:
                self.ends.append(bucket)
                held = 0
            held += size
        self.ends.append(self.buckets)

    def bucket(self):
        return F.pmod(F.xxhash64("item", "text"), F.lit(self.buckets))

    def __len__(self) -> int:
        return len(self.ends) - 1

    def of(self, i: int) -> DataFrame:
        return self.items.filter((self.bucket() >= self.ends[i]) & (self.bucket() < self.ends[i + 1]))

    def __getitem__(self, i: int) -> Part:
        if i >= len(self):
            raise IndexError(i)
        rows = self.of(i).toArrow()
        return index_items(rows.column("item").to_pylist(), rows.column("text").combine_chunks())


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, written, and the name of that column, which is none of theirs."""
    name = "_row"
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return written(docs.withColumn(name, F.monotonically_increasing_id())), name


def found_in_all(rows: DataFrame, parts: Parts) -> DataFrame:
    """(_row, words, items) of the rows (_row, text) that any part hits; for each part a list."""
    found = None
    for part in parts:
        own = written(rows.mapInArrow(found_in_part(part), "_row long, words array<long>, items array<string>"))
        found = own if found is None else found.union(own)
    return found.groupBy("_row").agg(F.collect_list("words").alias("words"), F.collect_list("items").alias("items"))


def judged(rows: DataFrame, parts: Parts) -> DataFrame:
    """The verdict of each row (_row, doc_id, text), with its number."""
    return rows.join(found_in_all(rows, parts), "_row", "left").mapInArrow(join_parts, f"{VERDICT}, _row long")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The words and hits of every document, and whether it counts as contaminated."""
    docs = docs.select("doc_id", "text")
    parts = Parts(benchmark)
    if len(parts) == 1:
        return docs.mapInArrow(report(parts[0]), VERDICT)
    return judged(numbered(docs)[0], parts).drop("_row")


def keep_clean(part: Part):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text = read(batch.column("text"))
            hit = mark(text, part)[0]
            yield batch.filter(pa.array(~is_contaminated(per_row(hit, text.first), np.diff(text.first))))
    return run


def cut_words(batch: pa.RecordBatch, text: Text, hit: np.ndarray) -> pa.RecordBatch:
    """The rows of a batch, the hit words cut from their texts."""
    data, offsets = text_bytes(batch.column("text"))
    keep = np.ones(len(data), bool)
    gone = np.flatnonzero(hit)
    # A hit word goes with what stands between it and a hit word right before it in the same row.
    rows = row_of(text.first)
    joined = np.zeros(len(gone), bool)
    joined[1:] = (gone[1:] == gone[:-1] + 1) & (rows[gone[1:]] == rows[gone[:-1]])
    low = np.where(joined, text.ends[gone - 1], text.starts[gone]) if len(gone) else gone
    keep[within(low, text.ends[gone] - low)] = False
    kept = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    column = binary_array(data[keep], kept[offsets], pa.string())
    whole = batch.column("text")
    column = pa.array([None if v is None else t for v, t in zip(whole.to_pylist(), column.to_pylist(), strict=True)], pa.string())
    return batch.set_column(batch.schema.get_field_index("text"), "text", column)


def cut_hits(part: Part):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text = read(batch.column("text"))
            yield cut_words(batch, text, mark(text, part)[0])
    return run


def cut_found(listed: str):
    """The rows with the hit words of all parts cut at once; the column ``listed`` has them, a list for each part."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text = read(batch.column("text"))
            hit = np.zeros(len(text.starts), bool)
            for first, parts in zip(text.first[:-1], batch.column(listed).to_pylist(), strict=True):
                for words in parts or ():
                    hit[first + np.array(words, np.int64)] = True
            yield cut_words(batch.drop_columns([listed]), text, hit)
    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    parts = Parts(benchmark)
    if len(parts) == 1:
        return docs.mapInArrow(keep_clean(parts[0]), docs.schema)
    rows, row = numbered(docs)
    verdicts = judged(rows.select(F.col(row).alias("_row"), "doc_id", "text"), parts)
    bad = written(verdicts.filter("contaminated").select(F.col("_row").alias(row)))
    return rows.join(small(bad, 8), row, "left_anti").select(docs.columns)


def cut_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents, the hit words cut from their texts; a word is hit where a window stands in the text as given."""
    parts = Parts(benchmark)
    if len(parts) == 1:
        return docs.mapInArrow(cut_hits(parts[0]), docs.schema)
    rows, row = numbered(docs)
    found = found_in_all(rows.select(F.col(row).alias("_row"), "text"), parts).select(
        F.col("_row").alias(row), F.col("words").alias(f"{row}words"))
    given = rows.join(found, row, "left").select(*docs.columns, F.col(f"{row}words").alias(row))
    return given.mapInArrow(cut_found(row), docs.schema)
