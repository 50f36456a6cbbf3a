"""Quality rules: plain counts, and a log-likelihood ratio between trusted texts and the corpus.

Both multinomials are over 65,536 hashed n-grams of four bytes: the corpus one counts every document, the target
one up to TRUSTED_DOCS labelled documents of quality 1 that are not toxic (those whose hashed ids come first).
The target is mixed with a tenth of the corpus, so one n-gram weighs at least ln 0.1. A document's score is the
mean over its n-grams; it passes if that is at least LIMIT, and the base rules hold. Weights are whole numbers of
2**-20, so a score does not depend on how rows are batched.

A null text has no words and fails. Without labels every score is 0. Other columns are ignored, or kept as they
are where the documents themselves are returned.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import (BASES, NOT_SPACE, U64, between, byte_codes, chunks, code_points, mix, per_row, row_of,
                                  running, span_hashes, spans, text_bytes, window_hashes)

GRAM, BUCKETS = 4, 1 << 16
TRUSTED_DOCS = 20_000
CORPUS_SHARE = 0.1
LIMIT = -0.4
UNIT = 1 << 20
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
WINDOW = 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the n-gram at each byte, and the offsets of each row's n-grams (the last bytes have none)."""
    wide = np.zeros(max(len(data) - GRAM + 1, 0), np.uint32)
    for i in range(GRAM):
        wide |= data[i:i + len(wide)].astype(np.uint32) << np.uint32(8 * i)
    return (wide * np.uint32(0x9E3779B1)) >> np.uint32(16), np.stack([offsets[:-1], np.maximum(offsets[1:] - GRAM + 1, offsets[:-1])])


def inner(places: np.ndarray, n: int) -> np.ndarray:
    """Which n-grams lie within one row."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(places[0], n), 1)
    np.add.at(edge, np.minimum(places[1], n), -1)
    return np.cumsum(edge[:-1]) > 0


def count_grams(trusted: np.ndarray):
    """Counts of each bucket over the task's documents and over its trusted ones."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in chunks(batches):
            data, offsets = text_bytes(batch.column("text"))
            buckets, places = gram_buckets(data, offsets)
            if not len(buckets):
                continue
            ids = batch.column("doc_id")
            known = np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), trusted) & ids.is_valid().to_numpy(zero_copy_only=False)
            raw += np.bincount(buckets[inner(places, len(buckets))], minlength=BUCKETS)
            if known.any():
                target += np.bincount(buckets[inner(places[:, known], len(buckets))], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "raw", "target"])
    return run


def trusted_ids(labels: DataFrame) -> np.ndarray:
    """At most TRUSTED_DOCS ids of labelled documents to learn from."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).filter(
        "doc_id IS NOT NULL AND quality = 1 AND coalesce(toxic, 0) = 0")
    rows = good.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").limit(TRUSTED_DOCS).collect()
    return np.array(sorted(r.doc_id for r in rows), np.int64)


def gram_weights(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The weight of each bucket; what reaches the driver is one row per bucket."""
    counted = docs.select("doc_id", "text").mapInArrow(count_grams(trusted_ids(labels)), "bucket long, raw long, target long")
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows.bucket], target[rows.bucket] = rows.raw, rows.target
    if not target.sum():
        return np.zeros(BUCKETS, np.int64)
    raw, target = raw / raw.sum(), target / target.sum()
    seen, out = raw > 0, np.zeros(BUCKETS)
    out[seen] = np.log(((1 - CORPUS_SHARE) * target[seen] + CORPUS_SHARE * raw[seen]) / raw[seen])
    return np.round(out * UNIT).astype(np.int64)


def repeats_within(keys: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more in their row, and each row's number of keys beyond the first of a kind."""
    own = mix(keys + mix(rows.astype(np.uint64) + U64(1)))
    order = np.argsort(own)
    again = own[order][1:] == own[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][again]] = out[order[:-1][again]] = True
    return out, np.bincount(rows[order[1:][again]], minlength=n_rows)


def base_counts(text: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = text_bytes(text)
    n_rows = len(offsets) - 1
    starts, ends, first = spans(NOT_SPACE[data], offsets)
    points = code_points(data)
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SYMBOLS[data], out=symbols[1:])
    out = {"n_words": np.diff(first), "word_chars": per_row(points[ends] - points[starts], first),
           "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]]}
    line_starts, line_ends, line_first = spans(data != 0x0A, offsets)
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(ends, line_starts, "right")
    lines = between(running(byte_codes(1, False)[data], BASES[1]), line_starts[worded], line_ends[worded]) if worded.any() else np.zeros(0, np.uint64)
    out["n_dup_lines"] = repeats_within(lines, row_of(line_first)[worded], n_rows)[1]
    rows = row_of(first)
    windows = window_hashes(span_hashes(data, starts, ends), WINDOW)
    whole = np.flatnonzero(rows[:len(windows)] == rows[WINDOW - 1:]) if len(windows) else np.zeros(0, np.int64)
    often = whole[repeats_within(windows[whole], rows[whole], n_rows)[0]]
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, often, 1)
    np.add.at(edge, often + WINDOW, -1)
    out["n_repeat_words"] = per_row(np.cumsum(edge[:-1]) > 0, first)
    return out


def base_failures(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


def scores(text: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The mean weight of each row's n-grams; 0 without any."""
    data, offsets = text_bytes(text)
    buckets, (low, high) = gram_buckets(data, offsets)
    total = np.zeros(len(buckets) + 1, np.int64)
    np.cumsum(weights[buckets], out=total[1:])
    low, high = np.minimum(low, len(buckets)), np.minimum(high, len(buckets))
    return (total[high] - total[low]) / (np.maximum(high - low, 1) * UNIT)


def judge(weights: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            counts, score = base_counts(batch.column("text")), scores(batch.column("text"), weights)
            failed = base_failures(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(counts[c].astype(np.int64)) for c in COUNTS], pa.array(failed),
                 pa.array(score), pa.array(~failed & (score >= LIMIT))],
                ["doc_id", *COUNTS, "base_failed", "score", "kept"])
    return run


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The counts, the score and the verdict of every document."""
    kinds = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "text").mapInArrow(
        judge(gram_weights(docs, labels)), f"doc_id long, {kinds}, base_failed boolean, score double, kept boolean")


def keep_good(weights: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            text = batch.column("text")
            yield batch.filter(pa.array(~base_failures(base_counts(text)) & (scores(text, weights) >= LIMIT)))
    return run


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    return docs.mapInArrow(keep_good(gram_weights(docs, labels)), docs.schema)
