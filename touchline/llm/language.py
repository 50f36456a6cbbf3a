"""Language identification: script ranges, word scores, and Viterbi spans.

Words are runs of ASCII letters and bytes from 0x80 on. A language is two multinomials over hashed byte n-grams
(three and five bytes, word ends included), counted over every learned document. The script of a
word (told from its lead bytes) leaves only the languages that use it; then the best sequence of labels under a
penalty for each switch is found for the whole text, so a text of several languages gets several spans.
Scores are whole numbers, so a result does not depend on how rows are batched. Long texts are solved in segments
of 64 words whose best paths are tables from each label to each other, put together afterwards.

A null text or one without a letter is ``und`` with score 0, as is every text if nothing was learned. Rows with a
null lang teach nothing. A null doc_id counts as the empty text and is held out. Repeated rows are judged one by
one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import LOWER, chunks, code_points, row_of, spans, text_bytes, within

ORDERS, BUCKETS = (3, 5), 1 << 15
UNIT = 256  # scores are nats times this
SWITCH = 12 * UNIT
BARRED = 40 * UNIT  # for a word in a script its language does not use
SEGMENT = 64
SCRIPT_SHARE = 0.001

# The script of a lead byte: 0 Latin and common, 1 Greek, 2 Cyrillic, 3 Hebrew, 4 Arabic, 5 Indic and
# South-East Asian, 6 Kana, 7 Han, 8 Hangul, 9 other.
SCRIPTS = np.zeros(256, np.int8)
SCRIPTS[0xCE:0xD0], SCRIPTS[0xD0:0xD4], SCRIPTS[0xD6:0xD8], SCRIPTS[0xD8:0xDC] = 1, 2, 3, 4
SCRIPTS[0xE0], SCRIPTS[0xE3], SCRIPTS[0xE4:0xEA], SCRIPTS[0xEA:0xEE], SCRIPTS[0xF0:0xF8] = 5, 6, 7, 8, 9
N_SCRIPTS = 10
CELLS = len(ORDERS) * BUCKETS + N_SCRIPTS

LETTERS = np.zeros(256, bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True
FOLDED = np.where(LETTERS, LOWER, 0).astype(np.uint8)


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


class Words:
    """The words of a chunk and the cells of their n-grams."""

    def __init__(self, text: pa.Array) -> None:
        self.data, self.offsets = text_bytes(text)
        self.starts, self.ends, self.first = spans(LETTERS[self.data], self.offsets)
        self.rows = row_of(self.first)
        sizes = np.diff(self.offsets)
        # Zeros before each row, as many as an n-gram reaches back, keep it within the row.
        self.shift = np.arange(1, len(sizes) + 1) * (max(ORDERS) - 1)
        self.padded = np.zeros(len(self.data) + (len(sizes) + 1) * max(ORDERS), np.uint8)
        self.padded[np.arange(len(self.data)) + np.repeat(self.shift, sizes)] = FOLDED[self.data]

    def cells(self) -> Iterator[np.ndarray]:
        """For each order, the cell of the n-gram that ends at each padded byte; three or five bytes back."""
        for number, order in enumerate(ORDERS):
            key = np.zeros(len(self.padded), np.uint64)
            for back in range(order):
                key[back:] |= self.padded[:len(self.padded) - back].astype(np.uint64) << np.uint64(8 * back)
            yield ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64) + number * BUCKETS

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Each word's n-grams: those that end in it or right after it."""
        low = self.starts + self.shift[self.rows]
        return low, low + (self.ends - self.starts) + 1

    def scripts(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.int8)
        edges = np.stack([self.starts, self.ends], 1).ravel()
        edges = edges[:-1] if edges[-1] >= len(self.data) else edges
        return np.maximum.reduceat(SCRIPTS[self.data], edges)[::2]


def count_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each cell for each language of the task's documents."""
    totals: dict[str, np.ndarray] = {}
    for batch in chunks(batches):
        words, langs = Words(batch.column("text")), np.array(batch.column("lang").to_pylist(), object)
        cells, scripts, (low, high) = list(words.cells()), words.scripts(), words.bounds()
        for lang in set(langs):
            own = langs[words.rows] == lang
            at = within(low[own], high[own] - low[own])
            counts = totals.setdefault(lang, np.zeros(CELLS, np.int64))
            for found in cells:
                counts += np.bincount(found[at], minlength=CELLS)
            counts += np.bincount(scripts[own].astype(np.int64) + len(ORDERS) * BUCKETS, minlength=CELLS)
    for lang, counts in totals.items():
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen), pa.array(counts[seen])], ["lang", "cell", "n"])


class Model:
    """Scores in whole numbers: (language, cell), and which languages a script leaves."""

    def __init__(self, langs: list[str], counts: np.ndarray) -> None:
        self.langs, grams = langs, counts[:, :len(ORDERS) * BUCKETS].reshape(len(langs), len(ORDERS), BUCKETS)
        share = (grams + 0.5) / (grams.sum(2, keepdims=True) + 0.5 * BUCKETS)
        self.scores = np.round(np.log(share) * UNIT / len(ORDERS)).astype(np.int64).reshape(len(langs), len(ORDERS) * BUCKETS)
        scripts = counts[:, len(ORDERS) * BUCKETS:]
        used = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
        used &= scripts > 0
        self.barred = np.where(used | ~used.any(0), 0, BARRED)

    def word_scores(self, words: Words) -> np.ndarray:
        """(word, language) scores."""
        out, (low, high) = np.zeros((len(words.starts), len(self.langs)), np.int64), words.bounds()
        total = np.zeros(len(words.padded) + 1, np.int64)
        for cells in words.cells():
            for i, scores in enumerate(self.scores):
                np.cumsum(scores[cells], out=total[1:])
                out[:, i] += total[high] - total[low]
        return out - self.barred[:, words.scripts()].T


def learn(docs: DataFrame) -> Model:
    """Count every document that has a lang and is not held out. One row per language and cell reaches the driver."""
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & ~held_out()).select("text", "lang")
    rows = known.mapInArrow(count_cells, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(rows.lang))
    counts = np.zeros((len(langs), CELLS), np.int64)
    counts[np.searchsorted(langs, rows.lang), rows.cell] = rows.n
    return Model(langs, counts)


def advance(best: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """One word further: stay with a label, or come from the best one for the penalty."""
    return np.maximum(best, best.max(-1, keepdims=True) - SWITCH) + scores


def viterbi(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The best label of each word, row by row; staying wins ties, then the first label."""
    n_words, n_langs = scores.shape
    counts = np.diff(first)
    n_segments = -(-counts // SEGMENT)
    total = int(n_segments.sum())
    if not total:
        return np.zeros(0, np.int64)
    seg_first = np.append(0, np.cumsum(n_segments))
    row = np.repeat(np.arange(len(counts)), n_segments)
    rank = np.arange(total) - seg_first[row]
    begin = first[row] + rank * SEGMENT
    sizes = np.minimum(SEGMENT, first[row + 1] - begin)
    least = np.iinfo(np.int64).min // 4
    # From each label before a segment to each label at its end.
    paths = np.where(np.eye(n_langs, dtype=bool), 0, least)[None].repeat(total, 0)
    for step in range(int(sizes.max())):
        live = np.flatnonzero(sizes > step)
        paths[live] = advance(paths[live], scores[begin[live] + step][:, None, :])
    # Through the segments of every row at once.
    best, came = np.zeros((len(counts), n_langs), np.int64), np.zeros((total, n_langs), np.int64)
    for step in range(int(n_segments.max())):
        live = np.flatnonzero(n_segments > step)
        routes = best[live][:, :, None] + paths[seg_first[live] + step]
        came[seg_first[live] + step], best[live] = routes.argmax(1), routes.max(1)
    leave, state = np.zeros(total, np.int64), best.argmax(1)
    for step in range(int(n_segments.max()) - 1, -1, -1):
        live = np.flatnonzero(n_segments > step)
        at = seg_first[live] + step
        leave[at] = state[live]
        state[live] = came[at, state[live]]
    enter = came[np.arange(total), leave]
    # Inside each segment, between its two known labels.
    best = np.where(np.arange(n_langs)[None] == enter[:, None], 0, least)
    source = np.zeros((int(sizes.max()), total, n_langs), np.int16)
    for step in range(len(source)):
        live = np.flatnonzero(sizes > step)
        own = best[live]
        top = own.argmax(1)
        moved = own.max(1, keepdims=True) - SWITCH > own
        source[step, live] = np.where(moved, top[:, None], np.arange(n_langs)[None])
        best[live] = advance(own, scores[begin[live] + step])
    labels, state = np.zeros(n_words, np.int64), leave.copy()
    for step in range(len(source) - 1, -1, -1):
        live = np.flatnonzero(sizes > step)
        labels[begin[live] + step] = state[live]
        state[live] = source[step, live, state[live]]
    return labels


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def label_spans(words: Words, labels: np.ndarray, langs: list[str]) -> list[str]:
    """Each row's spans as lang:start:end in code points, comma-joined; a span ends with its last word."""
    out = [""] * (len(words.first) - 1)
    if not len(labels):
        return out
    new = np.ones(len(labels), bool)
    new[1:] = (labels[1:] != labels[:-1]) | (words.rows[1:] != words.rows[:-1])
    heads = np.flatnonzero(new)
    tails, points = np.append(heads[1:], len(labels)) - 1, code_points(words.data)
    rows = words.rows[heads]
    zero = points[words.offsets[rows]]
    for row, label, a, b in zip(rows.tolist(), labels[heads].tolist(), (points[words.starts[heads]] - zero).tolist(),
                                (points[words.ends[tails]] - zero).tolist(), strict=True):
        out[row] += f"{',' if out[row] else ''}{langs[label]}:{a}:{b}"
    return out


def predict(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(model.langs)
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            plain = np.zeros(len(words.data) + 1, np.int64)
            np.cumsum(LETTERS[words.data] & (words.data < 0x80), out=plain[1:])
            lettered = plain[words.offsets[1:]] > plain[words.offsets[:-1]]
            for i in np.flatnonzero(~lettered):
                lettered[i] = has_letter(batch.column("text")[int(i)].as_py())
            lettered &= n > 0
            if n:
                labels = viterbi(model.word_scores(words), words.first)
                held = np.bincount(words.rows * n + labels, words.ends - words.starts, minlength=batch.num_rows * n).reshape(-1, n)
                best = held.argmax(1)
                score = np.where(lettered, held[np.arange(len(best)), best] / np.maximum(held.sum(1), 1), 0.0)
                found, told = np.array([*model.langs, "und"], object)[np.where(lettered, best, n)], label_spans(words, labels, model.langs)
            else:
                score, found, told = np.zeros(batch.num_rows), ["und"] * batch.num_rows, [""] * batch.num_rows
            told = [t if ok else "" for t, ok in zip(told, lettered, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(list(found), pa.string()), pa.array(score),
                 pa.array(told, pa.string())], ["doc_id", "held_out", "lang_pred", "score", "spans"])
    return run


def languages(docs: DataFrame) -> DataFrame:
    """The main language of every text, the share of its letters' bytes, and its spans."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(predict(learn(docs)), "doc_id long, held_out boolean, lang_pred string, score double, spans string")
