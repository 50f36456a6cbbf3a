"""Runs of words that repeat with a period, by seeds on diagonals that are extended both ways.

A run is a stretch of consecutive words whose smallest period is q (words q apart are equal), of at least MIN_WORDS
words and TIMES periods, that no neighbouring word continues. Words at lag q then agree over at least (TIMES - 1) * q
places (over MIN_WORDS - 1 at lag 1), the guaranteed overlap. Lags are taken in classes, 1 to 5, 6 to 18, 19 to 57, ...:
the k-grams of a class are as long as the overlap that its smallest lag guarantees, which is also its largest lag. Such
a k-gram holds a whole period, so inside a run it comes back after exactly q words and not before; hence each place is
paired with the next one of its k-gram only, and the pairs of a text are never more than its places, however often one
k-gram stands in it. Pairs in a row on one diagonal are one seed; a table of the furthest place covered at each lag
keeps a stretch from being extended twice.

k-grams are numbered exactly, by doubling; places whose gram stands once in the text leave on the way. A chunk of text
is one numpy pass; a longer text is a chunk of its own.

Null and empty texts have no words and no runs. Rows are judged one by one, so repeated rows and repeated or null
doc_ids give a row each. Runs that overlap are all given, ordered by start, then period. Only the two named columns
are read, whatever else the table holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import NOT_SPACE, binary_array, chunks, row_of, spans, text_bytes, within

MIN_WORDS, TIMES = 6, 4
FIRST_GRAM = MIN_WORDS - 1  # what a run of period 1 guarantees
RUNS = "array<struct<start: long, length: long, period: long>>"
STRETCH = 64  # places compared at once, doubled while they agree


def classes(longest: int) -> Iterator[tuple[int, int]]:
    """(smallest lag, largest lag and k) of each class that a text of ``longest`` words can have runs of."""
    low, k = 1, FIRST_GRAM
    while max(MIN_WORDS, TIMES * low) <= longest:
        yield low, k
        low, k = k + 1, (TIMES - 1) * (k + 1)


class Grams:
    """Numbers of the grams at each place that stand there and elsewhere in the same text; other places have -1."""

    def __init__(self, words: np.ndarray) -> None:
        self.words, self.numbers = words, {}
        self.numbers[1] = self.numbered(np.arange(len(words)), words)

    def numbered(self, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(self.words), -1, np.int64)
        if len(at):
            _, number, times = np.unique(keys, return_inverse=True, return_counts=True)
            again = times[number] > 1
            out[at[again]] = number[again]
        return out

    def joined(self, half: int, width: int) -> np.ndarray:
        """Grams of ``width`` from two of ``half`` that overlap or touch. Words carry their row, so a gram that
        goes on in the next row equals no other."""
        have, step = self.numbers[half], width - half
        at = np.flatnonzero(have[:max(len(have) - step, 0)] >= 0)
        at = at[have[at + step] >= 0]
        return self.numbered(at, have[at] * len(have) + have[at + step])

    def of(self, width: int) -> np.ndarray:
        half = 1
        while half * 2 <= width:
            if half * 2 not in self.numbers:
                self.numbers[half * 2] = self.joined(half, half * 2)
            half *= 2
        return self.numbers[half] if half == width else self.joined(half, width)


def agreeing(words: np.ndarray, one: int, two: int) -> int:
    """How many places from ``one`` and ``two`` on agree; ``two`` is the later one."""
    total, size = 0, STRETCH
    while two + total < len(words):
        a, b = words[one + total:one + total + size], words[two + total:two + total + size]
        differ = a[:len(b)] != b
        if differ.any():
            return total + int(np.argmax(differ))
        total, size = total + len(b), size * 2
    return total


def agreeing_before(words: np.ndarray, one: int, two: int) -> int:
    total, size = 0, STRETCH
    while total < one:
        n = min(size, one - total)
        differ = words[one - total - n:one - total] != words[two - total - n:two - total]
        if differ.any():
            return total + int(np.argmax(differ[::-1]))
        total, size = total + n, size * 2
    return total


def smallest_period(words: np.ndarray, start: int, lag: int) -> bool:
    """Whether the first ``lag`` words of a run are not themselves a shorter word sequence repeated."""
    rest, prime = lag, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime:
            prime += 1
            continue
        while rest % prime == 0:
            rest //= prime
        short = lag // prime
        if np.array_equal(words[start:start + lag - short], words[start + short:start + lag]):
            return False
    return True


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """(start, length, period) of all runs in the texts of a chunk; ``words`` are numbers of (row, word), so that no
    run goes over into another row."""
    grams, found = Grams(words), []
    for low, k in classes(longest):
        number = grams.of(k)
        at = np.flatnonzero(number >= 0)
        if not len(at):
            break  # where no gram comes back, no longer one does
        at = at[np.argsort(number[at], kind="stable")]
        same = np.flatnonzero(number[at[1:]] == number[at[:-1]])
        places, lags = at[same], at[same + 1] - at[same]
        near = (lags >= low) & (lags <= k)
        places, lags = places[near], lags[near]
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        head = np.flatnonzero(np.r_[True, (np.diff(lags) != 0) | (np.diff(places) != 1)]) if len(places) else places
        agree = places[np.r_[head[1:], len(places)].astype(np.int64) - 1] - places[head] + k if len(places) else places
        enough = agree + lags[head] >= np.maximum(MIN_WORDS, TIMES * lags[head])
        furthest: dict[int, int] = {}
        for place, lag, known in zip(places[head][enough].tolist(), lags[head][enough].tolist(), agree[enough].tolist(), strict=True):
            if place < furthest.get(lag, 0):
                continue
            end = place + known
            end += agreeing(words, end, end + lag)
            start = place - agreeing_before(words, place, place + lag)
            furthest[lag] = end
            length = end + lag - start
            if length >= max(MIN_WORDS, TIMES * lag) and smallest_period(words, start, lag):
                found.append((start, length, lag))
    return np.array(sorted(found, key=lambda run: (run[0], run[2])), np.int64).reshape(-1, 3)


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, n_rows: int) -> pa.Array:
    """The words of each row with one blank between them."""
    sizes = ends - starts + 1
    out = np.append(data, np.uint8(0x20))[within(starts, sizes)]
    after = np.cumsum(sizes)
    out[after - 1] = 0x20
    last = np.flatnonzero(np.diff(row, append=n_rows)) if len(row) else np.zeros(0, np.int64)
    out = np.delete(out, after[last] - 1)
    length = np.bincount(row, weights=sizes, minlength=n_rows).astype(np.int64)
    length[row[last]] -= 1
    return binary_array(out, np.r_[0, np.cumsum(length)], pa.string())


def judged(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(words, first run and runs relative to their rows, texts of the words that stay) of a chunk."""
    data, offsets = text_bytes(texts)
    inside = NOT_SPACE[data] if len(data) else np.zeros(0, bool)
    starts, ends, first = spans(inside, offsets)
    row, n = row_of(first), len(offsets) - 1
    kinds = binary_array(data[inside], np.r_[0, np.cumsum(ends - starts)]).dictionary_encode()
    words = row * max(len(kinds.dictionary), 1) + kinds.indices.to_numpy()
    runs = runs_of(words, int(np.diff(first).max(initial=0)))
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    stay = np.cumsum(gone)[:-1] == 0
    texts = joined_words(data, starts[stay], ends[stay], row[stay], n)
    places = np.searchsorted(runs[:, 0], first)
    runs[:, 0] -= first[row[runs[:, 0]]]
    return np.diff(first), places, runs, texts


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row (doc_id, n_words, runs, collapsed): all runs, and the words left, one blank between them, when of
    each run only the first period stays."""
    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            n_words, places, runs, texts = judged(part.column("text"))
            fields = [pa.array(runs[:, i]) for i in range(3)]
            runs = pa.ListArray.from_arrays(
                pa.array(places, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n_words, pa.int64()), runs, texts], ["doc_id", "n_words", "runs", "collapsed"])

    picked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(judge, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def without_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with all their columns; a text with runs keeps the first period of each, one blank between words, and
    any other text stays as it is."""
    place, schema = docs.columns.index(text), docs.schema

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text):
            _, places, _, texts = judged(part.column(place))
            columns = list(part.columns)
            columns[place] = pc.if_else(pa.array(np.diff(places) > 0), texts, columns[place])
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(cut, schema)
