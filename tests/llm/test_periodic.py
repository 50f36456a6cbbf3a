"""Periodic runs against plain Python, on built texts and on the whole small table."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import SPACED, sha
from tests.llm.test_corpus_operators import SF, docs_frame
from touchline.llm import periodic, queries


def runs(words):
    """Every maximal stretch of smallest period q and enough words, by its definition."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            shorter = any(all(words[x] == words[x + d] for x in range(start, end - d)) for d in range(1, q))
            if end - start >= max(6, 4 * q) and not shorter:
                out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


def digests(words):
    found = runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    middle = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *middle, sha(lines), sha(collapsed(words, found)))


def some_texts(rng, count, longest=200):
    for _ in range(count):
        words = []
        for _ in range(rng.randrange(6)):
            kinds = rng.choice([1, 2, 2, 3, 5, 50])
            unit = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(1, rng.choice([3, 10, 40])))]
            words += (unit * rng.randrange(1, 9))[:rng.randrange(1, longest)]
        yield rng.choice([" ", "\n", "\x0b \t"]).join(words)


@pytest.mark.parametrize("seed", range(4))
def test_runs_and_rest_equal_their_definition(seed):
    texts = [*some_texts(random.Random(seed), 400), None, "", " \n "]
    n_words, places, found, rest = periodic.judged(pa.array(texts))
    for i, text in enumerate(texts):
        words = SPACED.findall(text or "")
        want = runs(words)
        assert [tuple(r) for r in found[places[i]:places[i + 1]].tolist()] == want
        assert (n_words[i], rest[i].as_py()) == (len(words), collapsed(words, want))


def test_long_texts_stay_near_linear():
    """Every place is paired once, also where one word or one block fills a text of many words."""
    block = [f"v{i}" for i in range(9_000)]
    for words, want in (["a"] * 200_000, [(0, 200_000, 1)]), (["a", "b", "a"] * 60_000, [(0, 180_000, 3)]), \
            (["x", *block * 4, "y"], [(1, 36_000, 9_000)]), (block * 3, []):
        _, _, found, rest = periodic.judged(pa.array([" ".join(words)]))
        assert [tuple(r) for r in found.tolist()] == want and rest[0].as_py() == collapsed(words, want)
    number = np.zeros(1_000, np.int64)
    assert (periodic.Grams(number).of(5) >= 0).sum() == 996


def test_hard_rows_and_other_columns(spark):
    texts = [(1, None), (2, ""), (3, " \t"), (4, "a " * 60), (4, "b " * 7), (4, "a " * 60), (None, "c d " * 9), (5, "é ß " * 5)]
    frame = docs_frame(spark, texts).withColumn("runs", F.lit("clash")).withColumn("collapsed", F.lit("clash"))
    got = periodic.periodic_runs(frame).collect()
    want = sorted(repr((i, [tuple(r) for r in runs((t or "").split())])) for i, t in texts)
    assert sorted(repr((r.doc_id, [tuple(x) for x in r.runs])) for r in got) == want
    cut = periodic.without_runs(frame)
    assert cut.columns == frame.columns
    assert sorted(repr((r.doc_id, r.text)) for r in cut.collect()) == sorted(repr((i, {
        "a " * 60: "a", "b " * 7: "b", "c d " * 9: "c d", "é ß " * 5: "é ß"}.get(t, t))) for i, t in texts)
    empty = frame.limit(0)
    assert periodic.periodic_runs(empty).count() == 0 and periodic.without_runs(empty).count() == 0


def test_query_equals_its_definition_on_the_small_table(spark):
    docs = queries.table(spark, SF, "documents")
    want = {r.doc_id: digests(planted(r.doc_id, SPACED.findall(r.text or ""))) for r in docs.collect()}
    got = {r[0]: tuple(r[1:]) for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert got == want
    assert sum(v[0] > 0 for v in want.values()) > len(want) // 20


def test_planting_takes_hard_rows(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    texts = [(ids[0], None), (ids[1], ""), (ids[2], "one"), (ids[3], " a b\tc\nd e f g h "), (None, "a b"), (ids[3], " x y")]
    got = [(r.doc_id, SPACED.findall(r.text or "")) for r in queries.with_planted_periods(docs_frame(spark, texts)).collect()]
    want = [(i, SPACED.findall(t or "") if i is None else planted(i, SPACED.findall(t or ""))) for i, t in texts]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
