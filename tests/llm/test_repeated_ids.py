"""Rows that share a doc_id and not their text, for the operators that cut words and lines."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_corpus_operators import docs_frame, words
from touchline.llm import line_dedup, substring, tables


def repeated_rows():
    """Texts with shared passages and lines, in rows whose ids are 0-14, each two or three times, and null."""
    rng, passage = random.Random(5), words(random.Random(6), 40, 10**6)
    rows = [(1, " ".join(passage)), (2, " ".join([*passage, *words(rng, 200, 10**6)])), (2, " ".join([*passage[:25], *words(rng, 35, 10**6)])),
            (3, "a unique line that nobody else has got\nanother line of this row"), (3, "the line of many texts\nand its own end"),
            (4, "the line of many texts"), (4, None), (4, ""), (None, " ".join(passage)), (None, "the line of many texts")]
    for i in range(15):
        for _ in range(2 + i % 2):
            rows.append((i, "\n".join(" ".join(words(rng, rng.randrange(1, 60), 300)) for _ in range(rng.randrange(1, 6)))
                         + rng.choice(["", "\nthe line of many texts", "\nThe line of many texts.", " " + " ".join(passage[5:])])))
    return rows + rows[3:8] + rows[20:25]


@pytest.fixture(scope="module")
def rows():
    return repeated_rows()


@pytest.fixture(scope="module")
def frame(spark, rows):
    df = docs_frame(spark, rows)
    for name in ("_marks", "_lines_removed", "_place", "_text_sha256"):
        df = df.withColumn(name, F.lit("clash"))
    return df.coalesce(1)  # further documents in the same chunk


def keyed(rows):
    return {(i, brute.sha(t or "")): t for i, t in rows if i is not None}


def cut_words(text, gone):
    return " ".join(w for i, w in enumerate(text.split()) if i not in gone)


def test_words_go_from_their_own_row(rows, frame):
    wanted = brute.repeated_words(keyed(rows))
    got = sorted(tuple(r) for r in substring.repeated_words(frame).filter("doc_id IS NOT NULL").collect())
    assert got == sorted((i, *wanted[i, brute.sha(t or "")]) for i, t in rows if i is not None)
    cut = substring.without_repeats(frame)
    assert cut.columns == frame.columns and cut.filter("_marks = 'clash' AND _place = 'clash'").count() == len(rows)
    texts = sorted((r.doc_id, brute.sha(" ".join((r.text or "").split()))) for r in cut.collect() if r.doc_id is not None)
    assert texts == sorted((i, wanted[i, brute.sha(t or "")][2]) for i, t in rows if i is not None)
    assert sorted(r.text for r in cut.filter("doc_id IS NULL").collect()) == sorted(t for i, t in rows if i is None)


def test_lines_go_from_their_own_row(rows, frame):
    wanted = brute.similar_lines(keyed(rows))
    got = sorted(tuple(r) for r in line_dedup.similar_lines(frame).filter("doc_id IS NOT NULL").collect())
    assert got == sorted((i, *v) for (i, _), v in wanted.items())
    cut = line_dedup.without_similar_lines(frame)
    assert cut.columns == frame.columns and cut.filter("_lines_removed = 'clash'").count() == len(rows)
    left = defaultdict(list)
    for i, t in rows:
        gone = wanted[i, brute.sha(t or "")][2].split(",") if i is not None else []
        left[i].append("\n".join(line for n, line in enumerate((t or "").split("\n")) if str(n) not in gone))
    got = defaultdict(list)
    for r in cut.collect():
        got[r.doc_id].append(r.text or "")
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in left.items()}
    assert any("a unique line that nobody else has got" in t for t in got[3])


def test_places(spark, rows, frame):
    placed, name = tables.with_place(frame)
    assert name == "_place_" and placed.columns == [*frame.columns, name]
    at = {(r.doc_id, brute.sha(r.text or "")): r[name] for r in placed.collect()}
    known = sorted(k for k in at if k[0] is not None)
    assert [at[k] for k in known] == list(range(1, len(known) + 1)) and {v for k, v in at.items() if k[0] is None} == {None}
    once = docs_frame(spark, [(7, "a"), (9, "b"), (None, "c"), (None, "d")])
    assert sorted((r.doc_id or 0, r._place or 0) for r in tables.with_place(once)[0].collect()) == [(0, 0), (0, 0), (7, 7), (9, 9)]


def test_no_rows(spark):
    none = docs_frame(spark, [(1, "x")]).limit(0)
    assert substring.without_repeats(none).count() == line_dedup.without_similar_lines(none).count() == 0
