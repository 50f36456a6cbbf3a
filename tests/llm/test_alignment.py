"""Token alignment against plain Python over whole texts, with counts over the whole corpus."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import sha
from tests.llm.test_corpus_operators import SF, docs_frame
from touchline.llm import alignment, queries, tables

A, B = queries.vocabulary(), queries.vocabulary("piece_bpe_32k.model")
BITS = [" ", "  ", "\n", "\t", " a", "b", "Ab", "é", "’s", "'s", "'ll", " 1", "23", "<|endoftext|>", "▁", " ", "　", " ",
        "\u0085", "漢字", "🦜", "\0", "\x7f", "﻿", "--", "=", "the", " of", "ing", "\r", "<0x41>", "<s>", "​", "ß", "́", " ▁", "ﬁ", "᠎"]
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


def whole(aligner, text):
    """(n_a, n_b, n_groups, string of groups, links) of one text, its tokens laid out byte by byte."""
    want = (" " + (text or "")).encode()
    a = aligner.a.tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
    b = aligner.b.model.encode(text) if text else []
    bytes_a, bytes_b = ([side.tokens[i] for i in ids] for side, ids in ((aligner.a, a), (aligner.b, b)))
    if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return 0, 0, 0, "", Counter()
    at_a, at_b = ([n for n, t in enumerate(side) for _ in t] for side in (bytes_a, bytes_b))
    links = Counter((a[x], b[y]) for x, y in set(zip(at_a, at_b, strict=True)))
    groups, low_a, low_b = [], 0, 0
    for i in range(len(want)):
        last = i + 1 == len(want)
        if last or (at_a[i] != at_a[i + 1] and at_b[i] != at_b[i + 1]):
            parts = (a[low_a:at_a[i] + 1], b[low_b:at_b[i] + 1])
            groups.append("|".join(",".join(map(str, ids)) for ids in parts))
            low_a, low_b = at_a[i] + 1, at_b[i] + 1
    return len(a), len(b), len(groups), ";".join(groups), links


def expected(aligner, texts):
    """{row: the columns of the query} for a list of texts."""
    found = [whole(aligner, t) for t in texts]
    counts = sum((f[4] for f in found), Counter())
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [(n_a, n_b, groups, sum(links.values()), sum(n for p, n in links.items() if counts[p] == most[p[1]]),
             sum(n * counts[p] for p, n in links.items()), sha(string) if n_a else "")
            for n_a, n_b, groups, string, links in found]


def hard_texts():
    rng = random.Random(11)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(1, 30))) for _ in range(150)]
    return [*texts, *texts[:40], *["the same text"] * 60, None, "", None, " ", "  ", "a ", "a", "x" * 5_000, "word " * 20_000,
            "<|endoftext|>", "▁", "\0"]


@pytest.mark.parametrize("seed", range(3))
def test_parts_equal_whole_texts(aligner, seed):
    assert aligner.cut
    rng = random.Random(seed)
    for _ in range(40):
        texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(1, 30))) for _ in range(30)]
        columns = [c.to_pylist() for c in aligner.align(pa.array(texts))]
        for text, n_a, n_b, n_groups, n_links, digest, a, b, times in zip(texts, *columns, strict=True):
            want = whole(aligner, text)
            assert (n_a, n_b, n_groups, n_links, digest) == (*want[:3], sum(want[4].values()), sha(want[3]) if want[0] else "")
            assert dict(zip(zip(a, b, strict=True), times, strict=True)) == want[4]


def test_files_that_allow_no_cuts_are_read_whole(aligner, monkeypatch):
    texts = pa.array(["one two  three ", "a▁b", " x", "one two"])
    cut = aligner.align(texts)
    monkeypatch.setattr(aligner, "cut", False)
    assert [c.to_pylist() for c in aligner.align(texts)] == [c.to_pylist() for c in cut]


def test_part_starts():
    data = np.frombuffer("a b  c　 d é e\n f ".encode(), np.uint8)
    starts = np.flatnonzero(alignment.begins(data, np.array([0, len(data)])))
    assert [bytes(x) for x in np.split(data, starts[1:])] == [p.encode() for p in ("a", " b", "  c　 d", " é", " e\n f ")]


@pytest.mark.parametrize("rows", [tables.BROADCAST_ROWS, 0])
def test_hard_rows(spark, aligner, monkeypatch, rows):
    """Pair counts go to the texts by broadcast, and by a shuffle."""
    monkeypatch.setattr(tables, "BROADCAST_ROWS", rows)
    texts = hard_texts()
    frame = docs_frame(spark, list(enumerate(texts))).withColumn("a", F.lit("clash")).withColumn("n_a", F.lit("clash")).repartition(6)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.alignment(frame, A, B).collect()}
    assert got == dict(enumerate(expected(aligner, texts)))


def test_repeated_and_null_ids(spark, aligner):
    rows = [(1, "one text"), (1, "another text"), (1, "one text"), (None, "one text"), (None, None), (2, "")]
    got = alignment.alignment(docs_frame(spark, rows), A, B).collect()
    want = [(i, *e) for (i, _), e in zip(rows, expected(aligner, [t for _, t in rows]), strict=True)]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))


def test_no_rows(spark):
    frame = docs_frame(spark, [(1, "x")])
    assert alignment.alignment(frame.limit(0), A, B).count() == 0
    got = alignment.alignment(docs_frame(spark, [(1, None), (2, "▁")]), A, B).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_over_the_whole_small_table(spark, aligner):
    docs = queries.table(spark, SF, "documents").collect()
    want = dict(zip([r.doc_id for r in docs], expected(aligner, [r.text for r in docs]), strict=True))
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_token_alignment(spark, SF).collect()}
    assert got == want
