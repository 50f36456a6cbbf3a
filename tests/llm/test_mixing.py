"""The mix against plain Python: weights, budgets, which documents are taken and how often, and their order."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import SPACED
from tests.llm.test_corpus_operators import SF, docs_frame
from touchline.llm import mixing, queries


def weights_of(tokens, entropy=mixing.TARGET_ENTROPY, repeats=mixing.MAX_REPEATS):
    """Source -> weight, by bisection of the exponent."""
    total = sum(tokens.values())
    p = {s: t / total for s, t in tokens.items()}

    def weighted(a):
        z = sum(x**a for x in p.values())
        return {s: x**a / z for s, x in p.items()}

    def bisect(holds, low, high):
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if holds(middle) else (low, middle)
        return low
    even = lambda a: -sum(w * math.log(w) for w in weighted(a).values() if w) >= entropy * math.log(len(p))
    most = lambda a: max(w / p[s] for s, w in weighted(a).items()) / min(w / p[s] for s, w in weighted(a).items())
    a = 1.0 if even(1.0) else bisect(even, 0.0, 1.0)
    if most(a) > repeats:
        a = bisect(lambda x: most(x) > repeats, 0.0, 1.0)
    return weighted(a)


def test_the_whole_small_table(spark):
    docs = queries.table(spark, SF, "documents").select("doc_id", "text", "source").collect()
    size = {r.doc_id: max(len(SPACED.findall(r.text or "")), 1) for r in docs}
    source = {r.doc_id: r.source for r in docs}
    tokens = Counter()
    for i, n in size.items():
        tokens[source[i]] += n
    want = weights_of(tokens)
    rows = queries.op8_mix_sources(spark, SF).collect()
    taken, seen = defaultdict(list), defaultdict(Counter)
    for r in rows:
        assert (r.source, r.n_tokens) == (source[r.doc_id], size[r.doc_id])
        assert r.weight == pytest.approx(want[r.source], abs=1e-5)
        taken[r.source].append(r)
        seen[r.source][r.epoch, r.doc_id] += 1
    least = min(want[s] / tokens[s] for s in tokens)
    for s, own in taken.items():
        budget = max(round(want[s] / least), tokens[s])
        ids = {i for i in source if source[i] == s}
        epochs = max(r.epoch for r in own)
        # Every document once in each full epoch, none twice in one, and the last epoch ends where the budget does.
        assert set(seen[s].values()) == {1}
        for e in range(epochs):
            assert {i for f, i in seen[s] if f == e} == ids
        total = sum(r.n_tokens for r in own)
        assert budget * (1 - 1e-4) <= total < budget * (1 + 1e-4) + max(size[i] for i in ids)
        # One whole order: no two documents of a source share their place, blocks do not overlap, positions ascend.
        order = sorted(own, key=lambda r: (r.epoch, r.position, r.in_block))
        assert len({(r.epoch, r.position, r.in_block) for r in own}) == len(own)
        before, starts = 0, {}
        for r in order:
            starts.setdefault((r.epoch, r.position), before)
            before += r.n_tokens
        assert all(position == pytest.approx(start / budget, abs=1e-3) for (_, position), start in starts.items())
    assert set(taken) == set(tokens)


def test_columns_with_the_names_of_its_own(spark):
    texts = [(i, f"word {i} " * (1 + i % 4)) for i in range(60)] + [(3, "another text"), (None, None), (None, "")]
    frame = docs_frame(spark, texts)
    for name in ("_mix_tokens", "_mix_row", "_mix_source", "_mix_epoch", "position", "in_block", "weight_", "_MIX_block"):
        frame = frame.withColumn(name, F.lit("clash"))
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns and out.filter("_mix_tokens = 'clash' AND _mix_row = 'clash' AND _MIX_block = 'clash'").count() == out.count()
    once = {(r.doc_id, r.text) for r in out.collect()}
    assert once == set(texts)
    with pytest.raises(ValueError, match="_mix_tokens"):
        mixing.mixed(frame)
    assert mixing.mixed_documents(frame.limit(0)).count() == 0
