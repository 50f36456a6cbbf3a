"""Parts of a benchmark keep to their size, whatever the items are, and find what one part finds."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_corpus_operators import docs_frame, words
from touchline.llm import decontaminate


def items_and_docs():
    rng = random.Random(3)
    long = words(rng, 3_000, 10**6)
    items = [(str(i), "the same item of a benchmark that many sources list under their own name again and again " * 2) for i in range(60)]
    items += [("long", " ".join(long)), ("long", " ".join(long)), ("a", " ".join(words(rng, 5))), ("b", " ".join(words(rng, 40))), (None, "x y"), ("n", None),
              ("w", " ".join("z" * 900 + str(i) for i in range(14))), ("e", ""), ("é", "é " * 30)]
    docs = {i: " ".join([*words(rng, 20), *long[at:at + 13 + i % 3], *words(rng, 20)]) for i, at in enumerate(range(0, 2_980, 37))}
    docs |= {500: items[0][1], 501: items[62][1], 502: None, 503: "x y", 504: items[66][1], 505: "é " * 13, 506: " ".join(long[:12]), 507: " ".join(long)}
    return items, docs


@pytest.mark.parametrize("part_bytes", [8_000, 10**7])
def test_parts_keep_to_their_size(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part_bytes)
    items, docs = items_and_docs()
    bench = spark.createDataFrame(items, "item_id string, text string")
    parts = decontaminate.Parts(bench)
    sizes = [parts.of(i).agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows")).first() for i in range(len(parts))]
    # Fourteen words of 900 letters make stretches of thirteen, which no part can split.
    assert all(r.bytes <= part_bytes or r.rows == 1 for r in sizes) and (len(parts) > 1) == (part_bytes < 10**6) and len(parts) < 16
    assert sum(r.rows for r in sizes) == parts.items.count()
    named = [(i if i is not None else "", t) for i, t in items if t is not None]
    wanted = brute.contamination(docs, named)
    got = decontaminate.contamination(docs_frame(spark, docs.items()), bench)
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == wanted
    assert sum(v[1] > 0 for v in wanted.values()) > 80


def test_stretches_have_every_window():
    rng = random.Random(4)
    texts = [" ".join("w" * rng.randrange(1, 30) + str(i) for i in range(n)) for n in (1, 12, 13, 14, 40, 400)] + ["", "ü" * 300, " ! "]
    batch = pa.RecordBatch.from_pydict({"item": [str(i) for i in range(len(texts))], "text": texts})
    for limit in (1, 100, 700):
        cut = {}
        for out in decontaminate.stretches(limit)([batch]):
            for item, text in zip(out.column("item").to_pylist(), out.column("text").to_pylist()):
                cut.setdefault(int(item), []).append(text)
        for i, text in enumerate(texts):
            own = brute.PLAIN.findall(text)
            windows = lambda t: {tuple(t[k:k + 13]) for k in range(len(t) - 12)} if len(t) > 12 else {tuple(t)}
            assert set().union(*(windows(brute.PLAIN.findall(t)) for t in cut[i])) == windows(own)
            assert limit < 700 or all(len(t.encode()) <= limit or len(t.split()) <= 13 for t in cut[i])


def test_windows_of_one_hash_stand_side_by_side(monkeypatch):
    monkeypatch.setattr(decontaminate, "window_hashes", lambda hashes, width, seed=0: hashes[:max(len(hashes) - width + 1, 0)] * 0)
    rng = random.Random(5)
    items = [" ".join(words(rng, 20)) for _ in range(4)]
    part = decontaminate.index_items(["b", "a", "b", "c"], pa.array([items[0], items[0], items[1], items[2]]))
    (windows,) = part.windows
    texts = {}
    for entry in range(len(windows.words)):
        at = int(windows.words[entry])
        text = b" ".join(part.text.data[part.text.starts[w]:part.text.ends[w]].tobytes() for w in range(at, at + 13))
        texts.setdefault(text, set()).update(part.items(windows, entry))
    want = {}
    for name, item in zip(["b", "a", "b", "c"], [items[0], items[0], items[1], items[2]]):
        own = item.split()
        for k in range(8):
            want.setdefault(" ".join(own[k:k + 13]).encode(), set()).add(name)
    assert texts == want
