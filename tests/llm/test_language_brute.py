"""The whole prediction of languages, learning included, against plain Python on the small table."""

import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.test_corpus_operators import SF
from touchline.llm import language, queries

LETTER = [65 <= b < 91 or 97 <= b < 123 or b >= 128 for b in range(256)]
GRAMS = len(language.ORDERS) * language.BUCKETS


def words_of(raw):
    """(start, end, cells, script) of each word of a text's bytes."""
    folded = [0] * 4 + [(b + 32 if 65 <= b < 91 else b) if LETTER[b] else 0 for b in raw] + [0]
    out, start = [], None
    for i, b in enumerate([*raw, 32]):
        if LETTER[b] and start is None:
            start = i
        if not LETTER[b] and start is not None:
            cells = []
            for number, order in enumerate(language.ORDERS):
                for p in range(start + 4, i + 5):
                    key = sum(folded[p - back] << 8 * back for back in range(order))
                    cells.append((key * 0x9E3779B97F4A7C15 % 2**64 >> 49) + number * language.BUCKETS)
            out.append((start, i, cells, max(int(language.SCRIPTS[x]) for x in raw[start:i])))
            start = None
    return out


def learnt(rows):
    grams, scripts = defaultdict(Counter), defaultdict(Counter)
    for lang, words in rows:
        for _, _, cells, script in words:
            grams[lang].update(cells)
            scripts[lang][script] += 1
    langs = sorted(grams)
    sums = {x: [sum(n for c, n in grams[x].items() if c // language.BUCKETS == k) for k in range(len(language.ORDERS))] for x in langs}

    def score(lang, cell):
        share = (grams[lang][cell] + 0.5) / (sums[lang][cell // language.BUCKETS] + 0.5 * language.BUCKETS)
        return round(math.log(share) * language.UNIT / len(language.ORDERS))

    def uses(lang, script):
        return scripts[lang][script] > 0 and scripts[lang][script] >= language.SCRIPT_SHARE * max(sum(scripts[lang].values()), 1)

    def barred(lang, script):
        return 0 if uses(lang, script) or not any(uses(x, script) for x in langs) else language.BARRED
    return langs, score, barred


def best_path(scores):
    """The best total of a label sequence: every word's score less the penalty of each switch."""
    best = list(scores[0])
    for own in scores[1:]:
        top = max(best) - language.SWITCH
        best = [max(b, top) + s for b, s in zip(best, own, strict=True)]
    return max(best)


def test_every_prediction_of_the_small_table(spark):
    docs = queries.table(spark, SF, "documents").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in docs}
    words = {r.doc_id: words_of((r.text or "").encode()) for r in docs}
    langs, score, barred = learnt([(r.lang, words[r.doc_id]) for r in docs if r.lang is not None and not held[r.doc_id]])
    known = {}

    def scored(word):
        _, _, cells, script = word
        for c in cells:
            if c not in known:
                known[c] = [score(x, c) for x in langs]
        return [sum(known[c][i] for c in cells) - barred(x, script) for i, x in enumerate(langs)]
    right = 0
    for r in queries.op2_language_id(spark, SF).collect():
        own, text = words[r.doc_id], next(d.text for d in docs if d.doc_id == r.doc_id) or ""
        assert r.held_out == held[r.doc_id]
        if not any(map(str.isalpha, text)):
            assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, "")
            continue
        # The spans are a best path: their score, penalties included, is the greatest there is.
        places, at, label = [len(text[:k].encode()) for k in range(len(text) + 1)], 0, []
        pieces = [s.rsplit(":", 2) for s in r.spans.split(",")]
        for lang, low, high in pieces:
            while at < len(own) and own[at][0] < places[int(high)]:
                assert own[at][0] >= places[int(low)]
                label.append(langs.index(lang))
                at += 1
        assert len(label) == len(own)
        table = [scored(w) for w in own]
        total = sum(s[x] for s, x in zip(table, label, strict=True)) - language.SWITCH * sum(a != b for a, b in zip(label, label[1:]))
        assert total == best_path(table), r.doc_id
        held_bytes = Counter()
        for w, x in zip(own, label, strict=True):
            held_bytes[x] += w[1] - w[0]
        most = min(range(len(langs)), key=lambda i: (-held_bytes[i], i))
        assert (r.lang_pred, r.score) == (langs[most], held_bytes[most] / sum(held_bytes.values()))
        if r.held_out:
            lang = next(d.lang for d in docs if d.doc_id == r.doc_id)
            right += (lang in (None, r.lang_pred)) - (lang not in (None, r.lang_pred))
    assert right > 0


def test_a_prediction_depends_on_its_own_text_alone(spark):
    """However rows are dealt into tasks and batches, each has the same spans and score."""
    docs = queries.table(spark, SF, "documents")
    model = language.learn(docs)
    rows = docs.select("doc_id", language.held_out().alias("held_out"), "text")
    out = "doc_id long, held_out boolean, lang_pred string, score double, spans string"
    dealt = [rows.repartition(n, F.xxhash64("doc_id", F.lit(n))).mapInArrow(language.predict(model), out) for n in (1, 3, 17)]
    first, *others = [sorted(map(tuple, df.collect())) for df in dealt]
    assert all(other == first for other in others)
    counts = [language.learn(docs.repartition(n)).scores for n in (2, 7)]
    assert (counts[0] == counts[1]).all()
