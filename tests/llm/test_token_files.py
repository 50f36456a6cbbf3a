"""Token files: wide ids, tokenizers that allow no cuts, and the reading of single documents."""

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_corpus_operators import docs_frame, hard_texts
from touchline.llm import queries, tokens

TEXTS = ["", "one two", "a<|end_of_text|>b x-y", "<|pad one|> <|pad one|>", "Ünï \n\n tab\t.", "it's a word- by-word_case", "日本 語"]


def changed(tmp_path, change):
    state = json.load(open(queries.vocabulary()))
    change(state)
    path = str(tmp_path / "own.json")
    json.dump(state, open(path, "w"))
    return path


def added(state, *contents, **flags):
    first = max(state["model"]["vocab"].values()) + len(state["added_tokens"])
    for i, content in enumerate(contents):
        state["added_tokens"].append({"id": first + i, "content": content, "single_word": False, "lstrip": False, "rstrip": False,
                                      "normalized": False, "special": True} | flags)


def large(state):
    """More than 65,536 ids: the further ones are added tokens that the cuts leave whole."""
    added(state, *(f"<{i}|" for i in range(20_000)))


@pytest.fixture
def encoders():
    yield tokens.encoder
    tokens.encoder.cache_clear()


@pytest.mark.parametrize("change, cut, width", [
    (lambda s: None, True, 2), (large, True, 4), (lambda s: added(s, "<|end_of_text|>"), False, 2), (lambda s: added(s, "<|pad one|>"), False, 2),
    (lambda s: added(s, "<|x|>", lstrip=True), False, 2), (lambda s: s["pre_tokenizer"].update(add_prefix_space=True), False, 2),
    (lambda s: s.update(normalizer={"type": "Lowercase"}), False, 2)])
def test_ids_equal_those_of_the_tokenizer(tmp_path, encoders, change, cut, width):
    path = changed(tmp_path, change)
    own = encoders(path)
    assert (own.cut, own.width.itemsize) == (cut, width)
    texts = [*TEXTS, "<19999| a<0|b <|x|> c", *[t for t in hard_texts().values() if t and len(t) < 5_000]]
    ids, places = own.encode(pa.array(texts))
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(path)
    for text, low, high in zip(texts, places[:-1], places[1:], strict=True):
        assert ids[low:high].tolist() == [*plain.encode(text, add_special_tokens=False).ids, tokens.END_ID]


def test_wide_ids_survive_the_files(spark, tmp_path, encoders):
    path = changed(tmp_path, large)
    texts = {i: f"<{19_000 + i}| word {i} <{i}|" for i in range(40)} | {50: None, 51: ""}
    frame = docs_frame(spark, texts.items())
    folder = tokens.write_tokens(frame, path, str(tmp_path / "ids"))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokens.read_tokens(spark, folder).collect()}
    assert got == brute.encoded(texts, path)
    ids = {r.doc_id: r.ids for r in tokens.read_documents(spark, folder, list(texts)).collect()}
    assert max(max(x) for x in ids.values()) > 65_536 and ids[50] == [tokens.END_ID]


def test_single_documents(spark, tmp_path, monkeypatch):
    texts = {3 * i: f"text number {i} " * (i % 7) for i in range(300)}
    rows = [*texts.items(), (30, "another text of the same id"), (None, "no id")]
    frame = docs_frame(spark, rows).repartition(3)
    monkeypatch.setattr(tokens, "ENCODED_BYTES", 500)
    folder = tokens.write_tokens(frame, queries.vocabulary(), str(tmp_path / "ids"))
    encode = tokens.Encoder(queries.vocabulary()).tokenizer.encode
    want = lambda text: [*encode(text, add_special_tokens=False).ids, tokens.END_ID]
    for limit in (tokens.NAMED_IDS, 2):
        monkeypatch.setattr(tokens, "NAMED_IDS", limit)
        found = tokens.read_documents(spark, folder, [30, 31, 600, 897, 10**6, None, 30]).collect()
        assert sorted((r.doc_id, r.ids) for r in found) == sorted(
            [(30, want(texts[30])), (30, want("another text of the same id")), (600, want(texts[600])), (897, want(texts[897]))])
    assert tokens.read_documents(spark, folder, []).count() == 0
    monkeypatch.setattr(tokens, "NAMED_IDS", 1_000)
    shown = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = tokens.read_documents(spark, folder, [600])._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", shown)
    assert "LessThanOrEqual(least,600)" in plan and "GreaterThanOrEqual(greatest,600)" in plan
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.count() > 30 and blocks.filter("least <= 600 AND greatest >= 600").count() == 1
    assert blocks.agg(F.max(F.size("doc_ids"))).first()[0] < 40


def test_dictionary_must_be_the_blocks_own(spark, tmp_path):
    folder = tokens.write_tokens(docs_frame(spark, [(1, "a b c")]), queries.vocabulary(), str(tmp_path / "ids"))
    spark.createDataFrame([("x", bytearray(b"other"))], "sha256 string, content binary").write.mode("overwrite").parquet(f"{folder}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        tokens.read_documents(spark, folder, [1]).collect()
    assert np.dtype("<u4") == tokens.width_of(4)
