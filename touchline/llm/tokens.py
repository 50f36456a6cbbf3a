"""Token ids in compressed binary blocks that give back single short documents.

Texts are cut before a blank or line feed that follows a byte no white space ends with, and between an ASCII letter
and a mark. No token of a byte-level vocabulary with the usual pattern crosses such a cut, so equal pieces are encoded once
and their ids are put together; a tokenizer of another kind, or with an added token that the cuts would split, gets whole
texts. Ids are written in two bytes, or in four if the vocabulary has more than 65,536. A piece that is one word of Latin letters goes straight to the tokenizer's merges, many at a time, with
a byte between them that no text has; any other piece goes through the whole tokenizer. Every document is its own
zstandard frame, under one dictionary trained on the id arrays of at most SAMPLE_DOCS documents of at most
SAMPLE_BYTES; the dictionary only changes sizes, never ids.

The output is three tables in one folder: ``dictionary`` (sha256, content); ``blocks`` (shard, block, dict_sha256,
tokens_before, n_tokens, id_bytes, least, greatest, doc_ids, counts, ends, frames), the documents ascending by doc_id from
least to greatest, ``ends`` giving where each frame ends; ``shards`` (shard, start), the ids before each shard.
``read_documents`` reads single documents: the file's statistics of least and greatest leave the blocks that can hold
them, and of those only the bytes between two ends are decoded.

A null text counts as empty and is the end id alone. Null doc_ids come first. Rows that repeat a doc_id are kept,
ordered by text. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.arrays import binary_array, chunks, release_memory, text_bytes, within
from touchline.llm.tables import small
from touchline.session import new_folder, with_known_rows

END_ID = 2
WIDTH, WIDE = np.dtype("<u2"), np.dtype("<u4")  # ids below 65,536, and others
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 65_536, 112_640
LEVEL = 3
CACHED_PIECES = 300_000
ENCODED_BYTES, LEAN_BYTES = 8_000_000, 2_000_000
JOINED_WORDS = 100
BLOCKS = ("shard int, block int, dict_sha256 string, tokens_before long, n_tokens long, id_bytes int, least long, greatest long, "
          "doc_ids array<long>, counts array<long>, ends array<long>, frames binary")
NAMED_IDS = 1_000  # so many documents are looked for by the statistics of the files; more of them by a join


#: One pre-token as a whole: a blank at most, then letters of ASCII, Latin-1 or Latin Extended-A and -B.
ONE_WORD = re.compile(r" ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+")
LETTERS, MARKS = np.zeros(256, bool), np.zeros(256, bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = True
MARKS[0x21:0x30] = MARKS[0x3A:0x41] = MARKS[0x5B:0x61] = MARKS[0x7B:0x7F] = True
MARKS[0x7C] = False  # the special token's name ends at a bar


def byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it shows, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(hidden)) for b in range(256))


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: at each row, at blanks and line feeds right after a byte that ends no white space, and at
    marks right after a letter."""
    if not len(data):
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data[1:] == 0x20) | (data[1:] == 0x0A)) + 1
    before = data[at - 1]
    plain = (before > 0x20) & (before < 0x7F)
    high = np.flatnonzero(before >= 0x80)
    lead = np.stack([data[np.maximum(at[high] - i, 0)] for i in (1, 2, 3)])
    # White space beyond ASCII ends in 85 or A0 after C2, or is three bytes after E1, E2 or E3.
    blank = ((lead[1] == 0xC2) & ((lead[0] == 0x85) | (lead[0] == 0xA0))) | ((lead[2] >= 0xE1) & (lead[2] <= 0xE3))
    plain[high] = ~blank
    begins = np.zeros(len(data), bool)
    begins[1:] = LETTERS[data[:-1]] & MARKS[data[1:]]
    begins[at[plain]] = True
    heads = offsets[:-1]
    begins[heads[heads < len(data)]] = True
    return np.flatnonzero(begins)


def cuts_hold(state: dict) -> bool:
    """Whether a tokenizer, as its file states it, never goes across a cut: a byte-level pattern on the text as it is,
    and added tokens that the cuts leave whole and that take no white space with them."""
    before = state.get("pre_tokenizer") or {}
    usual = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if state.get("normalizer") is not None or not usual:
        return False
    for token in state.get("added_tokens", ()):
        data = np.frombuffer(token["content"].encode(), np.uint8)
        if token["lstrip"] or token["rstrip"] or token["single_word"] or len(cuts(data, np.array([0, len(data)]))) != 1:
            return False
    return True


class Encoder:
    """The tokenizer of one worker, with the ids of the pieces it met last. ``traits`` are those of another encoder of
    the same file, which takes a copy of the vocabulary and of the file to find out."""

    def __init__(self, path: str, traits: tuple[int, bool, bool] | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        self.tokenizer.model._resize_cache(0)  # self.known is the cache
        self.letters = dict(enumerate(byte_letters()))
        between = self.letters[0xFF]
        self.between = self.tokenizer.token_to_id(between)
        if traits is None:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            width = WIDTH if max(vocabulary.values()) < 1 << 16 else WIDE
            cut = cuts_hold(json.loads(self.tokenizer.to_str()))
            traits = width.itemsize, cut, cut and self.between is not None and not any(between in t for t in vocabulary if t != between)
        self.traits = traits
        self.width, self.cut, self.joins = width_of(traits[0]), *traits[1:]

    def learn(self, fresh: list[str]) -> None:
        whole = [p for p in fresh if self.joins and ONE_WORD.fullmatch(p)]
        for low in range(0, len(whole), JOINED_WORDS):
            part = whole[low:low + JOINED_WORDS]
            letters = b"\xff".join(p.encode() for p in part).decode("latin-1").translate(self.letters)
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(letters)], np.int64)
            ends, raw, start = np.append(np.flatnonzero(ids == self.between), len(ids)), ids.astype(self.width).tobytes(), 0
            for piece, end in zip(part, (ends * self.width.itemsize).tolist(), strict=True):
                self.known[piece] = raw[start:end]
                start = end + self.width.itemsize
        rest = [p for p in fresh if p not in self.known]
        for low in range(0, len(rest), JOINED_WORDS):
            part = rest[low:low + JOINED_WORDS]
            for piece, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[piece] = np.array(found.ids, self.width).tobytes()

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        fresh = [p for p in pieces if p not in self.known]
        if len(self.known) + len(fresh) > CACHED_PIECES:
            self.known, fresh = {}, pieces
        self.learn(fresh)
        return list(map(self.known.__getitem__, pieces))

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, each row ended by END_ID, and each row's first place."""
        data, offsets = text_bytes(text)
        begins = cuts(data, offsets) if self.cut else np.unique(offsets[:-1][offsets[:-1] < len(data)])
        pieces = binary_array(data, np.append(begins, len(data)), pa.string()).dictionary_encode()
        ids = self.ids_of(pieces.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width.itemsize
        starts, index = np.cumsum(sizes) - sizes, pieces.indices.to_numpy()
        flat, lengths = np.frombuffer(b"".join(ids), self.width), sizes[index]
        total = np.zeros(len(index) + 1, np.int64)
        np.cumsum(lengths, out=total[1:])
        places = total[np.searchsorted(begins, offsets)] + np.arange(len(offsets))
        out = np.full(places[-1], END_ID, self.width)
        body = np.ones(len(out), bool)
        body[places[1:] - 1] = False
        out[body] = flat[within(starts[index], lengths)]
        return out, places


@cache
def encoder(path: str, traits: tuple[int, bool, bool] | None = None) -> Encoder:
    return Encoder(path, traits)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for short id arrays; too few samples are used as they are."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def sampled_dictionary(docs: DataFrame, path: str) -> bytes:
    """The dictionary, from at most SAMPLE_DOCS documents: those whose hashed ids come first."""
    short = docs.select("doc_id", "text").filter(F.octet_length("text").between(1, SAMPLE_BYTES))
    texts = short.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(SAMPLE_DOCS).select("text").toArrow().column("text")
    if not len(texts):
        return b""
    ids, places = encoder(path).encode(texts.combine_chunks())
    return train_dictionary([ids[a:b].tobytes() for a, b in zip(places[:-1], places[1:], strict=True)])


def dictionary_of(content: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(content) if content else None


def write_blocks(path: str, traits: tuple[int, bool, bool], dictionary: bytes, lean: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        own = dictionary_of(dictionary)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=True) if own else zstandard.ZstdCompressor(level=LEVEL)
        shard, mark, before = TaskContext.get().partitionId(), hashlib.sha256(dictionary).hexdigest(), 0
        for number, batch in enumerate(chunks(batches, limit=LEAN_BYTES if lean else ENCODED_BYTES)):
            ids, places = encoder(path, traits).encode(batch.column("text"))
            frames = [press.compress(ids[a:b].tobytes()) for a, b in zip(places[:-1], places[1:], strict=True)]
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "block": number, "dict_sha256": mark, "tokens_before": before, "n_tokens": len(ids),
                  "id_bytes": ids.itemsize, "least": pc.min(batch.column("doc_id")).as_py(), "greatest": pc.max(batch.column("doc_id")).as_py(),
                  "doc_ids": batch.column("doc_id").to_pylist(), "counts": np.diff(places).tolist(),
                  "ends": np.cumsum([len(f) for f in frames]).tolist(), "frames": b"".join(frames)}],
                pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("dict_sha256", pa.string()), ("tokens_before", pa.int64()),
                           ("n_tokens", pa.int64()), ("id_bytes", pa.int32()), ("least", pa.int64()), ("greatest", pa.int64()),
                           ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                           ("ends", pa.list_(pa.int64())), ("frames", pa.binary())]))
            before += len(ids)
        if lean:
            encoder.cache_clear()
            release_memory()
    return run


def write_tokens(docs: DataFrame, path: str, folder: str | None = None, lean: bool = False) -> str:
    """Encode the documents into a folder of the format above and return it. ``lean``: with less text at a time, and
    no tokenizer or pieces kept for a worker's next task; slower, for jobs whose workers do other things as well."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    content = sampled_dictionary(docs, path)
    spark.createDataFrame([(hashlib.sha256(content).hexdigest(), content)], "sha256 string, content binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    order = ["doc_id", F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order, "text")
    rows.mapInArrow(write_blocks(path, encoder(path).traits, content, lean), BLOCKS).write.parquet(f"{folder}/blocks")
    sizes = spark.read.parquet(f"{folder}/blocks").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    sizes.select("shard", F.coalesce(before, F.lit(0)).alias("start")).coalesce(1).write.parquet(f"{folder}/shards")
    return folder


def decompressor(dictionary):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()


def decode_rows(frames: bytes, ends: list[int], dictionary, width: np.dtype = WIDTH) -> Iterator[np.ndarray]:
    reader = decompressor(dictionary)
    for a, b in zip([0, *ends], ends):
        yield np.frombuffer(reader.decompress(frames[a:b]), width)


def width_of(id_bytes: int) -> np.dtype:
    return {w.itemsize: w for w in (WIDTH, WIDE)}[id_bytes]


def summarise(content: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, mark = dictionary_of(content), hashlib.sha256(content).hexdigest()
        for batch in batches:
            for block in range(batch.num_rows):
                row = {name: batch.column(name)[block].as_py() for name in ("start", "tokens_before", "dict_sha256", "id_bytes", "doc_ids", "ends", "frames")}
                if row["dict_sha256"] != mark:
                    raise ValueError("a block was written with another dictionary")
                ids = list(decode_rows(row["frames"], row["ends"], own, width_of(row["id_bytes"])))
                sizes = np.array([len(i) for i in ids], np.int64)
                starts = row["start"] + row["tokens_before"] + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(sizes),
                     pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from a written folder."""
    content = spark.read.parquet(f"{folder}/dictionary").first()["content"]
    shards = spark.read.parquet(f"{folder}/shards")
    shards = small(with_known_rows(shards, shards.count()), 16)
    blocks = spark.read.parquet(f"{folder}/blocks").join(shards, "shard")
    return blocks.mapInArrow(summarise(bytes(content)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def picked(content: bytes, wanted: set[int] | None):
    """The ids of the wanted documents of each block; without a set, those a row lists in ``wanted``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, mark = decompressor(dictionary_of(content)), hashlib.sha256(content).hexdigest()
        for batch in batches:
            for block in range(batch.num_rows):
                ids = batch.column("doc_ids")[block].as_py()
                own = wanted if wanted is not None else set(batch.column("wanted")[block].as_py())
                at = [i for i, doc in enumerate(ids) if doc in own]
                if not at:
                    continue
                if batch.column("dict_sha256")[block].as_py() != mark:
                    raise ValueError("a block was written with another dictionary")
                ends, frames = [0, *batch.column("ends")[block].as_py()], batch.column("frames")[block].as_buffer()
                width = width_of(batch.column("id_bytes")[block].as_py())
                tokens = [np.frombuffer(reader.decompress(frames[ends[i]:ends[i + 1]]), width).astype(np.int64) for i in at]
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in at], pa.int64()), pa.array(tokens, pa.list_(pa.int64()))], ["doc_id", "ids"])
    return run


def read_documents(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """(doc_id, ids) of the documents named, with a row for each row that has the doc_id; those that are not there are
    left out. Blocks that cannot hold them are not read, and nothing else of a block is decoded."""
    content = bytes(spark.read.parquet(f"{folder}/dictionary").first()["content"])
    blocks, wanted = spark.read.parquet(f"{folder}/blocks"), sorted({i for i in ids if i is not None})
    columns = ["dict_sha256", "id_bytes", "doc_ids", "ends", "frames"]
    if len(wanted) <= NAMED_IDS:
        near = [(F.col("least") <= i) & (F.col("greatest") >= i) for i in wanted]
        near = reduce(lambda a, b: a | b, near, F.lit(False))
        return blocks.filter(near).select(columns).mapInArrow(picked(content, set(wanted)), "doc_id long, ids array<long>")
    index = blocks.select("shard", "block", F.explode("doc_ids").alias("id"))
    asked = spark.createDataFrame([(i,) for i in wanted], "id long")
    listed = index.join(asked, "id").groupBy("shard", "block").agg(F.collect_set("id").alias("wanted"))
    return blocks.join(listed, ["shard", "block"]).select(*columns, "wanted").mapInArrow(picked(content, None), "doc_id long, ids array<long>")


def tokenized(docs: DataFrame, path: str, lean: bool = False) -> DataFrame:
    return read_tokens(docs.sparkSession, write_tokens(docs, path, lean=lean))
