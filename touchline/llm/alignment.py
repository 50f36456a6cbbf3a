"""Alignment of the tokens of two tokenizers, once for each distinct text.

Rows are shuffled by their full text; each distinct text is tokenized and aligned once, its pair counts are weighted by
how many rows have it, and its measures go back to the rows by a SHA-256 of the text (the most frequent texts by
broadcast). Tokenizer A is a byte-level BPE file of the tokenizers library, B a sentencepiece model with byte fallback
that puts a blank before the text; A gets that blank too, so both speak of the same bytes. Byte offsets where a token of
A and one of B end cut the tokens into groups. Two tokens are linked where their byte ranges overlap, which they do once
between two neighbouring ends of either side, so links are found in one pass over the ends.

Within a chunk of texts, words that repeat are tokenized once as well: texts are cut before a blank that follows a visible
character, where A's pattern always starts anew and no piece of B goes across. The distinct parts are put together
as one text, whose tokens fall apart at the same cuts. Both conditions are read off the two files; if one does not hold,
texts are not cut. A chunk holds CHUNK bytes of text; a longer text is a chunk of its own.

Pair counts are a table of (a, b) over the whole corpus; a counted small one is broadcast to the texts' pairs, a larger
one is joined by a shuffle of them.

Texts that are null, empty, or not given back byte by byte by the tokens of either side (U+2581, say) have no tokens and
count nowhere: zeros and an empty string. Rows that repeat a doc_id, or have none, are rows of their own. An empty table
gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import binary_array, chunks, per_row, release_memory, text_bytes, within
from touchline.llm.tables import joined_to_rows, small, written
from touchline.llm.tokens import byte_letters

CHUNK = 2_000_000
ENCODED = 50_000  # characters given to a tokenizer at once
BLANK = "▁"  # stands for a blank in the pieces of B
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = "key string, n long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, times array<int>"


def begins(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which bytes begin a part: the first of each row, and a blank after a visible character if something follows it."""
    out = np.zeros(len(data), bool)
    if not len(data):
        return out
    at = np.flatnonzero(data[1:-1] == 0x20) + 1
    before = data[at - 1]
    visible = (before > 0x20) & (before < 0x7F)
    high = np.flatnonzero(before >= 0x80)
    one, two, three = (data[np.maximum(at[high] - i, 0)] for i in (1, 2, 3))
    # White space beyond ASCII ends in 85 or A0 after C2, or is three bytes after E1, E2 or E3.
    visible[high] = ~(((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((three >= 0xE1) & (three <= 0xE3)))
    out[at[visible]] = True
    last, first = offsets[1:][offsets[1:] > 0] - 1, offsets[:-1]
    out[last] = False  # a blank that ends a text stays with what is before it
    out[first[first < len(data)]] = True
    return out


class Side:
    """What the alignment needs of a tokenizer: the bytes of each id, and the ids of texts."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens, self.sizes = tokens, np.array([len(t) for t in tokens], np.int64)

    def ids(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def encoded(self, parts: list[str], raw: list[bytes], n_tied: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all parts, how many each has, and whether they give its bytes back. The first ``n_tied`` parts are
        put together; where that is not given back, every part is encoded by itself."""
        ids, n_ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if n_tied:
            ids = np.array(list(chain.from_iterable(self.ids(joined(parts[:n_tied])))), np.int64)
            ends, token_ends = np.cumsum(list(map(len, raw[:n_tied]))), np.cumsum(self.sizes[ids])
            if b"".join(map(self.tokens.__getitem__, ids.tolist())) != b"".join(raw[:n_tied]) or not np.isin(ends, token_ends).all():
                return self.encoded(parts, raw, 0)
            n_ids = np.diff(np.searchsorted(token_ends, ends, "right"), prepend=0)
        alone = self.ids(parts[n_tied:])
        same = [b"".join(map(self.tokens.__getitem__, x)) == y for x, y in zip(alone, raw[n_tied:], strict=True)]
        ids = np.concatenate([ids, np.array(list(chain.from_iterable(alone)), np.int64)])
        return ids, np.r_[n_ids, np.array(list(map(len, alone)), np.int64)], np.r_[np.ones(n_tied, bool), np.array(same, bool)]


def joined(parts: list[str]) -> list[str]:
    step = max(1, ENCODED * len(parts) // max(1, sum(map(len, parts))))
    return ["".join(parts[i:i + step]) for i in range(0, len(parts), step)]


class ByteLevel(Side):
    """Tokenizer A."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.model._resize_cache(0)  # parts come once
        letter = {c: i for i, c in enumerate(byte_letters())}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = bytes(letter[c] for c in token) if all(c in letter for c in token) else token.encode()
        super().__init__(tokens)
        state = json.loads(self.tokenizer.to_str())
        before = state["pre_tokenizer"] or {}
        self.starts_anew = (
            state["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and all(t["special"] for t in state["added_tokens"]))

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces(Side):
    """Tokenizer B, which puts the first blank of a part there itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__([
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(BLANK, " ").encode()
            for i, name in enumerate(names)])
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.model.serialized_model_proto())
        rules, across = spec.normalizer_spec, re.compile(f"[^{BLANK}]{BLANK}")
        self.starts_anew = (
            spec.trainer_spec.model_type == 2 and rules.add_dummy_prefix and not rules.remove_extra_whitespaces  # 2: BPE
            and rules.escape_whitespaces and not rules.precompiled_charsmap and not any(map(across.search, names))
            and not any(piece.type == 4 for piece in spec.pieces))  # 4: found before any merge

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1) if texts else []


class Aligner:
    """Both tokenizers of one worker."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.cut = self.a.starts_anew and self.b.starts_anew
        digits = [str(i).encode() + b"," for i in range(max(len(self.a.tokens), len(self.b.tokens)))]
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        sizes = np.array([len(d) for d in digits], np.int64)
        self.digit_at, self.digit_sizes = np.cumsum(sizes) - sizes, sizes

    def align(self, texts: pa.Array) -> list[pa.Array]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, a, b, times) of texts that are neither null nor empty."""
        data, offsets = text_bytes(pc.binary_join_element_wise(pa.scalar(""), texts, pa.scalar(" ")))
        heads = offsets[:-1]
        heads = heads[heads < len(data)]
        begin = begins(data, offsets) if self.cut else np.isin(np.arange(len(data)), heads)
        places = np.flatnonzero(begin)
        first = np.searchsorted(places, offsets)
        parts = binary_array(data, np.append(places, len(data)), pa.string()).dictionary_encode()
        index, parts = parts.indices.to_numpy(), parts.dictionary.to_pylist()
        # Parts that no other part may follow, as the end of one and the blank of the next would go together, come last.
        loose = np.array([not self.cut or p[-1].isspace() or BLANK in p for p in parts], bool)
        order = np.argsort(loose, kind="stable")
        index, parts = np.argsort(order)[index], [parts[i] for i in order.tolist()]
        raw, n_tied = [p.encode() for p in parts], int((~loose).sum())
        ids_a, n_a, same_a = self.a.encoded(parts, raw, n_tied)
        ids_b, n_b, same_b = self.b.encoded(parts, raw, n_tied)
        good = same_a & same_b

        # Ends of tokens in the bytes of all parts that both sides give back.
        keep_a, keep_b = np.repeat(good, n_a), np.repeat(good, n_b)
        ids_a, ids_b, n_a, n_b = ids_a[keep_a], ids_b[keep_b], n_a * good, n_b * good
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        ends = np.union1d(ends_a, ends_b)
        link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        part_of_a = np.repeat(np.arange(len(parts)), n_a)
        part_ends = np.r_[0, ends_a][np.cumsum(n_a)]
        n_groups = np.diff(np.searchsorted(both, part_ends, "right"), prepend=0)
        n_links = np.diff(np.searchsorted(ends, part_ends, "right"), prepend=0)
        strings = self.group_strings(ids_a, ids_b, ends_a, ends_b, both, part_of_a, np.repeat(np.arange(len(parts)), n_b), len(parts))

        whole = per_row((~good[index]).astype(np.int64), first) == 0
        rows = len(texts)
        index_of = [index[first[i]:first[i + 1]].tolist() for i in range(rows)]
        digests = [hashlib.sha256(b"".join(map(strings.__getitem__, x))[:-1]).hexdigest() if ok else "" for x, ok in zip(index_of, whole.tolist(), strict=True)]
        measures = [pa.array(per_row(n[index], first) * whole) for n in (n_a, n_b, n_groups, n_links)]

        kinds, kind = np.unique(ids_a[link_a] * len(self.b.tokens) + ids_b[link_b], return_inverse=True)
        starts, sizes = (np.cumsum(n_links) - n_links)[index], n_links[index] * np.repeat(whole, np.diff(first))
        row = np.repeat(np.repeat(np.arange(rows), np.diff(first)), sizes)
        found, times = np.unique(row * max(len(kinds), 1) + kind[within(starts, sizes)], return_counts=True)
        at, pairs = found // max(len(kinds), 1), kinds[found % max(len(kinds), 1)]
        lists = pa.array(np.searchsorted(at, np.arange(rows + 1)), pa.int32())
        arrays = [pa.ListArray.from_arrays(lists, pa.array(x, pa.int32())) for x in (pairs // len(self.b.tokens), pairs % len(self.b.tokens), times)]
        return [*measures, pa.array(digests, pa.string()), *arrays]

    def group_strings(self, ids_a, ids_b, ends_a, ends_b, both, part_of_a, part_of_b, n_parts) -> list[bytes]:
        """For each part its groups, as ``a1,a2|b1;``: every token's number with the mark that follows it."""
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        before_a, before_b = (np.r_[0, np.cumsum(np.bincount(g, minlength=len(both)))] for g in (group_a, group_b))
        at_a, at_b = np.arange(len(ids_a)) + before_b[group_a], np.arange(len(ids_b)) + before_a[group_b + 1]
        total = len(ids_a) + len(ids_b)
        ids, mark, part = np.zeros(total, np.int64), np.full(total, ord(","), np.uint8), np.zeros(total, np.int64)
        ids[at_a], ids[at_b], part[at_a], part[at_b] = ids_a, ids_b, part_of_a, part_of_b
        mark[at_a[before_a[1:] - 1]], mark[at_b[before_b[1:] - 1]] = ord("|"), ord(";")
        sizes = self.digit_sizes[ids]
        out = self.digits[within(self.digit_at[ids], sizes)]
        ends = np.cumsum(sizes)
        out[ends - 1] = mark
        cuts = np.r_[0, ends][np.searchsorted(part, np.arange(n_parts + 1))].tolist()
        whole = out.tobytes()
        return [whole[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def aligned_texts(kinds: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """ALIGNED for rows (key, text, n) of distinct texts."""
    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        names = [part.split()[0] for part in ALIGNED.split(", ")]
        for part in chunks(batches, limit=CHUNK):
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("n"), *aligner.align(part.column("text"))], names)
        release_memory()

    return kinds.select("key", "text", "n").mapInArrow(align, ALIGNED)


def pair_counts(links: DataFrame) -> DataFrame:
    """(a, b, count, best) over the corpus from (a, b, times, n): how many links hold the pair, and whether no other pair
    of that b holds more."""
    counts = written(links.groupBy("a", "b").agg(F.sum(F.col("times") * F.col("n")).alias("count")))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return written(counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).cast("long").alias("best")))


def alignment(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    filled = F.coalesce(F.length("text") > 0, F.lit(False))
    kinds = rows.where(filled).groupBy("text").agg(F.count(F.lit(1)).alias("n")).withColumn("key", F.sha2("text", 256))
    texts = written(aligned_texts(kinds, path_a, path_b).withColumn("no", F.monotonically_increasing_id()))
    links = texts.select("no", "n", F.inline(F.arrays_zip("a", "b", "times")))
    counts = pair_counts(links)
    scores = links.join(small(counts, 32), ["a", "b"]).groupBy("no").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    measured = texts.select("no", "key", "n", *COUNTS, "groups_sha256").join(scores, "no", "left")
    of_texts = written(measured.select("key", "n", *COUNTS, *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")), "groups_sha256"))
    keyed = rows.where(filled).select("doc_id", F.sha2("text", 256).alias("key"))
    out = ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]
    blank = rows.where(~filled).select("doc_id", *(F.lit(0).cast("long").alias(c) for c in out[1:-1]), F.lit("").alias("groups_sha256"))
    return joined_to_rows(keyed, of_texts, "key", "n").select(*out).unionByName(blank)
