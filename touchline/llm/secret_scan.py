"""Secret scan: a keyword automaton first, anchored patterns only at its hits, checksums last.

Kinds, in the order of the result: ``assign`` (a named value of 8 characters or more), ``access`` (AKIA and 16
characters or more in all), ``hex`` (32 digits or more), and, because they carry a checksum that proves them,
``github`` and ``npm`` tokens. Matches of one kind are leftmost and do not overlap; one that is too short is
dropped after it was matched. Only ASCII letters have two cases. Spans count code points, the end exclusive, and
cover the whole match.

A null text counts as empty. Repeated rows are judged one by one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.arrays import chunks, code_points, row_of, spans, text_bytes

# The kinds, their key words, patterns and least lengths.
KINDS = ["assign", "access", "hex", "github", "npm"]
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm",
}
PATTERNS = {
    "assign": re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(rb"(AKIA[A-Z0-9]+)"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
}
LEAST = {"assign": 8, "access": 16, "hex": 32, "github": 36, "npm": 36}
DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

HEX = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))


@cache
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def checksum_holds(body: bytes) -> bool:
    """Whether the last six of 36 characters are the CRC-32 of the first thirty, in base 62."""
    value, out = zlib.crc32(body[:30]), bytearray()
    for _ in range(6):
        value, digit = divmod(value, 62)
        out.append(DIGITS[digit])
    return bytes(reversed(out)) == body[30:]


def valid(kind: str, match: re.Match) -> bool:
    value = match[1]
    return len(value) >= LEAST[kind] and (kind not in ("github", "npm") or checksum_holds(value))


def find(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """All spans of a chunk as (row, start, number of the kind, end) in bytes, sorted."""
    raw, out = data.tobytes(), []
    past = dict.fromkeys(PATTERNS, 0)
    for last, (size, kind) in automaton().iter(raw.lower().decode("latin-1")):
        start = last + 1 - size
        if start < past[kind]:
            continue
        row = int(np.searchsorted(offsets, start, "right")) - 1
        match = PATTERNS[kind].match(raw, start, int(offsets[row + 1]))
        if match:
            past[kind] = match.end()
            if valid(kind, match):
                out.append((row, start, KINDS.index(kind), match.end()))
    starts, ends, first = spans(HEX[data], offsets)
    rows, long = row_of(first), np.flatnonzero(ends - starts >= LEAST["hex"])
    out.extend(zip(rows[long].tolist(), starts[long].tolist(), [KINDS.index("hex")] * len(long), ends[long].tolist(), strict=True))
    return sorted(out)


def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        data, offsets = text_bytes(batch.column("text"))
        counts, listed, points = np.zeros((len(KINDS), batch.num_rows), np.int64), [[] for _ in range(batch.num_rows)], None
        for row, start, kind, end in find(data, offsets):
            points = code_points(data) if points is None else points
            zero = points[offsets[row]]
            counts[kind, row] += 1
            listed[row].append((kind, f"{KINDS[kind]}:{points[start] - zero}:{points[end] - zero}"))
        base = [hashlib.sha256(",".join(s for kind, s in found if kind < 3).encode()).hexdigest() for found in listed]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c) for c in counts[:3]], pa.array(base, pa.string()),
             pa.array([",".join(s for _, s in found) for found in listed], pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secret_spans(docs: DataFrame) -> DataFrame:
    """Counts and spans of the secrets of every document."""
    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def mask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        data, offsets = text_bytes(batch.column("text"))
        texts = batch.column("text").to_pylist()
        cuts: dict[int, list[tuple[int, int, int]]] = {}
        for row, start, kind, end in find(data, offsets):
            cuts.setdefault(row, []).append((start, end, kind))
        for row, found in cuts.items():
            raw, at, out = data[:offsets[row + 1]].tobytes(), int(offsets[row]), b""
            for start, end, kind in sorted(found):
                if end > at:
                    out += raw[at:max(start, at)] + (f"[{KINDS[kind]}]".encode() if start >= at else b"")
                    at = end
            texts[row] = (out + raw[at:]).decode()
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with each secret replaced by the name of its kind in brackets."""
    return docs.mapInArrow(mask, docs.schema)
