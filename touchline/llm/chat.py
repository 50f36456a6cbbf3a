"""Chat formatting: conversations as one text with turn marks and a loss mask.

A turn becomes ``<|im_start|>role\\n text <|im_end|>\\n``. In texts and roles, ``<``, any backslashes and ``|`` get
one more backslash before the bar, so no text can hold a mark, and taking that backslash away restores it. The
bytes are laid out column by column: lengths of all segments, running offsets, then one scatter of headers,
contents and ends into one buffer, which becomes the Arrow column as it is.

The output is a table of pieces. A conversation is one piece unless it is longer than PIECE_BYTES or
lies in two partitions; a piece holds whole turns. So no conversation, however long, is put together in one task.
``loss`` lists the code points [start, end) of each assistant text in the piece.

A null text counts as empty, as does a null role; a null conv_id is one conversation of its own; turns of one
number are ordered by role and text. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.arrays import binary_array, chunks, code_points, text_bytes, within
from touchline.llm.tables import written

RANGE_CHARS = 64  # of a text that tell turns of one number apart when a conversation is split

# The marks of the template and the role that is learned.
START, END, LEARNED = "<|im_start|>", "<|im_end|>", "assistant"
PIECE_BYTES = 1_000_000
ESCAPED = re.compile(r"<(\\*)\\\|")
BAR, LESS, BACK = 0x7C, 0x3C, 0x5C
PIECES = "conv_id long, first_turn long, piece long, n_turns long, text string, loss array<struct<start:long,end:long>>"


def bars_to_escape(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of the bars that follow ``<`` and any backslashes within their row."""
    bars = np.flatnonzero(data == BAR)
    heads = offsets[np.searchsorted(offsets, bars, "right") - 1]
    at = bars - 1
    while (back := np.flatnonzero((at >= heads) & (data[np.maximum(at, 0)] == BACK))).size:
        at[back] -= 1
    return bars[(at >= heads) & (data[np.maximum(at, 0)] == LESS)]


def escape(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bars = bars_to_escape(data, offsets)
    if not len(bars):
        return data, offsets
    return np.insert(data, bars, BACK), offsets + np.searchsorted(bars, offsets)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy the rows of a byte column to the places ``at`` of the buffer."""
    sizes = np.diff(offsets)
    out[within(at, sizes)] = data[offsets[0]:offsets[-1]]


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The buffer of all formatted turns, their offsets, and where the text of each begins and ends."""
    role, role_at = escape(*text_bytes(roles))
    text, text_at = escape(*text_bytes(texts))
    head, tail = (np.frombuffer(s.encode(), np.uint8) for s in (START, END + "\n"))
    role_sizes, text_sizes = np.diff(role_at), np.diff(text_at)
    offsets = np.zeros(len(role_at), np.int64)
    np.cumsum(len(head) + role_sizes + 1 + text_sizes + len(tail), out=offsets[1:])
    out = np.empty(offsets[-1], np.uint8)
    out[(offsets[:-1, None] + np.arange(len(head))).ravel()] = np.tile(head, len(role_sizes))
    scatter(out, offsets[:-1] + len(head), role, role_at)
    begin = offsets[:-1] + len(head) + role_sizes + 1
    out[begin - 1] = 0x0A
    scatter(out, begin, text, text_at)
    out[(offsets[1:, None] - len(tail) + np.arange(len(tail))).ravel()] = np.tile(tail, len(role_sizes))
    return out, offsets, begin, begin + text_sizes


def format_turns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to pieces. A piece ends with its conversation, its chunk or PIECE_BYTES."""
    for number, batch in enumerate(chunks(batches)):
        out, offsets, begin, end = assemble(batch.column("role"), batch.column("text"))
        ids = batch.column("conv_id")
        convs, heads, size = ids.to_pylist(), [], 0
        for i, grown in enumerate(np.diff(offsets)):
            if i == 0 or convs[i] != convs[i - 1] or size + grown > PIECE_BYTES:
                heads.append(i)
                size = 0
            size += grown
        heads = np.array(heads, np.int64)
        stops = np.append(heads[1:], batch.num_rows)
        points = code_points(out)
        learned = np.array([r == LEARNED for r in batch.column("role").to_pylist()], bool)
        piece_of = np.repeat(np.arange(len(heads)), stops - heads)[learned]
        zero = points[offsets[heads]][piece_of]
        loss = pa.StructArray.from_arrays([pa.array(points[begin[learned]] - zero), pa.array(points[end[learned]] - zero)], ["start", "end"])
        bounds = np.searchsorted(piece_of, np.arange(len(heads) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(heads)), batch.column("turn").take(pa.array(heads)),
             pa.array(np.arange(len(heads), dtype=np.int64) + (number << 32)), pa.array(stops - heads),
             binary_array(out, offsets[np.append(heads, batch.num_rows)], pa.string()),
             pa.ListArray.from_arrays(pa.array(bounds), loss)],
            ["conv_id", "first_turn", "piece", "n_turns", "text", "loss"])


def formatted(turns: DataFrame) -> DataFrame:
    """The written pieces (conv_id, part, piece, ...) of conversations (conv_id, turn, role, text), in order of
    part and piece within a conversation."""
    order = ["conv_id", "turn", "role", "text"]
    # Texts that begin alike stay together, so partitions follow each other as the rows in them do.
    ranges = ["conv_id", "turn", "role", F.substring("text", 1, RANGE_CHARS)]
    rows = turns.select(*order).repartitionByRange(*ranges).sortWithinPartitions(*order)
    pieces = rows.mapInArrow(format_turns, PIECES)
    return written(pieces.select("conv_id", F.spark_partition_id().alias("part"), "piece", "n_turns", "text", "loss"))


def parse(text: str) -> Iterator[tuple[str, str]]:
    """The (role, text) of each turn of a formatted piece."""
    at = 0
    while at < len(text):
        line, stop = text.index("\n", at), text.index(END, at)
        yield unescape(text[at + len(START):line]), unescape(text[line + 1:stop])
        at = stop + len(END) + 1


class Digest:
    """What one conversation reads back as; a conversation may come in many pieces."""

    def __init__(self, conv) -> None:
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.said, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, loss: list[dict]) -> None:
        for role, said in parse(text):
            self.turns += 1
            self.said.update(f"{role}\n{said}\n".encode())
        for span in loss:
            said = unescape(text[span["start"]:span["end"]])
            self.loss_chars += len(said)
            self.learned.update(said.encode())
        self.chars += len(text)

    def row(self) -> dict:
        return {"conv_id": self.conv, "n_turns": self.turns, "turns_sha256": self.said.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.learned.hexdigest(), "formatted_chars": self.chars}


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
DIGEST_TYPES = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                          ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from their pieces in order; only one conversation's state is held."""
    now = None
    for batch in batches:
        rows = []
        for conv, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss")), strict=True):
            if now is None or now.conv != conv:
                if now is not None:
                    rows.append(now.row())
                now = Digest(conv)
            now.add(text, loss)
        yield pa.RecordBatch.from_pylist(rows, DIGEST_TYPES)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], DIGEST_TYPES)


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted pieces. A hash runs over a conversation in order, so
    its pieces pass through one task, one piece at a time."""
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return ordered.select("conv_id", "text", "loss").mapInArrow(read_back, DIGESTS)
