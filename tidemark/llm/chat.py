"""Chat formatting by columnar byte assembly.

Every turn becomes a segment `[INST]role[/INST]text</s>`; a conversation is `<s>` and its segments in order. For a batch, numpy
computes the pieces' lengths, cumulative offsets and scatter indices, and all pieces are copied into one preallocated Arrow buffer,
whose offsets are the result's; nothing is concatenated row by row, and no segment needs its neighbours, so a conversation of any
length is formatted in parallel. The pass over the sorted segments puts `<s>` into the buffer before each conversation's first.

Escaping is reversible: a backslash is doubled, and a control string gets one after its first character; so an escaped text holds
no control string, and dropping each backslash before its character gives the text back.

Defined cases: null roles and texts are empty; null conversations are one conversation without id; null turns come first; turns
that tie are ordered by role, then segment, and repeated rows all stay. Only the four columns are read; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices

# fixed values: the control strings of the template
START, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = (START, END, OPEN, CLOSE)
STEP = 1 << 20  # bytes that one scatter moves
TRAINED = "assistant"
_SEGMENT = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(CLOSE) + "(.*?)" + re.escape(END), re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: pa.Array) -> pa.Array:
    out = pc.replace_substring(pc.fill_null(text, ""), "\\", "\\\\")
    for word in CONTROL:
        out = pc.replace_substring(out, word, f"{word[0]}\\{word[1:]}")
    return out


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return at, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def _copy(out: np.ndarray, starts: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> None:
    """Scatter every value of a column to its place in the buffer. Index arrays cover STEP bytes at most; a longer value is one run."""
    sizes, first = np.diff(offsets), 0
    ends = np.cumsum(sizes)
    while first < len(sizes):
        base = ends[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, base + STEP, side="right")))
        if sizes[first] > STEP:
            out[starts[first] : starts[first] + sizes[first]] = data[offsets[first] : offsets[first + 1]]
        else:
            some = sizes[first:stop]
            within = np.arange(int(some.sum())) - np.repeat(np.cumsum(some) - some, some)
            out[np.repeat(starts[first:stop], some) + within] = data[np.repeat(offsets[first:stop], some) + within]
        first = stop


def assemble(role: pa.Array, text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(segments, first byte of each text in its segment, bytes of each text)."""
    heads = [np.frombuffer(x.encode(), np.uint8) for x in (OPEN, CLOSE, END)]
    (role_at, roles), (text_at, texts) = _bytes(escape(role)), _bytes(escape(text))
    role_size, text_size = np.diff(role_at), np.diff(text_at)
    before_text = len(heads[0]) + role_size + len(heads[1])
    lengths = before_text + text_size + len(heads[2])
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    buffer = pa.allocate_buffer(int(offsets[-1]), resizable=False)
    out = np.asarray(memoryview(buffer)).view(np.uint8) if buffer.size else np.zeros(0, np.uint8)
    starts = offsets[:-1]
    for mark, at in zip(heads, (starts, starts + len(heads[0]) + role_size, starts + before_text + text_size), strict=True):
        out[at[:, None] + np.arange(len(mark))] = mark
    _copy(out, starts + len(heads[0]), role_at, roles)
    _copy(out, starts + before_text, text_at, texts)
    segments = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), buffer])
    return segments.cast(pa.string()), before_text, text_size


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            made, at, size = assemble(part.column("role"), part.column("text"))
            trained = pc.fill_null(pc.equal(part.column("role"), TRAINED), False).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [part.column("conv"), part.column("turn"), part.column("role"), made, pa.array(np.where(trained, at, 0)), pa.array(np.where(trained, size, 0))],
                names=["conv", "turn", "role", "segment", "loss_start", "loss_bytes"],
            )


def format_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, segment, loss_start, loss_bytes) for every turn: its formatted bytes, and which of them are trained on
    (byte offsets in the segment; none for other roles)."""
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    kinds = rows.schema
    return rows.mapInArrow(_segments, f"conv {kinds['conv'].dataType.simpleString()}, turn {kinds['turn'].dataType.simpleString()}, role string, segment string, loss_start bigint, loss_bytes bigint")


def parse(segment: str) -> list[tuple[str, str]]:
    """(role, text) of every turn in formatted text; raises if anything else is there."""
    found = list(_SEGMENT.finditer(segment))
    if sum(m.end() - m.start() for m in found) != len(segment):
        raise ValueError("not a formatted segment")
    return [(unescape(m[1]), unescape(m[2])) for m in found]


def _begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted segments, each conversation's first with the start marker in front."""
    last: object = _read_back  # equal to no conversation
    for batch in batches:
        convs = batch.column("conv").to_pylist()
        first = np.array([a != b for a, b in zip([last, *convs], convs)], bool)
        last = convs[-1] if convs else last
        marked = pc.binary_join_element_wise(pa.array(np.where(first, START, "").tolist(), pa.string()), batch.column("segment"), "")
        start = batch.column("loss_start").to_numpy(zero_copy_only=False)
        moved = pa.array(start + np.where(first & (start > 0), len(START), 0), pa.int64())  # a trained text begins after its role
        yield pa.RecordBatch.from_arrays([batch.column("conv"), marked, moved, batch.column("loss_bytes")], names=["conv", "segment", "loss_start", "loss_bytes"])


def conversations(segments: DataFrame) -> DataFrame:
    """(conv, segment, loss_start, loss_bytes) in order: joined, the segments of a conversation are its formatted text, marker included."""
    kind = segments.schema["conv"].dataType.simpleString()
    ordered = segments.repartition("conv").sortWithinPartitions("conv", "turn", "role", "segment").select("conv", "segment", "loss_start", "loss_bytes")
    return ordered.mapInArrow(_begin, f"conv {kind}, segment string, loss_start bigint, loss_bytes bigint")


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of sorted segments; one conversation is open at a time, whatever its length."""
    state: dict | None = None
    done: list[dict] = []
    kinds = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    schema = pa.schema([("conv", pa.null()), *kinds])

    def close() -> None:
        if state:
            done.append({k: v.hexdigest() if k.endswith("sha256") else v for k, v in state.items()})

    for batch in batches:
        schema = pa.schema([("conv", batch.schema.field("conv").type), *kinds])
        for conv, segment, start, size in zip(*(batch.column(c).to_pylist() for c in ("conv", "segment", "loss_start", "loss_bytes")), strict=True):
            if state is None or state["conv"] != conv:
                close()
                state = {"conv": conv, "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0, "loss_sha256": hashlib.sha256(), "formatted_chars": 0}
                if not segment.startswith(START):
                    raise ValueError("a conversation without its start marker")
                turns = segment[len(START) :]
            else:
                turns = segment
            for role, text in parse(turns):
                state["n_turns"] += 1
                state["turns_sha256"].update(f"{role}\n{text}\n".encode())
            loss = unescape(segment.encode()[start : start + size].decode())
            state["loss_chars"] += len(loss)
            state["loss_sha256"].update(loss.encode())
            state["formatted_chars"] += len(segment)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
    close()
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=schema)


def read_back(segments: DataFrame) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), parsed from the formatted text of each conversation."""
    kind = segments.schema["conv"].dataType.simpleString()
    return conversations(segments).mapInArrow(_read_back, f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
