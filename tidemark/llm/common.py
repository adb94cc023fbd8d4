"""What the corpus operators share: word splitting and group streaming over Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.storage import discard, fresh_path, materialise, shared_dir  # noqa: F401

SLICE_BYTES = 4 << 20  # text that one vectorised step holds at once; its words and hashes take about 40 times as much


def release() -> None:
    """Give freed memory back to the system: Arrow's pool and the C library both keep it, as long as the process lives."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not the GNU C library
        pass


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow(run, schema), after which the worker, which Spark keeps for other tasks, holds nothing of this one."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(released, schema)


def empty_table(spark: SparkSession, columns: str) -> DataFrame:
    """No rows of these columns; unlike createDataFrame([]) it starts no Python worker."""
    return spark.range(0).select(F.lit(None).cast(f"struct<{columns}>").alias("row")).select("row.*")


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about limit bytes of the column, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def split_words(text: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lower-cased runs of letters, marks and digits: (distinct words, word number of each word in order, words per row).

    Null and blank rows have none. Only distinct blank-separated tokens meet the regular expression.
    """
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(text, "")))
    per_row = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    tokens = coded.indices.to_numpy(zero_copy_only=False)
    cleaned = pc.utf8_split_whitespace(pc.replace_substring_regex(coded.dictionary, pattern=r"[^\p{L}\p{M}\p{N}]+", replacement=" "))
    parts, widths = cleaned.flatten(), cleaned.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    kept = pc.not_equal(parts, "").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(widths)), widths)[kept]
    words = parts.filter(pa.array(kept)).dictionary_encode()
    of_part = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    widths = np.bincount(owner, minlength=len(widths)).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(widths)))
    width = widths[tokens] if len(tokens) else np.zeros(0, np.int64)
    first = np.repeat(starts[tokens] if len(tokens) else np.zeros(0, np.int64), width)
    begins = np.cumsum(width) - width
    within = np.arange(int(width.sum()), dtype=np.int64) - np.repeat(begins, width)
    flat = of_part[first + within] if len(first) else np.zeros(0, np.int64)
    totals = np.concatenate(([0], np.cumsum(width)))
    ends = np.cumsum(per_row)
    counts = totals[ends] - totals[ends - per_row]
    out = words.dictionary.to_pylist(), flat, counts
    del lists, coded, tokens, cleaned, parts, words, of_part
    pa.default_memory_pool().release_unused()  # else what the split took stays beside what the caller makes of the words
    return out


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, as tables; rows must come sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            col = batch.column(key)
            differs = pc.not_equal(col.slice(1), col.slice(0, len(col) - 1))
            change[1:] |= pc.fill_null(differs, True).to_numpy(zero_copy_only=False)
        head = tuple(batch.column(k)[0].as_py() for k in keys)
        cuts = np.flatnonzero(change)
        if held and head != last:
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, stop in zip(edges[:-1], edges[1:], strict=True):
            if start and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
    if held:
        yield pa.Table.from_batches(held)
