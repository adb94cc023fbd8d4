"""Benchmark decontamination: rare n-gram seeds propose passages, Smith-Waterman alignment scores them.

A copy of an item of L words that lacks l of them and has x inserted ones is similar by (L - l) / (L + x). A lacking word destroys at
most n of the item's word n-grams, an inserted one n - 1; D is the most that a copy which reaches the similarity destroys. Hence any
D + 1 n-grams hold a survivor: the seeds are the rarest that many, by document frequency over the whole corpus. A passage around
a seed is aligned only if as many n-grams as must survive occur in it (both steps lose no match). Where no n-gram must survive, the
item takes shorter ones. The similarity of the best local alignment is matched words / (item words + inserted words).

Items come in blocks of bounded size; each block is one pass to count and one to align for each length of its n-grams. Items of
fewer than min_words words count where their exact word sequence stands: their similarity must be 1. Texts shorter than an alignment,
null or blank texts and null ids take no part. Repeated rows each give their own result;
an item's copies each give theirs. Empty tables give an empty result. Only ids and texts are read, so no other column can clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import empty_table, map_batches, materialise, split_words, text_slices

BLOCK = 20_000  # items whose n-grams a task holds at once
MATCH, MISMATCH, GAP = 2, -1, -1


@dataclass
class Items:
    """Test items as word numbers, with the sorted codes of their n-grams."""

    ids: list
    words: list[np.ndarray]
    vocabulary: list[str]
    n: int
    codes: np.ndarray  # sorted distinct n-gram codes
    owner: np.ndarray  # item of each occurrence, grouped by code
    place: np.ndarray  # position of each occurrence in its item
    first: np.ndarray  # where a code's occurrences begin; one more at the end
    need: np.ndarray  # n-grams of each item that must survive
    spare: np.ndarray  # words that an item may lose
    broken: np.ndarray  # n-grams that an item may lose
    least: np.ndarray  # similarity that counts
    seeds: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # owner and place of the seeds, grouped by code; where a code's begin

    def grams(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the code, place) of an item's n-grams, sorted by code."""
        codes = _codes(self.words[item], self.n)[: len(self.words[item]) - self.n + 1]
        index = np.searchsorted(self.codes, codes)
        order = np.argsort(index, kind="stable")
        return index[order], order


def _codes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes (63 bits) of the n-grams at every position; -1 where a word is unknown or the end is near. Two n-grams of one hash
    would only propose more passages; the alignment decides on the words."""
    out = np.full(len(words), -1, np.int64)
    if len(words) < n:
        return out
    m = len(words) - n + 1
    rolled, known = np.full(m, n, np.uint64), np.ones(m, bool)
    for i in range(n):
        rolled = (rolled ^ words[i : i + m].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
        known &= words[i : i + m] >= 0
    out[:m] = np.where(known, (rolled >> np.uint64(1)).astype(np.int64), -1)
    return out


def destroyed(size: int, n: int, similarity: float) -> int:
    """The most n-grams of an item of size words that a copy which reaches the similarity may lack."""
    least = similarity - 1e-9
    return max(n * math.floor(size - least * (size + x)) + (n - 1) * x for x in range(math.floor(size / least - size) + 1))


def _gram_size(size: int, n: int, similarity: float) -> int:
    """The largest size, up to n, of which every copy keeps an n-gram; of single words one stays always."""
    return next((k for k in range(min(n, size), 1, -1) if size - k + 1 > destroyed(size, k, similarity)), 1)


def prepare(rows: list, n: int, similarity: float, min_words: int) -> list[Items]:
    """Items from (id, text) rows, apart by the size of their n-grams."""
    vocab, flat, counts = split_words(pa.array([r[1] for r in rows], pa.string()))
    ends = np.cumsum(counts)
    least = np.where(counts < min_words, 1.0, similarity)
    by_size: dict[int, list[int]] = {}
    for i in np.flatnonzero(counts).tolist():
        by_size.setdefault(_gram_size(int(counts[i]), n, least[i]), []).append(i)
    return [_indexed([rows[i][0] for i in kept], [flat[ends[i] - counts[i] : ends[i]] for i in kept], vocab, k, least[kept]) for k, kept in sorted(by_size.items())]


def _indexed(ids: list, words: list[np.ndarray], vocab: list[str], n: int, least: np.ndarray) -> Items:
    grams = [_codes(w, n)[: len(w) - n + 1] for w in words]
    code = np.concatenate(grams) if grams else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(words)), [len(g) for g in grams])
    place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
    order = np.argsort(code, kind="stable")
    codes, first = np.unique(code[order], return_index=True)
    sizes = np.array([len(w) for w in words], np.int64)
    spare = np.floor((1 - least) * sizes + 1e-9).astype(np.int64)
    broken = np.array([destroyed(int(s), n, x) for s, x in zip(sizes, least, strict=True)], np.int64)
    return Items(ids, words, vocab, n, codes, owner[order], place[order], np.append(first, len(code)), np.maximum(1, sizes - n + 1 - broken), spare, broken, least)


def choose_seeds(items: Items, frequency: dict[int, int]) -> None:
    """Mark each item's rarest D + 1 n-grams; ties go to the earlier place."""
    freq = np.repeat([frequency.get(int(c), 0) for c in items.codes], np.diff(items.first)) if len(items.codes) else np.zeros(0, np.int64)
    order = np.lexsort((items.place, freq, items.owner))
    starts = np.searchsorted(items.owner[order], np.arange(len(items.ids)))
    rank = np.arange(len(order)) - starts[items.owner[order]]
    seed = np.zeros(len(order), bool)
    seed[order] = rank < items.broken[items.owner[order]] + 1
    items.seeds = items.owner[seed], items.place[seed], np.concatenate(([0], np.cumsum(seed)))[items.first]


def _numbered(text: pa.Array, vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(vocabulary number of each word or -1, words per row)."""
    words, flat, counts = split_words(text)
    known = pc.fill_null(pc.index_in(pa.array(words, pa.string()), pa.array(vocabulary, pa.string())), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return known[flat] if len(flat) else flat, counts


def _hits(numbers: np.ndarray, counts: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(positions of item n-grams in the words of all rows, index of each one's code); n-grams don't cross rows."""
    code = _codes(numbers, items.n)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(numbers))
    at = np.flatnonzero((code >= 0) & (left >= items.n))
    index = np.searchsorted(items.codes, code[at])
    found = index < len(items.codes)
    found[found] = items.codes[index[found]] == code[at][found]
    return at[found], index[found]


def _counter(items: Items) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(items.codes), np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                numbers, counts = _numbered(part.column("text"), items.vocabulary)
                at, index = _hits(numbers, counts, items)
                row = np.repeat(np.arange(len(counts)), counts)[at]
                pairs = np.unique(row * len(items.codes) + index)
                seen += np.bincount(pairs % max(1, len(items.codes)), minlength=len(items.codes))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(items.codes[some]), pa.array(seen[some])], names=["code", "docs"])

    return run


def align(item: np.ndarray, passages: list[np.ndarray]) -> list[tuple[int, int]]:
    """(matched words, inserted words) of the best Smith-Waterman alignment of the item with each passage.

    Scores are 2, -1, -1 for match, mismatch and gap; of equal scores the alignment with more matches and fewer insertions counts.
    The recurrence runs along anti-diagonals, for all passages at once.
    """
    width, rows, count = len(item), max(map(len, passages)), len(passages)
    text = np.full((count, rows), -2, np.int64)
    for i, p in enumerate(passages):
        text[i, : len(p)] = np.where(p < 0, -2, p)
    lengths = np.array([len(p) for p in passages])
    one = 1 << 20  # score, then matches, then fewer insertions, in one number
    score = one * one
    match, miss, skip, insert = MATCH * score + one, MISMATCH * score, GAP * score, GAP * score - 1
    best = np.zeros(count, np.int64)
    before, last = np.zeros((count, width + 1), np.int64), np.zeros((count, width + 1), np.int64)
    for d in range(2, width + rows + 1):  # cells (i of item, d - i of text)
        low, high = max(1, d - rows), min(width, d - 1)
        i = np.arange(low, high + 1)
        j = d - i
        same = text[:, j - 1] == item[i - 1]
        cell = np.where(same, match, miss) + before[:, i - 1]
        cell = np.maximum(np.maximum(cell, last[:, i - 1] + skip), last[:, i] + insert)
        cell = np.where(cell < score // 2, 0, cell)  # a score of 0 starts anew
        cell[j[None, :] > lengths[:, None]] = 0
        best = np.maximum(best, cell.max(axis=1))
        now = np.zeros((count, width + 1), np.int64)
        now[:, i] = cell
        before, last = last, now
    low20 = best & (one - 1)
    inserted = np.where(low20 >= one // 2, one - low20, 0)
    matches = ((best + inserted) >> 20) & (one - 1)
    return [(int(m), int(x)) for m, x in zip(matches, inserted, strict=True)]


def _occurrences(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, element) of every element of the ranges."""
    size = stop - first
    return np.repeat(np.arange(len(size)), size), np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _windows(at: np.ndarray, index: np.ndarray, row: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, first word, end) of the passages that a seed proposes and that hold enough of the item's n-grams. Only seeds are
    met with the items that they belong to; what else an item has in the row is looked up for the proposed items alone."""
    owners, places, begin = items.seeds
    hit, seed = _occurrences(begin[index], begin[index + 1])
    if not len(hit):
        return
    order = np.lexsort((at[hit], owners[seed], row[hit]))
    rows, item, start = row[hit][order], owners[seed][order], (at[hit] - places[seed])[order]
    cuts = np.flatnonzero((np.diff(rows) != 0) | (np.diff(item) != 0)) + 1
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for low, high in zip(np.append(0, cuts), np.append(cuts, len(rows)), strict=True):
        own = int(item[low])
        if own not in held:
            held[own] = items.grams(own)
        code, place_of = held[own]
        a, b = np.searchsorted(row, [rows[low], rows[low] + 1])  # hits come in order of place, so rows are together
        near, occurrence = _occurrences(np.searchsorted(code, index[a:b], "left"), np.searchsorted(code, index[a:b], "right"))
        if len(near) < items.need[own]:
            continue
        position, place = at[a:b][near], place_of[occurrence]
        size, slack = len(items.words[own]), int(items.spare[own]) * 2 + 2
        for begins, ends in _merged(start[low:high], slack):
            first, end = begins - slack, ends + size + slack
            inside = (position >= first) & (position < end)
            if len(np.unique(place[inside])) >= items.need[own]:
                yield int(rows[low]), own, int(first), int(end)


def _merged(starts: np.ndarray, slack: int) -> list[tuple[int, int]]:
    """Runs of near starts: where a copy of the item would begin."""
    out: list[tuple[int, int]] = []
    for s in np.unique(starts).tolist():
        if out and s - out[-1][1] <= slack:
            out[-1] = (out[-1][0], s)
        else:
            out.append((s, s))
    return out


def _aligner(items: Items) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                numbers, counts = _numbered(part.column("text"), items.vocabulary)
                ends = np.cumsum(counts)
                row = np.repeat(np.arange(len(counts)), counts)
                at, index = _hits(numbers, counts, items)
                proposed: dict[int, list[tuple[int, int, int]]] = {}
                for r, own, first, end in _windows(at, index, row[at] if len(at) else at, items):
                    proposed.setdefault(own, []).append((r, max(first, int(ends[r] - counts[r])), min(end, int(ends[r]))))
                best: dict[tuple[int, int], tuple[float, int, int]] = {}
                for own, spots in proposed.items():
                    size = len(items.words[own])
                    for low in range(0, len(spots), 512):
                        some = spots[low : low + 512]
                        for (r, first, end), (matched, inserted) in zip(some, align(items.words[own], [numbers[a:b] for _, a, b in some]), strict=True):
                            near = matched / (size + inserted)
                            if near >= items.least[own] - 1e-9:
                                best[r, own] = max(best.get((r, own), (0.0, 0, 0)), (near, -(first - int(ends[r] - counts[r])), end - first))
                if best:
                    keys = sorted(best)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(pa.array([r for r, _ in keys])), pa.array([items.ids[i] for _, i in keys]), pa.array([best[k][0] for k in keys]), pa.array([-best[k][1] for k in keys], pa.int64()), pa.array([best[k][2] for k in keys], pa.int64())],
                        names=["id", "item", "similarity", "first_word", "n_words"],
                    )

    return run


def leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, n: int = 3, similarity: float = 0.8, min_words: int = 5, block: int = BLOCK) -> DataFrame:
    """(id, item, similarity, first_word, n_words): every row and item whose alignment reaches the similarity; the passage is where
    the best alignment was found."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    tests = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null")
    kinds = f"id {rows.schema['id'].dataType.simpleString()}, item {tests.schema['item'].dataType.simpleString()}"
    schema = f"{kinds}, similarity double, first_word long, n_words long"
    found = empty_table(docs.sparkSession, schema)
    for some in _blocks(tests, block):
        for ready in prepare(some, n, similarity, min_words):
            counted = map_batches(rows, _counter(ready), "code long, docs long").groupBy("code").agg(F.sum("docs").alias("docs"))
            choose_seeds(ready, {r["code"]: r["docs"] for r in counted.collect()})  # a row for each n-gram of the block
            found = found.unionByName(materialise(map_batches(rows, _aligner(ready), schema), "leaks"))  # the block can go
    return found


def _blocks(tests: DataFrame, block: int) -> Iterator[list]:
    """The items in lists of bounded length, in order of id; the driver holds one list at a time."""
    held: list = []
    for r in tests.orderBy("item", "text").toLocalIterator():
        held.append((r["item"], r["text"]))
        if len(held) == block:
            yield held
            held = []
    if held:
        yield held
