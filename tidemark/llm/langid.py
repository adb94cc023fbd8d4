"""Language identification by word-first backoff.

A known word adds its log frequency in each language. An unseen word falls back to its character 4-grams, then 3-, 2- and
1-grams: the longest order of which at least one n-gram is known is averaged. A row's language is the one with the largest sum.

Defined cases: null text, or text without a letter, gives `und` with score 0; a row whose words and characters are all unknown
gets equal posteriors and the first language by name; without any training row every answer is `und`. Ties go to the first
language by name. Null labels teach nothing. Extra columns pass through; input columns named like the outputs are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import map_batches, split_words, text_slices

ORDERS = (4, 3, 2, 1)
UND = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Sorted token hashes and log frequencies by language, for words (order 0) and the character n-grams of each order."""

    languages: list[str]
    keys: dict[int, np.ndarray]
    logs: dict[int, np.ndarray]

    def rows(self, order: int, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash in the order's table; -1 if unknown."""
        known = self.keys[order]
        at = np.searchsorted(known, hashes)
        return np.where(known[np.minimum(at, len(known) - 1)] == hashes, at, -1) if len(known) else np.full(len(hashes), -1)


def hashed(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64).view(np.int64)


def ngrams(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the character n-grams of all words, number in each word); above single characters a word's ends are characters."""
    marked = [f"^{w}$" for w in words] if n > 1 else words
    sizes = np.array([len(w) for w in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.arange(len(codes))
    fits = starts + n <= np.repeat(np.cumsum(sizes), sizes)
    rolled = np.full(len(codes), n, np.uint64)
    for i in range(n):
        inside = max(0, len(codes) - i)
        rolled[:inside] = (rolled[:inside] ^ codes[i:]) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
    return rolled[fits].view(np.int64), np.maximum(0, sizes - n + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            langs = part.column("lang").to_pylist()
            words, flat, counts = split_words(part.column("text"))
            owner = np.repeat(np.arange(len(langs)), counts)
            for lang in sorted(set(langs)):
                mine = np.array([x == lang for x in langs])
                seen = np.bincount(flat[mine[owner]], minlength=len(words))
                own = np.flatnonzero(seen)
                some = [words[i] for i in own]
                for n in (0, *ORDERS):
                    keys, widths = (hashed(some), np.ones(len(some), np.int64)) if n == 0 else ngrams(some, n)
                    tokens, at = np.unique(keys, return_inverse=True)
                    hits = np.bincount(at, weights=np.repeat(seen[own], widths), minlength=len(tokens)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(tokens), pa.string()), pa.array(np.full(len(tokens), n), pa.int32()), pa.array(tokens), pa.array(hits)], names=["lang", "n", "token", "hits"])


def train(rows: DataFrame, text: str, lang: str, key: str, max_rows: int = 12_000, max_bytes: int = 32 << 20, smoothing: float = 0.5) -> LanguageModel:
    """Fit on every token of a bounded sample: about max_rows labelled rows and max_bytes bytes of text, chosen by a hash of the key."""
    known = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(key).cast("string")).alias("h")).where("lang is not null and text is not null")
    size = known.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    share = min(1.0, max_rows / max(1, size["n"]), max_bytes / max(1, size["bytes"] or 0))
    if share < 1:
        known = known.where(F.pmod("h", F.lit(1 << 20)) < math.ceil((1 << 20) * share))
    counted = map_batches(known.select("text", "lang"), _count, "lang string, n int, token long, hits long").groupBy("lang", "n", "token").agg(F.sum("hits").alias("hits")).toArrow()
    languages = sorted(set(pc.unique(counted["lang"]).to_pylist()))
    of_lang = pc.index_in(counted["lang"], pa.array(languages, pa.string())).to_numpy()
    order, token, hits = (counted[c].to_numpy() for c in ("n", "token", "hits"))
    keys, logs = {}, {}
    for n in (0, *ORDERS):
        mine = order == n
        keys[n], at = np.unique(token[mine], return_inverse=True)
        table = np.zeros((len(keys[n]), len(languages)))
        table[at, of_lang[mine]] = hits[mine]
        logs[n] = np.log((table + smoothing) / (table.sum(axis=0) + smoothing * (len(table) + 1))).astype(np.float32)
    return LanguageModel(languages, keys, logs)


def word_scores(model: LanguageModel, words: list[str]) -> np.ndarray:
    """Log frequencies by language of each word: its own if it is known, else the mean of its longest known n-grams."""
    table = np.zeros((len(words), len(model.languages)))
    at = model.rows(0, hashed(words))
    table[at >= 0] = model.logs[0][at[at >= 0]]
    left = np.flatnonzero(at < 0)
    for n in ORDERS:
        grams, widths = ngrams([words[i] for i in left], n)
        row = model.rows(n, grams)
        owner = np.repeat(np.arange(len(left)), widths)[row >= 0]
        found = np.bincount(owner, minlength=len(left))
        for j in range(len(model.languages)):
            sums = np.bincount(owner, weights=model.logs[n][row[row >= 0], j], minlength=len(left))
            table[left, j] = sums / np.maximum(1, found)
        left = left[found == 0]
    return table


def score_texts(model: LanguageModel, text: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and posterior of each text."""
    if not model.languages:
        return [UND] * len(text), np.zeros(len(text))
    words, flat, counts = split_words(text)
    table = word_scores(model, words)
    owner = np.repeat(np.arange(len(text)), counts)
    sums = np.stack([np.bincount(owner, weights=table[flat, j], minlength=len(text)) for j in range(len(model.languages))], axis=1)
    letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    odds = np.exp(sums - sums.max(axis=1, keepdims=True))
    best = np.argmax(sums, axis=1)
    posterior = np.where(letters, (odds / odds.sum(axis=1, keepdims=True))[np.arange(len(text)), best], 0.0)
    return [model.languages[j] if ok else UND for j, ok in zip(best, letters, strict=True)], posterior


def _scorer(model: LanguageModel, text: str, kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                langs, scores = score_texts(model, part.column(text))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), pa.array(langs, pa.string()), pa.array(scores)], names=[*kept, "lang_pred", "score"])

    return run


def identify(rows: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """rows (or only the columns in keep) with lang_pred and score; one pass, no shuffle."""
    kept = [c for c in (rows.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    base = rows.select(*dict.fromkeys([*kept, text]))
    schema = T.StructType([*(base.schema[c] for c in kept), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_batches(base, _scorer(model, text, kept), schema)


def held_out(key: Column) -> Column:
    """True for the third of the rows that never teach: crc32 of the key as text, modulo 3, is 1. A null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))
