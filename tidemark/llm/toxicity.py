"""Toxicity by averaged subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the mean of the embeddings of its hashed character n-grams, so a misspelling that training never saw shares most of its
vector with the word it hides. A text is the mean of its words, whole and of any length; a linear softmax over two class vectors and
their biases scores it. Embeddings, class vectors and biases are trained together, by gradient descent with momentum on the
class-balanced loss. Only n-grams that go with a class in the teaching texts have an embedding: the difference of the texts of either
class that hold the n-gram from what chance would give must reach `ASSOCIATION` standard deviations. The others stand in no vector
but count in the mean, so unknown words speak for neither class and dilute the ones that do.

Defined cases: null, empty and wordless texts are the zero vector, which the biases alone score; without labels of both classes every
score is 0. Repeated rows count as often as they come. Extra columns don't matter: only key and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import split_words, text_slices

ORDERS = (3, 4, 5, 6)
BUCKETS = 1 << 18
WIDTH = 8
ASSOCIATION = 3.0  # standard deviations
MAX_ROWS, MAX_BYTES = 6000, 8 << 20  # of training text, for each class


@dataclass(frozen=True)
class ToxicityModel:
    buckets: np.ndarray  # n-gram buckets that have an embedding
    embeddings: np.ndarray
    classes: np.ndarray  # a column for each class: clean, toxic
    bias: np.ndarray

    def margins(self) -> np.ndarray:
        """Of each bucket: how much it speaks for toxic rather than clean."""
        out = np.zeros(BUCKETS)
        out[self.buckets] = self.embeddings @ (self.classes[:, 1] - self.classes[:, 0])
        return out


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram buckets of all words, number in each word); word boundaries are characters, and short words are one n-gram."""
    marked = [f"<{w}>" for w in words]
    sizes = np.array([len(w) for w in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(codes))
    owner = np.repeat(np.arange(len(words)), sizes)
    hashes, owners = [], []
    for n in ORDERS:
        rolled = np.full(len(codes), n, np.uint64)
        fits = at + n <= ends
        for i in range(n):
            inside = max(0, len(codes) - i)
            rolled[:inside] = rolled[:inside] * np.uint64(0x100000001B3) + codes[i:]
        rolled ^= rolled >> np.uint64(29)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        hashes.append((rolled[fits] >> np.uint64(40)).astype(np.int64) % BUCKETS)
        owners.append(owner[fits])
    owner, flat = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owner, kind="stable")
    return flat[order], np.bincount(owner, minlength=len(words))


def _bag(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams of the distinct words, number in each word, text and word of each pair that occurs, share of the word in the text)."""
    words, flat, counts = split_words(text)
    grams, per_word = subwords(words)
    row = np.repeat(np.arange(len(counts)), counts)
    pairs, times = np.unique(row * max(1, len(words)) + flat, return_counts=True)
    row, word = pairs // max(1, len(words)), pairs % max(1, len(words))
    return grams, per_word, row, word, times / np.maximum(1, counts)[row]


def _logits(margins: np.ndarray, bias: float, grams: np.ndarray, per_word: np.ndarray, row: np.ndarray, word: np.ndarray, share: np.ndarray, rows: int) -> np.ndarray:
    """Toxic less clean, of each text."""
    owner = np.repeat(np.arange(len(per_word)), per_word)
    of_word = np.bincount(owner, weights=margins[grams], minlength=len(per_word)) / np.maximum(1, per_word)
    return np.bincount(row, weights=of_word[word] * share, minlength=rows) + bias


def score_texts(model: ToxicityModel, text: pa.Array, margins: np.ndarray | None = None) -> np.ndarray:
    """Probability of each text to be toxic."""
    logit = _logits(model.margins() if margins is None else margins, float(model.bias[1] - model.bias[0]), *_bag(text), len(text))
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def associated(grams: np.ndarray, per_word: np.ndarray, row: np.ndarray, word: np.ndarray, toxic: np.ndarray, least: float) -> np.ndarray:
    """Buckets whose document frequencies in the classes differ by `least` standard deviations from chance."""
    starts = np.cumsum(per_word) - per_word
    seen = np.zeros((2, BUCKETS))
    step = 64  # texts at once
    for low in range(0, len(toxic), step):
        a, b = np.searchsorted(row, [low, low + step])
        width = per_word[word[a:b]]
        at = np.repeat(starts[word[a:b]] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        pairs = np.unique(np.repeat(row[a:b], width) * BUCKETS + grams[at])
        for label in (0, 1):
            seen[label] += np.bincount(pairs[toxic[pairs // BUCKETS] == label] % BUCKETS, minlength=BUCKETS)
    share = toxic.mean()
    expected = seen.sum(axis=0) * share
    return np.flatnonzero(np.abs(seen[1] - expected) >= least * np.sqrt(expected * (1 - share) + 0.5))


def train(texts: list[str], labels: np.ndarray, epochs: int = 200, rate: float = 1.0, momentum: float = 0.9, decay: float = 1e-4, scale: float = 300.0, least: float = ASSOCIATION, seed: int = 5) -> ToxicityModel:
    """Joint steps on embeddings, class vectors and biases. Means of many words are small, so `scale` stands before them; the model
    carries it in its class vectors."""
    if len(set(labels.tolist())) < 2:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros((0, WIDTH)), np.zeros((WIDTH, 2)), np.array([500.0, -500.0]))
    grams, per_word, row, word, share = _bag(pa.array(texts, pa.large_string()).cast(pa.string()))
    kept = associated(grams, per_word, row, word, labels, least)
    place = np.full(BUCKETS, -1)
    place[kept] = np.arange(len(kept))
    owner = np.repeat(np.arange(len(per_word)), per_word)
    used = place[grams] >= 0
    gram, owner = place[grams][used], owner[used]
    weight = scale / np.maximum(1, per_word)[owner]
    y = labels.astype(float)
    each = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    start = np.random.default_rng(seed).normal(0, 1, WIDTH)
    start /= np.linalg.norm(start) * math.sqrt(2)
    params = {"e": np.zeros((len(kept), WIDTH)), "c": np.stack([-start, start], axis=1), "b": np.zeros(2)}
    speed = {k: np.zeros_like(v) for k, v in params.items()}
    for _ in range(epochs):
        margin = params["e"] @ (params["c"][:, 1] - params["c"][:, 0])
        of_word = np.bincount(owner, weights=margin[gram] * weight, minlength=len(per_word))
        logit = np.bincount(row, weights=of_word[word] * share, minlength=len(y)) + params["b"][1] - params["b"][0]
        slope = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y) * each  # of the toxic class; the clean one's is its opposite
        by_word = np.bincount(word, weights=slope[row] * share, minlength=len(per_word))
        by_gram = np.bincount(gram, weights=by_word[owner] * weight, minlength=len(kept))
        by_class = np.stack([-by_gram, by_gram], axis=1)
        slopes = {"e": by_class @ params["c"].T + decay * params["e"], "c": 0.01 * (params["e"].T @ by_class), "b": np.array([-slope.sum(), slope.sum()])}
        for k, g in slopes.items():
            speed[k] = momentum * speed[k] - rate * g
            params[k] = params[k] + speed[k]
    return ToxicityModel(kept, params["e"], params["c"] * scale, params["b"])


def sample(docs: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> tuple[list[str], np.ndarray]:
    """Whole texts and labels of a bounded sample: about max_rows rows and max_bytes bytes of either class, by a hash of the key."""
    marked = labels.select(F.col(label_key).alias("id"), F.col(label).alias("y")).where("y in (0, 1) and id is not null")
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("text is not null")
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 24))
    lengths = rows.select("id", F.octet_length("text").alias("bytes")).join(marked, "id")
    sizes = {r["y"]: (r["n"], r["bytes"]) for r in lengths.groupBy("y").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).collect()}
    limit = {y: math.ceil((1 << 24) * min(1.0, max_rows / n, max_bytes / max(1, size))) for y, (n, size) in sizes.items()}
    most = max(limit.values(), default=0)
    kept = F.lit(False)
    for y, below in limit.items():
        kept = kept | ((F.col("y") == y) & (place < below))
    # texts outside the larger share never meet the labels, so the join moves the sample alone
    picked = rows.where(place < most).join(marked.where(place < most), "id").where(kept).orderBy(place, "id", "text").select("text", "y").toArrow()
    return picked["text"].to_pylist(), picked["y"].to_numpy().astype(np.int64)


def _scorer(model: ToxicityModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = model.margins()
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score_texts(model, part.column("text"), margins))], names=["id", "score"])

    return run


def score(docs: DataFrame, key: str, text: str, model: ToxicityModel) -> DataFrame:
    """(id, score) of every row; one pass, no shuffle."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_scorer(model), f"id {rows.schema['id'].dataType.simpleString()}, score double")
