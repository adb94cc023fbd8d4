"""Nearest neighbours by block matrix join: int8 tiles with error bounds, then exact products in double.

Query vectors come in blocks of bounded size; each block meets all candidates, tile by tile. A vector is a scale times int8
components plus an error of known norm, so a tile of integer products (exact in float32 up to 1024 components, else float64) bounds every
inner product from both sides. A pair survives if its upper bound reaches the k-th best lower bound known for its query; only
survivors are computed in double, component by component, and go through a heap per query. Heaps of all tasks merge by rank.
The bounds are safe, so the result is exact. Of equal vectors only the k + 1 smallest ids can appear, so only they are compared.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, take no part; vectors of another
length than the query's are no candidates; null ids take no part; a repeated id is one candidate for each different vector, and never
its own neighbour. Fewer than k candidates give all. Only id and vector are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

QUERY_BLOCK = 16_384
TILE = 2048


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 components, scales, norms, norms of the errors)."""
    scale = np.abs(vectors).max(axis=1) / 127
    safe = np.where(scale > 0, scale, 1)  # components too small to divide become error
    small = np.rint(vectors / safe[:, None]).astype(np.int8)
    error = vectors - small * safe[:, None]
    up = 1 + 1e-12
    return small, safe, np.sqrt((vectors**2).sum(axis=1)) * up, np.sqrt((error**2).sum(axis=1)) * up


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double, summed from the first component to the last."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


class BlockSearch:
    """The k best candidates of a block of queries, over any number of tiles."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.small, self.scale, self.norm, self.error = quantised(vectors)
        self.kind = np.float32 if vectors.shape[1] <= 1024 else np.float64
        self.tile_of = self.small.astype(self.kind)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        small, scale, norm, error = quantised(vectors)
        for low in range(0, len(self.ids), TILE):
            rows = slice(low, low + TILE)
            product = (self.tile_of[rows] @ small.astype(self.kind).T).astype(np.float64) * (self.scale[rows, None] * scale[None, :])
            slack = self.norm[rows, None] * error[None, :] + self.error[rows, None] * (norm + error)[None, :]
            slack += 1e-9 * self.norm[rows, None] * norm[None, :]  # for the rounding of the bounds themselves
            own = self.ids[rows, None] == ids[None, :]
            floor = self.floor[rows]
            if len(ids) > self.k:
                least = np.where(own, -np.inf, product - slack)
                floor = np.maximum(floor, np.partition(least, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
            left, right = np.nonzero((product + slack >= floor[:, None]) & ~own)
            for start in range(0, len(left), 1 << 16):
                l, r = left[start : start + (1 << 16)] + low, right[start : start + (1 << 16)]
                for i, score, vec in zip(l.tolist(), exact(self.vectors[l], vectors[r]).tolist(), ids[r].tolist(), strict=True):
                    heap, item = self.heaps[i], (score, -vec)
                    if len(heap) < self.k:
                        heapq.heappush(heap, item)
                    elif item > heap[0]:
                        heapq.heapreplace(heap, item)
            for i in np.unique(left + low).tolist():
                if len(self.heaps[i]) == self.k:
                    self.floor[i] = self.heaps[i][0][0]

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = [len(h) for h in self.heaps]
        flat = [x for h in self.heaps for x in h]
        return np.repeat(self.ids, sizes), np.array([-x[1] for x in flat], np.int64), np.array([x[0] for x in flat])


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _searcher(ids: np.ndarray, vectors: np.ndarray, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = BlockSearch(ids, vectors, k)
        for batch in batches:
            for start in range(0, batch.num_rows, TILE):
                part = batch.slice(start, TILE)
                block.add(part.column("id").to_numpy(), _matrix(part.column("vector"), vectors.shape[1]))
        query, vec, score = block.results()
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), pa.array(score)], names=["query_id", "vec_id", "score"])

    return run


_FOUND = "query_id long, vec_id long, score double"


def nearest(rows: DataFrame, key: str, vector: str, queries: Column, k: int = 20, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every row for which `queries` holds with all other rows."""
    chosen = F.coalesce(queries, F.lit(False)).alias("chosen")
    base = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), chosen).where(F.col("id").isNotNull() & usable(F.col("vector")))
    asked = base.where("chosen").select("id", "vector").distinct()
    few = base.select("id", "vector").distinct().withColumn("copy", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("copy") <= k + 1).select("id", "vector")
    few = materialise(few, "candidates")
    asked = materialise(asked, "queries")
    found = rows.sparkSession.createDataFrame([], _FOUND)
    for width, n in sorted((r["width"], r["n"]) for r in asked.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n")).collect()):
        blocks = -(-n // block)
        same = few.where(F.size("vector") == width)
        for b in range(blocks):
            some = asked.where((F.size("vector") == width) & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)).toArrow()  # a block of bounded size
            if some.num_rows:
                ids, vectors = some["id"].to_numpy(), _matrix(some["vector"].combine_chunks(), width)
                found = found.unionByName(materialise(same.mapInArrow(_searcher(ids, vectors, k), _FOUND), "nearest"))  # the block can go
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
