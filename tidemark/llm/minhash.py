"""Jaccard join on word n-grams by MinHash banding.

Every text becomes the set of its word 5-grams (a text of one to four words is one gram). Texts with equal sets form one node, so
copies are never paired. Nodes that share a band hash are candidates: a star to the smallest node of each bucket joins them. A
component of candidates is one block, or, beyond BLOCK nodes, several: nodes that hang on the same smallest lead go together, and a
lead with many nodes is split. Blocks that share a band meet, and are verified on full sets inside tasks that hold two blocks.
A task returns link counts and a spanning forest of the verified links, never the pairs. Exact counts of links inside a group of m
different texts that all share a band take (m / BLOCK) ** 2 / 2 such tasks; blocks without a common band never meet.

Bands and rows come from the target recall: the fewest false candidates under the budget of hash functions.

Defined cases: null or wordless texts and rows without an id have no links; their class is their own id. Rows that repeat an id and
text are one node, each a link of the other. Empty tables give empty results. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, empty_table, groups, map_batches, materialise, split_words, text_slices
from tidemark.llm.components import SMALL, components

BLOCK = 256  # sets on either side of a verification task
HASHES = 256  # budget of hash functions
_MIX = np.uint64(0x9E3779B97F4A7C15)


def banding(threshold: float, recall: float = 0.999, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): at the threshold a pair shares a band with probability recall; of these, the fewest candidates at half of it."""
    best = None
    for rows in range(1, 33):
        for bands in range(1, hashes // rows + 1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                false = 1 - (1 - (threshold / 2) ** rows) ** bands
                best = min(best or (false, bands, rows), (false, bands, rows))
                break
    if best is None:
        raise ValueError("no banding reaches that recall within the budget of hash functions")
    return best[1], best[2]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the word n-grams of all rows, number in each row); a row of fewer words has one gram."""
    words, flat, counts = split_words(text)
    coded = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)[flat] if len(flat) else np.zeros(0, np.uint64)
    ends = np.cumsum(counts)
    starts = ends - counts
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    first = np.repeat(starts - (np.cumsum(made) - made), made) + np.arange(int(made.sum()))
    length = np.minimum(np.repeat(counts, made), n)
    rolled = length.astype(np.uint64)
    for i in range(n):
        there = i < length
        at = np.where(there, first + i, 0)
        rolled = np.where(there, rolled * _MIX + (coded[at] if len(coded) else 0), rolled)
    return _mixed(rolled), made


def _signer(n: int, bands: int, rows: int, seed: int = 7) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    rng = np.random.default_rng(seed)
    mult = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                grams, made = shingles(part.column("text"), n)
                at = np.flatnonzero(made)
                ends = np.cumsum(made)
                starts = (ends - made)[at]
                lows = np.empty((len(at), bands * rows), np.uint64)
                step = 0
                while step < len(at):  # rows of about 32k grams at once stay in cache
                    stop = max(step + 1, int(np.searchsorted(starts, starts[step] + 32768)))
                    some, cut = grams[starts[step] : ends[at[stop - 1]]], starts[step:stop] - starts[step]
                    for k in range(bands * rows):
                        lows[step:stop, k] = np.minimum.reduceat(some * mult[k] + add[k], cut)
                    step = stop
                sums = np.zeros((len(at), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
                for r in range(rows):
                    sums = _mixed(sums * _MIX + lows[:, r::rows][:, :bands])
                keys, sizes = [], []
                for i in at:
                    own = np.unique(grams[ends[i] - made[i] : ends[i]])
                    keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                    sizes.append(len(own))
                flat = pa.array(sums.view(np.int64).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * bands), flat)
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(at)), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), lists], names=["id", "node", "size", "bands"])

    return run


def _setter(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                grams, made = shingles(part.column("text"), n)
                ends = np.cumsum(made)
                sets = [np.unique(grams[e - m : e]).tobytes() for e, m in zip(ends, made, strict=True)]
                same = np.array([xxhash.xxh3_128_digest(s) == k for s, k in zip(sets, part.column("node").to_pylist(), strict=True)], bool)
                out = pa.RecordBatch.from_arrays([part.column("node"), part.column("comp"), part.column("copies"), part.column("own"), pa.array(sets, pa.binary())], names=["node", "comp", "copies", "own", "grams"])
                yield out.filter(pa.array(same))

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets of distinct hashes; grams in one set only are left out of the product."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, gram, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen[gram] > 1
    owner, gram = owner[shared], np.unique(gram[shared], return_inverse=True)[1]
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    width = 4096
    for low in range(0, int(gram[-1]) + 1 if len(gram) else 0, width):
        a, b = np.searchsorted(gram, [low, low + width])
        present = np.zeros((len(sets), width), np.float32)
        present[owner[a:b], gram[a:b] - low] = 1
        both += present @ present.T
    return both.astype(np.int64)


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric link matrix."""
    left, out = set(range(len(linked))), []
    while left:
        todo = [left.pop()]
        while todo and left:
            u = todo.pop()
            for v in [v for v in np.flatnonzero(linked[u]).tolist() if v in left]:
                left.discard(v)
                out.append((u, v))
                todo.append(v)
    return out


def _across(within: np.ndarray, between: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join the components of either block across the blocks: what is joined within them is known elsewhere."""
    root = np.arange(len(within))
    for u, v in _forest(within):  # a tree is listed from its root on
        root[v] = root[u]
    joined = np.zeros_like(between)
    u, v = np.nonzero(between)
    joined[root[u], root[v]] = True
    return _forest(joined)


def _verifier(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        for block in groups(batches, ["comp", "lo", "hi"]):
            if block.num_rows > 1:
                nodes, own = block["node"].to_pylist(), block["own"].to_numpy()
                copies = block["copies"].to_numpy()
                sets = [np.frombuffer(s, np.uint64) for s in block["grams"].to_pylist()]
                sizes = np.array([len(s) for s in sets])
                both = overlaps(sets)
                linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
                np.fill_diagonal(linked, False)
                edges = _forest(linked)
                if block["lo"][0].as_py() != block["hi"][0].as_py():  # pairs within a block have a task of their own
                    same = own[:, None] == own[None, :]
                    edges = _across(linked & same, linked & ~same)
                    linked &= ~same
                counts = linked @ copies
                rows = [(nodes[i], None, int(counts[i])) for i in np.flatnonzero(counts).tolist()] + [(nodes[u], nodes[v], 0) for u, v in edges]
                for held, values in zip(out, zip(*rows, strict=True), strict=False):
                    held.extend(values)
            if len(out[0]) > 5000:
                yield _links(out)
                out = ([], [], [])
        if out[0]:
            yield _links(out)

    return run


def _links(out: tuple[list, list, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64())], names=["node", "other", "links"])


def jaccard_classes(docs: DataFrame, key: str, text: str, n: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """(id, class_id, n_links) for every row: the smallest id among the texts linked to it, directly or by a chain, and the number
    of other rows whose sets have a Jaccard similarity of the threshold or more with its own."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    bands, per_band = banding(threshold, recall)
    known = rows.where("id is not null and text is not null")
    signed = materialise(map_batches(known, _signer(n, bands, per_band), f"id {rows.schema['id'].dataType.simpleString()}, node binary, size int, bands array<bigint>"), "signed")
    # one row for each node from here on, however many copies it has
    nodes = materialise(signed.groupBy("node").agg(F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first("bands").alias("bands")), "nodes")

    # candidates: a star in each bucket
    hashed = nodes.select("node", F.explode("bands").alias("band"))
    buckets = hashed.groupBy("band").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead <> last").select("band", "lead")
    stars = hashed.join(buckets, "band").where("node <> lead").select("node", "lead").distinct()
    # each node hangs on the smallest of its leads, and its other leads on that one: few leads make few distinct pairs
    hung = materialise(stars.withColumn("least", F.min("lead").over(Window.partitionBy("node"))), "hung")  # a row for each band at most
    candidates = components(hung.select("node", "least").union(hung.select("lead", "least")).distinct(), "node", "least")
    members, meets = _blocks(candidates, hung.select("node", "least").distinct(), nodes)

    # every node meets the blocks that share a band with its own
    found = members.join(nodes.select("node", "copies", "first_id"), "node")
    texts = found.join(rows, found["first_id"] == rows["id"]).select("node", "comp", "copies", "own", "text")
    sets = map_batches(texts, _setter(n), "node binary, comp binary, copies bigint, own int, grams binary").dropDuplicates(["node"])
    meets = materialise(meets, "meets")
    pairs = meets.select("comp", F.col("a").alias("own"), F.col("b").alias("met")).union(meets.where("a <> b").select("comp", "b", "a"))
    few = meets.count() <= SMALL
    met = sets.join(F.broadcast(pairs) if few else pairs, ["comp", "own"], "left").withColumn("met", F.coalesce("met", "own"))
    dealt = met.select("comp", F.least("own", "met").alias("lo"), F.greatest("own", "met").alias("hi"), "own", "node", "copies", "grams")
    together = dealt.repartition("comp", "lo", "hi").sortWithinPartitions("comp", "lo", "hi")
    verified = materialise(map_batches(together, _verifier(threshold), "node binary, other binary, links bigint"), "links")
    discard(hung)
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    # the vertices of the components are (smallest id, node), so that a component's label carries its class id
    named = nodes.select("node", F.struct("first_id", "node").alias("vertex"))
    edges = verified.where("other is not null").join(named, "node").select("other", F.col("vertex").alias("u"))
    edges = edges.join(named, edges["other"] == named["node"]).select("u", F.col("vertex").alias("v"))
    classes = components(edges, "u", "v").select(F.col("node")["node"].alias("node"), F.col("label")["first_id"].alias("class_id"))
    info = nodes.select("node", "first_id", "copies").join(classes, "node", "left").join(links, "node", "left")
    info = info.select("node", F.coalesce("class_id", "first_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = signed.select("id", "node").join(info, "node").select("id", "class_id", "n_links")
    # rows without grams come back alone
    bare = rows.where("id is null or text is null").select("id").unionByName(_wordless(rows))
    return linked.unionByName(bare.select("id", F.col("id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links")))


def _blocks(candidates: DataFrame, least: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((node, comp, own) of every candidate, (comp, a, b) for the blocks a <= b of a component that share a band). A component of one
    block has no row in the second table."""
    big = materialise(candidates.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("label", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "large")
    n_big = big.count()
    if not n_big:
        return candidates.select("node", F.col("label").alias("comp"), F.lit(0).alias("own")), empty_table(nodes.sparkSession, "comp binary, a int, b int")
    few = F.broadcast(big) if n_big <= SMALL else big
    tagged = candidates.join(few, "label", "left")
    small = tagged.where("blocks is null").select("node", F.col("label").alias("comp"), F.lit(0).alias("own"))
    large = tagged.where("blocks is not null").join(least, "node", "left").withColumn("least", F.coalesce("least", "node"))
    # a lead's nodes go to one block, or are dealt over as many as they fill
    sizes = large.groupBy("least").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    spread = F.xxhash64("least") + F.pmod(F.xxhash64("node"), F.col("parts"))
    dealt = materialise(large.join(sizes, "least").select("node", F.col("label").alias("comp"), F.pmod(spread, F.col("blocks")).cast("int").alias("own")), "blocks")
    at = dealt.join(nodes.select("node", "bands"), "node").select("comp", "own", F.explode("bands").alias("band")).distinct()
    left, right = at.withColumnRenamed("own", "a"), at.withColumnRenamed("own", "b")
    return small.unionByName(dealt), left.join(right, ["comp", "band"]).where("a <= b").select("comp", "a", "b").distinct()


def _wordless(rows: DataFrame) -> DataFrame:
    """Ids of the non-null texts that have no word."""
    return rows.where(F.col("id").isNotNull() & F.col("text").isNotNull() & ~F.col("text").rlike(r"[\p{L}\p{M}\p{N}]")).select("id")
