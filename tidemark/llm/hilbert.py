"""Sharding along a Hilbert curve, in DataFrame functions only.

Metadata dimensions are quantised to a few bits each, the packed coordinates name a cell, and cells are ordered by their index on
the Hilbert curve; the sorted rows are cut into runs whose counts differ by one at most. A row's global place is the sum of three
counts: rows in cells before its own (a table of at most 2 ** (bits * dimensions) rows), rows in its cell's hash buckets before its
own, and its place in that bucket; so a cell with a third of all rows is still ranked in small groups.

Defined cases: a null dimension is coordinate 0, a null or empty text has size 16, a null key is a key like any other; rows that
repeat an id, null ones included, are told apart by a hash of all their columns, so that slots don't change from run to run. An empty
table gives an empty result. Input columns named like the outputs (place, shard, slot) are replaced; all others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 50_000


@dataclass(frozen=True)
class Dimension:
    """A column and how it becomes coordinates: `category` by hash, `size` by powers of two up to 2 ** 24, `range` linearly."""

    column: str
    kind: str = "category"
    low: float = 0.0
    high: float = 1.0


def quantise(dim: Dimension, bits: int) -> Column:
    """Coordinate of a dimension, from 0 to 2 ** bits - 1; 0 for null."""
    col, top = F.col(dim.column), (1 << bits) - 1
    if dim.kind == "category":
        coordinate = F.when(col.isNotNull(), F.pmod(F.xxhash64(col.cast("string")), F.lit(top + 1)))
    elif dim.kind == "size":
        coordinate = F.floor(F.log2(F.greatest(col, F.lit(0)).cast("double") + 1) * ((top + 1) / 24))
    elif dim.kind == "range":
        coordinate = F.floor((col.cast("double") - dim.low) / (dim.high - dim.low) * (top + 1))
    else:
        raise ValueError(f"unknown kind of dimension: {dim.kind}")
    inside = F.when(F.isnan(coordinate.cast("double")), F.lit(0)).otherwise(F.least(F.greatest(coordinate.cast("double"), F.lit(0.0)), F.lit(float(top))))
    return F.coalesce(inside.cast("int"), F.lit(0))


def curve_index(coordinates: list[Column], bits: int) -> Column:
    """Hilbert index of a cell.

    The state is one struct in an array of length 1, so that each step refers to the former by a lambda variable and the
    expression grows linearly. Steps: undo the excess rotations from the top bit down, Gray-code, interleave.
    """
    n = len(coordinates)
    names = [f"x{i}" for i in range(n)]

    def step(state: Column, change) -> Column:
        return F.transform(state, lambda s: F.struct(*(c.alias(k) for k, c in zip(names, change([s[k] for k in names]), strict=True))))

    state = F.array(F.struct(*(c.cast("int").alias(k) for k, c in zip(names, coordinates, strict=True))))
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(n):

            def undo(x: list[Column], i: int = i, bit: int = bit, low: int = low) -> list[Column]:
                set_ = x[i].bitwiseAND(1 << bit) != 0
                swap = x[0].bitwiseXOR(x[i]).bitwiseAND(low)
                out = list(x)
                out[0] = F.when(set_, x[0].bitwiseXOR(F.lit(low))).otherwise(x[0].bitwiseXOR(swap))
                if i:
                    out[i] = F.when(set_, x[i]).otherwise(x[i].bitwiseXOR(swap))
                return out

            state = step(state, undo)
    for i in range(1, n):
        state = step(state, lambda x, i=i: [*x[:i], x[i].bitwiseXOR(x[i - 1]), *x[i + 1 :]])

    def flip(x: list[Column]) -> list[Column]:
        turn = reduce(Column.bitwiseXOR, [F.when(x[-1].bitwiseAND(1 << b) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)) for b in range(1, bits)], F.lit(0))
        return [c.bitwiseXOR(turn) for c in x]

    state = step(state, flip)
    last = state[0]
    index = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for k in names:
            index = index * 2 + F.shiftright(last[k], b).bitwiseAND(1)
    return index


def order_and_cut(rows: DataFrame, key: str, dimensions: list[Dimension], shards: int, bits: int = 4) -> DataFrame:
    """rows with place (0-based, along the curve), shard (0 to shards - 1) and slot (gapless from 0 in each shard)."""
    base = rows.drop("place", "shard", "slot")
    total = base.count()
    buckets = max(1, -(-total // BUCKET_ROWS))
    packed = reduce(lambda acc, d: acc * (1 << bits) + quantise(d, bits), dimensions, F.lit(0).cast("long"))
    # the row travels as one struct, so that no column of it can clash
    tie = F.xxhash64(*(F.col(f"`{c}`") for c in base.columns))
    tagged = base.select(F.struct(*(F.col(f"`{c}`") for c in base.columns)).alias("row"), F.col(key).alias("key"), packed.alias("cell"), tie.alias("tie"))
    tagged = tagged.withColumn("bucket", F.pmod(F.xxhash64("key", "tie"), F.lit(buckets)).cast("int"))
    counts = tagged.groupBy("cell", "bucket").agg(F.count("*").alias("n"))
    top = len(dimensions) - 1
    axes = [F.shiftright("cell", bits * (top - i)).bitwiseAND((1 << bits) - 1) for i in range(top + 1)]
    cells = counts.groupBy("cell").agg(F.sum("n").alias("in_cell")).withColumn("index", curve_index(axes, bits))
    cells = cells.withColumn("cell_start", F.sum("in_cell").over(Window.orderBy("index")) - F.col("in_cell")).select("cell", "cell_start")
    within = Window.partitionBy("cell").orderBy("bucket")
    starts = counts.withColumn("before", F.sum("n").over(within) - F.col("n")).join(F.broadcast(cells), "cell")  # at most 2 ** (bits * dimensions) cells
    starts = starts.select("cell", "bucket", (F.col("before") + F.col("cell_start")).alias("start"))
    # rows that still tie are equal in every column
    ranked = tagged.withColumn("rank", F.row_number().over(Window.partitionBy("cell", "bucket").orderBy(F.xxhash64("key"), "key", "tie")))
    placed = ranked.join(starts, ["cell", "bucket"]).select("row", (F.col("start") + F.col("rank") - 1).alias("place"))
    n = max(1, total)
    cut = placed.withColumn("shard", F.expr(f"int(place * {shards} div {n})"))
    slot = F.expr(f"place - (bigint(shard) * {n} + {shards - 1}) div {shards}")  # the shard's first place is a ceiling
    return cut.withColumn("slot", slot).select(*(F.col("row")[c].alias(c) for c in base.columns), "place", "shard", "slot")


def write_shards(cut: DataFrame, path: str, files: int = 64) -> None:
    """Write the shards as folders shard=N whose files are runs of the curve, so that readers prune by footer statistics. A range of
    places that crosses a shard's end makes a file in either folder."""
    cut.repartitionByRange(files, "place").sortWithinPartitions("place").write.partitionBy("shard").parquet(path)
