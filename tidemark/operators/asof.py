"""As-of join: each left row gets the latest right row of its key at or before its time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, by: list[tuple[str, str]], how: str = "left", small_rows: int = 100_000, bucket: str = "month") -> DataFrame:
    """left plus the columns of right (by and time columns of right keep their names). Null keys and times match nothing.

    The right side must be unique by key and time. Up to small_rows right rows: validity intervals from `lead`, broadcast and joined by
    range. Beyond: rows of both sides are sorted by key and time bucket, so that a hot key is spread over its buckets, and the
    last right row before each bucket is carried in from an aggregate of one row for each key and bucket.
    """
    keys = [r for _, r in by]
    solid = right.where(" and ".join(f"`{c}` is not null" for c in [*keys, right_time]))
    if solid.limit(small_rows + 1).count() <= small_rows:
        after = F.lead(right_time).over(Window.partitionBy(*keys).orderBy(right_time))
        valid = solid.withColumn("__until", after)
        on = [left[a] == valid[b] for a, b in by] + [left[left_time] >= valid[right_time], valid["__until"].isNull() | (left[left_time] < valid["__until"])]
        return left.join(F.broadcast(valid), on, how).drop("__until")
    row = F.struct(*(F.col(c) for c in right.columns))
    k = [f"__k{i}" for i in range(len(by))]
    stamp = lambda t: F.date_trunc(bucket, F.col(t))
    r = solid.select(*(F.col(b).alias(n) for n, (_, b) in zip(k, by, strict=True)), F.col(right_time).alias("__t"), stamp(right_time).alias("__b"), row.alias("__row"))
    rows = left.select(*(F.col(a).alias(n) for n, (a, _) in zip(k, by, strict=True)), F.col(left_time).alias("__t"), stamp(left_time).alias("__b"), F.struct(*left.columns).alias("__left"))
    carried = r.groupBy(*k, "__b").agg(F.max_by("__row", "__t").alias("__row"), F.max("__t").alias("__t"))
    # one marker for each bucket that has left rows, so that it finds the last bucket before it
    marks = rows.where("__t is not null").select(*k, "__b").distinct().withColumn("__mark", F.lit(True))
    before = Window.partitionBy(*k).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    seen = carried.unionByName(marks, allowMissingColumns=True).groupBy(*k, "__b").agg(F.max("__mark").alias("__mark"), F.first("__row", ignorenulls=True).alias("__row"))
    starts = seen.withColumn("__carry", F.last("__row", ignorenulls=True).over(before)).where("__mark and __carry is not null").select(*k, "__b", F.col("__carry").alias("__row"))
    first = starts.withColumn("__order", F.lit(0))
    both = first.unionByName(r.withColumn("__order", F.lit(1)), allowMissingColumns=True).unionByName(rows.withColumn("__order", F.lit(2)), allowMissingColumns=True)
    order = Window.partitionBy(*k, "__b").orderBy(F.col("__t").asc_nulls_first(), "__order")
    matched = both.withColumn("__hit", F.last("__row", ignorenulls=True).over(order)).where("__order = 2")
    known = F.col("__t").isNotNull()
    for n in k:
        known = known & F.col(n).isNotNull()
    out = matched.withColumn("__hit", F.when(known, F.col("__hit")))
    if how == "inner":
        out = out.where("__hit is not null")
    return out.select("__left.*", *(F.col("__hit")[c].alias(c) for c in right.columns))
