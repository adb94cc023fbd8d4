"""Change-event semantics: typed projection, current state, versions, and what a merge needs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    """A captured table: key and typed columns (name -> Spark SQL type); history says whether versions are kept."""

    name: str
    primary_key: tuple[str, ...]
    columns: dict[str, str]
    history: bool = False
    source: str = "shop"


META = ("_is_deleted", "_op", "_seq", "_source_ts", "_processed_at")


def typed_events(events: DataFrame, spec: TableSpec, run_ts: Column) -> DataFrame:
    """Payload fields of each event as typed columns (deletes have only `before`), with the envelope's meta columns."""
    payload = F.coalesce("after", "before")
    fields = [F.get_json_object(payload, f"$.{c}").cast(kind).alias(c) for c, kind in spec.columns.items()]
    meta = [(F.col("op") == "d").alias("_is_deleted"), F.col("op").alias("_op"), F.col("kafka_offset").alias("_seq"), F.timestamp_millis("source_ts_ms").alias("_source_ts"), run_ts.alias("_processed_at")]
    return events.select(*fields, *meta)


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key; max_by over a struct aggregates before the shuffle, unlike a window."""
    packed = F.struct(*rows.columns)
    newest = rows.groupBy(*keys).agg(F.max_by(packed, F.struct(*order)).alias("__row"))
    return newest.select("__row.*")


def versions(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """Versions of each key: valid until the next event of the key; a delete ends a version and starts none."""
    order = Window.partitionBy(*spec.primary_key).orderBy("_seq")
    following = typed.withColumn("_valid_to", F.lead("_source_ts").over(order)).where(~F.col("_is_deleted"))
    return following.select(*spec.columns, F.col("_source_ts").alias("_valid_from"), "_valid_to", F.col("_valid_to").isNull().alias("_is_current"), "_seq", "_op", "_processed_at")


def close_rows(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """For each key of a batch, when its open version ends: the batch's first event."""
    return typed.groupBy(*spec.primary_key).agg(F.min("_source_ts").alias("_valid_to"), F.min("_seq").alias("_seq"), F.max("_processed_at").alias("_processed_at"))


def merge_source(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """Close rows and new versions in one table, told apart by _action."""
    close = close_rows(typed, spec).withColumn("_action", F.lit("close"))
    return close.unionByName(versions(typed, spec).withColumn("_action", F.lit("insert")), allowMissingColumns=True)


def merge_current(state: DataFrame, latest: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert by key, where only a higher _seq replaces a row."""
    packed = lambda df, name: df.select(*(F.col(k).alias(k) for k in keys), F.struct(*state.columns).alias(name))
    both = packed(state, "old").join(packed(latest, "new"), keys, "full")
    newer = F.col("old").isNull() | (F.col("new._seq") > F.col("old._seq"))
    row = F.when(F.col("new").isNotNull() & newer, F.col("new")).otherwise(F.col("old"))
    return both.select(row.alias("r")).select("r.*")


def merge_history(state: DataFrame, typed: DataFrame, spec: TableSpec) -> DataFrame:
    """Add versions and close what they end. Events that a key's history already has are dropped first, so that a replay that
    overlaps and extends the history leaves one open version."""
    keys = list(spec.primary_key)
    known = state.groupBy(*keys).agg(F.max("_seq").alias("__last"))
    fresh = typed.join(known, keys, "left").where("__last is null or _seq > __last").drop("__last")
    ends = close_rows(fresh, spec).select(*keys, F.col("_valid_to").alias("__to"), F.col("_processed_at").alias("__at"))
    closing = F.col("_is_current") & F.col("__to").isNotNull()
    changed = {"_valid_to": F.col("__to"), "_is_current": F.lit(False), "_processed_at": F.col("__at")}
    kept = state.join(ends, keys, "left").select(*(F.when(closing, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in state.columns))
    return kept.unionByName(versions(fresh, spec))


def beyond(events: DataFrame, marks: dict[int, int]) -> DataFrame:
    """Events past the applied offset of their partition; partitions without a mark are new."""
    if not marks:
        return events
    applied = reduce(lambda a, b: a | b, ((F.col("kafka_partition") == p) & (F.col("kafka_offset") <= o) for p, o in sorted(marks.items())))
    return events.where(~applied)


def max_offsets(events: DataFrame) -> DataFrame:
    """Highest offset of each topic and partition."""
    return events.groupBy("kafka_topic", "kafka_partition").agg(F.max("kafka_offset").alias("max_offset"))


def drop_written(batch: DataFrame, committed: DataFrame) -> DataFrame:
    """Events past what the table has of their topic and partition."""
    marks = committed.select("kafka_topic", "kafka_partition", F.col("max_offset").alias("__max"))
    joined = batch.join(marks, ["kafka_topic", "kafka_partition"], "left")
    return joined.where(F.col("kafka_offset") > F.coalesce("__max", F.lit(-1))).select(*batch.columns)
