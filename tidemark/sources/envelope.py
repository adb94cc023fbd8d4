"""Change envelopes (Kafka source rows) to the raw event schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLUMBING = ("debezium_signal",)  # fixed value: tables that carry no data


def canonical_json(text: Column) -> Column:
    """The same document with sorted keys and without blanks; null stays null, and text that isn't JSON is an error."""
    return F.to_json(F.parse_json(text))


def parse_envelope(messages: DataFrame, ingested_at: Column) -> DataFrame:
    """Rows of (topic, partition, offset, key, value) as raw events; tombstones and plumbing tables are dropped.

    Payloads stay JSON text, in canonical form."""
    get = lambda path: F.get_json_object("value", path)
    table = F.coalesce(get("$.source.table"), F.element_at(F.split("topic", r"\."), -1))
    rows = messages.where("value is not null").withColumn("source_table", table).where(~F.col("source_table").isin(*PLUMBING))
    return rows.select(
        get("$.op").alias("op"),
        F.col("key").cast("string").alias("record_key"),
        canonical_json(get("$.before")).alias("before"),
        canonical_json(get("$.after")).alias("after"),
        canonical_json(get("$.source")).alias("source"),
        "source_table",
        get("$.source.lsn").cast("long").alias("source_lsn"),
        get("$.source.txId").cast("long").alias("source_txid"),
        get("$.source.ts_ms").cast("long").alias("source_ts_ms"),
        (F.lower(F.coalesce(get("$.source.snapshot"), F.lit("false"))) != "false").alias("is_snapshot"),
        get("$.ts_ms").cast("long").alias("event_ts_ms"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        ingested_at.alias("ingested_at"),
        F.to_date(ingested_at).alias("ingest_date"),
    )


def table_path(topic: str) -> str:
    """`<prefix>.<schema>.<table>` to `<prefix>/<table>_cdc`."""
    parts = topic.split(".")
    return f"{parts[0]}/{parts[-1]}_cdc"
