"""Continuous ingestion of change envelopes into raw tables, one for each topic, exactly once by offset.

The table is the truth about what was written: a batch drops events up to the table's own marks, and its marks are committed with
its rows, so a batch that runs again after a crash adds nothing. The stream's checkpoint only saves reading.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import cdc
from tidemark.sources.envelope import parse_envelope, table_path
from tidemark.sources.lake import LakeTable

MESSAGES = "topic string, partition int, offset bigint, key string, value string"


def kafka(spark: SparkSession, servers: str, pattern: str, max_messages: int = 5000) -> DataFrame:
    """Every topic that matches, from the earliest offset, in bounded batches; needs the Kafka package on the classpath."""
    options = {"kafka.bootstrap.servers": servers, "subscribePattern": pattern, "startingOffsets": "earliest", "maxOffsetsPerTrigger": str(max_messages), "kafka.metadata.max.age.ms": "30000"}
    return spark.readStream.format("kafka").options(**options).load().selectExpr("topic", "partition", "offset", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def append_events(events: DataFrame, table: LakeTable) -> None:
    """Append the events that the table doesn't have, and mark their offsets in the same commit."""
    marks = {int(k.rpartition("/p")[2]): v for k, v in table.txns().items()}
    new = cdc.beyond(events, marks)
    tops = {f"bronze/p{r['kafka_partition']}": r["top"] for r in new.groupBy("kafka_partition").agg(F.max("kafka_offset").alias("top")).collect()}
    if tops:
        table.append(new, tops, ["ingest_date"])


def writer(root: str, now: Callable[[], Column]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: parse, split by topic, append."""

    def write(batch: DataFrame, _: int) -> None:
        held = batch.persist()
        try:
            for r in held.select("topic").distinct().collect():  # a row for each topic
                events = parse_envelope(held.where(F.col("topic") == r["topic"]), now())
                append_events(events, LakeTable(batch.sparkSession, f"{root}/{table_path(r['topic'])}"))
        finally:
            held.unpersist()

    return write


def start(messages: DataFrame, root: str, checkpoint: str, now: Callable[[], Column] = F.current_timestamp, once: bool = False, seconds: int = 30) -> StreamingQuery:
    """Run until stopped, or over what is there; stop() ends after the batch at hand."""
    stream = messages.writeStream.foreachBatch(writer(root, now)).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream.trigger(processingTime=f"{seconds} seconds")).start()
