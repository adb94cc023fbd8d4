"""Raw tables: file rows and API payloads appended as they came, with where and when they came from.

The table is the record of what was ingested: a file counts as seen if its path and etag stand in the table, so rows and state can't
disagree, and a run that died is run again without harm."""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.sources import rest
from tidemark.sources.lake import LakeTable
from tidemark.sources.spi import Connector


@dataclass(frozen=True)
class Ingested:
    files_seen: int
    files_ingested: int
    rows: int


def seen(table: LakeTable) -> dict[str, Any]:
    """The connector state that the table stands for: every (path, etag) it has."""
    if not table.exists():
        return {"seen": []}
    pairs = table.read().select("_source_file", "_file_etag").distinct().collect()  # a row for each file
    return {"seen": [[r["_source_file"], r["_file_etag"]] for r in pairs]}


def ingest_files(connector: Connector, table: LakeTable, ingested_at: datetime.datetime) -> Ingested:
    """Append the rows of new and changed files, a commit for each; a new column widens the table."""
    files, rows = 0, 0
    for batch in connector.incremental(seen(table)):
        staged = table.stage(batch.rows.withColumn("_ingested_at", F.lit(ingested_at)))
        table.append(staged)
        rows += staged.rows.count()
        files += 1
    return Ingested(len(connector.files()), files, rows)


def ingest_window(spark: SparkSession, table: LakeTable, template: str, as_of: datetime.date, ingested_at: datetime.datetime, lookback_days: int = 7, params: dict[str, str] | None = None, fetch: Any = rest.fetch_json) -> int:
    """Append the payload of the window that ends at as_of; returns its length in bytes."""
    row = rest.fetch_window(spark, template, as_of, ingested_at, lookback_days, params, fetch)
    table.append(row)
    return len(row.first()["payload"].encode())
