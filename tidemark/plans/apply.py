"""Apply new change events to current state and history; the offsets applied are committed with the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.sources.lake import Commit, LakeTable


@dataclass(frozen=True)
class Applied:
    """What a run read and wrote; partitions is 0 if nothing was new."""

    partitions: int = 0
    events: int = 0
    inserted: int = 0
    updated: int = 0


def _fresh(bronze: DataFrame, base: Commit | None, app: str) -> tuple[DataFrame, dict[str, int], int]:
    """(events past the marks of the base, marks after them, their number)."""
    marks = {int(k.rpartition("/p")[2]): v for k, v in (base.txns if base else {}).items() if k.startswith(f"{app}/p")}
    new = cdc.beyond(bronze, marks)
    tops = new.groupBy("kafka_partition").agg(F.max("kafka_offset").alias("top"), F.count("*").alias("n")).collect()  # a row for each partition
    return new, {f"{app}/p{r['kafka_partition']}": r["top"] for r in tops}, sum(r["n"] for r in tops)


def _commit(table: LakeTable, state: DataFrame, base: Commit | None, marks: dict[str, int], events: int, before: int, touched: Column) -> Applied:
    """Write the state, count what this run touched in it, and commit rows, marks and counts together."""
    staged = table.stage(state)
    counts = staged.rows.agg(F.count("*").alias("rows"), F.count(F.when(touched, 1)).alias("touched")).first()
    inserted = counts["rows"] - before
    done = Applied(len(marks), events, inserted, counts["touched"] - inserted)
    table.publish(staged, base, marks, {"rows": counts["rows"], "events": events, "inserted": done.inserted, "updated": done.updated})
    return done


def _rows_before(base: Commit | None) -> int:
    return base.metrics.get("rows", 0) if base else 0


def apply_current(spec: cdc.TableSpec, bronze: DataFrame, table: LakeTable, run_ts: Column) -> Applied:
    """Upsert the newest event of each key, against the version that was read: a commit that comes between is a conflict."""
    base = table.head()
    new, marks, events = _fresh(bronze, base, f"silver/{spec.source}/{spec.name}/current")
    if not marks:
        return Applied()
    latest = cdc.latest_per_key(cdc.typed_events(new, spec, run_ts), list(spec.primary_key), ["_seq"])
    state = cdc.merge_current(table.read(base), latest, list(spec.primary_key)) if base else latest
    return _commit(table, state, base, marks, events, _rows_before(base), F.col("_processed_at") == run_ts)


def apply_history(spec: cdc.TableSpec, bronze: DataFrame, table: LakeTable, run_ts: Column) -> Applied:
    """Add versions; its marks are its own, apart from the current state's."""
    base = table.head()
    new, marks, events = _fresh(bronze, base, f"silver/{spec.source}/{spec.name}/history")
    if not marks:
        return Applied()
    typed = cdc.typed_events(new, spec, run_ts)
    state = cdc.merge_history(table.read(base), typed, spec) if base else cdc.versions(typed, spec)
    return _commit(table, state, base, marks, events, _rows_before(base), F.col("_processed_at") == run_ts)
