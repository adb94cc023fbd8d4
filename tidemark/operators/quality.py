"""Quality checks, model tests and reconciliation, as tables of violations."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    """A check found violations."""


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur twice; nulls count as equal."""
    return rows.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(F.count("*").alias("n")).where("n > 1")


def null_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.where(reduce(lambda a, b: a | b, (F.col(f"`{k}`").isNull() for k in keys)))


def history_checks(history: DataFrame, current: DataFrame, keys: list[str]) -> dict[str, DataFrame]:
    """The checks of a versioned table, by name; each table holds what violates it."""
    opened = history.where("_is_current").select(*keys, F.lit(True).alias("__open"))
    live = current.where("not _is_deleted").select(*keys, F.lit(True).alias("__live"))
    return {
        "scd2_one_current_version": duplicate_keys(history.where("_is_current"), keys),
        "scd2_valid_interval": history.where("_valid_to < _valid_from"),
        "scd2_open_iff_current": history.where("_is_current <> (_valid_to is null)"),
        "scd2_matches_current_state": opened.join(live, keys, "full").where("__open is null or __live is null"),
    }


def gate(checks: dict[str, DataFrame]) -> None:
    """Raise if any table holds a row; one job counts them all."""
    if not checks:
        return
    counted = reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in checks.items()))
    bad = {r["name"]: r["n"] for r in counted.where("n > 0").collect()}
    if bad:
        raise QualityError(", ".join(f"{k}: {v}" for k, v in sorted(bad.items())))


# tests that a model may declare by name, each a table of what violates it
MODEL_TESTS: dict[str, Callable[[DataFrame, list[str]], DataFrame]] = {
    "unique": lambda rows, columns: duplicate_keys(rows, columns),
    "not_null": lambda rows, columns: null_keys(rows, columns),
}


def reconcile(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, status): missing in the target, extra there, or mismatched in a shared column."""
    values = [c for c in source.columns if c not in keys]
    a = source.select(*keys, F.struct(*values).alias("__a"), F.lit(True).alias("__in_a"))
    b = target.select(*keys, F.struct(*values).alias("__b"), F.lit(True).alias("__in_b"))
    status = F.when(F.col("__in_b").isNull(), "missing").when(F.col("__in_a").isNull(), "extra").when(~F.col("__a").eqNullSafe(F.col("__b")), "mismatched")
    return a.join(b, keys, "full").withColumn("status", status).where("status is not null").select(*keys, "status")
