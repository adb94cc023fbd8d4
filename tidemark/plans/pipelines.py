"""Whole runs over the layers, for the command line and for any scheduler: settings, declared sources, and one function for each step."""

from __future__ import annotations

import datetime
import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc, quality, reshape
from tidemark.plans import apply
from tidemark.plans.runner import ModelSet
from tidemark.sources import raw, spi
from tidemark.sources.lake import LakeTable

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MODELS = Path(__file__).parent / "models"


@dataclass(frozen=True)
class Settings:
    """Where the layers lie; every field comes from TIDEMARK_<FIELD> in the environment or has its default under root."""

    root: str = "file:///tmp/tidemark"
    landing: str = ""
    raw: str = ""
    silver: str = ""
    gold: str = ""
    sources: str = "sources.yml"
    store_endpoint: str = ""
    store_region: str = ""
    store_access_key: str = field(default="", repr=False)
    store_secret_key: str = field(default="", repr=False)

    @classmethod
    def load(cls, env: Mapping[str, str] = os.environ) -> Settings:
        given = {name: env[f"TIDEMARK_{name.upper()}"].rstrip("/") for name in cls.__dataclass_fields__ if env.get(f"TIDEMARK_{name.upper()}")}
        root = given.get("root", cls.root)
        return cls(**{"root": root} | {layer: f"{root}/{layer}" for layer in ("landing", "raw", "silver", "gold")} | given)

    def store_conf(self) -> dict[str, str]:
        """Options of the session for an object store of the S3 kind; none if no endpoint is set."""
        if not self.store_endpoint:
            return {}
        plain = {"endpoint": self.store_endpoint, "endpoint.region": self.store_region, "access.key": self.store_access_key, "secret.key": self.store_secret_key, "path.style.access": "true", "connection.ssl.enabled": str(self.store_endpoint.startswith("https:")).lower()}
        return {f"spark.hadoop.fs.s3a.{k}": v for k, v in plain.items() if v}


@dataclass(frozen=True)
class Source:
    """A declared source: a connector type or `rest_api`, and its options."""

    name: str
    type: str
    options: dict[str, Any]
    description: str = ""
    owner: str = ""


def declared(text: str) -> dict[str, Source]:
    """Sources by name, from YAML with a map `sources`."""
    import yaml

    entries = (yaml.safe_load(text) or {}).get("sources")
    if not isinstance(entries, dict):
        raise spi.ConfigurationError("there is no map named sources")
    out = {}
    for name, entry in entries.items():
        if not isinstance(entry, dict) or not entry.get("type"):
            raise spi.ConfigurationError(f"sources.{name}: type is missing")
        about = {k: str(entry.get(k) or "") for k in ("type", "description", "owner")}
        out[name] = Source(name=name, options={k: v for k, v in entry.items() if k not in about}, **about)
    return out


def connector_of(spark: SparkSession, source: Source, settings: Settings) -> spi.Connector:
    """The source's connector; `landing_prefix` stands for a location in the landing area, other lists become tuples."""
    known = {"landing_prefix": "location", "file_pattern": "pattern"}
    options = {known.get(k, k): tuple(v) if isinstance(v, list) else v for k, v in source.options.items() if k != "category_aliases"}
    if "landing_prefix" in source.options:
        options["location"] = f"{settings.landing}/{source.options['landing_prefix']}"
    return spi.create(source.type, spark, options)


def raw_table(spark: SparkSession, source: Source, settings: Settings) -> LakeTable:
    return LakeTable(spark, f"{settings.raw}/{'api' if source.type == 'rest_api' else 'files'}/{source.name}")


def upload(spark: SparkSession, file: Path, prefix: str, settings: Settings) -> str:
    """Copy a local file into the landing area."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{settings.landing}/{prefix.strip('/')}/{file.name}")
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).copyFromLocalFile(False, True, jvm.org.apache.hadoop.fs.Path(f"file://{file.resolve()}"), target)
    return target.toString()


def ingest_files(spark: SparkSession, source: Source, settings: Settings, now: datetime.datetime) -> raw.Ingested:
    return raw.ingest_files(connector_of(spark, source, settings), raw_table(spark, source, settings), now)


def ingest_api(spark: SparkSession, source: Source, settings: Settings, as_of: datetime.date, now: datetime.datetime, **fetch: Any) -> int:
    o = source.options
    return raw.ingest_window(spark, raw_table(spark, source, settings), o["url"], as_of, now, int(o.get("lookback_days", 7)), o.get("params"), **fetch)


def build_targets(rows: DataFrame, source: Source) -> DataFrame:
    return reshape.monthly_targets(rows, MONTHS, source.options.get("category_aliases") or {}).orderBy("fiscal_year", "category", "month_start")


def build_rates(rows: DataFrame, source: Source) -> DataFrame:
    flat = reshape.flatten_rates(rows, "payload", "_ingested_at")
    return reshape.newest_wins(flat, ["rate_date", "base_currency", "currency"], [F.desc("_ingested_at")]).orderBy("rate_date", "currency")


REFERENCE = {"sales_targets": build_targets, "fx_rates": build_rates}


def build_reference(spark: SparkSession, source: Source, settings: Settings) -> int:
    """Replace a reference table by what its raw table says; returns its rows."""
    if source.name not in REFERENCE:
        raise spi.ConfigurationError(f"no reference table is built from {source.name}; there are: {', '.join(sorted(REFERENCE))}")
    rows = REFERENCE[source.name](raw_table(spark, source, settings).read(), source)
    table = LakeTable(spark, f"{settings.silver}/{'api' if source.type == 'rest_api' else 'files'}/{source.name}")
    table.overwrite(rows)
    return table.read().count()


def build_silver(spark: SparkSession, spec: cdc.TableSpec, settings: Settings, now: datetime.datetime) -> dict[str, apply.Applied]:
    """Apply new events of a captured table to its current state and history, then check both."""
    events = LakeTable(spark, f"{settings.raw}/{spec.source}/{spec.name}_cdc")
    at, root = F.lit(now), f"{settings.silver}/{spec.source}/{spec.name}"
    current, history = LakeTable(spark, root), LakeTable(spark, f"{root}_history")
    done = {"current": apply.apply_current(spec, events.read(), current, at)} if events.exists() else {}
    if events.exists() and spec.history:
        done["history"] = apply.apply_history(spec, events.read(), history, at)
    quality.gate(table_checks(spec, current, history))
    return done


def table_checks(spec: cdc.TableSpec, current: LakeTable, history: LakeTable) -> dict[str, DataFrame]:
    """Checks of a captured table; a table that isn't there yet has none."""
    if not current.exists():
        return {}
    keys, state = list(spec.primary_key), current.read()
    out = {"pk_unique": quality.duplicate_keys(state, keys), "pk_not_null": quality.null_keys(state, keys)}
    return out | (quality.history_checks(history.read(), state, keys) if spec.history and history.exists() else {})


def reconcile(spark: SparkSession, spec: cdc.TableSpec, settings: Settings, jdbc: Mapping[str, str]) -> DataFrame:
    """(keys, status) where the source database and the current state differ; jdbc has the reader's options."""
    source = spark.read.format("jdbc").options(**jdbc).load().select(*(F.col(c).cast(kind).alias(c) for c, kind in spec.columns.items()))
    live = LakeTable(spark, f"{settings.silver}/{spec.source}/{spec.name}").read().where("not _is_deleted").select(*spec.columns)
    return quality.reconcile(source, live, list(spec.primary_key))


def build_gold(spark: SparkSession, settings: Settings, as_of: datetime.date, models: ModelSet | None = None) -> dict[str, int]:
    """Run every model over the silver tables that it names; returns the rows of each."""
    models = models or ModelSet.read(MODELS)
    needed = {r for m in models.by_name.values() for r in m.inputs if r.layer == "silver"}
    silver = {r.name: LakeTable(spark, r.path(settings.silver)).read() for r in needed}
    return {name: table.read().count() for name, table in models.run(spark, silver, settings.gold, {"as_of": as_of}).items()}
