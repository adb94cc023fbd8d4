"""Connector interface: capabilities, ingestion modes, registry, masking and the mode recommender."""

from __future__ import annotations

import enum
import importlib.metadata
import logging
import re
from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass, field, fields
from typing import Any, ClassVar

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)
PLUGINS = "tidemark.connectors"
MASK = "***"
# fixed values: names of columns that move with every change, and how they may end
CURSOR_NAMES = ("updated", "modified", "changed", "last_modified", "last_updated")
CURSOR_ENDS = ("", "_at", "_on", "_ts", "_date", "_time")


class ConnectorError(RuntimeError):
    """A source cannot be read as configured."""


class ConfigurationError(ConnectorError):
    """Settings are wrong; the message names the setting."""


class UnsupportedOperation(ConnectorError):
    """The connector has no such mode."""


class Mode(enum.Enum):
    FULL = "full"
    INCREMENTAL = "incremental"
    CDC = "cdc"
    SNAPSHOT_DIFF = "snapshot_diff"


@dataclass(frozen=True)
class Capabilities:
    files: bool = False
    cursor: bool = False
    cdc: bool = False
    snapshot_diff: bool = True

    def modes(self) -> list[Mode]:
        out = [Mode.FULL]
        if self.files or self.cursor:
            out.append(Mode.INCREMENTAL)
        if self.cdc:
            out.append(Mode.CDC)
        if self.snapshot_diff:
            out.append(Mode.SNAPSHOT_DIFF)
        return out


@dataclass(frozen=True)
class Column:
    name: str
    type: str


@dataclass(frozen=True)
class DatasetSchema:
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def as_dict(self) -> dict[str, Any]:
        return {"columns": [{"name": c.name, "type": c.type} for c in self.columns], "primary_key": list(self.primary_key)}

    def with_types(self, overrides: dict[str, str]) -> DatasetSchema:
        if unknown := overrides.keys() - set(self.names):
            raise ConfigurationError(f"type overrides name unknown columns: {', '.join(sorted(unknown))}")
        return DatasetSchema(tuple(Column(c.name, overrides.get(c.name, c.type)) for c in self.columns), self.primary_key)


@dataclass(frozen=True)
class Stream:
    """Something that can be extracted: a sheet, a file set, an endpoint, a table."""

    id: str
    name: str
    kind: str
    visible: bool = True
    metadata: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Batch:
    """Rows of one unit, with the state that makes the next extract skip it."""

    rows: DataFrame
    state: dict[str, Any]
    source: str


@dataclass(frozen=True)
class Recommendation:
    mode: Mode
    cursor: str | None = None
    caveats: tuple[str, ...] = ()


def cursor_column(schema: DatasetSchema) -> str | None:
    """The first time column whose name says that it moves with every change; one that only tells of the creation does not."""
    moving = {n + e for n in CURSOR_NAMES for e in CURSOR_ENDS}
    return next((c.name for c in schema.columns if c.name.lower() in moving and c.type.upper().startswith(("TIMESTAMP", "DATE"))), None)


def recommend(capabilities: Capabilities, schema: DatasetSchema) -> Recommendation:
    """Change capture with a key, then files, a cursor column, a diff of snapshots with a key, and a full load."""
    if capabilities.cdc and schema.primary_key:
        return Recommendation(Mode.CDC)
    if capabilities.files:
        return Recommendation(Mode.INCREMENTAL, caveats=("a changed file is read again as a whole",))
    missing = ("change capture needs a primary key",) if capabilities.cdc else ()
    if capabilities.cursor and (cursor := cursor_column(schema)):
        return Recommendation(Mode.INCREMENTAL, cursor, (*missing, "deleted rows are not seen"))
    if schema.primary_key and not missing and capabilities.snapshot_diff:
        return Recommendation(Mode.SNAPSHOT_DIFF, caveats=("every run reads the whole source",))
    return Recommendation(Mode.FULL, caveats=(*missing, "every run reads and replaces everything"))


SECRET = re.compile(r"password|secret|token|key_id|access_key|credential", re.IGNORECASE)


def masked(config: Any) -> Any:
    """config without the values of secret settings, at any depth."""
    if isinstance(config, dict):
        return {k: MASK if SECRET.search(k) and v is not None else masked(v) for k, v in config.items()}
    return [masked(x) for x in config] if isinstance(config, (list, tuple)) else config


class Connector(ABC):
    type: ClassVar[str]
    capabilities: ClassVar[Capabilities]
    config_class: ClassVar[type]

    def __init__(self, spark: SparkSession, config: dict[str, Any]) -> None:
        known = {f.name for f in fields(self.config_class)}
        if unknown := config.keys() - known:
            raise ConfigurationError(f"{self.type}: unknown settings: {', '.join(sorted(unknown))}")
        try:
            self.config = self.config_class(**config)
        except TypeError as error:
            raise ConfigurationError(f"{self.type}: {error}") from error
        self.spark = spark

    def public_config(self) -> dict[str, Any]:
        return masked(dict(vars(self.config)))

    @abstractmethod
    def streams(self) -> list[Stream]: ...

    @abstractmethod
    def extract(self, state: dict[str, Any] | None = None, full: bool = False) -> Iterator[Batch]: ...

    def incremental(self, state: dict[str, Any] | None, cursor: str | None = None) -> Iterator[Batch]:
        if Mode.INCREMENTAL not in self.capabilities.modes():
            raise UnsupportedOperation(f"{self.type} has no incremental mode")
        if not self.capabilities.files and cursor is None:
            raise ConfigurationError(f"{self.type}: an incremental extract needs a cursor column")
        return self.extract(state)

    def default_stream(self) -> Stream:
        found = self.streams()
        if not found:
            raise ConnectorError(f"{self.type}: nothing to read")
        return next((s for s in found if s.visible), found[0])


_registry: dict[str, type[Connector]] = {}


def register(cls: type[Connector]) -> type[Connector]:
    if cls.type in _registry:
        raise ValueError(f"connector type {cls.type} is taken")
    _registry[cls.type] = cls
    return cls


def available() -> list[str]:
    """Registered types, plugins included; a plugin that fails to load is logged and left out."""
    for point in importlib.metadata.entry_points(group=PLUGINS):
        if point.name not in _registry:
            try:
                point.load()
            except Exception:  # whatever a plugin raises, others must load
                log.exception("connector plugin %s", point.name)
    return sorted(_registry)


def create(kind: str, spark: SparkSession, config: dict[str, Any]) -> Connector:
    if kind not in available():
        raise ConfigurationError(f"unknown connector type {kind}; there are: {', '.join(sorted(_registry))}")
    return _registry[kind](spark, config)
