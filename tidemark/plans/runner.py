"""Tested models: SQL files that name their inputs by layer, run in order of dependency, each tested before it is committed.

A model's leading comment lines are its header: `test: ...` lines declare tests, the others describe it. Inputs are the layered names
(`silver.x`, `gold.y`) in its SQL and in the SQL of its tests; text in comments and in quotes names nothing. A model is written to a
staging folder once; the tests read what was written, and only a commit makes it visible.
"""

from __future__ import annotations

import graphlib
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.quality import MODEL_TESTS, QualityError
from tidemark.sources.lake import LakeTable

LAYERS = ("silver", "gold")  # fixed values: what a name may start with
_SKIPPED = r"--[^\n]*|/\*.*?\*/|'(?:[^']|'')*'|\"[^\"]*\""
_PIECE = re.compile(rf"(?P<skip>{_SKIPPED})|\b(?P<layer>{'|'.join(LAYERS)})\.(?P<name>\w+)", re.DOTALL)


class Ref(NamedTuple):
    layer: str
    name: str

    def __str__(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def view(self) -> str:
        return f"{self.layer}__{self.name}"

    def path(self, root: str) -> str:
        """A silver table lies under its domain, which is what precedes the first underscore; gold tables lie side by side."""
        parts = self.name.split("_", 1) if self.layer == "silver" else [self.name]
        return "/".join([root.rstrip("/"), *parts, *([""] if self.layer == "silver" and len(parts) == 1 else [])])


def refs(sql: str) -> set[Ref]:
    return {Ref(m["layer"], m["name"]) for m in _PIECE.finditer(sql) if m["layer"]}


def with_views(sql: str, views: Callable[[Ref], str] = lambda r: r.view) -> str:
    """sql with layered names replaced by names of views."""
    return _PIECE.sub(lambda m: m["skip"] or views(Ref(m["layer"], m["name"])), sql)


@dataclass(frozen=True)
class Test:
    """`kind(column, ...)`, or `kind: sql`."""

    kind: str
    columns: tuple[str, ...] = ()
    sql: str = ""

    @classmethod
    def parse(cls, text: str) -> Test:
        call, query = re.match(r"(\w+)\s*\((.*)\)\s*$", text), re.match(r"(\w+)\s*:(.*)$", text, re.DOTALL)
        if call and call[1] in MODEL_TESTS:
            return cls(call[1], tuple(c.strip().strip("`") for c in call[2].split(",")))
        if query and query[1] == "assert_empty":
            return cls(query[1], sql=query[2].strip())
        raise ValueError(f"unknown test: {text}")

    def violations(self, spark: SparkSession, table: DataFrame, views: Callable[[Ref], str]) -> DataFrame:
        return spark.sql(with_views(self.sql, views)) if self.sql else MODEL_TESTS[self.kind](table, list(self.columns))

    def __str__(self) -> str:
        return f"{self.kind}: {self.sql}" if self.sql else f"{self.kind}({', '.join(self.columns)})"


@dataclass(frozen=True)
class Model:
    name: str
    sql: str
    tests: tuple[Test, ...] = ()
    description: str = ""

    @classmethod
    def parse(cls, name: str, text: str) -> Model:
        head = []
        for line in text.splitlines():
            if not line.startswith("--"):
                break
            head.append(line[2:].strip())
        declared = [x.split(":", 1)[1].strip() for x in head if x.startswith("test:")]
        return cls(name, text, tuple(map(Test.parse, declared)), " ".join(x for x in head if not x.startswith("test:")))

    @property
    def inputs(self) -> set[Ref]:
        return set().union(refs(self.sql), *(refs(t.sql) for t in self.tests)) - {Ref("gold", self.name)}


class ModelSet:
    def __init__(self, models: list[Model]) -> None:
        self.by_name = {m.name: m for m in models}

    @classmethod
    def read(cls, folder: Path) -> ModelSet:
        return cls([Model.parse(p.stem, p.read_text()) for p in sorted(folder.glob("*.sql"))])

    def order(self) -> list[Model]:
        """Inputs first; a reference to no model is a ValueError, a cycle a graphlib.CycleError."""
        sorter: graphlib.TopologicalSorter[str] = graphlib.TopologicalSorter()
        for m in self.by_name.values():
            needed = sorted(r.name for r in m.inputs if r.layer == "gold")
            if lost := [n for n in needed if n not in self.by_name]:
                raise ValueError(f"{m.name} refers to unknown models: {', '.join(lost)}")
            sorter.add(m.name, *needed)
        return [self.by_name[n] for n in sorter.static_order()]

    def edges(self) -> list[tuple[str, str]]:
        """(upstream, downstream) for the lineage."""
        return sorted((str(r), f"gold.{m.name}") for m in self.by_name.values() for r in m.inputs)

    def run(self, spark: SparkSession, silver: dict[str, DataFrame], gold_root: str, args: dict[str, object] | None = None) -> dict[str, LakeTable]:
        """Write every model. A failing test stops before its own table is visible; those written before it stay. Views have names of
        this run's own, so runs don't meet."""
        run = uuid.uuid4().hex[:12]
        view = lambda r: f"{r.view}_{run}"
        made: list[str] = []

        def show(ref: Ref, df: DataFrame) -> None:
            made.append(view(ref))
            df.createOrReplaceTempView(made[-1])

        try:
            for name, df in silver.items():
                show(Ref("silver", name), df)
            out = {}
            for m in self.order():
                own = Ref("gold", m.name)
                table = LakeTable(spark, own.path(gold_root))
                base = table.head()
                given = {k: v for k, v in (args or {}).items() if re.search(rf":{k}\b", m.sql)}
                staged = table.stage(spark.sql(with_views(m.sql, view), args=given))
                show(own, staged.rows)
                failed = [str(t) for t in m.tests if t.violations(spark, staged.rows, view).limit(1).count()]
                if failed:
                    table.discard(staged)
                    raise QualityError(f"{m.name}: {'; '.join(failed)}")
                table.publish(staged, base)
                out[m.name] = table
            return out
        finally:
            for name in made:
                spark.catalog.dropTempView(name)
