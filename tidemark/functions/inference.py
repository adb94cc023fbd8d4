"""Narrowest type of string columns, in one aggregate over all columns and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# fixed values: what a value must look like before a cast may decide
INTEGER = r"^[+-]?(0|[1-9][0-9]*)$"
DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
LEADING_ZERO = r"^[+-]?0[0-9]"
DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
STAMP = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?"
ZONE = r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def _rules(v: Column) -> list[tuple[str, Column]]:
    stamp = v.rlike(STAMP + "$") & v.try_cast("timestamp_ntz").isNotNull()
    zoned = v.rlike(STAMP + ZONE) & v.try_cast("timestamp").isNotNull()
    day = v.rlike(DATE) & v.try_cast("date").isNotNull()
    return [
        ("BIGINT", v.rlike(INTEGER) & v.try_cast("bigint").isNotNull()),
        ("DOUBLE", v.rlike(DECIMAL) & ~v.rlike(LEADING_ZERO) & v.try_cast("double").isNotNull()),
        ("BOOLEAN", F.lower(v).isin("true", "false")),
        ("DATE", day),
        ("TIMESTAMP", stamp),
        ("TIMESTAMP WITH TIME ZONE", zoned | day),
    ]


def infer_types(rows: DataFrame) -> dict[str, str]:
    """Type of each column by name; blanks don't count, and a column of blanks stays VARCHAR."""
    parts = []
    for i, c in enumerate(rows.columns):
        v = F.trim(F.col(f"`{c}`"))
        seen = v.isNotNull() & (v != "")
        parts.append(F.count(F.when(seen, 1)).alias(f"n{i}"))
        parts += [F.bool_and(F.when(seen, rule)).alias(f"c{i}_{j}") for j, (_, rule) in enumerate(_rules(v))]
    got = rows.agg(*parts).first()
    names = [name for name, _ in _rules(F.lit(""))]
    return {c: next((names[j] for j in range(len(names)) if got[f"n{i}"] and got[f"c{i}_{j}"]), "VARCHAR") for i, c in enumerate(rows.columns)}


# fixed values: names of Spark's types in the vocabulary of the catalogue
NAMES = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "binary": "BLOB", "string": "VARCHAR", "void": "VARCHAR"}


def sql_types(schema: StructType) -> dict[str, str]:
    """Type name of each column; decimals keep precision and scale, other types their Spark name in capitals."""
    return {f.name: NAMES.get(kind := f.dataType.simpleString(), kind.upper()) for f in schema.fields}
