"""Reference data: unpivot, newest load, alias lookup, nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot(rows: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """Columns to rows, without nulls."""
    return rows.unpivot(ids, columns, name, value).where(F.col(value).isNotNull())


def newest_load(rows: DataFrame, keys: list[str], loaded_at: str) -> DataFrame:
    """All rows of the newest load of each key, null keys among them; loads that tie all stay. The maximum is aggregated before it is
    joined back."""
    tops = rows.groupBy(*keys).agg(F.max(loaded_at).alias("__top")).select(*(F.col(k).alias(f"__{k}") for k in keys), "__top")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return rows.join(tops, [*same, F.col(loaded_at) == F.col("__top")]).select(*rows.columns)


def number(text: Column, kind: str) -> Column:
    """A number with thousands separators."""
    return F.nullif(F.replace(text, F.lit(","), F.lit("")), F.lit("")).cast(kind)


def monthly_targets(sheet: DataFrame, months: list[str], aliases: dict[str, str]) -> DataFrame:
    """Targets by fiscal year, category and month, from spreadsheet rows with a column for each month: the newest load of each year,
    unpivoted, labels replaced by their aliases, numbers freed of separators."""
    newest = newest_load(sheet, ["_file_fiscal_year"], "_ingested_at")
    kept = ["category", "_file_fiscal_year", "_source_file", "_row_number", "_ingested_at"]
    long = alias_lookup(unpivot(newest, kept, months, "month_name", "raw"), "category", aliases, "__alias")
    year, month = F.col("_file_fiscal_year").cast("int"), F.array_position(F.array(*map(F.lit, months)), F.col("month_name")).cast("int")
    return long.select(
        year.alias("fiscal_year"), F.make_date(year, month, F.lit(1)).alias("month_start"), F.col("__alias").alias("category"), F.trim("category").alias("source_label"),
        number(F.col("raw"), "decimal(12,2)").alias("target_usd"), "_source_file", "_row_number", "_ingested_at",
    )


def alias_lookup(rows: DataFrame, label: str, aliases: dict[str, str], out: str) -> DataFrame:
    """The alias of a trimmed label, or the label itself; the aliases come from configuration, so they are an inline map."""
    trimmed = F.trim(F.col(label))
    if not aliases:
        return rows.withColumn(out, trimmed)
    table = F.create_map(*(F.lit(x) for pair in sorted(aliases.items()) for x in pair))
    return rows.withColumn(out, F.coalesce(F.try_element_at(table, trimmed), trimmed))


def flatten_rates(payloads: DataFrame, payload: str, loaded_at: str) -> DataFrame:
    """{"base": b, "rates": {day: {currency: rate}}} to one row for each rate."""
    days = F.from_json(F.get_json_object(payload, "$.rates"), "map<string,map<string,double>>")
    by_day = payloads.select(F.get_json_object(payload, "$.base").alias("base_currency"), F.col(loaded_at), F.explode(days).alias("day", "rates"))
    return by_day.select(F.to_date("day").alias("rate_date"), "base_currency", F.explode("rates").alias("currency", "rate"), loaded_at)


def newest_wins(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, by order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__place", place).where("__place = 1").drop("__place")
