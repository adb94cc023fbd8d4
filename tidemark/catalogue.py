"""Registered queries over the driver's tables, with their SQL twins."""

from __future__ import annotations

import datetime
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.inference import infer_types, sql_types
from tidemark.operators import cdc, quality, reshape
from tidemark.operators.asof import asof_join
from tidemark.plans import apply, pipelines, runner
from tidemark.plans.pipelines import MODELS, MONTHS
from tidemark.sources import files, raw, spi
from tidemark.sources.envelope import parse_envelope
from tidemark.sources.lake import LakeTable
from tidemark.storage import fresh_path, materialise
from tidemark.streaming import bronze as streams

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = datetime.date(2000, 6, 15)
RUN_TS = "timestamp'2024-02-01 00:00:00'"
# fixed values: currency, base, step and modulus of the made-up rates, in thousandths
FX = [("EUR", 900, 7, 100), ("GBP", 780, 11, 90), ("JPY", 110_000, 13, 9000), ("IDR", 15_000_000, 17, 900_000)]
CURRENCY = "CASE o_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' ELSE 'IDR' END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- order lines in USD -------------------------------------------------------------------------------------------------------


def fx_rates(spark: SparkSession) -> DataFrame:
    """Weekday rates, and 1 for USD on every day that has a rate."""
    days = spark.sql("SELECT explode(sequence(date'1994-12-26', date'2001-12-31', interval 1 day)) AS rate_date").where("unix_date(rate_date) % 7 NOT IN (2, 3)")
    kinds = F.array(*(F.struct(F.lit(c).alias("currency"), F.lit(b).alias("b"), F.lit(k).alias("k"), F.lit(m).alias("m")) for c, b, k, m in FX))
    rates = days.withColumn("c", F.explode(kinds)).selectExpr("rate_date", "c.currency", "CAST(c.b + (CAST(unix_date(rate_date) AS BIGINT) * c.k) % c.m AS DOUBLE) / 1000 AS rate")
    return rates.union(rates.selectExpr("rate_date", "'USD'", "CAST(1 AS DOUBLE)").distinct())


def silver(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The tables that the models read, from the driver's."""
    return {
        "shop_orders": table(spark, d, "orders").selectExpr("o_orderkey AS order_key", "o_custkey AS customer_key", "CAST(o_orderdate AS DATE) AS order_date", f"{CURRENCY} AS currency", "o_orderstatus = 'P' AS is_cancelled"),
        "shop_order_items": table(spark, d, "lineitem").selectExpr("l_orderkey AS order_key", "l_partkey AS product_key", "l_linenumber AS line_number", "CAST(l_quantity AS BIGINT) AS quantity", "CAST(l_extendedprice AS DECIMAL(14,2)) AS amount"),
        "shop_products": table(spark, d, "part").selectExpr("p_partkey AS product_key", "p_type AS category"),
        "shop_customers": table(spark, d, "customer").selectExpr("c_custkey AS customer_key", "c_mktsegment AS segment", "true AS is_current"),
        "api_fx_rates": fx_rates(spark),
        "targets_sales": sales_targets(spark, d).selectExpr("category", "month_start", "CAST(target_usd AS DECIMAL(18,2)) AS target_usd"),
    }


def _model(spark: SparkSession, d: str, name: str, inputs: dict[str, DataFrame], args: dict[str, object] | None = None) -> DataFrame:
    """The rows of a model, its inputs given by view name; nothing is left behind in the session."""
    frames = {r.view: inputs[r.name] for r in runner.refs((MODELS / f"{name}.sql").read_text())}
    sql = runner.with_views((MODELS / f"{name}.sql").read_text(), lambda r: f"{{{r.view}}}")
    for k, v in (args or {}).items():
        sql = sql.replace(f":{k}", f"DATE '{v}'")
    return spark.sql(sql, **frames)


def fct_order_items(spark: SparkSession, d: str) -> DataFrame:
    return _model(spark, d, "fct_order_items", silver(spark, d))


_FX_VALUES = ", ".join(f"('{c}', {b}, {k}, {m})" for c, b, k, m in FX)
FCT_CTE = f"""
days AS (SELECT CAST(d AS DATE) AS rate_date FROM generate_series(DATE '1994-12-26', DATE '2001-12-31', INTERVAL 1 DAY) t(d)),
rates AS (SELECT rate_date, currency, CAST(b + (date_diff('day', DATE '1970-01-01', rate_date) * k) % m AS DOUBLE) / 1000 AS rate
  FROM days CROSS JOIN (VALUES {_FX_VALUES}) c(currency, b, k, m) WHERE date_diff('day', DATE '1970-01-01', rate_date) % 7 NOT IN (2, 3)),
fx AS (SELECT * FROM rates UNION ALL SELECT DISTINCT rate_date, 'USD', CAST(1 AS DOUBLE) FROM rates),
o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, {CURRENCY} AS currency FROM orders WHERE o_orderstatus <> 'P'),
priced AS (SELECT o.*, fx.rate FROM o ASOF LEFT JOIN fx ON o.currency = fx.currency AND o.order_date >= fx.rate_date),
fct AS (SELECT l_orderkey AS order_key, l_linenumber AS line_number, p_type AS category, c_mktsegment AS segment, currency, order_date,
  CAST(date_trunc('month', order_date) AS DATE) AS order_month, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(14,2)) AS amount, rate,
  CAST(sign(x) * floor(abs(x) * 100 + 0.5) / 100 AS DECIMAL(14,2)) AS amount_usd
  FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE) / rate AS x FROM lineitem JOIN priced ON l_orderkey = o_orderkey)
  JOIN part ON l_partkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey)"""


FISCAL_YEARS = range(1995, 2002)


def target_sheet(spark: SparkSession, d: str) -> DataFrame:
    """Spreadsheet rows as a connector reads them: a row for each category and year, a text column for each month. The last year was
    loaded twice, and its first load must not count."""
    kinds = table(spark, d, "part").select(F.concat(F.lit(" "), "p_type").alias("category")).distinct()
    scale = F.broadcast(table(spark, d, "orders").agg(F.count("*").alias("orders")))  # one row
    years = F.explode(F.array(*map(F.lit, FISCAL_YEARS))).alias("y")
    rows = kinds.select("category", years).join(scale, how="cross")
    # after its eighth month the last year has no targets
    month = lambda i: F.expr(f"CASE WHEN y < {FISCAL_YEARS[-1]} OR {i} < 8 THEN format_number(orders * (150 + ((y - 1995) * 12 + {i}) * 7919 % 211 + length(category) * 104729 % 97), 0) END")
    sheet = rows.select("category", F.col("y").cast("string").alias("_file_fiscal_year"), F.lit("sheet").alias("_source_file"), F.lit(2).cast("long").alias("_row_number"), *(month(i).alias(m) for i, m in enumerate(MONTHS)))
    old = sheet.where(f"_file_fiscal_year = '{FISCAL_YEARS[-1]}'").withColumns({m: F.lit("1") for m in MONTHS}).withColumn("_ingested_at", F.expr("timestamp'2024-01-01 00:00:00'"))
    return sheet.withColumn("_ingested_at", F.expr(RUN_TS)).unionByName(old)


def sales_targets(spark: SparkSession, d: str) -> DataFrame:
    return reshape.monthly_targets(target_sheet(spark, d), MONTHS, {}).select("fiscal_year", "month_start", "category", "source_label", "target_usd")


TARGETS_CTE = """
targets AS (SELECT category, CAST(m AS DATE) AS month_start,
  CAST((SELECT count(*) FROM orders) * (150 + date_diff('month', DATE '1995-01-01', CAST(m AS DATE)) * 7919 % 211 + (length(category) + 1) * 104729 % 97) AS DECIMAL(18,2)) AS target_usd
  FROM (SELECT DISTINCT p_type AS category FROM part) CROSS JOIN generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 MONTH) t(m))"""
TARGETS_SQL = f"WITH {TARGETS_CTE} SELECT CAST(year(month_start) AS INTEGER) AS fiscal_year, month_start, category, category AS source_label, CAST(target_usd AS DECIMAL(12,2)) AS target_usd FROM targets"


def mart_sales_vs_target(spark: SparkSession, d: str) -> DataFrame:
    inputs = silver(spark, d)
    return _model(spark, d, "mart_sales_vs_target", inputs | {"fct_order_items": fct_order_items(spark, d)}, {"as_of": AS_OF})


# written without the model: sales and targets meet by key, months are judged one by one
MART_CTE = f"""{FCT_CTE},{TARGETS_CTE},
sold AS (SELECT order_month, category, count(DISTINCT order_key) AS orders, sum(quantity) AS units, sum(amount_usd) AS revenue FROM fct WHERE order_date <= DATE '{AS_OF}' GROUP BY order_month, category),
met AS (SELECT coalesce(order_month, month_start) AS m, coalesce(sold.category, targets.category) AS category, coalesce(orders, 0) AS orders, coalesce(units, 0) AS units,
  coalesce(revenue, 0) AS revenue, target_usd AS goal, last_day(coalesce(order_month, month_start)) AS ends FROM sold FULL JOIN targets ON order_month = month_start AND sold.category = targets.category),
dated AS (SELECT *, day(ends) AS n, CASE WHEN ends > DATE '{AS_OF}' THEN day(DATE '{AS_OF}') ELSE day(ends) END AS gone FROM met WHERE m <= DATE '{AS_OF}' AND m >= (SELECT min(order_month) FROM fct)),
pace AS (SELECT *, CAST(floor(CAST(revenue AS DOUBLE) * n / gone * 100 + 0.5) / 100 AS DECIMAL(18,2)) AS projected FROM dated),
mart AS (SELECT m AS month_start, category, CASE WHEN n = gone AND ends <= DATE '{AS_OF}' THEN 'closed' ELSE 'in_progress' END AS period_status, CAST(gone AS INTEGER) AS days_elapsed, CAST(n AS INTEGER) AS days_in_month,
  CAST(orders AS BIGINT) AS orders, CAST(units AS BIGINT) AS units, CAST(revenue AS DECIMAL(18,2)) AS revenue_usd, goal AS target_usd, floor(CAST(revenue AS DOUBLE) / CAST(goal AS DOUBLE) * 10000 + 0.5) / 10000 AS attainment_pct,
  projected AS projected_revenue_usd, floor(CAST(projected AS DOUBLE) / CAST(goal AS DOUBLE) * 10000 + 0.5) / 10000 AS projected_attainment_pct, CAST(revenue - goal AS DECIMAL(18,2)) AS gap_usd,
  CASE WHEN ends <= DATE '{AS_OF}' AND revenue < goal THEN 'missed' WHEN ends <= DATE '{AS_OF}' THEN 'hit' WHEN projected >= goal THEN 'on_track' WHEN CAST(projected AS DOUBLE) < 0.9 * CAST(goal AS DOUBLE) THEN 'behind' ELSE 'at_risk' END AS status FROM pace)"""

_gold: dict[tuple[str, str], dict[str, LakeTable]] = {}


def gold(spark: SparkSession, d: str) -> dict[str, LakeTable]:
    """The models' tables over d, run, tested and written once in a session; reports read them."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _gold:
        _gold[key] = runner.ModelSet.read(MODELS).run(spark, silver(spark, d), fresh_path(spark, "gold"), {"as_of": AS_OF})
    return _gold[key]


def _report(make: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        tables = gold(spark, d)
        return make(tables["mart_sales_vs_target"].read(), tables["fct_order_items"].read())

    return run


def month_totals(mart: DataFrame, fct: DataFrame) -> DataFrame:
    money = lambda c: F.sum(c).cast("decimal(20,2)").alias(c)
    return mart.groupBy("month_start").agg(money("revenue_usd"), money("target_usd"), *(F.any_value(c).alias(c) for c in ("period_status", "days_elapsed", "days_in_month")))


def category_lines(mart: DataFrame, fct: DataFrame) -> DataFrame:
    """Lines of each month, best attainment first; the place is a column, so that the order can be tested."""
    place = F.row_number().over(Window.partitionBy("month_start").orderBy(F.desc("attainment_pct"), "category"))
    return mart.select("month_start", place.alias("place"), "category", "revenue_usd", "target_usd", "attainment_pct", "projected_attainment_pct", "status").orderBy("month_start", "place")


def shortfalls(mart: DataFrame, fct: DataFrame) -> DataFrame:
    """Categories of the latest month that missed, or are about to miss, their target."""
    last = F.broadcast(mart.agg(F.max("month_start").alias("month_start")))  # one row
    short = (F.col("target_usd") - F.col("projected_revenue_usd")).cast("decimal(20,2)").alias("short_usd")
    return mart.join(last, "month_start").where(F.col("status").isin("missed", "behind", "at_risk")).select("category", short, "status").orderBy(F.desc("short_usd"))


def all_months(mart: DataFrame, fct: DataFrame) -> DataFrame:
    """Categories that hit (or are on track for) their target in every month, and those that missed it in every month."""
    verdict = F.when(F.col("status").isin("hit", "on_track"), "hit").when(F.col("status").isin("missed", "behind"), "missed")
    months = F.broadcast(mart.agg(F.countDistinct("month_start").alias("months")))  # one row
    return mart.withColumn("verdict", verdict).where("verdict is not null").groupBy("category", "verdict").agg(F.count("*").alias("n")).join(months, F.col("n") == F.col("months")).select("category", "verdict", "months")


def fx_share(mart: DataFrame, fct: DataFrame) -> DataFrame:
    """Share of revenue booked in each foreign currency."""
    by = fct.groupBy("currency").agg(F.sum("amount_usd").alias("s"))
    whole = F.broadcast(by.agg(F.sum("s").alias("whole")))  # one row
    share = F.floor(F.col("s").cast("double") / F.col("whole").cast("double") * 10000 + 0.5) / 10000
    return by.join(whole, how="cross").where("currency <> 'USD'").select("currency", F.col("s").cast("decimal(20,2)").alias("revenue_usd"), share.alias("share")).orderBy(F.desc("share"))


def _sloped(make: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A report over targets of which two categories always meet theirs and one never does."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        mart = gold(spark, d)["mart_sales_vs_target"].read()
        rank = F.dense_rank().over(Window.orderBy("category"))
        ranks = mart.select("category").distinct().withColumn("k", rank)  # a row for each category
        return make(mart.join(F.broadcast(ranks), "category").withColumn("status", F.expr("CASE WHEN k <= 2 THEN 'hit' WHEN k = 3 THEN 'behind' ELSE status END")), mart)

    return run


REPORTS: dict[str, tuple[Query, str]] = {
    "rpt_month_totals": (_report(month_totals), "SELECT month_start, CAST(sum(revenue_usd) AS DECIMAL(20,2)) AS revenue_usd, CAST(sum(target_usd) AS DECIMAL(20,2)) AS target_usd, max(period_status) AS period_status, max(days_elapsed) AS days_elapsed, max(days_in_month) AS days_in_month FROM mart GROUP BY 1"),
    "rpt_category_lines": (_report(category_lines), "SELECT month_start, CAST(1 + (SELECT count(*) FROM mart o WHERE o.month_start = m.month_start AND (o.attainment_pct > m.attainment_pct OR o.attainment_pct = m.attainment_pct AND o.category < m.category)) AS INTEGER) AS place, category, revenue_usd, target_usd, attainment_pct, projected_attainment_pct, status FROM mart m"),
    "rpt_shortfalls": (_report(shortfalls), f"SELECT category, CAST(target_usd - projected_revenue_usd AS DECIMAL(20,2)) AS short_usd, status FROM mart WHERE month_start = date_trunc('month', DATE '{AS_OF}') AND status NOT IN ('hit', 'on_track')"),
    "rpt_all_months": (_sloped(all_months), "SELECT category, CASE WHEN k <= 2 THEN 'hit' ELSE 'missed' END AS verdict, (SELECT count(DISTINCT month_start) FROM mart) AS months FROM (SELECT category, row_number() OVER (ORDER BY category) AS k FROM (SELECT DISTINCT category FROM mart)) WHERE k <= 3"
      " UNION ALL SELECT category, 'hit', count(*) FROM mart WHERE category NOT IN (SELECT DISTINCT category FROM mart ORDER BY category LIMIT 3) GROUP BY 1 HAVING bool_and(status IN ('hit', 'on_track'))"
      " UNION ALL SELECT category, 'missed', count(*) FROM mart WHERE category NOT IN (SELECT DISTINCT category FROM mart ORDER BY category LIMIT 3) GROUP BY 1 HAVING bool_and(status IN ('missed', 'behind'))"),
    "rpt_fx_share": (_report(fx_share), "SELECT currency, CAST(sum(amount_usd) AS DECIMAL(20,2)) AS revenue_usd, floor(CAST(sum(amount_usd) AS DOUBLE) / (SELECT CAST(sum(amount_usd) AS DOUBLE) FROM fct) * 10000 + 0.5) / 10000 AS share FROM fct WHERE currency <> 'USD' GROUP BY currency"),
}

# --- as-of joins over events --------------------------------------------------------------------------------------------------


def _asof_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, d, "events")
    buys = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.where("event_type = 'click'").groupBy(F.col("user_id").alias("click_user"), F.col("ts").alias("click_ts")).agg(F.max("event_id").alias("click_id"))
    return buys, clicks


def _asof(how: str, small_rows: int) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        buys, clicks = _asof_sides(spark, d)
        return asof_join(buys, clicks, "ts", "click_ts", [("user_id", "click_user")], how, small_rows, "day").select("event_id", "user_id", "click_id")

    return run


def _asof_sql(how: str) -> str:
    return f"SELECT b.event_id, b.user_id, c.click_id FROM (SELECT * FROM events WHERE event_type = 'purchase') b ASOF {how} JOIN (SELECT user_id, ts, max(event_id) AS click_id FROM events WHERE event_type = 'click' GROUP BY ALL) c ON b.user_id = c.user_id AND b.ts >= c.ts"


# --- change capture over events -----------------------------------------------------------------------------------------------

USERS = cdc.TableSpec("users", ("user_id",), {"user_id": "bigint", "event_type": "string", "k": "int"}, history=True)


def messages(spark: SparkSession, d: str) -> DataFrame:
    """events as Kafka rows of change envelopes: errors delete, signups create, the rest update; one tombstone for each delete's key
    is left to the parser, as is a plumbing table."""
    sql = """
      SELECT 'shop.public.users' AS topic, CAST(user_id % 3 AS INT) AS partition, event_id AS offset, concat('{"user_id":', user_id, '}') AS key,
        concat('{"before":', if(op = 'd', row, 'null'), ',"after":', if(op = 'd', 'null', row), ',"source":{"table":"', if(event_id % 97 = 0, 'debezium_signal', 'users'), '","lsn":', event_id * 8, ',"txId":', event_id,
          ',"ts_ms":', ms, ',"snapshot":"', if(op = 'c', 'first', 'false'), '"},"op":"', op, '","ts_ms":', ms + 5, '}') AS value
      FROM (SELECT *, CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op, unix_millis(CAST(ts AS TIMESTAMP)) AS ms,
        concat('{"user_id":', user_id, ',"event_type":"', event_type, '","k":', get_json_object(props, '$.k'), '}') AS row FROM {events})"""
    return spark.sql(sql.replace("{", "{{").replace("}", "}}").replace("{{events}}", "{events}"), events=table(spark, d, "events"))


def bronze(spark: SparkSession, d: str) -> DataFrame:
    return parse_envelope(messages(spark, d), F.expr(RUN_TS))


def typed(spark: SparkSession, d: str) -> DataFrame:
    return cdc.typed_events(bronze(spark, d), USERS, F.expr(RUN_TS))


BRONZE_CTE = """b AS (SELECT *, CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op, epoch_us(ts) // 1000 AS ms,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_id % 97 <> 0)"""
VERSIONS_CTE = f"{BRONZE_CTE}, v AS (SELECT * FROM (SELECT user_id, event_type, k, ms AS valid_from, lead(ms) OVER (PARTITION BY user_id ORDER BY event_id) AS valid_to, event_id AS seq, op FROM b) WHERE op <> 'd')"


def debezium_parse(spark: SparkSession, d: str) -> DataFrame:
    return bronze(spark, d).select("op", "record_key", "before", "after", "source_table", "source_lsn", "source_txid", "source_ts_ms", "is_snapshot", "event_ts_ms", "kafka_partition", "kafka_offset")


_ROW = """concat('{"event_type":"', event_type, '","k":', k, ',"user_id":', user_id, '}')"""
DEBEZIUM_SQL = f"""WITH {BRONZE_CTE} SELECT op, concat('{{"user_id":', user_id, '}}') AS record_key, CASE WHEN op = 'd' THEN {_ROW} END AS before, CASE WHEN op <> 'd' THEN {_ROW} END AS after,
  'users' AS source_table, event_id * 8 AS source_lsn, event_id AS source_txid, ms AS source_ts_ms, op = 'c' AS is_snapshot, ms + 5 AS event_ts_ms, CAST(user_id % 3 AS INTEGER) AS kafka_partition, event_id AS kafka_offset FROM b"""


def _current(state: DataFrame) -> DataFrame:
    return state.select("user_id", "event_type", "k", F.col("_is_deleted").alias("is_deleted"), F.col("_op").alias("op"), F.col("_seq").alias("seq"), F.unix_millis("_source_ts").alias("source_ms"))


def _history(state: DataFrame) -> DataFrame:
    return state.select("user_id", "event_type", "k", F.unix_millis("_valid_from").alias("valid_from"), F.unix_millis("_valid_to").alias("valid_to"), F.col("_is_current").alias("is_current"), F.col("_seq").alias("seq"), F.col("_op").alias("op"))


def cdc_current_state(spark: SparkSession, d: str) -> DataFrame:
    return _current(cdc.latest_per_key(typed(spark, d), ["user_id"], ["_seq"]))


def cdc_history_scd2(spark: SparkSession, d: str) -> DataFrame:
    return _history(cdc.versions(typed(spark, d), USERS))


def cdc_close_rows(spark: SparkSession, d: str) -> DataFrame:
    return cdc.close_rows(typed(spark, d), USERS).select("user_id", F.unix_millis("_valid_to").alias("valid_to"), F.col("_seq").alias("seq"))


def scd2_merge_source(spark: SparkSession, d: str) -> DataFrame:
    return cdc.merge_source(typed(spark, d), USERS).select("user_id", "event_type", "k", F.unix_millis("_valid_to").alias("valid_to"), F.col("_seq").alias("seq"), F.col("_action").alias("action"))


def _batches(spark: SparkSession, d: str, history: bool) -> DataFrame:
    """Three batches by offset, the second twice and the third overlapping it, applied to a table."""
    raw = bronze(spark, d)
    lake = LakeTable(spark, fresh_path(spark, "history" if history else "current"))
    step = apply.apply_history if history else apply.apply_current
    top = raw.agg(F.max("kafka_offset")).first()[0] or 0
    for low, high in ((0, top // 3), (top // 3, 2 * top // 3), (top // 3, 2 * top // 3), (top // 2, top)):
        step(USERS, raw.where(F.col("kafka_offset").between(low, high)), lake, F.expr(RUN_TS))
    return lake.read()


def cdc_incremental_equals_full(spark: SparkSession, d: str) -> DataFrame:
    return _current(_batches(spark, d, False))


def cdc_incremental_history(spark: SparkSession, d: str) -> DataFrame:
    return _history(_batches(spark, d, True))


def cdc_drop_replayed(spark: SparkSession, d: str) -> DataFrame:
    raw = bronze(spark, d)
    committed = cdc.max_offsets(raw.where("kafka_offset < 1000 and kafka_partition < 2"))
    return cdc.drop_written(raw, committed).groupBy("kafka_partition").agg(F.count("*").alias("kept"), F.max("kafka_offset").alias("max_offset"))


CURRENT_SQL = f"WITH {BRONZE_CTE} SELECT user_id, event_type, k, op = 'd' AS is_deleted, op, event_id AS seq, ms AS source_ms FROM b QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"
HISTORY_SQL = f"WITH {VERSIONS_CTE} SELECT user_id, event_type, k, valid_from, valid_to, valid_to IS NULL AS is_current, seq, op FROM v"
CLOSE_SQL = f"WITH {BRONZE_CTE} SELECT user_id, min(ms) AS valid_to, min(event_id) AS seq FROM b GROUP BY user_id"
MERGE_SQL = f"WITH {VERSIONS_CTE} SELECT user_id, NULL AS event_type, NULL AS k, min(ms) AS valid_to, min(event_id) AS seq, 'close' AS action FROM b GROUP BY user_id UNION ALL SELECT user_id, event_type, k, valid_to, seq, 'insert' FROM v"
REPLAY_SQL = f"""WITH {BRONZE_CTE}, m AS (SELECT user_id % 3 AS p, max(event_id) AS top FROM b WHERE event_id < 1000 AND user_id % 3 < 2 GROUP BY 1)
  SELECT CAST(user_id % 3 AS INTEGER) AS kafka_partition, count(*) AS kept, max(event_id) AS max_offset FROM b LEFT JOIN m ON p = user_id % 3 WHERE event_id > coalesce(top, -1) GROUP BY 1"""

# --- reference data -----------------------------------------------------------------------------------------------------------

def _wide(spark: SparkSession, d: str) -> DataFrame:
    """Order counts by year and priority, a column for each month (null where none), as text."""
    orders = table(spark, d, "orders").selectExpr("year(o_orderdate) AS fiscal_year", "o_orderpriority AS label", "month(o_orderdate) AS m")
    wide = orders.groupBy("fiscal_year", "label").pivot("m", list(range(1, 13))).count()
    return wide.select("fiscal_year", "label", *(F.col(str(i + 1)).cast("string").alias(x) for i, x in enumerate(MONTHS)))


ALIASES = {"1-URGENT": "urgent", "2-HIGH": "high"}


def unpivot_targets(spark: SparkSession, d: str) -> DataFrame:
    long = reshape.unpivot(_wide(spark, d), ["fiscal_year", "label"], MONTHS, "month_name", "raw")
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.col("month_name"))
    return long.select("label", F.make_date("fiscal_year", month.cast("int"), F.lit(1)).alias("month_start"), F.col("raw").cast("decimal(12,2)").alias("target"))


def alias_lookup(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").selectExpr("concat(' ', o_orderpriority, ' ') AS label")
    return reshape.alias_lookup(orders, "label", ALIASES, "category").groupBy("category").agg(F.count("*").alias("n"))


def newest_file_wins(spark: SparkSession, d: str) -> DataFrame:
    loads = table(spark, d, "orders").selectExpr("o_orderkey", "o_orderpriority", "CAST(o_orderdate AS DATE) AS loaded")
    return reshape.newest_load(loads, ["o_orderpriority"], "loaded")


def fx_flatten_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Two payloads for each brand of part; the newer wins for each day and currency."""
    parts = table(spark, d, "part").selectExpr("p_partkey", "p_brand", "CAST(p_partkey % 5 + 1 AS INT) AS day", "p_size")
    payloads = parts.selectExpr("""concat('{"base":"', p_brand, '","rates":{"2026-09-0', day, '":{"EUR":', p_size, '.5,"IDR":', p_size * 100, '.0}}}') AS payload""", "p_partkey AS loaded")
    flat = reshape.flatten_rates(payloads, "payload", "loaded")
    return reshape.newest_wins(flat, ["rate_date", "base_currency", "currency"], [F.desc("loaded")])


UNPIVOT_SQL = "SELECT o_orderpriority AS label, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, CAST(count(*) AS DECIMAL(12,2)) AS target FROM orders GROUP BY ALL"
ALIAS_SQL = "SELECT coalesce(a, trim(o_orderpriority)) AS category, count(*) AS n FROM orders LEFT JOIN (VALUES ('1-URGENT', 'urgent'), ('2-HIGH', 'high')) t(l, a) ON l = trim(o_orderpriority) GROUP BY 1"
NEWEST_SQL = "SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS loaded FROM orders QUALIFY CAST(o_orderdate AS DATE) = max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_orderpriority)"
FLATTEN_SQL = """WITH f AS (SELECT make_date(2026, 9, CAST(p_partkey % 5 + 1 AS INTEGER)) AS rate_date, p_brand AS base_currency, currency, CASE currency WHEN 'EUR' THEN p_size + 0.5 ELSE p_size * 100 END::DOUBLE AS rate, p_partkey AS loaded
  FROM part CROSS JOIN (VALUES ('EUR'), ('IDR')) c(currency)) SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY rate_date, base_currency, currency ORDER BY loaded DESC) = 1"""

# --- quality ------------------------------------------------------------------------------------------------------------------


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")


def dq_checks(spark: SparkSession, d: str) -> DataFrame:
    """Violations of every check, over a current state and a history that were damaged on purpose."""
    rows = materialise(typed(spark, d), "typed")  # six checks, one parse
    current = cdc.latest_per_key(rows, ["user_id"], ["_seq"])
    history = cdc.versions(rows, USERS)
    hurt = history.withColumn("_is_current", F.col("_is_current") | (F.col("_seq") % 500 == 0)).withColumn("_valid_to", F.when(F.col("_seq") % 700 == 0, F.col("_valid_from") - F.expr("interval 1 day")).otherwise(F.col("_valid_to")))
    checks = {"pk_unique": quality.duplicate_keys(rows, ["user_id"]), "pk_not_null": quality.null_keys(rows.withColumn("user_id", F.expr("nullif(user_id, 7)")), ["user_id"])}
    checks |= quality.history_checks(hurt, current, ["user_id"])
    out = None
    for name, df in checks.items():
        one = _count(df, name)
        out = one if out is None else out.unionByName(one)
    return out


DQ_SQL = f"""WITH {VERSIONS_CTE}, h AS (SELECT user_id, valid_from, CASE WHEN seq % 700 = 0 THEN valid_from - 86400000 ELSE valid_to END AS valid_to, valid_to IS NULL OR seq % 500 = 0 AS is_current FROM v),
  live AS (SELECT user_id FROM (SELECT user_id, op FROM b QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) WHERE op <> 'd')
SELECT 'pk_unique' AS "check", count(*) AS violations FROM (SELECT user_id FROM b GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'pk_not_null', count(*) FROM b WHERE user_id = 7
UNION ALL SELECT 'scd2_one_current_version', count(*) FROM (SELECT user_id FROM h WHERE is_current GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'scd2_valid_interval', count(*) FROM h WHERE valid_to < valid_from
UNION ALL SELECT 'scd2_open_iff_current', count(*) FROM h WHERE is_current <> (valid_to IS NULL)
UNION ALL SELECT 'scd2_matches_current_state', count(*) FROM (SELECT user_id FROM h WHERE is_current) x FULL JOIN live y ON x.user_id = y.user_id WHERE x.user_id IS NULL OR y.user_id IS NULL"""


def _model_test(test: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "nullif(l_returnflag, 'R') AS flag", "l_quantity")
        declared = runner.Test.parse(test)
        bad = spark.sql(declared.sql.replace("gold.tested", "{tested}"), tested=rows) if declared.sql else declared.violations(spark, rows, str)
        return _count(bad, test)

    return run


MODEL_TESTS = {
    "model_test_unique": ("unique(l_orderkey, l_linenumber)", "SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
    "model_test_not_null": ("not_null(flag)", "SELECT 1 FROM lineitem WHERE l_returnflag = 'R'"),
    "model_test_assert_empty": ("assert_empty: SELECT * FROM gold.tested WHERE l_quantity > 45", "SELECT 1 FROM lineitem WHERE l_quantity > 45"),
}


def reconcile_orders(spark: SparkSession, d: str) -> DataFrame:
    source = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    copy = source.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.expr("if(o_orderkey % 13 = 0, 'X', o_orderstatus)"))
    extra = source.where("o_orderkey % 17 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return quality.reconcile(source, copy.unionByName(extra), ["o_orderkey"])


RECONCILE_SQL = """SELECT o_orderkey, 'missing' AS status FROM orders WHERE o_orderkey % 11 = 0 UNION ALL SELECT o_orderkey, 'mismatched' FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0
UNION ALL SELECT -o_orderkey - 1, 'extra' FROM orders WHERE o_orderkey % 17 = 0"""


def infer_column_types(spark: SparkSession, d: str) -> DataFrame:
    text = table(spark, d, "orders").selectExpr("CAST(o_orderkey AS STRING) AS a", "CAST(o_totalprice AS STRING) AS b", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS c", "o_orderpriority AS d", "lpad(CAST(o_orderkey AS STRING), 12, '0') AS e", "if(o_orderkey % 2 = 0, 'true', 'False') AS f", "CAST(o_orderdate AS STRING) AS g")
    return spark.createDataFrame(sorted(infer_types(text).items()), "name string, type string")


INFER_SQL = "SELECT * FROM (VALUES ('a', 'BIGINT'), ('b', 'DOUBLE'), ('c', 'DATE'), ('d', 'VARCHAR'), ('e', 'VARCHAR'), ('f', 'BOOLEAN'), ('g', 'TIMESTAMP')) t(name, type)"


def lineage_edges(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(runner.ModelSet.read(MODELS).edges(), "upstream string, downstream string")


LINEAGE_SQL = """SELECT * FROM (VALUES ('silver.shop_orders', 'gold.fct_order_items'), ('silver.shop_order_items', 'gold.fct_order_items'), ('silver.shop_products', 'gold.fct_order_items'), ('silver.shop_customers', 'gold.fct_order_items'),
  ('silver.api_fx_rates', 'gold.fct_order_items'), ('gold.fct_order_items', 'gold.mart_sales_vs_target'), ('silver.targets_sales', 'gold.mart_sales_vs_target')) t(upstream, downstream)"""


def cdc_replay_noop(spark: SparkSession, d: str) -> DataFrame:
    """The same events twice: what the second run read and wrote, beside the first."""
    raw, out = bronze(spark, d), []
    for kind, step in (("current", apply.apply_current), ("history", apply.apply_history)):
        lake = LakeTable(spark, fresh_path(spark, kind))
        for run in (1, 2):
            done = step(USERS, raw, lake, F.expr(RUN_TS))
            out.append((kind, run, done.events, done.inserted, lake.head().version))
    return spark.createDataFrame(out, "kind string, run int, events bigint, inserted bigint, version int")


REPLAY_NOOP_SQL = f"""WITH {VERSIONS_CTE}, n AS (SELECT (SELECT count(*) FROM b) AS events, (SELECT count(DISTINCT user_id) FROM b) AS keys, (SELECT count(*) FROM v) AS rows)
SELECT 'current' AS kind, 1 AS run, events, keys AS inserted, 0 AS version FROM n UNION ALL SELECT 'current', 2, 0, 0, 0 FROM n UNION ALL SELECT 'history', 1, events, rows, 0 FROM n UNION ALL SELECT 'history', 2, 0, 0, 0 FROM n"""


def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """Nations written as a delimited file with quotes and null words, read back by the connector into a raw table, twice."""
    rows = table(spark, d, "nation").orderBy("n_nationkey").select("n_nationkey", "n_name").collect()  # 25 rows
    text = "Key;Name;Note\n" + "".join(f'{r[0]};"{r[1]}; ""x""";{"NA" if r[0] % 2 else chr(34) + "NA" + chr(34)}\n' for r in rows)
    folder = fresh_path(spark, "landing")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(folder)
    found = spi.create("csv", spark, {"location": folder, "pattern": r"part-.*\.txt$", "delimiter": ";", "null_values": ("NA",)})
    lake = LakeTable(spark, fresh_path(spark, "raw"))
    for _ in range(2):  # the second run finds nothing new
        raw.ingest_files(found, lake, datetime.datetime(2024, 2, 1))
    return lake.read().select(F.col("key").cast("bigint").alias("n_nationkey"), "name", "note", F.col("_row_number").alias("row_number"))


CSV_SQL = """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name || '; "x"' AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'NA' END AS note, 1 + row_number() OVER (ORDER BY n_nationkey) AS row_number FROM nation"""


def xlsx_scan(spark: SparkSession, d: str) -> DataFrame:
    """Regions as a workbook with a title above the header and a total below, read back by the connector."""
    rows = table(spark, d, "region").orderBy("r_regionkey").select("r_regionkey", "r_name").collect()  # 5 rows
    sheet = [["Regions"], [None], ["Key", "Name", "Sum"], *([r[0] + 0.0, f" {r[1]} ", 1] for r in rows), ["Total", None, 5]]
    settings = pipelines.Settings.load({"TIDEMARK_ROOT": fresh_path(spark, "lake")})
    with tempfile.TemporaryDirectory() as folder:  # the driver's own; the workbook is copied to the shared landing area
        files.write_xlsx(f"{folder}/regions_2024.xlsx", {"Notes": [["x"]], "Data": sheet}, hidden=("Notes",))
        pipelines.upload(spark, Path(folder) / "regions_2024.xlsx", "in", settings)
    found = spi.create("excel", spark, {"location": f"{settings.landing}/in", "pattern": r"regions_(?P<year>\d+)", "header_row_contains": "Name", "stop_at_first_cell": "Total", "ignore_columns": ("Sum",)})
    [batch] = found.incremental(None)
    return batch.rows.select(F.col("key").cast("bigint").alias("r_regionkey"), F.col("name").alias("r_name"), F.col("_row_number").alias("row_number"), F.col("_file_year").alias("year"))


XLSX_SQL = "SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name, 3 + row_number() OVER (ORDER BY r_regionkey) AS row_number, '2024' AS year FROM region"


def mode_recommend(spark: SparkSession, d: str) -> DataFrame:
    """The mode for sources of each ability over tables with a key and a moving column, with a key alone, and without either."""
    moving, key = spi.Column("updated_at", "TIMESTAMP"), spi.Column("id", "BIGINT")
    shapes = {"moving": spi.DatasetSchema((key, moving), ("id",)), "keyed": spi.DatasetSchema((key, spi.Column("created_at", "TIMESTAMP")), ("id",)), "bare": spi.DatasetSchema((key,))}
    able = {"cdc": spi.Capabilities(cdc=True), "cursor": spi.Capabilities(cursor=True), "files": spi.Capabilities(files=True), "plain": spi.Capabilities()}
    rows = [(a, n, (r := spi.recommend(c, x)).mode.value, r.cursor) for a, c in able.items() for n, x in shapes.items()]
    return spark.createDataFrame(rows, "ability string, shape string, mode string, cursor string")


MODES_SQL = """SELECT a.ability, s.shape, CASE WHEN ability = 'cdc' AND shape <> 'bare' THEN 'cdc' WHEN ability = 'files' OR ability = 'cursor' AND shape = 'moving' THEN 'incremental'
  WHEN shape <> 'bare' THEN 'snapshot_diff' ELSE 'full' END AS mode, CASE WHEN ability = 'cursor' AND shape = 'moving' THEN 'updated_at' END AS cursor
FROM (VALUES ('cdc'), ('cursor'), ('files'), ('plain')) a(ability) CROSS JOIN (VALUES ('moving'), ('keyed'), ('bare')) s(shape)"""


def rest_window(spark: SparkSession, d: str) -> DataFrame:
    """Payloads of two windows appended to a raw table and flattened, the later payload first; the answers are made here."""
    lake = LakeTable(spark, fresh_path(spark, "raw"))
    for n, as_of in ((1, datetime.date(2024, 2, 3)), (2, datetime.date(2024, 2, 4))):
        body = '{"base":"USD","rates":{"2024-02-03":{"EUR":0.%d},"2024-02-0%d":{"GBP":0.7}}}' % (n, n)
        raw.ingest_window(spark, lake, "http://x/{start}..{end}", as_of, datetime.datetime(2024, 2, n), 2, fetch=lambda url, params, b=body: (b, url))
    flat = reshape.flatten_rates(lake.read().withColumn("from", F.element_at(F.split("request_url", "/"), -1)), "payload", "_ingested_at")
    return reshape.newest_wins(flat, ["rate_date", "base_currency", "currency"], [F.desc("_ingested_at")]).select("rate_date", "currency", "rate")


REST_SQL = "SELECT CAST(d AS DATE) AS rate_date, c AS currency, CAST(r AS DOUBLE) AS rate FROM (VALUES ('2024-02-03', 'EUR', 0.2), ('2024-02-01', 'GBP', 0.7), ('2024-02-02', 'GBP', 0.7)) t(d, c, r)"


def stream_bronze(spark: SparkSession, d: str) -> DataFrame:
    """Every message streamed into raw tables, and streamed again under another checkpoint, which must add nothing."""
    landing, root = fresh_path(spark, "messages"), fresh_path(spark, "bronze")
    messages(spark, d).selectExpr("topic", "partition", "offset", "key", "value").write.json(landing)
    for _ in range(2):
        stream = spark.readStream.schema(streams.MESSAGES).json(landing)
        streams.start(stream, root, fresh_path(spark, "checkpoint"), lambda: F.expr(RUN_TS), once=True).awaitTermination()
    return LakeTable(spark, f"{root}/shop/users_cdc").read().groupBy("kafka_partition").agg(F.count("*").alias("events"), F.max("kafka_offset").alias("max_offset"), F.max("ingest_date").alias("ingest_date"))


STREAM_SQL = f"WITH {BRONZE_CTE} SELECT CAST(user_id % 3 AS INTEGER) AS kafka_partition, count(*) AS events, max(event_id) AS max_offset, DATE '2024-02-01' AS ingest_date FROM b GROUP BY 1"


def sql_type_names(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(sorted(sql_types(table(spark, d, "orders").selectExpr("o_orderkey", "o_orderpriority", "CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice", "o_orderdate IS NULL AS b", "CAST(o_orderdate AS DATE) AS c").schema).items()), "name string, type string")


SQL_TYPES_SQL = "SELECT column_name AS name, column_type AS type FROM (DESCRIBE SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate IS NULL AS b, CAST(o_orderdate AS DATE) AS c FROM orders)"


_PLAIN: dict[str, tuple[Query, str | None]] = {
    "fct_order_items": (fct_order_items, f"WITH {FCT_CTE} SELECT * FROM fct"),
    "asof_backward": (_asof("left", 100_000), _asof_sql("LEFT")),
    "asof_inner": (_asof("inner", 100_000), _asof_sql("")),
    "asof_backward_large": (_asof("left", 0), _asof_sql("LEFT")),
    "debezium_parse": (debezium_parse, DEBEZIUM_SQL),
    "cdc_current_state": (cdc_current_state, CURRENT_SQL),
    "cdc_history_scd2": (cdc_history_scd2, HISTORY_SQL),
    "cdc_close_rows": (cdc_close_rows, CLOSE_SQL),
    "scd2_merge_source": (scd2_merge_source, MERGE_SQL),
    "cdc_incremental_equals_full": (cdc_incremental_equals_full, CURRENT_SQL),
    "cdc_incremental_history": (cdc_incremental_history, HISTORY_SQL),
    "cdc_drop_replayed": (cdc_drop_replayed, REPLAY_SQL),
    "unpivot_targets": (unpivot_targets, UNPIVOT_SQL),
    "alias_lookup": (alias_lookup, ALIAS_SQL),
    "newest_file_wins": (newest_file_wins, NEWEST_SQL),
    "fx_flatten_dedup": (fx_flatten_dedup, FLATTEN_SQL),
    "dq_checks": (dq_checks, DQ_SQL),
    "reconcile_orders": (reconcile_orders, RECONCILE_SQL),
    "infer_types": (infer_column_types, INFER_SQL),
    "lineage_edges": (lineage_edges, LINEAGE_SQL),
    "sales_targets": (sales_targets, TARGETS_SQL),
    "cdc_replay_noop": (cdc_replay_noop, REPLAY_NOOP_SQL),
    "csv_scan": (csv_scan, CSV_SQL),
    "sql_types": (sql_type_names, SQL_TYPES_SQL),
    "xlsx_scan": (xlsx_scan, XLSX_SQL),
    "mode_recommend": (mode_recommend, MODES_SQL),
    "rest_window": (rest_window, REST_SQL),
    "stream_bronze": (stream_bronze, STREAM_SQL),
}


def _registered() -> dict[str, tuple[Query, str | None]]:
    mart = {"mart_sales_vs_target": (mart_sales_vs_target, f"WITH {MART_CTE} SELECT * FROM mart")}
    reports = {n: (run, f"WITH {MART_CTE} {sql}") for n, (run, sql) in REPORTS.items()}
    tests = {n: (_model_test(test), f"SELECT '{test}' AS \"check\", count(*) AS violations FROM ({sql})") for n, (test, sql) in MODEL_TESTS.items()}
    return _PLAIN | mart | reports | tests


def queries() -> dict[str, Query]:
    return {n: q for n, (q, _) in _registered().items()}


def oracle_sql() -> dict[str, str]:
    return {n: sql for n, (_, sql) in _registered().items() if sql}
