import datetime
import urllib.error

import pytest
from pyspark.sql import functions as F

from tidemark import catalogue
from tidemark.functions.inference import infer_types, sql_types
from tidemark.operators import cdc
from tidemark.plans import pipelines, runner
from tidemark.sources import envelope, files, rest, spi
from tidemark.streaming import bronze


def test_csv_dialect():
    text = 'Code;Name;Country;Price;Price\n007;"Müller; GmbH";"NA";1,5;2\n008;;DE;;3\n'
    names, rows = files.parse_csv(text.encode("latin-1"), files.CsvConfig("x", delimiter=";", encoding="latin-1", null_values=("", "NA")))
    assert names == ["code", "name", "country", "price", "price_2"]
    assert rows == [(2, ["007", "Müller; GmbH", "NA", "1,5", "2"]), (3, ["008", None, "DE", None, "3"])]
    assert files.parse_csv(b"1,x\n2,y", files.CsvConfig("x", header_row=0)) == (["column_1", "column_2"], [(1, ["1", "x"]), (2, ["2", "y"])])
    with pytest.raises(spi.ConnectorError, match="header line 5"):
        files.parse_csv(b"a,b\n", files.CsvConfig("x", header_row=5))
    with pytest.raises(spi.ConnectorError, match="line 2"):
        files.parse_csv(b"a,b\n1\n", files.CsvConfig("x"))


def test_csv_takes_what_csv_allows():
    data = 'a,b\n5" pipe,x\n\n"two\nlines",y\x0c\u2028z\n'.encode()
    assert files.parse_csv(data, files.CsvConfig("x")) == (["a", "b"], [(2, ['5" pipe', "x"]), (3, ["two\nlines", "y\x0c\u2028z"])])
    with pytest.raises(spi.ConnectorError, match="not readable as utf-8"):
        files.parse_csv(b"a,b\n\xff,1\n", files.CsvConfig("x"))
    with pytest.raises(spi.ConnectorError):
        files.parse_csv(b"a,b\n1,2\n", files.CsvConfig("x", encoding="no-such"))


def test_headers():
    assert files.unique_names(["Amount", "amount ", "%", "Note"]) == ["amount", "amount_2", "column_3", "note"]


def test_excel_and_incremental(spark, tmp_path):
    rows = [["Targets"], ["Owner: x"], [None], ["Category", "Jan", "FY Total"], ["Electronics", "32,000", None], ["Home & Living", 10, None], ["Total", 1, None]]
    files.write_xlsx(str(tmp_path / "sales_2026.xlsx"), {"Targets": rows, "Lookups": [["a"]]}, hidden=("Lookups",))
    config = {"location": f"file://{tmp_path}", "pattern": r"sales_(?P<fiscal_year>\d+)\.xlsx", "sheet": "Targets", "header_row_contains": "Category", "stop_at_first_cell": "Total", "ignore_columns": ("FY Total",)}
    c = spi.create("excel", spark, config)
    assert [(s.name, s.visible) for s in c.streams()] == [("Targets", True), ("Lookups", False)] and c.default_stream().name == "Targets"
    [batch] = c.incremental(None)
    got = batch.rows.orderBy("_row_number").collect()
    assert [(r["_row_number"], r["category"], r["jan"], r["_file_fiscal_year"]) for r in got] == [(5, "Electronics", "32,000", "2026"), (6, "Home & Living", "10", "2026")]
    assert list(c.incremental(batch.state)) == []
    with pytest.raises(spi.ConnectorError, match="no sheet"):
        files.read_sheet((tmp_path / "sales_2026.xlsx").read_bytes(), "March")


def test_configuration(spark):
    with pytest.raises(spi.ConfigurationError, match="unknown settings: delimeter"):
        spi.create("csv", spark, {"location": "x", "delimeter": ";"})
    with pytest.raises(spi.ConfigurationError, match="unknown connector"):
        spi.create("fax", spark, {})
    assert spi.masked({"a": {"password": "x", "b": [{"access_key": "y"}]}}) == {"a": {"password": "***", "b": [{"access_key": "***"}]}}
    with pytest.raises(ValueError, match="taken"):
        spi.register(files.CsvConnector)


def test_recommender():
    keyed = spi.DatasetSchema((spi.Column("id", "BIGINT"), spi.Column("updated_at", "TIMESTAMP")), ("id",))
    bare = spi.DatasetSchema((spi.Column("id", "BIGINT"),))
    plain = spi.DatasetSchema((spi.Column("id", "BIGINT"),), ("id",))
    created = spi.DatasetSchema((spi.Column("id", "BIGINT"), spi.Column("created_at", "TIMESTAMP"), spi.Column("modified_on", "date")))
    assert spi.cursor_column(created) == "modified_on" and spi.cursor_column(spi.DatasetSchema(created.columns[:2])) is None
    assert spi.recommend(spi.Capabilities(cdc=True), keyed).mode is spi.Mode.CDC
    assert spi.recommend(spi.Capabilities(cdc=True), bare).mode is spi.Mode.FULL
    assert spi.recommend(spi.Capabilities(cursor=True), keyed).cursor == "updated_at"
    assert spi.recommend(spi.Capabilities(cursor=True), plain).mode is spi.Mode.SNAPSHOT_DIFF
    assert spi.recommend(spi.Capabilities(files=True), bare).mode is spi.Mode.INCREMENTAL


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1", "-2", None, " "], "BIGINT"), (["1.5", "2"], "DOUBLE"), (["007", "12"], "VARCHAR"), (["true", "False"], "BOOLEAN"), (["2026-01-05"], "DATE"),
        (["2026-01-05 10:00:00", "2026-01-05T11:00:00"], "TIMESTAMP"), (["2026-01-05T10:00:00Z", "2026-01-05 10:00:00+07:00"], "TIMESTAMP WITH TIME ZONE"),
        (["32,000", "1"], "VARCHAR"), ([None], "VARCHAR"), (["1.5d"], "VARCHAR"), (["2026-01"], "VARCHAR"), (["10:00"], "VARCHAR"),
    ],
)
def test_inference(spark, values, kind):
    assert infer_types(spark.createDataFrame([(v,) for v in values], "x string")) == {"x": kind}


def test_rest_retries_and_window(spark):
    calls, waits = [], []

    def opener(url):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.HTTPError(url, 503, "busy", None, None)
        return "{}"

    assert rest.fetch_json("http://x", {"a": "1"}, opener=opener, sleep=waits.append) == ("{}", "http://x?a=1")
    assert waits == [2.0, 4.0]
    with pytest.raises(spi.ConnectorError, match="not JSON"):
        rest.fetch_json("http://x", opener=lambda u: "<html>")
    row = rest.fetch_window(spark, "http://x/{start}..{end}", datetime.date(2026, 9, 8), datetime.datetime(2026, 9, 8), fetch=lambda u, p: ("{}", u)).first()
    assert row["request_url"] == "http://x/2026-09-01..2026-09-08"


def test_models(spark, tmp_path):
    a = runner.Model.parse("a", "-- base\n-- test: unique(id)\nSELECT * FROM silver.shop_x -- not gold.c\nWHERE 'gold.d' <> ''")
    b = runner.Model.parse("b", "-- test: assert_empty: SELECT * FROM gold.b WHERE id > 1\nSELECT id FROM gold.a WHERE id < :top")
    models = runner.ModelSet([b, a])
    assert [m.name for m in models.order()] == ["a", "b"] and a.description == "base"
    assert models.edges() == [("gold.a", "gold.b"), ("silver.shop_x", "gold.a")]
    with pytest.raises(runner.QualityError, match="b: assert_empty"):
        models.run(spark, {"shop_x": spark.range(4)}, f"file://{tmp_path}", {"top": 9})
    assert runner.LakeTable(spark, f"file://{tmp_path}/a").read().count() == 4 and not runner.LakeTable(spark, f"file://{tmp_path}/b").exists()
    assert models.run(spark, {"shop_x": spark.range(4)}, f"file://{tmp_path}", {"top": 2})["b"].read().count() == 2
    assert not [t for t in spark.catalog.listTables() if "shop_x" in t.name]
    with pytest.raises(ValueError, match="unknown models"):
        runner.ModelSet([b]).order()
    with pytest.raises(ValueError, match="unknown test"):
        runner.Test.parse("nope(a)")
    assert runner.Ref("silver", "shop_order_items").path("/r") == "/r/shop/order_items" and runner.Ref("gold", "a_b").path("/r/") == "/r/a_b"


def test_mart_follows_its_rules(spark):
    """Targets without sales, sales after the day, an open month, and a category without a target."""
    day = datetime.date
    fct = spark.createDataFrame([(1, day(2026, 8, 3), "x", 5, 90.0), (2, day(2026, 8, 9), "x", 1, 20.0), (3, day(2026, 9, 2), "x", 1, 40.0), (4, day(2026, 9, 20), "x", 9, 999.0), (5, day(2026, 8, 3), "lost", 1, 5.0)], "order_key int, order_date date, category string, quantity bigint, amount double")
    fct = fct.withColumn("order_month", F.trunc("order_date", "month")).withColumn("amount_usd", F.col("amount").cast("decimal(14,2)"))
    goals = spark.createDataFrame([(day(2026, m, 1), c, g) for m, c, g in ((7, "x", 5), (8, "x", 100), (9, "x", 130), (9, "y", 7), (10, "x", 1))], "month_start date, category string, target_usd int")
    inputs = {"fct_order_items": fct, "targets_sales": goals.withColumn("target_usd", F.col("target_usd").cast("decimal(18,2)"))}
    got = {(r["month_start"].month, r["category"]): r for r in catalogue._model(spark, "", "mart_sales_vs_target", inputs, {"as_of": day(2026, 9, 10)}).collect()}
    assert set(got) == {(8, "x"), (8, "lost"), (9, "x"), (9, "y")}
    assert (got[8, "x"]["status"], float(got[8, "x"]["revenue_usd"]), got[8, "x"]["units"], got[8, "x"]["orders"], got[8, "x"]["attainment_pct"]) == ("hit", 110.0, 6, 2, 1.1)
    assert (got[9, "x"]["status"], float(got[9, "x"]["projected_revenue_usd"]), got[9, "x"]["days_elapsed"], got[9, "x"]["days_in_month"]) == ("at_risk", 120.0, 10, 30)
    assert (got[9, "y"]["status"], got[9, "y"]["orders"], got[9, "y"]["period_status"]) == ("behind", 0, "in_progress") and got[8, "lost"]["target_usd"] is None


def test_layers_from_landing_to_gold(spark, tmp_path):
    """Upload, ingest, build reference tables and models, as the command line does."""
    settings = pipelines.Settings.load({"TIDEMARK_ROOT": f"file://{tmp_path}/lake"})
    assert settings.gold == f"file://{tmp_path}/lake/gold" and settings.store_conf() == {}
    stored = pipelines.Settings.load({"TIDEMARK_STORE_ENDPOINT": "http://s", "TIDEMARK_STORE_SECRET_KEY": "k"})
    assert stored.store_conf()["spark.hadoop.fs.s3a.secret.key"] == "k" and "'k'" not in repr(stored)
    text = "sources:\n  sales_targets:\n    type: excel\n    landing_prefix: sheets/\n    file_pattern: 'targets_(?P<fiscal_year>[0-9]{4})'\n    header_row_contains: Category\n    category_aliases: {Home & Living: Home}\n  fx_rates:\n    type: rest_api\n    url: http://x/{start}..{end}\n    lookback_days: 3\n"
    sources = pipelines.declared(text)
    with pytest.raises(spi.ConfigurationError, match="type is missing"):
        pipelines.declared("sources: {a: {}}")
    files.write_xlsx(str(tmp_path / "targets_2026.xlsx"), {"S": [["Category", *pipelines.MONTHS], ["Home & Living", "32,000", *[None] * 10, 7], ["Toys", *range(12)]]})
    pipelines.upload(spark, tmp_path / "targets_2026.xlsx", "sheets/", settings)
    now = datetime.datetime(2026, 9, 1)
    assert pipelines.ingest_files(spark, sources["sales_targets"], settings, now) == pipelines.raw.Ingested(1, 1, 2)
    assert pipelines.ingest_files(spark, sources["sales_targets"], settings, now) == pipelines.raw.Ingested(1, 0, 0)
    assert pipelines.build_reference(spark, sources["sales_targets"], settings) == 14
    targets = {(r["category"], r["month_start"].month): float(r["target_usd"]) for r in files_table(spark, settings, "files/sales_targets").collect()}
    assert targets["Home", 1] == 32000 and targets["Home", 12] == 7 and targets["Toys", 3] == 2
    for rate, at in ((0.8, now), (0.9, now + datetime.timedelta(days=1))):  # the later payload wins
        body = '{"base":"USD","rates":{"2026-09-01":{"EUR":%s}}}' % rate
        assert pipelines.ingest_api(spark, sources["fx_rates"], settings, datetime.date(2026, 9, 3), at, fetch=lambda u, p, b=body: (b, u)) == len(body)
    assert pipelines.build_reference(spark, sources["fx_rates"], settings) == 1
    assert files_table(spark, settings, "api/fx_rates").first()["rate"] == 0.9
    assert runner.LakeTable(spark, f"{settings.raw}/api/fx_rates").read().first()["request_url"] == "http://x/2026-08-31..2026-09-03"
    model = runner.ModelSet([runner.Model.parse("yearly", "SELECT category, sum(target_usd) AS t FROM silver.files_sales_targets GROUP BY category")])
    assert pipelines.build_gold(spark, settings, datetime.date(2026, 9, 3), model) == {"yearly": 2}
    connector = pipelines.connector_of(spark, sources["sales_targets"], settings)
    assert connector.test() == "" and connector.size()["files"] == 1 and connector.schema().column("feb").type == "BIGINT" and connector.metadata()["type"] == "excel"
    assert "no file" in spi.create("csv", spark, {"location": settings.landing}).test()


def files_table(spark, settings, path):
    return runner.LakeTable(spark, f"{settings.silver}/{path}").read()


def test_silver_run_checks_and_reconciles(spark, tmp_path):
    settings = pipelines.Settings.load({"TIDEMARK_ROOT": f"file://{tmp_path}/lake"})
    spec = cdc.TableSpec("x", ("a",), {"a": "int"}, history=True, source="s")
    assert pipelines.build_silver(spark, spec, settings, datetime.datetime(2026, 9, 1)) == {}
    value = '{"before":null,"after":{"a":%d},"source":{"table":"x","ts_ms":5},"op":"c","ts_ms":9}'
    rows = spark.createDataFrame([("s.p.x", 0, i, None, value % i) for i in range(3)], bronze.MESSAGES)
    bronze.append_events(envelope.parse_envelope(rows, F.expr("timestamp'2026-10-01 00:00:00'")), runner.LakeTable(spark, f"{settings.raw}/s/x_cdc"))
    done = pipelines.build_silver(spark, spec, settings, datetime.datetime(2026, 9, 1))
    assert done["current"].inserted == 3 and done["history"].inserted == 3
    assert pipelines.build_silver(spark, spec, settings, datetime.datetime(2026, 9, 2))["current"].events == 0
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    options = {"url": url, "dbtable": "x", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.createDataFrame([(1,), (2,), (7,)], "a int").write.format("jdbc").options(**options).save()
    assert sorted(map(tuple, pipelines.reconcile(spark, spec, settings, options).collect())) == [(0, "extra"), (7, "missing")]


def test_envelopes_are_canonical(spark):
    rows = spark.createDataFrame([("t.p.x", 0, 1, None, '{"before":null,"after":{"b": 1, "a":{"z":[1, 2],"y":"é"}},"source":{"table":"x"},"op":"c"}')], bronze.MESSAGES)
    got = envelope.parse_envelope(rows, F.current_timestamp()).first()
    assert got["after"] == '{"a":{"y":"é","z":[1,2]},"b":1}' and got["before"] is None


def test_sql_type_names(spark):
    kinds = sql_types(spark.sql("SELECT 1 AS a, CAST(1 AS DECIMAL(9,2)) AS b, 'x' AS c, NULL AS d, current_timestamp() AS e, array(1) AS f").schema)
    assert kinds == {"a": "INTEGER", "b": "DECIMAL(9,2)", "c": "VARCHAR", "d": "VARCHAR", "e": "TIMESTAMP WITH TIME ZONE", "f": "ARRAY<INT>"}


def test_stream_is_exactly_once(spark, tmp_path):
    value = '{"before":null,"after":{"a":1},"source":{"table":"x","ts_ms":5},"op":"c","ts_ms":9}'
    now = lambda: F.expr("timestamp'2026-10-01 00:00:00'")

    def put(offsets):
        spark.createDataFrame([("s.p.x", 0, o, None, value) for o in offsets], bronze.MESSAGES).write.mode("append").json(f"file://{tmp_path}/in")

    def run(checkpoint):
        stream = spark.readStream.schema(bronze.MESSAGES).json(f"file://{tmp_path}/in")
        bronze.start(stream, f"file://{tmp_path}/b", f"file://{tmp_path}/{checkpoint}", now, once=True).awaitTermination()
        return sorted(r["kafka_offset"] for r in bronze.LakeTable(spark, f"file://{tmp_path}/b/s/x_cdc").read().collect())

    put(range(5))
    assert run("one") == list(range(5))
    put(range(3, 8))
    assert run("one") == list(range(8))
    assert run("another") == list(range(8))  # everything again: nothing is added
