import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, quality, reshape
from tidemark.operators.asof import asof_join
from tidemark.plans import apply
from tidemark.sources.envelope import parse_envelope, table_path
from tidemark.sources.lake import CommitConflict, LakeTable

SPEC = cdc.TableSpec("products", ("product_id",), {"product_id": "int", "unit_price": "decimal(10,2)"}, history=True)
RUN = lambda: F.expr("timestamp'2026-10-01 00:00:00'")
SCHEMA = "op string, before string, after string, source_ts_ms bigint, kafka_partition int, kafka_offset bigint"


def event(op, key, price, offset, partition=0):
    row = f'{{"product_id":{key},"unit_price":"{price}"}}'
    return (op, row if op == "d" else None, None if op == "d" else row, 1_790_000_000_000 + offset * 1000, partition, offset)


def state(table, history=False):
    key = "_valid_from" if history else "product_id"
    return sorted(((r["product_id"], str(r["unit_price"]), r["_is_current"] if history else r["_is_deleted"]) for r in table.read().orderBy(key).collect()))


def test_paths_and_envelopes(spark):
    assert table_path("shop.public.order_items") == "shop/order_items_cdc"
    value = '{"before":null,"after":{"a":1},"source":{"table":"%s","lsn":42,"ts_ms":5,"snapshot":"%s"},"op":"r","ts_ms":9}'
    rows = [("t.p.x", 0, 1, None, value % ("x", "true")), ("t.p.x", 0, 2, None, None), ("t.p.debezium_signal", 0, 3, None, value % ("debezium_signal", "false"))]
    got = parse_envelope(spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string"), RUN()).collect()
    assert len(got) == 1 and got[0]["is_snapshot"] and got[0]["source_lsn"] == 42 and got[0]["after"] == '{"a":1}'


def test_batches_reruns_and_reinsert(spark, tmp_path):
    current, history = LakeTable(spark, f"file://{tmp_path}/c"), LakeTable(spark, f"file://{tmp_path}/h")
    events = [event("r", 1, 10, 0), event("r", 2, 20, 1)]
    for more in ([], [event("u", 1, 12, 2), event("d", 2, 20, 3)], [], [event("c", 2, 99, 4)]):
        events += more
        bronze = spark.createDataFrame(events, SCHEMA)
        apply.apply_current(SPEC, bronze, current, RUN())
        apply.apply_history(SPEC, bronze, history, RUN())
    assert state(current) == [(1, "12.00", False), (2, "99.00", False)]
    assert state(history, True) == [(1, "10.00", False), (1, "12.00", True), (2, "20.00", False), (2, "99.00", True)]
    assert apply.apply_current(SPEC, spark.createDataFrame(events, SCHEMA), current, RUN()) == apply.Applied()
    quality.gate(quality.history_checks(history.read(), current.read(), ["product_id"]))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_batching_gives_the_same_state(spark, tmp_path, seed):
    rng = random.Random(seed)
    events = [event(rng.choice("cuud"), rng.randrange(5), i, i, rng.randrange(1)) for i in range(40)]
    whole = LakeTable(spark, f"file://{tmp_path}/w")
    apply.apply_history(SPEC, spark.createDataFrame(events, SCHEMA), whole, RUN())
    split = LakeTable(spark, f"file://{tmp_path}/s")
    cuts = sorted(rng.sample(range(1, 39), 2))
    for high in (*cuts, 40):
        some = events[:high]
        rng.shuffle(some)
        apply.apply_history(SPEC, spark.createDataFrame(some, SCHEMA), split, RUN())
    assert state(whole, True) == state(split, True)
    # a replay that overlaps the history and extends it, without the marks
    extended = cdc.merge_history(whole.read(), cdc.typed_events(spark.createDataFrame([*events[20:], event("u", 1, 77, 99)], SCHEMA), SPEC, RUN()), SPEC)
    assert quality.duplicate_keys(extended.where("_is_current"), ["product_id"]).count() == 0


def test_commits_are_exclusive(spark, tmp_path):
    table = LakeTable(spark, f"file://{tmp_path}/t")
    assert not table.exists()
    first = table.append(spark.range(3).toDF("a"))
    table.append(spark.range(2).selectExpr("id AS a", "'x' AS b"), {"m": 7})
    assert table.read().count() == 5 and table.read().where("b is null").count() == 3 and table.txns() == {"m": 7}
    with pytest.raises(CommitConflict):
        table._commit(first, [], table.read().schema, {}, {})


def test_torn_commits_stop_nobody(spark, tmp_path):
    table = LakeTable(spark, f"file://{tmp_path}/t")
    table.append(spark.range(3).toDF("a"))
    (tmp_path / "t/_commits/00000000000000000001.json").write_text("{")  # a writer that died, at the next number
    assert table.read().count() == 3
    assert table.append(spark.range(2).toDF("a")).version == 2 and table.read().count() == 5


def test_no_commit_is_lost(spark, tmp_path):
    """Another writer's rows come between reading and replacing."""
    table = LakeTable(spark, f"file://{tmp_path}/t")
    table.append(spark.range(3).toDF("a"))
    base = table.head()
    rows = table.read(base).where("a > 0")
    table.append(spark.range(10, 12).toDF("a"))
    with pytest.raises(CommitConflict):
        table.overwrite(rows, base=base)
    assert table.read().count() == 5
    table.overwrite(table.read().where("a > 0"), base=table.head())
    assert table.read().count() == 4
    marked = LakeTable(spark, f"file://{tmp_path}/m")
    staged = marked.stage(spark.range(2).toDF("a"))
    marked.append(staged, {"p": 1})
    assert marked.txns() == {"p": 1} and marked.read().count() == 2


def test_compact_and_expire(spark, tmp_path):
    table = LakeTable(spark, f"file://{tmp_path}/t")
    for i in range(4):
        table.append(spark.range(i, i + 1).toDF("a"), {"m": i})
    assert len(table.compact().folders) == 1 and table.txns() == {"m": 3}
    assert table.expire(keep=1) == 4 and sorted(r["a"] for r in table.read().collect()) == [0, 1, 2, 3]
    assert len(list((tmp_path / "t/data").iterdir())) == 1


def test_runs_tell_what_they_did(spark, tmp_path):
    current, history = LakeTable(spark, f"file://{tmp_path}/c"), LakeTable(spark, f"file://{tmp_path}/h")
    events = [event("c", k, 10, k) for k in range(4)]
    at = [lambda: F.expr("timestamp'2026-10-01 00:00:00'"), lambda: F.expr("timestamp'2026-10-02 00:00:00'")]
    assert apply.apply_current(SPEC, spark.createDataFrame(events, SCHEMA), current, at[0]()) == apply.Applied(1, 4, 4, 0)
    apply.apply_history(SPEC, spark.createDataFrame(events, SCHEMA), history, at[0]())
    events += [event("u", 1, 12, 10), event("c", 9, 1, 11)]
    assert apply.apply_current(SPEC, spark.createDataFrame(events, SCHEMA), current, at[1]()) == apply.Applied(1, 2, 1, 1)
    apply.apply_history(SPEC, spark.createDataFrame(events, SCHEMA), history, at[1]())
    # a closed version tells of the run that closed it
    days = {(r["product_id"], r["_is_current"]): r["_processed_at"].day for r in history.read().collect()}
    assert days[1, False] == 2 and days[1, True] == 2 and days[2, True] == 1


def test_offsets(spark):
    rows = [event("c", 1, 1, o, p) for p in (0, 1) for o in range(5)]
    batch = spark.createDataFrame(rows, SCHEMA).withColumn("kafka_topic", F.lit("t"))
    kept = cdc.drop_written(batch, cdc.max_offsets(batch.where("kafka_partition = 0 and kafka_offset <= 2")))
    assert kept.count() == 7
    assert {r["max_offset"] for r in cdc.max_offsets(kept).collect()} == {4}


@pytest.mark.parametrize("small", [0, 1000])
def test_asof_matches_brute_force(spark, small):
    rng = random.Random(4)
    left = [(i, rng.choice([None, "a", "b"]), rng.choice([None, *range(60)])) for i in range(80)]
    right = [(k, t, k + str(t)) for k in "ab" for t in rng.sample(range(60), 15)] + [(None, 5, "null")]
    stamp = lambda df, c: df.withColumn(c, F.timestamp_seconds(F.col(c) * 86400 * 3))
    a = stamp(spark.createDataFrame(left, "id int, k string, t int"), "t")
    b = stamp(spark.createDataFrame(right, "rk string, rt int, v string"), "rt")
    got = {r["id"]: r["v"] for r in asof_join(a, b, "t", "rt", [("k", "rk")], "left", small).collect()}
    for i, k, t in left:
        hits = [(rt, v) for rk, rt, v in right if rk == k and k is not None and t is not None and rt <= t]
        assert got[i] == (max(hits)[1] if hits else None)
    inner = asof_join(a, b, "t", "rt", [("k", "rk")], "inner", small).count()
    assert inner == sum(v is not None for v in got.values())


def test_gate_names_what_fails(spark):
    rows = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    with pytest.raises(quality.QualityError, match="pk_not_null: 1, pk_unique: 1"):
        quality.gate({"pk_unique": quality.duplicate_keys(rows, ["k"]), "pk_not_null": quality.null_keys(rows, ["k"])})
    assert [r["n"] for r in quality.MODEL_TESTS["unique"](spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "`a b` int, c int"), ["a b", "c"]).collect()] == [2]


def test_newest_load_keeps_null_keys(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 1), ("a", None)], "k string, at int")
    assert sorted(map(tuple, reshape.newest_load(rows, ["k"], "at").collect()), key=str) == [("a", 1), ("a", 1), (None, 2)]
