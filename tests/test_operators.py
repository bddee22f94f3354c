import datetime as dt

import pytest
from pyspark.sql import functions as F

from starling.operators.changes import multiset_changes, net_changes
from starling.operators.children import delete_by_keys, matched_children, parent_keys, replace_children
from starling.operators.dims import ConflictingVersions, distinct_rows, one_row_per_key
from starling.operators.flatten import explode_items
from starling.operators.latest import arrival_order, latest_per_key
from starling.operators.upsert import merge_counts, merge_upsert
from starling.plans import stage1

T0 = dt.datetime(2026, 2, 1, 8, 0, 0)


def landing(spark, rows):
    """rows: (file_name, row_number, load_ts, json)"""
    df = spark.createDataFrame(rows, "file_name string, row_number long, load_ts timestamp, j string")
    return df.select("file_name", "row_number", "load_ts", F.parse_json("j").alias("payload"),
                     F.lit(None).cast("string").alias("reject_reason"), F.lit(None).cast("string").alias("raw"))


def test_latest_version_total_order(spark):
    rows = [
        ("f1.json", 1, T0, '{"order_id": 1, "status": "A"}'),
        ("f1.json", 2, T0, '{"order_id": 1, "status": "B"}'),      # same file: last row wins
        ("f1.json", 3, T0, '{"order_id": 2, "status": "A"}'),
        ("f2.json", 1, T0, '{"order_id": 2, "status": "B"}'),      # same load: later file wins
        ("f0.json", 1, T0 + dt.timedelta(hours=1), '{"order_id": 3, "status": "B"}'),
        ("f9.json", 1, T0, '{"order_id": 3, "status": "A"}'),      # later load wins over file name
    ]
    got = {int(r["order_id"]): r["s"] for r in stage1.latest_orders(landing(spark, rows))
           .select("order_id", F.variant_get("payload", "$.status", "string").alias("s")).collect()}
    assert got == {1: "B", 2: "B", 3: "B"}


def test_latest_per_key_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(df, ["k"], [F.col("v").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert {tuple(r) for r in latest_per_key(df, ["k"], [F.col("v").desc()]).collect()} == {(0, 999), (1, 997), (2, 998)}


def test_null_keys_go_to_rejects(spark):
    df = landing(spark, [("f", 1, T0, '{"order_id": null}'), ("f", 2, T0, '{"status": "x"}'),
                         ("f", 3, T0, '{"order_id": 4}')])
    assert stage1.latest_orders(df).count() == 1
    rej = stage1.rejected_rows(df).collect()
    assert len(rej) == 2 and {r["reason"] for r in rej} == {stage1.REASON_NULL_KEY}


def test_bad_value_strict_fails_permissive_rejects(spark):
    df = landing(spark, [("f", 1, T0, '{"order_id": 1, "payment": {"amount": "x"}}'),
                         ("f", 2, T0, '{"order_id": 2, "payment": {"amount": 3}}')])
    with pytest.raises(Exception):
        stage1.staged_orders(stage1.latest_orders(df)).collect()
    ok = stage1.staged_orders(stage1.latest_orders(df, strict=False), strict=False).collect()
    assert [int(r["order_id"]) for r in ok] == [2]
    rej = stage1.rejected_rows(df, strict=False).collect()
    assert [r["reason"] for r in rej] == [stage1.REASON_BAD_VALUE]


def test_explode_inner_and_outer(spark):
    df = landing(spark, [("f", 1, T0, '{"order_id": 1, "items": [{"product_id": 5, "quantity": 2, "unit_price": 1.5},'
                                      ' {"product_id": 5, "quantity": 1, "unit_price": 1.5}]}'),
                         ("f", 2, T0, '{"order_id": 2, "items": []}'),
                         ("f", 3, T0, '{"order_id": 3}')])
    inner = explode_items(df, keep=["row_number"]).collect()
    assert len(inner) == 2 and all(int(r["product_id"]) == 5 for r in inner)   # same product twice kept
    assert [int(r["unit_price"]) for r in inner] == [2, 2]                      # 1.5 rounds half up
    outer = explode_items(df, keep=["row_number"], outer=True).collect()
    assert sorted(r["row_number"] for r in outer) == [1, 1, 2, 3]


def test_merge_upsert_by_name_and_counts(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, s string, n int")
    src = spark.createDataFrame([(2, "B"), (3, "C")], "k int, s string")
    out = merge_upsert(tgt, src, ["k"], set_values={"n": F.lit(0)})
    got = {r["k"]: (r["s"], r["n"], r["_merge_action"]) for r in out.collect()}
    assert got == {1: ("a", 10, None), 2: ("B", 0, "UPDATE"), 3: ("C", 0, "INSERT")}
    c = merge_counts(out).first()
    assert (c["inserted_rows"], c["updated_rows"], c["merged_rows"]) == (1, 1, 2)


def test_merge_upsert_explicit_columns(spark):
    tgt = spark.createDataFrame([(1, "a", "x")], "k int, s string, t string")
    src = spark.createDataFrame([(1, "b", "y"), (2, "c", "z")], "k int, s string, t string")
    out = merge_upsert(tgt, src, ["k"], update_cols=["s"], insert_cols=["s"])
    got = {r["k"]: (r["s"], r["t"]) for r in out.collect()}
    assert got == {1: ("b", "x"), 2: ("c", None)}


def test_replace_children(spark):
    tgt = spark.createDataFrame([(1, 5), (1, 5), (2, 6), (None, 7)], "k int, p int")
    keys = spark.createDataFrame([(1,), (3,)], "k int")
    new = spark.createDataFrame([(1, 8), (3, 9)], "k int, p int")
    assert matched_children(tgt, keys, ["k"]).count() == 2
    assert {tuple(r) for r in delete_by_keys(tgt, keys, ["k"]).collect()} == {(2, 6), (None, 7)}
    got = sorted(replace_children(tgt, keys, new, ["k"], keys_rows=2).collect(), key=lambda r: (r[0] or 0, r[1]))
    assert [tuple(r) for r in got] == [(None, 7), (1, 8), (2, 6), (3, 9)]
    assert parent_keys(tgt, ["k"]).count() == 3


def test_one_row_per_key_and_strict(spark):
    df = spark.createDataFrame([(1, "GOLD", 1), (1, "SILVER", 2), (2, "BRONZE", 1)], "c int, tier string, v int")
    got = {r["c"]: r["tier"] for r in one_row_per_key(df, "c", ["tier"], [F.col("v").desc()]).collect()}
    assert got == {1: "SILVER", 2: "BRONZE"}
    with pytest.raises(ConflictingVersions):
        one_row_per_key(df, "c", ["tier"], [F.col("v").desc()], strict=True)
    assert distinct_rows(df.select("c", "tier"), ["c", "tier"]).count() == 3


def test_net_changes_images(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, s string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, s string")
    got = sorted((r["k"], r["s"], r["_action"], r["_is_update"]) for r in net_changes(before, after, ["k"]).collect())
    assert got == [(2, "B", "INSERT", True), (2, "b", "DELETE", True), (3, "c", "DELETE", False),
                   (4, "d", "INSERT", False)]


def test_multiset_changes_keep_duplicates(spark):
    before = spark.createDataFrame([(1, 5), (1, 5), (1, 6)], "k int, p int")
    after = spark.createDataFrame([(1, 5), (1, 7)], "k int, p int")
    got = sorted(tuple(r) for r in multiset_changes(before, after).collect())
    assert got == [(1, 5, "DELETE"), (1, 6, "DELETE"), (1, 7, "INSERT")]


def test_arrival_order_columns():
    assert len(arrival_order()) == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_and_changes_have_no_join(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, n int")
    s = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    for df in (merge_upsert(t, s, ["k"]), net_changes(t.select("k", "v"), s, ["k"])):
        df.collect()
        assert "Join" not in _plan(df) and "Exchange hashpartitioning(k" in _plan(df)


def test_upsert_of_null_keys_and_two_keys(spark):
    t = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (None, None, "c"), (3, 3, None)], "k int, j int, v string")
    s = spark.createDataFrame([(1, None, "x"), (1, 2, None), (None, None, "y"), (3, 3, "z"), (4, 4, "n")], "k int, j int, v string")
    got = sorted((tuple(r) for r in merge_upsert(t, s, ["k", "j"]).collect()), key=repr)
    assert got == sorted([(1, None, "a", None), (1, None, "x", "INSERT"), (1, 2, None, "UPDATE"), (None, None, "c", None),
                          (None, None, "y", "INSERT"), (3, 3, "z", "UPDATE"), (4, 4, "n", "INSERT")], key=repr)
    images = sorted((tuple(r) for r in net_changes(t, s, ["k", "j"]).collect()), key=repr)
    assert images == sorted([(1, None, "a", "DELETE", False), (1, None, "x", "INSERT", False), (1, 2, "b", "DELETE", True),
                             (1, 2, None, "INSERT", True), (None, None, "c", "DELETE", False), (None, None, "y", "INSERT", False),
                             (3, 3, None, "DELETE", True), (3, 3, "z", "INSERT", True), (4, 4, "n", "INSERT", False)], key=repr)


def test_upsert_of_a_hot_key_moves_one_row_per_task(spark):
    t = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(0).cast("long").alias("at"))
    s = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") + 50).alias("k"),
                                            F.concat(F.lit("v"), F.col("id")).alias("v"), F.col("id").alias("at"))
    merged = merge_upsert(t, s, ["k"], version=["at"])
    rows = {r.k: r for r in merged.collect()}
    assert rows[7].v == "v29999" and rows[7]._merge_action == "UPDATE" and rows[0]._merge_action is None
    assert len(rows) == 100 + 10_000 - len(range(0, 50, 3)) and merged.count() == len(rows)
    # the hot key's 20,000 rows leave the tasks as one row each: the latest is taken before the shuffle
    text = _plan(merged)
    assert "partial_max_by" in text and "Join" not in text


def test_upsert_of_versions_without_values(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "b", None)], "k int, v string, at int")
    assert [tuple(r) for r in merge_upsert(t, s, ["k"], version=["at"]).collect()] == [(1, "b", "UPDATE")]
