"""What queries leave on disk: shuffle files go with the query that made them, tables and files are packed."""

import os
import time

from pyspark.sql import functions as F

from starling import queries as q
from starling.session import DROP_SHUFFLES, dropped_shuffles
from starling.sources import json_files as jf
from starling.sources.documents import load_tables, order_documents
from starling.store import catalog
from starling.store import pipeline as store_pipeline
from starling.store.tables import Store
from test_mixed_files import _tables


def _shuffle_files(spark) -> set[str]:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f"{d}/{f}" for top in manager.localDirs() for d, _, files in os.walk(top.getPath()) for f in files if f.startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    """Shuffle files that are new and stay."""
    until = time.time() + 10
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def _files_under(path: str) -> list[str]:
    return [f"{d}/{f}" for d, _, files in os.walk(path) for f in files if not f.startswith((".", "_"))]


def test_the_setting_is_put_back(spark):
    before = spark.conf.get(DROP_SHUFFLES, None)
    for value in ("true", "false"):
        spark.conf.set(DROP_SHUFFLES, value)
        with dropped_shuffles(spark, spark):
            assert spark.conf.get(DROP_SHUFFLES) == "true"
        assert spark.conf.get(DROP_SHUFFLES) == value
    spark.conf.set(DROP_SHUFFLES, "false")
    first, second = dropped_shuffles(spark), dropped_shuffles(spark)        # as two threads may
    first.__enter__(), second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(DROP_SHUFFLES) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(DROP_SHUFFLES) == "false"
    spark.conf.unset(DROP_SHUFFLES)
    with dropped_shuffles(spark):
        pass
    assert spark.conf.get(DROP_SHUFFLES, None) == before


def test_rows_used_again_leave_no_shuffle_files(spark, tmp_root):
    docs = order_documents(load_tables(spark, _tables(spark, tmp_root)))
    before = _shuffle_files(spark)
    kept = q._materialized(docs)
    assert not _left(spark, before)
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect())) and kept.count() == 8


def test_a_batch_leaves_packed_tables_only(spark, tmp_root):
    landing = q.scenario.two_batches(spark, _tables(spark, tmp_root))[0]
    st = Store(spark, f"{tmp_root}/state")
    before = _shuffle_files(spark)
    store_pipeline.load_batch(st, landing)
    assert not _left(spark, before)
    assert not _files_under(f"{tmp_root}/state/_scratch")
    for table in ("landing_loads", "stg_orders", "fact_order_items"):
        files = _files_under(st.path(table))
        assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert st.current("fact_orders").count() == 7


def test_array_files_are_packed_and_read_whole(spark, tmp_root):
    text = '[{"order_id":1},\n {"order_id":2}]'
    files = spark.createDataFrame([("a b.json", text), ("c.json", "[]")], "file_name string, value string")
    jf.write_json_array_files(files, f"{tmp_root}/in")
    written = _files_under(f"{tmp_root}/in")
    assert len(written) == 2 and all(f.endswith(".txt.gz") for f in written)
    assert [(r["file_name"], r["row_number"]) for r in jf.read_landing(spark, f"{tmp_root}/in").sort("row_number").collect()] == [
        ("a b.json", 1), ("a b.json", 2)]
    jf.write_json_array_files(files, f"{tmp_root}/plain", "none")
    assert all(f.endswith(".txt") for f in _files_under(f"{tmp_root}/plain"))


def test_both_versions_of_an_order_are_made_in_one_pass(spark, tmp_root):
    root = _tables(spark, tmp_root)
    docs, t = q._tied_documents(spark, root), load_tables(spark, root)
    assert docs._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 1
    two = order_documents(t, file_prefix="t1/").unionByName(
        order_documents(t, lines_where=F.col("l_linestatus") == "F", status=F.lit("T"), promote_tier=True, file_prefix="t2/"))
    assert docs.columns == two.columns and sorted(map(str, docs.collect())) == sorted(map(str, two.collect()))


def test_both_inserts_take_rows_made_once(spark, tmp_root, monkeypatch):
    plans, insert = [], catalog.Catalog._insert

    def seen(self, table, rows, *how):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        insert(self, table, rows, *how)

    monkeypatch.setattr(catalog.Catalog, "_insert", seen)
    rows = q.q_insert_by_name(spark, _tables(spark, tmp_root)).collect()
    assert len(plans) == 2 and not any("l_orderkey" in p for p in plans)
    assert sorted((r["order_id"], r["product_id"], r["quantity"]) for r in rows) == [(1, 100, 2), (1, 101, 3), (2, 100, 4), (3, 999, 1)]
