"""Change streams with several readers, replay of the landing tables, bounded and archiving discovery, counts in progress."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import item, order_doc, write_files
from starling.cli import main
from starling.sources import json_files as jf
from starling.store import pipeline
from starling.store.tables import Store
from starling.streaming import change_log
from starling.streaming.ingest import start_ingest
from starling.streaming.progress import progress_rows
from starling.streaming.replay import replay
from starling.streaming.transform import run_until_drained, start_transform


def load(spark, st, tmp_root, name, docs, hour):
    path = write_files(os.path.join(tmp_root, name), {f"{name}.json": docs})
    rows = jf.landing_rows(jf.read_files(spark, path), load_ts=F.to_timestamp(F.lit(f"2031-03-04 {hour:02d}:00:00")))
    return pipeline.load_batch(st, rows)


def drain(spark, st, table, reader):
    out = f"{st.root}/_readers/{reader}/{table}"
    changes = change_log.read_changes(spark, st, table)
    q = changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start()
    run_until_drained(q)
    return sorted((tuple(r) for r in spark.read.schema(changes.schema).parquet(out).select(
        "batch_id", F.col("order_id").cast("int"), "_action", *(["status"] if table == "stg_orders" else [F.col("product_id").cast("int")])).collect()))


def three_batches(spark, tmp_root):
    st = Store(spark, os.path.join(tmp_root, "state"))
    load(spark, st, tmp_root, "a", [order_doc(1, items=[item(7)]), order_doc(2, items=[item(8), item(8)])], 1)
    load(spark, st, tmp_root, "b", [order_doc(2, status="SENT", items=[item(9)])], 2)
    load(spark, st, tmp_root, "c", [order_doc(3, items=[])], 3)
    return st


ORDERS = [(0, 1, "INSERT", "NEW"), (0, 2, "INSERT", "NEW"), (1, 2, "DELETE", "NEW"), (1, 2, "INSERT", "SENT"), (2, 3, "INSERT", "NEW")]
ITEMS = [(0, 1, "INSERT", 7), (0, 2, "INSERT", 8), (0, 2, "INSERT", 8), (1, 2, "DELETE", 8), (1, 2, "DELETE", 8), (1, 2, "INSERT", 9)]


def test_readers_get_every_image_once(spark, tmp_root):
    st = Store(spark, os.path.join(tmp_root, "state"))
    assert drain(spark, st, "stg_orders", "early") == []
    st = three_batches(spark, tmp_root)
    assert change_log.publish(st) == [(t, b) for t in change_log.TABLES for b in (0, 1, 2)] and change_log.publish(st) == []
    assert drain(spark, st, "stg_orders", "early") == ORDERS and drain(spark, st, "stg_orders", "late") == ORDERS
    assert drain(spark, st, "stg_order_items", "late") == ITEMS
    load(spark, st, tmp_root, "d", [order_doc(1, status="GONE")], 4)
    change_log.publish(st)
    more = [(3, 1, "DELETE", "NEW"), (3, 1, "INSERT", "GONE")]
    assert drain(spark, st, "stg_orders", "early") == ORDERS + more and drain(spark, st, "stg_orders", "early") == ORDERS + more
    with pytest.raises(ValueError):
        change_log.read_changes(spark, st, "rejects")


def test_publish_goes_on_after_a_crash(spark, tmp_root, monkeypatch):
    st = three_batches(spark, tmp_root)
    st._mkdirs(f"{st.root}/changes/stg_orders")
    # a batch whose images were written and half moved, and one whose images were cut off
    staged = f"{st.root}/_changes_staged/stg_orders"
    change_log.images(st, "stg_orders", 0).repartition(3, "order_id").write.parquet(f"{staged}/0")
    parts = sorted(f for f in os.listdir(f"{staged}/0") if f.startswith("part-"))
    os.rename(f"{staged}/0/{parts[0]}", f"{st.root}/changes/stg_orders/batch-000000000-{parts[0]}")
    change_log.images(st, "stg_orders", 1).write.parquet(f"{staged}/1")
    os.remove(f"{staged}/1/_SUCCESS")
    before = drain(spark, st, "stg_orders", "r")
    assert len(before) < 2 or before == ORDERS[:2]
    change_log.publish(st)
    assert drain(spark, st, "stg_orders", "r") == ORDERS
    assert not os.path.exists(f"{staged}/0") and change_log.published(st, "stg_orders") == {0, 1, 2}


def test_failed_batches_publish_nothing_and_streams_publish_by_themselves(spark, tmp_root):
    st = Store(spark, os.path.join(tmp_root, "state"))
    with pytest.raises(Exception):
        load(spark, st, tmp_root, "bad", [order_doc(1, amount="x")], 1)
    assert change_log.publish(st) == []
    drop = write_files(os.path.join(tmp_root, "drop"), {"o.json": [order_doc(5, items=[item(1)])]})
    run_until_drained(start_ingest(spark, drop, st))
    run_until_drained(start_transform(spark, st, publish_changes=True))
    assert [r[1:] for r in drain(spark, st, "stg_orders", "r")] == [(5, "INSERT", "NEW")]


def curated(st):
    cols = {"fact_orders": ["order_id", "status"], "fact_order_items": ["order_id", "product_id", "quantity"], "dim_product": ["product_id", "category"]}
    return {t: sorted(tuple(str(r[x]) for x in c) for r in st.current(t).collect()) for t, c in cols.items()}


def test_replay_of_loads_and_of_the_stream(spark, tmp_root):
    st = three_batches(spark, tmp_root)
    assert curated(replay(spark, st)) == curated(st)
    drop = os.path.join(tmp_root, "drop")
    for n, status in ((1, "PAID"), (2, "LOST")):
        write_files(os.path.join(drop, status), {"o.json": [order_doc(n, status=status, items=[item(20 + n)])]})
        run_until_drained(start_ingest(spark, drop, st))
        run_until_drained(start_transform(spark, st))
    for f in ("PAID", "LOST"):
        os.remove(os.path.join(drop, f, "o.json"))         # the source files are gone
    fresh = replay(spark, st)
    assert curated(fresh) == curated(st) and fresh.root != st.root and fresh.landing().count() == st.landing().count()
    # the fresh state goes on by itself: new files are ingested once, an earlier file isn't
    write_files(os.path.join(drop, "more"), {"o.json": [order_doc(9, items=[item(30)])]})
    again = Store(spark, fresh.root)
    run_until_drained(start_ingest(spark, drop, again))
    run_until_drained(start_transform(spark, again))
    assert again.current("fact_orders").count() == 4 and again.current("fact_order_items").where("product_id = 30").count() == 1


def test_replay_of_loads_between_stream_batches_goes_by_load_time(spark, tmp_root):
    st = Store(spark, os.path.join(tmp_root, "state"))
    drop = write_files(os.path.join(tmp_root, "drop"), {"o.json": [order_doc(1, status="A", items=[item(1)]), order_doc(2)]})
    run_until_drained(start_ingest(spark, drop, st))
    run_until_drained(start_transform(spark, st))
    path = write_files(os.path.join(tmp_root, "late"), {"late.json": [order_doc(1, status="B", items=[item(2)])]})
    pipeline.load_batch(st, jf.landing_rows(jf.read_files(spark, path)))
    fresh = replay(spark, st)
    want = curated(st)
    assert curated(fresh)["fact_orders"] == want["fact_orders"] and curated(fresh)["fact_order_items"] == want["fact_order_items"]
    # a new load of the fresh state doesn't replace an old one in the shared landing table
    load(spark, fresh, tmp_root, "next", [order_doc(3)], 5)
    assert fresh.landing().count() == 4 and curated(replay(spark, fresh))["fact_orders"] == curated(fresh)["fact_orders"]
    run_until_drained(start_transform(spark, fresh))
    assert fresh.current("fact_orders").count() == 3


def test_batches_bounded_by_bytes_and_loaded_files_archived(spark, tmp_root):
    spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", "0")       # files are moved before the stream goes on
    st = Store(spark, os.path.join(tmp_root, "state"))
    drop, kept = os.path.join(tmp_root, "drop"), os.path.join(tmp_root, "kept")
    names = {f"day{n}/o{n}.json": [order_doc(n, items=[item(n)])] for n in range(6)}
    for name, docs in names.items():
        write_files(os.path.join(drop, os.path.dirname(name)), {os.path.basename(name): docs})
    size = os.path.getsize(os.path.join(drop, "day0/o0.json"))
    q = start_ingest(spark, drop, st, max_bytes_per_trigger=2 * size + 10, archive=kept)
    run_until_drained(q)
    batches = [r for r in progress_rows(spark, q).collect() if r.num_input_rows]
    assert len(batches) == 3 and [r.rows_landed for r in batches] == [2, 2, 2]
    write_files(os.path.join(drop, "day9"), {"o9.json": [order_doc(9)]})
    run_until_drained(start_ingest(spark, drop, st, archive=kept))
    left = [f for d, _, fs in os.walk(drop) for f in fs]
    moved = sorted(f for d, _, fs in os.walk(kept) for f in fs if f.endswith(".json"))
    assert left == ["o9.json"] and moved == sorted(os.path.basename(n) for n in names)     # the last batch's files wait for the next one
    run_until_drained(start_ingest(spark, drop, st, archive=kept))
    run_until_drained(start_transform(spark, st))
    assert st.landing().count() == 7 and st.current("fact_orders").count() == 7
    with pytest.raises(ValueError):
        start_ingest(spark, drop, st, max_files_per_trigger=1, max_bytes_per_trigger=1)


def test_progress_counts_rejects(spark, tmp_root):
    st = Store(spark, os.path.join(tmp_root, "state"))
    drop = write_files(os.path.join(tmp_root, "drop"), {"a.json": [order_doc(1), order_doc(2)], "b.json": "no json", "c.json": [order_doc(3)]})
    q = start_ingest(spark, drop, st, max_files_per_trigger=1)
    run_until_drained(q)
    rows = progress_rows(spark, q).agg(F.sum("rows_landed"), F.sum("rows_rejected")).first()
    assert tuple(rows) == (4, 1)


def test_cli_reset_with_replay(spark, tmp_root, capsys):
    st = three_batches(spark, tmp_root)
    main(["reset", "--state", st.root, "--replay", "--master", "local[4]"])
    fresh = Store(spark, capsys.readouterr().out.split()[-1])
    assert curated(fresh) == curated(st)
