import os


from conftest import item, order_doc, write_files
from starling.store.tables import Store
from starling.streaming.ingest import start_ingest
from starling.streaming.progress import progress_rows
from starling.streaming.transform import run_until_drained, start_transform


def test_files_to_curated_through_two_streams(spark, tmp_root):
    drop = os.path.join(tmp_root, "drop")
    st = Store(spark, os.path.join(tmp_root, "state"))
    write_files(drop, {
        "orders_20260201_08.json": [order_doc(1, items=[item(1000, 2, 5.0)]), order_doc(2, items=[item(1001)])],
        "orders_20260201_09.json": [order_doc(3, items=[item(1002)])],
        "orders_20260201_10.json": "not json",
    })
    q = start_ingest(spark, drop, st, max_files_per_trigger=1)
    run_until_drained(q)
    assert len(progress_rows(spark, q).collect()) >= 3        # one micro-batch per file (A4, L10)
    run_until_drained(start_transform(spark, st))
    assert st.current("fact_orders").count() == 3
    assert st.log("rejects").count() == 1

    # a later file re-sends order 2 with other items; a rerun with no new file does nothing
    write_files(drop, {"orders_20260201_11.json": [order_doc(2, status="SHIPPED", items=[item(1003, 1, 7.0)])]})
    run_until_drained(start_ingest(spark, drop, st))
    run_until_drained(start_transform(spark, st, compact_every=1))       # compaction inside the stream
    assert st.base_version(st.last_commit()) == st.last_commit()
    commits = st.last_commit()
    run_until_drained(start_ingest(spark, drop, st))
    run_until_drained(start_transform(spark, st))
    assert st.last_commit() == commits
    items = sorted((int(r["order_id"]), int(r["product_id"])) for r in st.current("fact_order_items").collect())
    assert items == [(1, 1000), (2, 1003), (3, 1002)]
    assert st.current("fact_orders").where("order_id = 2").first()["status"] == "SHIPPED"
    assert st.landing().count() == 5
    assert st.landing().select("load_ts").distinct().count() >= 2


def test_batch_load_then_stream_on_one_state_and_old_files(spark, tmp_root):
    from pyspark.sql import functions as F

    from starling.sources import json_files as jf
    from starling.store import pipeline

    st = Store(spark, os.path.join(tmp_root, "state"))
    first = write_files(os.path.join(tmp_root, "first"), {"a.json": [order_doc(1, items=[item(1000)])]})
    pipeline.load_batch(st, jf.landing_rows(jf.read_files(spark, first), load_ts=F.to_timestamp(F.lit("2026-02-01 08:00:00"))))
    drop = os.path.join(tmp_root, "drop")
    for n, age in ((50, 0), (51, 40 * 86400)):
        write_files(os.path.join(drop, f"day{n}"), {"o.json": [order_doc(n, items=[item(1001)])]})
        path = os.path.join(drop, f"day{n}", "o.json")
        t = os.path.getmtime(path) - age
        os.utime(path, (t, t))
        run_until_drained(start_ingest(spark, drop, st))
        run_until_drained(start_transform(spark, st))
    assert sorted(int(r["order_id"]) for r in st.current("fact_orders").collect()) == [1, 50, 51]
    assert st.last_commit() == 2
