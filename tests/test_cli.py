import os

from conftest import item, order_doc, write_files
from starling import cli
from starling.store.tables import Store


def test_cli_run_once_then_compact(spark, tmp_root):
    src = write_files(os.path.join(tmp_root, "drop"), {
        "orders_1.json": [order_doc(1, items=[item(1000, 2, 3.0)]), order_doc(2, items=[item(1001)])],
    })
    state = os.path.join(tmp_root, "state")
    cli.main(["run", "--once", "--source", src, "--state", state])
    cli.main(["compact", "--state", state])
    st = Store(spark, state)
    assert st.last_commit() == 0 and st.base_version(0) == 0
    assert sorted(int(r["order_id"]) for r in st.current("fact_orders").collect()) == [1, 2]
    assert st.current("fact_order_items").count() == 2
    assert spark.read.parquet(f"{state}/load_progress").count() >= 1


def test_diagnose_prints_every_row_and_reset_keeps_the_state(spark, tmp_root, capsys):
    src = write_files(os.path.join(tmp_root, "drop"), {f"orders_{i:03d}.json": [order_doc(i, items=[item(1000)])] for i in range(70)})
    state = os.path.join(tmp_root, "state")
    cli.main(["run", "--once", "--source", src, "--state", state])
    capsys.readouterr()
    cli.main(["diagnose", "--state", state])
    out = capsys.readouterr().out
    assert all(f"orders_{i:03d}.json" in out for i in range(70)) and "RAW_ORDERS_STREAM\t0" in out
    cli.main(["reset", "--state", state])
    assert Store(spark, state).last_commit() == 0


def test_a_submitted_session_keeps_its_settings(spark):
    from starling.session import build_session

    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert build_session(master=None).conf.get("spark.sql.shuffle.partitions") == "3"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
