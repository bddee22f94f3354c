import os

import pytest
from pyspark.sql import functions as F

from conftest import item, order_doc, write_files
from starling.plans import stage1, stage2
from starling.sources import json_files as jf
from starling.store import pipeline
from starling.store.tables import Store
from starling.schemas import STAGE1_STEPS, STAGE2_STEPS

ITEM_KEY = ["order_id", "product_id", "quantity", "unit_price"]


def load(spark, folder, files, hour):
    src = write_files(folder, files)
    ts = F.to_timestamp(F.lit(f"2026-02-01 {hour:02d}:00:00"))
    return jf.landing_rows(jf.read_files(spark, src), load_ts=ts)


def batches(spark, root):
    b1 = load(spark, os.path.join(root, "b1"), {
        "orders_08.json": [order_doc(1, customer_id=100, items=[item(1000, 2, 10.5), item(1000, 1, 10.5)]),
                           order_doc(2, customer_id=101, items=[item(1001, 1, 100.5)]),
                           order_doc(3, customer_id=100, items=[item(1002)])],
    }, 8)
    b2 = load(spark, os.path.join(root, "b2"), {
        "orders_09.json": [order_doc(2, customer_id=101, tier="GOLD", status="SHIPPED", items=[item(1003, 3, 1.0)]),
                           order_doc(3, customer_id=100, status="CANCELLED"),            # items removed (D8)
                           order_doc(4, customer_id=102, items=[item(1000, 1, 10.5, category="toys")]),
                           order_doc(4, customer_id=102, items=[item(1004, 1, 2.0)]),   # same order twice: last wins
                           {"order_id": None, "status": "x"}],
        "broken.json": "[{oops",
    }, 9)
    return b1, b2


def state(st):
    items = sorted(tuple(str(x) for x in r) for r in st.current("fact_order_items").select(*ITEM_KEY).collect())
    orders = sorted((int(r["order_id"]), r["status"]) for r in st.current("fact_orders").collect())
    cust = sorted((int(r["customer_id"]), r["loyalty_tier"]) for r in st.current("dim_customer").collect())
    prod = sorted((int(r["product_id"]), r["category"]) for r in st.current("dim_product").collect())
    return items, orders, cust, prod


def test_two_batches_semantics(spark, tmp_root):
    b1, b2 = batches(spark, tmp_root)
    st = Store(spark, os.path.join(tmp_root, "state"))
    r = pipeline.run_batches(st, [b1, b2])
    items, orders, cust, prod = state(st)
    assert orders == [(1, "NEW"), (2, "SHIPPED"), (3, "CANCELLED"), (4, "NEW")]
    assert items == sorted([("1", "1000", "2", "11"), ("1", "1000", "1", "11"), ("2", "1003", "3", "1"),
                            ("4", "1004", "1", "2")])
    assert cust == [(100, "SILVER"), (101, "GOLD"), (102, "SILVER")]
    assert (1000, "toys") not in prod          # dropped version of order 4 never reached the dims
    assert st.current("fact_order_items").where("order_id = 1").agg(F.sum("extended_amount")).first()[0] == 33
    rej = st.log("rejects").collect()
    assert {r["reason"] for r in rej} == {stage1.REASON_NULL_KEY, jf.REASON_MALFORMED}
    # audit conservation for batch 1
    assert r[1]["MERGE_STG_ORDERS"] == 3 and r[1]["DELETE_STG_ORDER_ITEMS"] == 2
    assert r[1]["INSERT_STG_ORDER_ITEMS"] == 2 and r[1]["STREAM_READ_ORDERS"] == 3 + 2
    audit = st.audit().where("batch_id = 1").collect()
    assert [a["stage_step"] for a in sorted(audit, key=lambda a: a["audit_id"])] == pipeline.STEP_ORDER
    assert set(STAGE1_STEPS + STAGE2_STEPS) < set(pipeline.STEP_ORDER)
    assert {a["file_name"] for a in audit} == {"orders_09.json"}


def test_incremental_equals_one_batch(spark, tmp_root):
    b1, b2 = batches(spark, tmp_root)
    inc = Store(spark, os.path.join(tmp_root, "inc"))
    pipeline.run_batches(inc, [b1, b2])
    one = Store(spark, os.path.join(tmp_root, "one"))
    pipeline.run_batches(one, [b1.unionByName(b2)])
    (i_items, i_orders, i_cust, i_prod), (o_items, o_orders, o_cust, o_prod) = state(inc), state(one)
    assert i_items == o_items and i_orders == o_orders
    # dimensions keep every key ever seen (never deleted), values of shared keys agree
    assert set(o_cust) <= set(i_cust) and set(o_prod) <= set(i_prod)
    assert dict(i_cust).keys() >= dict(o_cust).keys()


class FailingStore(Store):
    """Fails once, before or after it has written one table of one batch."""

    fail: tuple | None = None

    def write(self, table, df, batch_id):
        if self.fail == (table, batch_id, "before"):
            raise RuntimeError("disk gone")
        super().write(table, df, batch_id)
        if self.fail == (table, batch_id, "after"):
            raise RuntimeError("disk gone")


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("table,step", [("stg_orders", "MERGE_STG_ORDERS"), ("stg_order_items", "INSERT_STG_ORDER_ITEMS"),
                                        ("dim_product", "MERGE_DIM_PRODUCT"), ("fact_order_items", "INSERT_FACT_ORDER_ITEMS")])
def test_failure_between_writes_then_retry_equals_clean_run(spark, tmp_root, table, step, when):
    b1, b2 = batches(spark, tmp_root)
    clean = Store(spark, os.path.join(tmp_root, "clean"))
    pipeline.run_batches(clean, [b1, b2])
    st = FailingStore(spark, os.path.join(tmp_root, "faulty"))
    pipeline.load_batch(st, b1)
    st.fail = (table, 1, when)
    with pytest.raises(RuntimeError):
        pipeline.load_batch(st, b2, concurrent=False)
    assert st.last_commit() == 0                      # the failed batch is invisible
    assert st.current("fact_orders").count() == 3
    done = {r["stage_step"]: r for r in st.audit().where("batch_id = 1").collect()}
    before = pipeline.STEP_ORDER[:pipeline.STEP_ORDER.index(step)]
    assert done[step]["status"] == "FAILED" and done[step]["affected_rows"] is None and "disk gone" in done[step]["error_message"]
    assert done["STREAM_READ_CREATE_TMP"]["status"] == "SUCCESS" and done["ROUTE_REJECTS"]["affected_rows"] == 2
    assert all(s in pipeline.STEP_ORDER and (s == step or done[s]["status"] == "SUCCESS") for s in done)
    assert [s for s in before if s in done]
    st.fail = None
    pipeline.load_batch(st, b2)
    assert state(st) == state(clean)
    from starling.plans import diagnostics
    runs = {(r["batch_id"], r["status"]): r for r in diagnostics.runs(st.audit()).collect()}
    assert runs[(1, "FAILED")]["failed_step"] == step and runs[(1, "SUCCESS")]["rejected_rows"] == 2
    assert diagnostics.batch_summary(st.audit(), st.commits()).where("batch_id = 1").first()["merged_rows"] == 3


def test_retry_with_an_empty_load_does_not_run_the_old_rows(spark, tmp_root):
    b1, b2 = batches(spark, tmp_root)
    st = FailingStore(spark, os.path.join(tmp_root, "s"))
    pipeline.load_batch(st, b1)
    st.fail = ("stg_orders", 1, "after")
    with pytest.raises(RuntimeError):
        pipeline.load_batch(st, b2)
    st.fail = None
    assert pipeline.load_batch(st, b2.limit(0))["STREAM_READ_CREATE_TMP"] == 0
    assert st.current("fact_orders").count() == 3 and st.current("fact_orders").where("status <> 'NEW'").count() == 0


def test_a_second_reader_sees_later_commits(spark, tmp_root):
    b1, b2 = batches(spark, tmp_root)
    st = Store(spark, os.path.join(tmp_root, "s"))
    pipeline.load_batch(st, b1)
    reader = Store(spark, st.root)
    assert reader.last_commit() == 0
    pipeline.load_batch(st, b2)
    st.compact()
    assert reader.last_commit() == 1 and state(reader) == state(st)


def test_epochs_are_known_by_their_stream(spark, tmp_root):
    b1, b2 = batches(spark, tmp_root)
    st = Store(spark, os.path.join(tmp_root, "s"))
    pipeline.load_batch(st, b1)
    assert pipeline.run_batch(st, b2, source="a", epoch=0)["batch_id"] == 1
    assert pipeline.run_batch(st, b2, source="a", epoch=0)["skipped"]
    assert pipeline.run_batch(st, b2, source="b", epoch=0)["batch_id"] == 2
    assert Store(spark, st.root).has_epoch("b", 0)


def test_batch_reads_only_named_folders_and_counts_without_items(spark, tmp_root):
    b1, b2 = batches(spark, tmp_root)
    st = Store(spark, os.path.join(tmp_root, "s"))
    pipeline.run_batches(st, [b1, b2])
    plan = st.log("stg_orders", after=0)._jdf.queryExecution().executedPlan().toString()
    assert "batch_id=1" in plan and "batch_id=0" not in plan
    got = {int(r["order_id"]): (r["batch_id"], r["item_count"]) for r in st.prior_orders(st.current("stg_orders"), None).collect()}
    assert got == {1: (0, 2), 2: (1, 1), 3: (1, 0), 4: (1, 1)}


def test_committed_batch_is_skipped(spark, tmp_root):
    b1, _ = batches(spark, tmp_root)
    st = Store(spark, os.path.join(tmp_root, "s"))
    pipeline.load_batch(st, b1, batch_id=0)
    assert pipeline.run_batch(st, b1, 0)["skipped"] is True
    assert st.audit().count() == 11
    assert pipeline.load_batch(st, b1, batch_id=0)["skipped"] is True


def test_compaction_keeps_state(spark, tmp_root):
    b1, b2 = batches(spark, tmp_root)
    st = Store(spark, os.path.join(tmp_root, "c"))
    pipeline.load_batch(st, b1)
    before = state(st)
    st.compact()
    assert state(st) == before
    pipeline.load_batch(st, b2)
    ref = Store(spark, os.path.join(tmp_root, "r"))
    pipeline.run_batches(ref, [b1, b2])
    assert state(st) == state(ref)            # base + tail read
    st.compact()                              # second compaction builds on the first base
    assert state(st) == state(ref)
    assert state(Store(spark, st.root)) == state(ref)   # a fresh reader of the same folder


def test_reset_gives_empty_state(spark, tmp_root):
    b1, _ = batches(spark, tmp_root)
    st = Store(spark, os.path.join(tmp_root, "s"))
    pipeline.load_batch(st, b1)
    fresh = st.reset()
    assert fresh.last_commit() == -1 and fresh.current("fact_orders").count() == 0


def test_pure_stages_match_store(spark, tmp_root):
    b1, b2 = batches(spark, tmp_root)
    o, i, _ = stage1.apply_stage1(None, None, b1)
    o, i, _ = stage1.apply_stage1(o.drop("_merge_action"), i, b2)
    assert sorted((int(r["order_id"]), r["status"]) for r in o.collect()) == \
        [(1, "NEW"), (2, "SHIPPED"), (3, "CANCELLED"), (4, "NEW")]
    cur = stage2.apply_stage2({}, stage1.staged_orders(stage1.latest_orders(b1)),
                              stage1.staged_items(stage1.latest_orders(b1)))
    assert cur["fact_order_items"].count() == 4


def test_empty_batch_commits_with_zero_counts(spark, tmp_root):
    b1, _ = batches(spark, tmp_root)
    st = Store(spark, os.path.join(tmp_root, "e"))
    pipeline.load_batch(st, b1)
    before = state(st)
    r = pipeline.load_batch(st, b1.limit(0))
    assert r["STREAM_READ_CREATE_TMP"] == 0 and r["INSERT_FACT_ORDER_ITEMS"] == 0
    assert st.last_commit() == 1 and state(st) == before


def test_strict_dims_fail_the_batch_on_conflicting_tiers(spark, tmp_root):
    b = load(spark, os.path.join(tmp_root, "c"), {
        "orders_08.json": [order_doc(1, customer_id=100, tier="GOLD", items=[item(1000)]),
                           order_doc(2, customer_id=100, tier="SILVER", items=[item(1001)])],
    }, 8)
    st = Store(spark, os.path.join(tmp_root, "strict"))
    from starling.operators.dims import ConflictingVersions
    with pytest.raises(ConflictingVersions):
        pipeline.load_batch(st, b, strict_dims=True)
    assert st.last_commit() == -1
    failed = st.audit().where("status = 'FAILED'").collect()
    assert [r["stage_step"] for r in failed] == ["MERGE_DIM_CUSTOMER"]
    ok = Store(spark, os.path.join(tmp_root, "lenient"))
    pipeline.load_batch(ok, b)                     # default: latest version wins (order 2, SILVER)
    assert [(int(r["customer_id"]), r["loyalty_tier"]) for r in ok.current("dim_customer").collect()] == [(100, "SILVER")]


def test_product_with_two_categories_in_one_order_is_settled(spark, tmp_root):
    b = load(spark, os.path.join(tmp_root, "p"), {"orders_08.json": [
        order_doc(1, items=[item(1000, category="books"), item(1000, category="toys"), item(1000, category="art")])]}, 8)
    got = {stage2.dim_product_source(stage1.staged_items(stage1.latest_orders(b)).repartition(n)).first()["category"] for n in (1, 3, 5)}
    assert got == {"toys"}


def test_batches_are_written_into_their_folder_and_documents_whole(spark, tmp_root):
    import glob

    import pyarrow.parquet as pq

    b1, b2 = batches(spark, tmp_root)
    st = Store(spark, os.path.join(tmp_root, "s"))
    pipeline.run_batches(st, [b1, b2])
    for table in ("landing_loads", "stg_orders", "fact_order_items"):
        assert os.path.exists(f"{st.path(table)}/batch_id=1/_SUCCESS") and not os.path.exists(f"{st.path(table)}/_SUCCESS")
    assert not os.path.exists(f"{st.path('rejects')}/batch_id=0")           # without rows no folder stays
    for f in glob.glob(f"{st.path('landing_loads')}/batch_id=*/*.parquet"):
        payload = pq.read_schema(f).field("payload").type
        assert "typed_value" not in [payload.field(i).name for i in range(payload.num_fields)]
    rows = [r["order_id"] for r in st.batch("stg_orders", 0).collect()]
    assert sorted(rows) == [1, 2, 3]


def test_affected_orders_that_are_known_are_not_gathered(spark, tmp_root):
    b1, b2 = batches(spark, tmp_root)
    lats = [stage1.latest_orders(b) for b in (b1, b2)]
    (o1, i1), (o2, i2) = ((stage1.staged_orders(x), stage1.staged_items(x)) for x in lats)
    first = {k: v.drop("_merge_action") for k, v in stage2.apply_stage2({}, o1, i1).items()}
    told = stage2.apply_stage2(first, o2, i2, affected=lats[1].select("order_id"))["fact_order_items"]
    found = stage2.apply_stage2(first, o2, i2)["fact_order_items"]
    rows = [sorted(tuple(str(x) for x in r) for r in df.select(*ITEM_KEY).collect()) for df in (told, found)]
    assert rows[0] == rows[1] and len(rows[0]) == 4
    assert "Aggregate" not in told._jdf.queryExecution().optimizedPlan().toString()
