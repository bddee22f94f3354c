"""Bench: incremental order pipeline on the driver tables.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line. Timed steps:

* ``land_*``: documents built from the flat tables (R1) -> array text -> parsed landing rows, written;
* ``full_build``: every order through both stages into an empty state (one batch);
* ``resubmit_1pct`` / ``resubmit_10pct``: the newest ~1 % / ~10 % of orders (by order date) re-sent as
  a status update, one incremental batch each;
* ``read_items_before_compaction`` / ``compact`` / ``read_items_after_compaction``: current fact items
  (aggregated) over the 3-batch log, the compaction job, and the same read from the base snapshot;
* ``star_revenue`` and other registered queries, every column computed (``noop`` sink);
* ``stream_ingest`` / ``stream_transform``: the file-source stream from array files to the landing table, then
  the landing stream through both stages (``foreachBatch``) into a second, empty state.

Before the timings, both stages run once on the smallest test tables in a throwaway state (JIT/codegen
warm-up, as a long-running job would be); per-step seconds of each timed batch are in ``steps``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from starling.session import build_session, shared_path  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="starling-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})

    from starling import queries as Q
    from starling.plans import scenario
    from starling.sources.documents import documents_to_files, load_tables, order_documents
    from starling.sources.json_files import write_json_array_files
    from starling.store import pipeline
    from starling.store.tables import Store
    from starling.streaming.ingest import start_ingest
    from starling.streaming.transform import run_until_drained, start_transform

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # warm-up, not timed: JIT and codegen paths of both stages on a tiny scenario in a throwaway state
    spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.count(F.lit(1))).collect()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        pipeline.run_batches(Store(spark, shared_path(spark, "bench", "warmup")), scenario.two_batches(spark, warm_dir))

    t = load_tables(spark, sf_dir)
    st = Store(spark, shared_path(spark, "bench", "state"))

    def land(docs, batch: int, batch_id: int):
        """Documents -> array text -> parsed landing rows, written as the batch's landing partition."""
        st.write("landing_loads", scenario.landing_of(docs, batch), batch_id)
        return st.batch("landing_loads", batch_id).drop("batch_id")

    rows0 = timed("land_initial", lambda: land(scenario.initial_documents(t), 1, 0))
    r0 = timed("full_build", lambda: pipeline.run_batch(st, rows0, 0))

    last = t.orders.select(F.max("o_orderdate")).scalar()

    def resend_docs(days: int, label: str):
        cond = F.col("o_orderdate") >= last - F.make_dt_interval(days=F.lit(days))
        return order_documents(t, orders_where=cond, status=F.lit("F"), promote_tier=True, file_prefix=f"{label}/")

    rows1 = timed("land_1pct", lambda: land(resend_docs(24, "r1"), 2, 1))
    r1 = timed("resubmit_1pct", lambda: pipeline.run_batch(st, rows1, 1))
    rows2 = timed("land_10pct", lambda: land(resend_docs(240, "r10"), 3, 2))
    r10 = timed("resubmit_10pct", lambda: pipeline.run_batch(st, rows2, 2))

    def read_items():
        return st.current("fact_order_items").agg(F.count(F.lit(1)), F.sum("extended_amount")).collect()

    before = timed("read_items_before_compaction", read_items)
    timed("compact", st.compact)
    after = timed("read_items_after_compaction", read_items)
    assert before == after, (before, after)

    def drain(fn):
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()      # every column is computed

    for name in ("star_revenue", "stg_orders_upsert", "net_changes_items", "net_changes_orders", "fact_order_items",
                 "explode_items", "latest_event_per_user", "json_lines_load", "growing_item_changes"):
        timed(name, lambda: drain(Q.QUERIES[name]))

    drop = shared_path(spark, "bench", "drop")
    write_json_array_files(documents_to_files(scenario.initial_documents(t)), drop)
    st2 = Store(spark, shared_path(spark, "bench", "stream"))
    timed("stream_ingest", lambda: run_until_drained(start_ingest(spark, drop, st2, max_files_per_trigger=64)))
    timed("stream_transform", lambda: run_until_drained(start_transform(spark, st2)))

    out = {
        "metric": "pipeline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf_dir.rsplit("sf", 1)[-1]) if "sf" in sf_dir else None,
        "rows": {"resubmit_1pct_orders": r1.get("MERGE_STG_ORDERS"), "resubmit_10pct_orders": r10.get("MERGE_STG_ORDERS"),
                 "current_items": int(after[0][0])},
        "steps": {"full_build": r0.get("seconds"), "resubmit_1pct": r1.get("seconds"),
                  "resubmit_10pct": r10.get("seconds")},
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
