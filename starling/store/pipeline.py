"""One micro-batch through both stages against the stored state.

``run_batch`` is what the streaming ``foreachBatch`` calls, and what batch
loads call directly. Order of work for batch N:

1. ``begin``: drop partial output of an earlier failed attempt of N;
2. stage 1 (raw -> staged), stage 2 (staged -> curated), each step's affected
   row count taken from the write itself (``Observation``) or from the committed
   versions of the batch's orders, which carry their number of items. Work runs
   in three phases so no table is ever read while it is being written: (A) prior
   versions, (B) the staged writes, (C) the curated writes; inside a phase the
   jobs are independent and run concurrently unless ``concurrent=False``. Each
   step is recorded when it is done, with its own time;
3. the batch's audit rows, one append;
4. the commit row, last, with the stream and epoch the rows came from. An epoch
   that was committed is skipped (a replay after a crash between our commit and
   the stream's own), whatever number its batch got.

On error the steps done so far and a FAILED row (step, whole message) are
appended and the error is raised again, so the stream stops and retries the
epoch from its checkpoint.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starling import schemas as S
from starling.plans import stage1, stage2
from starling.session import dropped_shuffles
from starling.store.tables import Store

STEP_ORDER = [S.STAGE1_STEPS[0], S.REJECTS_STEP, *S.STAGE1_STEPS[1:], *S.STAGE2_STEPS]


class _Audit:
    """Steps of one attempt, recorded as they end."""

    def __init__(self, query_id: str):
        self.query_id, self.attempt = query_id, uuid.uuid4().hex[:12]
        self.file_name, self.file_count = None, 0
        self.steps: dict[str, tuple] = {}
        self.seconds: dict[str, float] = {}

    def run(self, step: str, fn):
        """Run ``fn`` as ``step``; its result is the affected row count."""
        start = time.perf_counter()
        try:
            rows = fn()
        except Exception as e:
            self.steps[step] = (dt.datetime.now(), None, "FAILED", f"{type(e).__name__}: {e}")
            raise
        self.done(step, rows)
        self.seconds[step] = round(time.perf_counter() - start, 3)
        return rows

    def done(self, step: str, rows: int) -> None:
        self.steps[step] = (dt.datetime.now(), rows, "SUCCESS", None)

    def rows(self) -> list[tuple]:
        out = []
        for step in STEP_ORDER:
            if step in self.steps:
                ts, n, status, error = self.steps[step]
                procedure = S.STAGE2_PROCEDURE if step in S.STAGE2_STEPS else S.STAGE1_PROCEDURE
                out.append((len(out) + 1, self.file_name, procedure, step, ts, n, status, error, self.query_id,
                            self.file_count, self.attempt))
        return out

    def counts(self) -> dict:
        return {step: v[1] for step, v in self.steps.items()}


def _phase(audit: _Audit, tasks: dict, concurrent: bool) -> dict:
    """Run independent steps, as concurrent Spark jobs or one after the other; raise the first failure in step order."""
    if not concurrent:
        return {step: audit.run(step, fn) for step, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {step: pool.submit(audit.run, step, fn) for step, fn in tasks.items()}
    return {step: f.result() for step, f in futures.items()}


def _write_counted(store: Store, table: str, df: DataFrame, batch_id: int) -> int:
    obs = Observation(f"{table}_{batch_id}_{uuid.uuid4().hex[:6]}")
    store.write(table, df.observe(obs, F.count(F.lit(1)).alias("n")), batch_id)
    return int(obs.get.get("n", 0) or 0)


def run_batch(store: Store, landing: DataFrame, batch_id: int | None = None, query_id: str | None = None,
              strict: bool = True, strict_dims: bool = False, concurrent: bool = True, source: str | None = None,
              epoch: int | None = None) -> dict:
    """Process ``landing`` as the next batch (or as ``batch_id``, skipped if that one is committed)."""
    last = store.last_commit()
    if source is not None and store.has_epoch(source, epoch):
        return {"batch_id": None, "skipped": True}
    if batch_id is None:
        batch_id = last + 1
    elif batch_id <= last:
        return {"batch_id": batch_id, "skipped": True}
    money = store.money
    audit = _Audit(query_id or f"batch:{batch_id}")
    store.begin(batch_id)
    # the landing batch is a Parquet read (landing table or its stream), cheap to scan twice; only
    # ``latest`` (after the shuffle of the latest-version window) is kept for its four consumers
    latest = folder = prior = None
    landed = 0
    sessions = ExitStack()
    sessions.enter_context(dropped_shuffles(store.spark, landing.sparkSession))
    try:
        # ------------------------------------------------ stage 1
        # all rows and rejects are counted while the latest versions are computed (no extra pass)
        obs = Observation(f"landing_{batch_id}_{uuid.uuid4().hex[:6]}")
        rows = stage1.judged(landing, strict, money).observe(
            obs, F.count("reason").alias("rejects"), F.count(F.lit(1)).alias("rows"))
        found: dict = {}

        def read_batch() -> int:
            nonlocal latest, folder
            latest, folder = store.scratch(stage1.latest_judged(rows))
            found.update(latest.agg(F.count(F.lit(1)).alias("n"), F.max("file_name").alias("f"),
                                    F.count_distinct("file_name").alias("fc"), F.min("order_id").alias("lo"),
                                    F.max("order_id").alias("hi")).first().asDict())
            return int(found["n"])

        n = audit.run(S.STAGE1_STEPS[0], read_batch)
        audit.file_name, audit.file_count = found["f"], int(found["fc"])
        landed, n_rejects = int(obs.get.get("rows", 0) or 0), int(obs.get.get("rejects", 0) or 0)
        if n_rejects:
            rejects = stage1.rejected_rows(landing, strict, money)
            audit.run(S.REJECTS_STEP, lambda: _write_counted(store, "rejects", rejects, batch_id))
        if n == 0:
            for step in STEP_ORDER:
                if step not in audit.steps and step != S.REJECTS_STEP:
                    audit.done(step, 0)
        else:
            # phase A: committed version of every order of the batch that existed before, with its number of items
            prior = store.prior_orders(latest.select("order_id"), (found["lo"], found["hi"]), n)
            updated, deleted = (int(x or 0) for x in prior.agg(F.count(F.lit(1)), F.sum("item_count")).first())

            # phase B, the staged writes of this batch (distinct tables)
            out = _phase(audit, {
                "MERGE_STG_ORDERS": lambda: _write_counted(
                    store, "stg_orders", stage1.staged_orders(latest, money, strict), batch_id),
                "INSERT_STG_ORDER_ITEMS": lambda: _write_counted(
                    store, "stg_order_items", stage1.staged_items(latest, money, strict), batch_id),
            }, concurrent)
            merged, inserted = out["MERGE_STG_ORDERS"], out["INSERT_STG_ORDER_ITEMS"]
            audit.done("DELETE_STG_ORDER_ITEMS", deleted)

            # ------------------------------------------------ stage 2 (I10), same batch
            tmp_orders = store.batch("stg_orders", batch_id)
            tmp_items = store.batch("stg_order_items", batch_id)
            audit.done("STREAM_READ_ORDERS", merged + updated)          # insert images + delete/insert pairs
            audit.done("STREAM_READ_ORDER_ITEMS", deleted + inserted)   # delete images + insert images

            # phase C, the curated writes of this batch (distinct tables, reading the staged batch)
            _phase(audit, {
                "MERGE_DIM_CUSTOMER": lambda: _write_counted(
                    store, "dim_customer", stage2.dim_customer_source(tmp_orders, strict_dims), batch_id),
                "MERGE_DIM_PRODUCT": lambda: _write_counted(
                    store, "dim_product", stage2.dim_product_source(tmp_items, strict_dims), batch_id),
                "MERGE_FACT_ORDERS": lambda: _write_counted(
                    store, "fact_orders", stage2.fact_orders_source(tmp_orders), batch_id),
                "INSERT_FACT_ORDER_ITEMS": lambda: _write_counted(
                    store, "fact_order_items", stage2.fact_items_source(tmp_items), batch_id),
            }, concurrent)
            audit.done("DELETE_FACT_ORDER_ITEMS", deleted)      # fact items mirror the staged items of each version
        store.append_audit(audit.rows(), batch_id)
        store.commit(batch_id, audit.query_id, audit.file_count, landed, audit.attempt, source, epoch)
    except Exception as e:
        if not any(v[2] == "FAILED" for v in audit.steps.values()):     # between two steps
            step = next((s for s in STEP_ORDER if s not in audit.steps and s != S.REJECTS_STEP), STEP_ORDER[-1])
            audit.steps[step] = (dt.datetime.now(), None, "FAILED", f"{type(e).__name__}: {e}")
        store.append_audit(audit.rows(), batch_id)
        raise
    finally:
        sessions.close()
        if folder is not None:
            store._delete(folder)
    return {"batch_id": batch_id, "skipped": False, **audit.counts(), "seconds": audit.seconds}


def load_batch(store: Store, landing: DataFrame, batch_id: int | None = None, **kw) -> dict:
    """A3 + I9/I10 in batch mode: land the rows under ``batch_id`` then run the batch."""
    batch_id = store.next_load() if batch_id is None else batch_id
    if batch_id <= store.last_commit():
        return {"batch_id": batch_id, "skipped": True}
    with dropped_shuffles(store.spark, landing.sparkSession):
        store.write("landing_loads", landing, batch_id)
    rows = store.batch("landing_loads", batch_id).drop("batch_id")
    return run_batch(store, rows, batch_id, **kw)


def run_batches(store: Store, landings: list[DataFrame], **kw) -> list[dict]:
    return [load_batch(store, df, **kw) for df in landings]
