"""Registered queries: one per operator family, each with its DuckDB oracle.

Every query reads the driver's tables under ``sf_dir`` (whole tables) and
builds order documents from them (R1), so the full path document -> parse ->
dedup -> merge -> star schema is what gets checked against SQL written over the
flat tables. Clock columns (``updated_at``, ingest times) are left out of the
compared results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.operators.changes import multiset_changes, net_changes
from starling.operators.children import delete_by_keys, matched_children, parent_keys
from starling.operators.latest import latest_per_key
from starling.operators.children import replace_children
from starling.operators.upsert import merge_counts, merge_upsert
from starling.session import delete_folder, dropped_shuffles, shared_path
from starling.plans import diagnostics, scenario, stage1, stage2
from starling.plans.star import star_revenue as star_revenue_plan
from starling.functions.paths import order_columns
from starling.sources.documents import (Version, documents_to_files, documents_to_mixed_files, load_tables, order_documents,
                                        order_versions)
from starling.sources.json_files import (PACKED, WHOLE_DOCUMENTS, landing_rows, list_files, query_files, read_landing,
                                         write_json_array_files)

ITEM_COLS = ["order_id", "order_date", "product_id", "category", "quantity", "unit_price", "file_name"]
ORDER_COLS = ["customer_id", "loyalty_tier", "segment", "order_date", "order_id", "payment_amount",
              "payment_currency", "payment_method", "shipping_city", "shipping_country",
              "shipping_delivery_type", "status", "file_name"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _materialized(df: DataFrame) -> DataFrame:
    """Packed Parquet below the shared checkpoint folder: later steps read it instead of
    re-running document build, parse and the latest-version window for every reference; what was shuffled for it is dropped."""
    return _written(df)[0]


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = shared_path(spark, "queries", "rows")
    with dropped_shuffles(spark):
        df.write.options(**WHOLE_DOCUMENTS, **PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _latest(landing: DataFrame, money="number") -> DataFrame:
    """The latest versions of landed rows; the documents' own shuffles are gone before the versions are shuffled."""
    landed, folder = _written(landing)
    latest = _materialized(stage1.latest_orders(landed, money=money))
    delete_folder(landed.sparkSession, folder)
    return latest


def _latest_batches(spark: SparkSession, sf_dir: str, money="number") -> list[DataFrame]:
    return [_latest(l, money) for l in scenario.two_batches(spark, sf_dir)]


def _pure_run(spark: SparkSession, sf_dir: str, money="number"):
    """Both scenario batches through the pure stage functions."""
    lat1, lat2 = _latest_batches(spark, sf_dir, money)
    o1 = stage1.staged_orders(lat1, money)
    i1 = stage1.staged_items(lat1, money)
    o2 = merge_upsert(o1, stage1.staged_orders(lat2, money), ["order_id"])
    i2 = replace_children(i1, lat2.select("order_id"), stage1.staged_items(lat2, money), ["order_id"])
    return dict(o1=o1, i1=i1, lat1=lat1, o2=o2, i2=i2, lat2=lat2)


def _pure_curated(spark: SparkSession, sf_dir: str, money="number") -> dict[str, DataFrame]:
    lat1, lat2 = _latest_batches(spark, sf_dir, money)
    cur = stage2.apply_stage2({}, stage1.staged_orders(lat1, money), stage1.staged_items(lat1, money))
    cur = {k: v.drop("_merge_action") for k, v in cur.items()}
    # staged orders and items are all of the batch's latest documents, so those name the affected orders
    cur = stage2.apply_stage2(cur, stage1.staged_orders(lat2, money), stage1.staged_items(lat2, money), affected=lat2.select("order_id"))
    return {k: v.drop("_merge_action") if "_merge_action" in v.columns else v for k, v in cur.items()}


# ---------------------------------------------------------------- queries

def q_parse_orders(spark, sf_dir):
    l1 = scenario.two_batches(spark, sf_dir)[0]
    return l1.select("file_name", "row_number", *order_columns("payload"))


def q_latest_event_per_user(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    return latest_per_key(ev, ["user_id"], [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()])


def q_latest_order_version(spark, sf_dir):
    l1, l2 = scenario.two_batches(spark, sf_dir)
    latest = stage1.latest_orders(l1.unionByName(l2))
    return latest.select("order_id", F.variant_get("payload", "$.status", "string").alias("status"),
                         F.variant_get("payload", "$.customer.loyalty_tier", "string").alias("loyalty_tier"),
                         "file_name")


def q_explode_items(spark, sf_dir):
    lat1 = stage1.latest_orders(scenario.two_batches(spark, sf_dir)[0])
    return stage1.staged_items(lat1).select(*ITEM_COLS)


def q_explode_items_outer(spark, sf_dir):
    lat1 = stage1.latest_orders(scenario.two_batches(spark, sf_dir)[0])
    return stage1.staged_items(lat1, outer=True).select(*ITEM_COLS)


def q_stg_orders_upsert(spark, sf_dir):
    return _pure_run(spark, sf_dir)["o2"].select(*ORDER_COLS)


def q_stg_items_replace(spark, sf_dir):
    return _pure_run(spark, sf_dir)["i2"].select(*ITEM_COLS)


def q_item_delete_count(spark, sf_dir):
    r = _pure_run(spark, sf_dir)
    deleted = matched_children(r["i1"], r["lat2"].select("order_id"), ["order_id"])
    return deleted.agg(F.count(F.lit(1)).cast("bigint").alias("deleted_rows"))


def q_surviving_items_anti(spark, sf_dir):
    r = _pure_run(spark, sf_dir)
    return delete_by_keys(r["i1"], r["lat2"].select("order_id"), ["order_id"]).select(*ITEM_COLS)


def q_affected_keys(spark, sf_dir):
    resent = scenario.landing_of(scenario.resend_documents(load_tables(spark, sf_dir)), 2)
    return parent_keys(stage1.latest_orders(resent), ["order_id"])


def q_dim_customer_scd1(spark, sf_dir):
    return _pure_curated(spark, sf_dir)["dim_customer"].select("customer_id", "segment", "loyalty_tier")


def q_dim_product_scd1(spark, sf_dir):
    return _pure_curated(spark, sf_dir)["dim_product"].select("product_id", "category")


def q_fact_orders(spark, sf_dir):
    return _pure_curated(spark, sf_dir)["fact_orders"].select(*stage2.FACT_ORDER_COLS)


FACT_ITEM_COLS = ["order_id", "product_id", "order_date", "quantity", "unit_price", "extended_amount"]


def q_fact_order_items(spark, sf_dir):
    return _pure_curated(spark, sf_dir)["fact_order_items"].select(*FACT_ITEM_COLS)


def q_fact_order_items_cents(spark, sf_dir):
    return _pure_curated(spark, sf_dir, money="cents")["fact_order_items"].select(*FACT_ITEM_COLS)


def q_net_changes_orders(spark, sf_dir):
    r = _pure_run(spark, sf_dir)
    cols = [c for c in ORDER_COLS if c != "order_id"]
    ch = net_changes(r["o1"].select(*ORDER_COLS), r["o2"].select(*ORDER_COLS), ["order_id"], cols)
    return ch.select("order_id", "status", "loyalty_tier", "file_name", "_action", "_is_update")


def q_net_changes_items(spark, sf_dir):
    r = _pure_run(spark, sf_dir)
    cols = ["order_id", "order_date", "product_id", "category", "quantity", "unit_price"]
    return multiset_changes(r["i1"], r["i2"], cols)


def q_merge_row_counts(spark, sf_dir):
    r = _pure_run(spark, sf_dir)
    counts = merge_counts(r["o2"])
    orders_long = counts.select(F.explode(F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
          for c in ("inserted_rows", "updated_rows", "merged_rows")])).alias("m")).select("m.*")
    deleted = (matched_children(r["i1"], r["lat2"].select("order_id"), ["order_id"])
               .agg(F.lit("deleted_item_rows").alias("metric"), F.count(F.lit(1)).cast("bigint").alias("value")))
    inserted = (stage1.staged_items(r["lat2"])
                .agg(F.lit("inserted_item_rows").alias("metric"), F.count(F.lit(1)).cast("bigint").alias("value")))
    return orders_long.unionByName(deleted).unionByName(inserted)


def q_max_file_name(spark, sf_dir):
    l1 = scenario.two_batches(spark, sf_dir)[0]
    return l1.agg(F.count_distinct("file_name").cast("bigint").alias("file_count"),
                  F.max("file_name").alias("max_file_name"),
                  F.count(F.lit(1)).cast("bigint").alias("doc_count"))


def _events_as_landing(spark, sf_dir) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    return ev.select(F.concat(F.lit("events_"), F.date_format("ts", "yyyyMMdd")).alias("file_name"),
                     F.col("ts").alias("load_ts"))


def q_load_history_48h(spark, sf_dir):
    land = _events_as_landing(spark, sf_dir)
    ref = land.select(F.max("load_ts")).scalar()
    return diagnostics.load_history(land, hours=48, reference=ref)


def q_load_usage_hourly(spark, sf_dir):
    land = _events_as_landing(spark, sf_dir)
    ref = land.select(F.max("load_ts")).scalar()
    return diagnostics.load_usage(land, hours=48, reference=ref)


def q_run_history(spark, sf_dir):
    ev = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return diagnostics.run_history(ev, "event_type", "PUR%", "ts")


def q_star_revenue(spark, sf_dir):
    cur = _pure_curated(spark, sf_dir)
    return star_revenue_plan(cur["fact_order_items"], cur["fact_orders"], cur["dim_customer"], cur["dim_product"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_orders": q_parse_orders,
    "latest_event_per_user": q_latest_event_per_user,
    "latest_order_version": q_latest_order_version,
    "explode_items": q_explode_items,
    "explode_items_outer": q_explode_items_outer,
    "stg_orders_upsert": q_stg_orders_upsert,
    "stg_items_replace": q_stg_items_replace,
    "item_delete_count": q_item_delete_count,
    "surviving_items_anti": q_surviving_items_anti,
    "affected_keys": q_affected_keys,
    "dim_customer_scd1": q_dim_customer_scd1,
    "dim_product_scd1": q_dim_product_scd1,
    "fact_orders": q_fact_orders,
    "fact_order_items": q_fact_order_items,
    "fact_order_items_cents": q_fact_order_items_cents,
    "net_changes_orders": q_net_changes_orders,
    "net_changes_items": q_net_changes_items,
    "merge_row_counts": q_merge_row_counts,
    "max_file_name": q_max_file_name,
    "load_history_48h": q_load_history_48h,
    "load_usage_hourly": q_load_usage_hourly,
    "run_history": q_run_history,
    "star_revenue": q_star_revenue,
}


# ---------------------------------------------------------------- stored state (incremental engine)

from starling.store import pipeline as store_pipeline  # noqa: E402
from starling.store.tables import Store  # noqa: E402


def _store(spark, label: str, money="number") -> Store:
    return Store(spark, shared_path(spark, "queries", label), money)


def _stored_two_batches(spark, sf_dir) -> Store:
    st = _store(spark, "two-batches")
    store_pipeline.run_batches(st, scenario.two_batches(spark, sf_dir))
    return st


def q_store_change_feed(spark, sf_dir):
    """Change rows of staged orders between the two committed batches, read from the store."""
    st = _stored_two_batches(spark, sf_dir)
    cols = [c for c in ORDER_COLS if c != "order_id"]
    ch = st.changes("stg_orders", after=0, upto=1, cols=cols)
    return ch.select("order_id", "status", "loyalty_tier", "file_name", "_action", "_is_update")


def q_store_item_changes(spark, sf_dir):
    st = _stored_two_batches(spark, sf_dir)
    cols = ["order_id", "order_date", "product_id", "category", "quantity", "unit_price"]
    return st.changes("stg_order_items", after=0, upto=1, cols=cols)


def q_rejects_permissive(spark, sf_dir):
    """Low-priority orders arrive with an amount that does not cast; a permissive load keeps the
    rest and routes those documents to rejects with a reason (D9, D10)."""
    t = load_tables(spark, sf_dir)
    docs = scenario.with_text_amount(scenario.initial_documents(t), F.col("priority") == "5-LOW")
    st = _store(spark, "permissive")
    store_pipeline.load_batch(st, scenario.landing_of(docs, 1), strict=False)
    staged = st.current("stg_orders").agg(F.lit("staged").alias("outcome"),
                                          F.count(F.lit(1)).cast("bigint").alias("row_count"))
    rejected = st.log("rejects").groupBy(F.col("reason").alias("outcome")).agg(
        F.count(F.lit(1)).cast("bigint").alias("row_count"))
    return staged.unionByName(rejected)


def q_incremental_equals_batch(spark, sf_dir):
    """Four dated loads then the status update, batch by batch through the stored state."""
    st = _store(spark, "dated")
    store_pipeline.run_batches(st, scenario.dated_batches(spark, sf_dir))
    return st.current("fact_order_items").select(*FACT_ITEM_COLS)


def _layers(st: Store) -> DataFrame:
    counts = diagnostics.layer_counts([
        ("RAW", "raw_orders_json", st.landing()),
        ("STAGED", "stg_orders", st.current("stg_orders")),
        ("STAGED", "stg_order_items", st.current("stg_order_items")),
        ("CURATED", "dim_customer", st.current("dim_customer")),
        ("CURATED", "dim_product", st.current("dim_product")),
        ("CURATED", "fact_orders", st.current("fact_orders")),
        ("CURATED", "fact_order_items", st.current("fact_order_items")),
    ])
    return counts.unionByName(diagnostics.pending_counts(st))


def q_layer_counts(spark, sf_dir):
    return _layers(_stored_two_batches(spark, sf_dir))


def q_layer_counts_pending(spark, sf_dir):
    """The second batch has landed but isn't processed yet."""
    st = _store(spark, "pending")
    l1, l2 = scenario.two_batches(spark, sf_dir)
    store_pipeline.load_batch(st, l1)
    st.write("landing_loads", l2, 1)
    return diagnostics.pending_counts(st)


def q_failed_batch_audit(spark, sf_dir):
    """A strict batch with amounts that don't cast fails; the audit has the steps done before, and the failure."""
    t = load_tables(spark, sf_dir)
    bad = scenario.with_text_amount(scenario.resend_documents(t), F.lit(True))
    st = _store(spark, "failed")
    store_pipeline.load_batch(st, scenario.landing_of(scenario.initial_documents(t), 1))
    try:
        store_pipeline.load_batch(st, scenario.landing_of(bad, 2), concurrent=False)
    except Exception:
        pass
    return st.audit().select("batch_id", "stage_step", "status", "affected_rows")


def q_run_history_runs(spark, sf_dir):
    """One row per run: the two committed batches and a repeated one that is skipped."""
    st = _stored_two_batches(spark, sf_dir)
    return diagnostics.runs(st.audit()).select("batch_id", "query_id", "steps_done", "stream_rows", "rejected_rows", "status", "failed_step")


def q_batch_then_stream(spark, sf_dir):
    """The initial orders as a batch load, the re-sent ones through both streams, on one state."""
    from starling.streaming.ingest import start_ingest
    from starling.streaming.transform import run_until_drained, start_transform

    st = _store(spark, "batch-stream")
    t = load_tables(spark, sf_dir)
    store_pipeline.load_batch(st, scenario.landing_of(scenario.initial_documents(t), 1))
    drop = f"{st.root}/_incoming"
    write_json_array_files(documents_to_files(scenario.resend_documents(t)), drop)
    run_until_drained(start_ingest(spark, drop, st))
    run_until_drained(start_transform(spark, st))
    return st.current("fact_order_items").select(*FACT_ITEM_COLS)


def _mixed_files(spark, sf_dir, label: str) -> str:
    """Files as they may come: open orders one object per line, finished ones as two arrays in a file (no document),
    others as one array."""
    drop = shared_path(spark, "queries", label)

    def kind_of(status):
        return F.when(status == "O", "lines").when(status == "F", "twice").otherwise("array")

    # all kinds in one pass over the tables
    docs = order_documents(load_tables(spark, sf_dir), file_prefix=F.concat(kind_of(F.col("o_orderstatus")), F.lit("/")))
    write_json_array_files(documents_to_mixed_files(docs.withColumn("kind", kind_of(F.col("order_status")))), drop)
    return drop


def q_multi_document_rejects(spark, sf_dir):
    rows = query_files(spark, _mixed_files(spark, sf_dir, "mixed"))
    kind = F.substring_index("file_name", "/", 1)
    return rows.groupBy(kind.alias("kind"), F.coalesce("reject_reason", F.lit("loaded")).alias("outcome")).agg(
        F.count(F.lit(1)).cast("bigint").alias("row_count"))


def q_load_history_rejects(spark, sf_dir):
    land = _loaded_at(read_landing(spark, _mixed_files(spark, sf_dir, "history")))
    return diagnostics.load_history(land, hours=48, reference=scenario.load_ts_of(1)).select(
        "file_name", "rows_loaded", "rows_rejected", "status")


def _loaded_at(rows: DataFrame) -> DataFrame:
    return rows.withColumn("load_ts", scenario.load_ts_of(1))


def q_json_lines_load(spark, sf_dir):
    """Documents as JSON Lines files, read through the splittable line source and landed once by two loads."""
    from starling.sources.json_files import load_once

    t = load_tables(spark, sf_dir)
    drop, landing = shared_path(spark, "queries", "lines"), shared_path(spark, "queries", "lines-landing")
    order_documents(t).select("doc").write.text(drop)
    load_once(spark, drop, landing, fmt="lines")
    rows = load_once(spark, drop, landing, fmt="lines")
    return rows.select(*[c for c in order_columns("payload")], "reject_reason")


def q_nested_landing(spark, sf_dir):
    """Array files in folders below folders; row counts and last row number per logical name."""
    t = load_tables(spark, sf_dir)
    drop = shared_path(spark, "queries", "nested")
    files = documents_to_files(order_documents(t, file_prefix="n/"))
    (files.withColumn("year", F.regexp_extract("file_name", r"orders_(\d{4})", 1)).select("year", "file_name", "value")
     .write.partitionBy("year", "file_name").text(drop))
    return read_landing(spark, drop).groupBy("file_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("row_count"), F.max("row_number").alias("last_row"))


def q_rejects_items(spark, sf_dir):
    """Permissive load: urgent orders come with a quantity that doesn't cast, low ones with items that are no array."""
    t = load_tables(spark, sf_dir)
    docs = scenario.initial_documents(t)
    word = F.regexp_replace("doc", r'"quantity":-?[0-9]+', '"quantity":"two"')
    text = F.regexp_replace("doc", r'"items":\[.*\],"shipping"', '"items":"none","shipping"')
    docs = docs.withColumn("doc", F.when(F.col("priority") == "1-URGENT", word).when(F.col("priority") == "5-LOW", text)
                           .otherwise(F.col("doc")))
    st = _store(spark, "bad-items")
    store_pipeline.load_batch(st, scenario.landing_of(docs, 1), strict=False)
    out = st.current("stg_orders").agg(F.lit("staged orders").alias("outcome"), F.count(F.lit(1)).cast("bigint").alias("row_count"))
    out = out.unionByName(st.current("stg_order_items").agg(F.lit("staged items").alias("outcome"),
                                                            F.count(F.lit(1)).cast("bigint").alias("row_count")))
    return out.unionByName(st.log("rejects").groupBy(F.col("reason").alias("outcome")).agg(
        F.count(F.lit(1)).cast("bigint").alias("row_count")))


def _growing(spark, sf_dir) -> dict:
    """Finished and partial orders with their fulfilled lines; then partial ones again with their open lines, and open
    orders for the first time."""
    first, second = _growing_documents(spark, sf_dir)
    lat1, lat2 = (_latest(scenario.landing_of(d, i)) for i, d in ((1, first), (2, second)))
    o1, i1 = stage1.staged_orders(lat1), stage1.staged_items(lat1)
    return dict(o1=o1, i1=i1, o2=merge_upsert(o1, stage1.staged_orders(lat2), ["order_id"]),
                i2=replace_children(i1, lat2.select("order_id"), stage1.staged_items(lat2), ["order_id"]))


def q_growing_merge_counts(spark, sf_dir):
    return merge_counts(_growing(spark, sf_dir)["o2"]).select("inserted_rows", "updated_rows", "merged_rows")


def q_growing_order_changes(spark, sf_dir):
    r = _growing(spark, sf_dir)
    ch = net_changes(r["o1"].select("order_id", "status", "file_name"), r["o2"].select("order_id", "status", "file_name"), ["order_id"])
    return ch.select("order_id", "status", "file_name", "_action", "_is_update")


def q_growing_item_changes(spark, sf_dir):
    r = _growing(spark, sf_dir)
    return multiset_changes(r["i1"], r["i2"], ["order_id", "order_date", "product_id", "category", "quantity", "unit_price"])


def q_distinct_customers(spark, sf_dir):
    """D-4: distinct rows over several columns of the staged orders."""
    from starling.operators.dims import distinct_rows

    return distinct_rows(_growing(spark, sf_dir)["o2"], ["customer_id", "loyalty_tier", "segment"])


def q_landing_times(spark, sf_dir):
    """Cast of a document value to a time stamp."""
    from starling.functions.paths import get_path

    rows = landing_rows(documents_to_files(order_documents(load_tables(spark, sf_dir))))
    return rows.select(get_path("payload", "$.order_id", "number").alias("order_id"),
                       get_path("payload", "$.order_date", "timestamp").alias("ordered_at"))


def q_audit_steps(spark, sf_dir):
    st = _stored_two_batches(spark, sf_dir)
    return st.audit().select("batch_id", "procedure_name", "stage_step", "affected_rows", "status", "file_name")


def q_batch_summary(spark, sf_dir):
    st = _stored_two_batches(spark, sf_dir)
    return diagnostics.batch_summary(st.audit(), st.commits())


def q_reset_and_replay(spark, sf_dir):
    st = _store(spark, "reset")
    l1, l2 = scenario.two_batches(spark, sf_dir)
    l1 = _materialized(l1)          # loaded twice
    store_pipeline.load_batch(st, l1)
    fresh = st.reset()
    store_pipeline.run_batches(fresh, [l1, l2])
    return fresh.current("fact_orders").select(*stage2.FACT_ORDER_COLS)


def q_compacted_read(spark, sf_dir):
    """Compaction after the initial load; the status update lands on top of the base."""
    st = _store(spark, "compact")
    l1, l2 = scenario.two_batches(spark, sf_dir)
    store_pipeline.load_batch(st, l1)
    st.compact()
    store_pipeline.load_batch(st, l2)
    return st.current("stg_order_items").select(*ITEM_COLS)


def q_stream_pipeline(spark, sf_dir):
    """Files -> ingest stream -> landing -> transform stream (foreachBatch) -> curated."""
    from starling.streaming.ingest import start_ingest
    from starling.streaming.transform import run_until_drained, start_transform

    st = _store(spark, "stream")
    t = load_tables(spark, sf_dir)
    drop = f"{st.root}/_incoming"
    for docs in (scenario.initial_documents(t), scenario.resend_documents(t)):
        write_json_array_files(documents_to_files(docs), drop)
        run_until_drained(start_ingest(spark, drop, st, max_files_per_trigger=2000))
        run_until_drained(start_transform(spark, st))
    return st.current("fact_order_items").select(*FACT_ITEM_COLS)


def q_file_listing(spark, sf_dir):
    drop = shared_path(spark, "queries", "listing")
    write_json_array_files(documents_to_files(scenario.initial_documents(load_tables(spark, sf_dir))), drop, "none")
    return list_files(spark, drop).where(F.col("path").endswith(".txt")).select("file_name", (F.col("length") > 2).alias("has_rows"))


def _growing_documents(spark, sf_dir) -> list[DataFrame]:
    t = load_tables(spark, sf_dir)
    return [order_documents(t, orders_where=F.coalesce(F.col("o_orderstatus") != "O", F.lit(True)),
                            lines_where=F.col("l_linestatus") == "F", file_prefix="g1/"),
            order_documents(t, orders_where=F.col("o_orderstatus").isin("P", "O"),
                            lines_where=F.coalesce(F.col("l_linestatus") != "F", F.lit(True)), file_prefix="g2/")]


def _followed(spark, st: Store, table: str, reader: str) -> DataFrame:
    """Drain what the change stream of ``table`` has for ``reader`` into its own table, with its own checkpoint."""
    from starling.streaming.change_log import read_changes

    out = f"{st.root}/_readers/{reader}/{table}"
    changes = read_changes(spark, st, table)
    query = (changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(changes.schema).parquet(out)


def q_change_stream_two_readers(spark, sf_dir):
    """Two batches; one reader follows batch by batch, another drains both at the end, a third publish adds nothing."""
    from starling.streaming.change_log import publish

    st = _store(spark, "followed")
    for i, docs in enumerate(_growing_documents(spark, sf_dir)):
        store_pipeline.load_batch(st, scenario.landing_of(docs, i + 1))
        publish(st)
        for table in ("stg_orders", "stg_order_items"):
            _followed(spark, st, table, "often")
    publish(st)
    out = None
    for reader in ("often", "once"):
        orders = _followed(spark, st, "stg_orders", reader).select(
            F.lit(reader).alias("reader"), F.lit("orders").alias("images"), "batch_id", "order_id", F.lit(None).cast("decimal(38,0)").alias("product_id"),
            F.lit(None).cast("decimal(38,0)").alias("quantity"), "status", F.col("_action").alias("action"), F.col("_is_update").alias("is_update"))
        items = _followed(spark, st, "stg_order_items", reader).select(
            F.lit(reader).alias("reader"), F.lit("items").alias("images"), "batch_id", "order_id", "product_id", "quantity",
            F.lit(None).cast("string").alias("status"), F.col("_action").alias("action"), F.lit(None).cast("boolean").alias("is_update"))
        both = orders.unionByName(items)
        out = both if out is None else out.unionByName(both)
    return out


def q_replay_landing(spark, sf_dir):
    """The initial orders as a batch load, the re-sent ones as a stream; all that landed is replayed into a fresh state."""
    from starling.streaming.ingest import start_ingest
    from starling.streaming.replay import replay
    from starling.streaming.transform import run_until_drained, start_transform

    st = _store(spark, "replayed")
    t = load_tables(spark, sf_dir)
    store_pipeline.load_batch(st, scenario.landing_of(scenario.initial_documents(t), 1))
    drop = f"{st.root}/_incoming"
    write_json_array_files(documents_to_files(scenario.resend_documents(t)), drop)
    run_until_drained(start_ingest(spark, drop, st))
    run_until_drained(start_transform(spark, st))
    return replay(spark, st).current("fact_order_items").select(*FACT_ITEM_COLS)


def q_load_progress_counts(spark, sf_dir):
    """Rows landed and rejected as the reports of the ingest stream tell, summed over its micro-batches."""
    from starling.streaming.ingest import start_ingest
    from starling.streaming.progress import progress_rows
    from starling.streaming.transform import run_until_drained

    st = _store(spark, "progress")
    drop = _mixed_files(spark, sf_dir, "progress-in")
    some = list_files(spark, drop).count() // 4 + 1        # a query keeps its last hundred reports
    q = start_ingest(spark, drop, st, max_files_per_trigger=some)
    run_until_drained(q)
    told = progress_rows(spark, q).agg(F.sum("rows_landed").alias("landed"), F.sum("rows_rejected").alias("rejected"))
    there = st.landing().agg(F.count(F.lit(1)).alias("landing_rows"), F.count("reject_reason").alias("landing_rejects"))
    return told.withColumn("one", F.lit(1)).join(there.withColumn("one", F.lit(1)), "one").drop("one")


def _inserted_items(spark, sf_dir, how: str) -> DataFrame:
    """Staged items inserted into a declared table from columns in another order, after a truncate of a first insert."""
    from starling import schemas as S
    from starling.store.catalog import Catalog

    lat1 = _latest(scenario.two_batches(spark, sf_dir)[0])      # for both inserts
    swapped = stage1.staged_items(lat1).select("order_id", "order_date", "product_id", "category", "unit_price", "quantity", "file_name",
                                               "ingested_at_ltz", "updated_at_ltz")
    catalog = Catalog(spark)
    catalog.create_or_replace("stg_order_items", S.stg_order_items())
    catalog.insert_by_name("stg_order_items", swapped)
    catalog.truncate("stg_order_items")
    getattr(catalog, how)("stg_order_items", swapped)
    return catalog.read("stg_order_items").select(*ITEM_COLS)


def q_insert_positional(spark, sf_dir):
    """Prices land in the quantity column and the other way round, as the position says."""
    return _inserted_items(spark, sf_dir, "insert_positional")


def q_insert_by_name(spark, sf_dir):
    return _inserted_items(spark, sf_dir, "insert_by_name")


def _tied_documents(spark, sf_dir) -> DataFrame:
    """Every order twice in one load, in different files; the second time with its customer's tier promoted, so that the
    orders of a customer, and the two versions of each order, conflict inside the batch."""
    again = Version("t2/", lines_where=F.col("l_linestatus") == "F", status=F.lit("T"), promote_tier=True)
    return order_versions(load_tables(spark, sf_dir), [Version("t1/"), again])


def _tied_state(spark, sf_dir) -> Store:
    st = _store(spark, "tied")
    store_pipeline.load_batch(st, scenario.landing_of(_tied_documents(spark, sf_dir), 1))
    return st


def q_tied_order_versions(spark, sf_dir):
    """Of the versions of an order in one load the one of the greatest file name, then row, is taken."""
    return _tied_state(spark, sf_dir).current("fact_orders").select("order_id", "status")


def q_tied_items(spark, sf_dir):
    return _tied_state(spark, sf_dir).current("fact_order_items").select("order_id", "product_id", "quantity")


def q_tied_dim_customer(spark, sf_dir):
    """A customer with several tiers in one batch gets that of the latest order document; the other half of the
    customers' orders come unpromoted, in a later file."""
    late = F.col("o_orderkey") % 2 == 0
    docs = order_documents(load_tables(spark, sf_dir), promote_tier=~late, file_prefix=F.when(late, "u2/").otherwise("u1/"))
    docs = docs.where(F.col("order_id").isNotNull())        # an order without a key is neither early nor late
    st = _store(spark, "tied-dims")
    store_pipeline.load_batch(st, scenario.landing_of(docs, 1))
    return st.current("dim_customer").select("customer_id", "loyalty_tier")


def q_clock_columns(spark, sf_dir):
    """H1, H2: every row of a load has one clock, in whole seconds where asked for."""
    from starling.functions.clock import now, now_seconds

    rows = _table(spark, sf_dir, "orders").select("o_orderstatus", now().alias("n"), now_seconds().alias("s"))
    return rows.groupBy("o_orderstatus").agg(
        F.count_distinct("n").cast("bigint").alias("clocks"), F.count_distinct("s").cast("bigint").alias("second_clocks"),
        F.max(F.date_trunc("second", "s") == F.col("s")).alias("whole_seconds"),
        F.max(F.col("n").between(F.col("s") - F.expr("interval 1 second"), F.col("s") + F.expr("interval 1 second"))).alias("same_time"))


def _large_files(spark, sf_dir, label: str, joined) -> str:
    """Files of up to 100,000 order keys each, documents in key order; ``joined`` makes a file's text of them."""
    docs = order_documents(load_tables(spark, sf_dir))
    name = F.format_string("keys_%05d.json", F.floor(F.col("order_id") / 100_000).cast("bigint"))
    files = docs.groupBy(name.alias("file_name")).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("order_id", "doc"))), lambda x: x["doc"]).alias("_docs"))
    drop = shared_path(spark, "queries", label)
    write_json_array_files(files.select("file_name", joined(F.col("_docs")).alias("value")), drop, "none")
    return drop


def _numbered_orders(rows: DataFrame) -> DataFrame:
    return rows.select("file_name", "row_number", F.variant_get("payload", "$.order_id", "decimal(38,0)").alias("order_id"),
                       F.variant_get("payload", "$.items", "array<variant>").alias("_i"), "reject_reason").select(
        "file_name", "row_number", "order_id", F.size("_i").cast("bigint").alias("item_count"), "reject_reason")


def q_split_array_load(spark, sf_dir):
    """Array files, each read by several tasks that resume at an element."""
    from starling.sources.split_arrays import read_split_arrays

    drop = _large_files(spark, sf_dir, "split-arrays", lambda d: F.concat(F.lit("["), F.array_join(d, ",\n "), F.lit("]")))
    return _numbered_orders(read_split_arrays(spark, drop, from_bytes=1))


def q_json_lines_rows(spark, sf_dir):
    """Row numbers of JSON Lines files that are read in splits."""
    drop = _large_files(spark, sf_dir, "line-rows", lambda d: F.array_join(d, "\n"))
    return _numbered_orders(read_landing(spark, drop, "lines"))


QUERIES.update({
    "split_array_load": q_split_array_load,
    "json_lines_rows": q_json_lines_rows,
    "insert_positional": q_insert_positional,
    "insert_by_name": q_insert_by_name,
    "tied_order_versions": q_tied_order_versions,
    "tied_items": q_tied_items,
    "tied_dim_customer": q_tied_dim_customer,
    "clock_columns": q_clock_columns,
    "change_stream_two_readers": q_change_stream_two_readers,
    "replay_landing": q_replay_landing,
    "load_progress_counts": q_load_progress_counts,
    "rejects_permissive": q_rejects_permissive,
    "store_change_feed": q_store_change_feed,
    "store_item_changes": q_store_item_changes,
    "incremental_equals_batch": q_incremental_equals_batch,
    "layer_counts": q_layer_counts,
    "audit_steps": q_audit_steps,
    "batch_summary": q_batch_summary,
    "reset_and_replay": q_reset_and_replay,
    "compacted_read": q_compacted_read,
    "stream_pipeline": q_stream_pipeline,
    "file_listing": q_file_listing,
    "layer_counts_pending": q_layer_counts_pending,
    "failed_batch_audit": q_failed_batch_audit,
    "run_history_runs": q_run_history_runs,
    "batch_then_stream": q_batch_then_stream,
    "multi_document_rejects": q_multi_document_rejects,
    "load_history_rejects": q_load_history_rejects,
    "json_lines_load": q_json_lines_load,
    "nested_landing": q_nested_landing,
    "rejects_items": q_rejects_items,
    "growing_merge_counts": q_growing_merge_counts,
    "growing_order_changes": q_growing_order_changes,
    "growing_item_changes": q_growing_item_changes,
    "distinct_customers": q_distinct_customers,
    "landing_times": q_landing_times,
})
