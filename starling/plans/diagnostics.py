"""Observability queries over the landing table and the audit log (L5-L9, D-2, G1, B12-B14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.clock import within_last_hours


def load_history(landing: DataFrame, hours: int = 48, reference: Column | None = None) -> DataFrame:
    """Per file, rows loaded and first/last load time within the last ``hours``.

    Where the rows carry a reject reason, rejected ones count apart and the file has a status: LOADED,
    PARTIALLY_LOADED or LOAD_FAILED."""
    recent = landing.where(within_last_hours(F.col("load_ts"), hours, reference))
    times = [F.min("load_ts").alias("first_load_ts"), F.max("load_ts").alias("last_load_ts")]
    if "reject_reason" not in landing.columns:
        return recent.groupBy("file_name").agg(F.count(F.lit(1)).cast("bigint").alias("rows_loaded"), *times)
    bad = F.col("reject_reason").isNotNull()
    out = recent.groupBy("file_name").agg(F.count_if(~bad).cast("bigint").alias("rows_loaded"),
                                          F.count_if(bad).cast("bigint").alias("rows_rejected"), *times)
    status = (F.when(F.col("rows_rejected") == 0, "LOADED").when(F.col("rows_loaded") > 0, "PARTIALLY_LOADED")
              .otherwise("LOAD_FAILED"))
    return out.withColumn("status", status)


def load_usage(landing: DataFrame, hours: int = 48, reference: Column | None = None) -> DataFrame:
    """Per hour of load time, files and rows loaded within the last ``hours``."""
    recent = landing.where(within_last_hours(F.col("load_ts"), hours, reference))
    if "reject_reason" in landing.columns:
        recent = recent.where(F.col("reject_reason").isNull())
    return (recent.groupBy(F.window("load_ts", "1 hour").alias("w"))
            .agg(F.count_distinct("file_name").cast("bigint").alias("files_loaded"),
                 F.count(F.lit(1)).cast("bigint").alias("rows_loaded"))
            .select(F.col("w.start").alias("hour_start"), "files_loaded", "rows_loaded"))


def run_history(df: DataFrame, name_col: str, pattern: str, order_col: str) -> DataFrame:
    """Rows whose name matches ``pattern`` case-insensitively, newest first."""
    return df.where(F.col(name_col).ilike(pattern)).orderBy(F.col(order_col).desc())


def layer_counts(tables: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """``SELECT layer, object_name, COUNT(*)`` per table, as one UNION ALL."""
    out = None
    for layer, name, df in tables:
        one = df.agg(F.lit(layer).alias("layer"), F.lit(name).alias("object_name"),
                     F.count(F.lit(1)).cast("bigint").alias("row_count"))
        out = one if out is None else out.unionByName(one)
    return out


def pending_counts(store) -> DataFrame:
    """Rows that the three change streams still have to deliver.

    Landed rows (batch loads and the stream's table) less those that committed batches have read; staged rows of a batch
    that is not committed."""
    read = sum(r["landing_rows"] or 0 for r in store.commit_rows())
    landed = store.landing().agg(F.lit("RAW_ORDERS_STREAM").alias("object_name"),
                                 (F.count(F.lit(1)) - read).cast("bigint").alias("row_count"))
    out = landed
    for name, table in (("STG_ORDERS_STREAM", "stg_orders"), ("STG_ORDER_ITEMS_STREAM", "stg_order_items")):
        out = out.unionByName(store.uncommitted(table).agg(F.lit(name).alias("object_name"),
                                                           F.count(F.lit(1)).cast("bigint").alias("row_count")))
    return out.select(F.lit("STREAM").alias("layer"), "object_name", "row_count")


def runs(audit: DataFrame) -> DataFrame:
    """L3 + L8: one row per attempt of a batch: time, steps, rows, status, failed step and message, newest first."""
    bad = F.col("status") == "FAILED"
    return audit.groupBy("batch_id", "attempt", "query_id").agg(
        F.min("event_ts").alias("batch_ts"), F.max("event_ts").alias("end_ts"),
        F.count_if(~bad).cast("bigint").alias("steps_done"),
        F.max(F.when(F.col("stage_step") == "STREAM_READ_CREATE_TMP", F.col("affected_rows"))).alias("stream_rows"),
        F.max(F.when(F.col("stage_step") == "ROUTE_REJECTS", F.col("affected_rows"))).alias("rejected_rows"),
        F.max(F.when(bad, F.col("stage_step"))).alias("failed_step"),
        F.max(F.when(bad, F.col("error_message"))).alias("error_message"),
    ).select("batch_id", "attempt", "query_id", "batch_ts", "end_ts", "steps_done", "stream_rows",
             F.coalesce("rejected_rows", F.lit(0)).cast("bigint").alias("rejected_rows"),
             F.when(F.col("failed_step").isNull(), "SUCCESS").otherwise("FAILED").alias("status"), "failed_step",
             "error_message").orderBy(F.col("batch_ts").desc())


def batch_summary(audit: DataFrame, commits: DataFrame | None = None) -> DataFrame:
    """L3 + L4: one row per batch with the step counts pivoted and both result texts.

    With ``commits``, only of the attempt that was committed."""
    from starling.functions.text import STAGE1_SUMMARY_LABELS, STAGE2_SUMMARY_LABELS, counts_text
    from starling.schemas import STAGE1_STEPS, STAGE2_STEPS

    ok = audit.where(F.col("status") == "SUCCESS")
    if commits is not None:
        ok = ok.join(commits.select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi")
    steps = STAGE1_STEPS + STAGE2_STEPS
    wide = ok.groupBy("batch_id").pivot("stage_step", steps).agg(F.max("affected_rows"))
    s1 = counts_text([(lbl, F.col(step)) for lbl, step in zip(STAGE1_SUMMARY_LABELS, STAGE1_STEPS)])
    s2 = counts_text([(lbl, F.col(step)) for lbl, step in zip(STAGE2_SUMMARY_LABELS, STAGE2_STEPS[2:])])
    return wide.select(
        F.col("batch_id").cast("bigint").alias("batch_id"),
        F.col("STREAM_READ_CREATE_TMP").cast("bigint").alias("stream_rows"),
        F.col("MERGE_STG_ORDERS").cast("bigint").alias("merged_rows"),
        F.col("DELETE_STG_ORDER_ITEMS").cast("bigint").alias("deleted_rows"),
        F.col("INSERT_STG_ORDER_ITEMS").cast("bigint").alias("inserted_rows"),
        s1.alias("stage1_result"), s2.alias("stage2_result"))
