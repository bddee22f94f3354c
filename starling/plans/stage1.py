"""Stage 1, raw -> staged (I9): latest version per order, staged orders, exploded items.

Pure DataFrame functions; ``store.pipeline`` runs them per batch against the
stored state, and the pure ``apply_stage1`` runs them against DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.clock import now_seconds
from starling.functions.paths import bad_cast_flag, get_path, item_count, order_columns, order_id
from starling.operators.children import replace_children
from starling.operators.flatten import explode_items
from starling.operators.latest import arrival_order, latest_per_key
from starling.operators.upsert import merge_upsert

REASON_NULL_KEY = "order_id is null"
REASON_BAD_VALUE = "value does not cast"


def with_key(landing: DataFrame, strict: bool = True) -> DataFrame:
    """Landing rows with ``order_id`` extracted (NULL for rows that carry a reject reason)."""
    return _with_key(landing, strict)


def judged(landing: DataFrame, strict: bool = True, money="number") -> DataFrame:
    """Landing rows with ``order_id`` and the ``reason`` why they cannot be staged (NULL when they can)."""
    return _with_key(landing, strict).withColumn("reason", reject_reason(strict, money))


def _with_key(landing: DataFrame, strict: bool) -> DataFrame:
    return landing.withColumn("order_id", F.when(F.col("reject_reason").isNull(), order_id("payload", strict)))


def latest_orders(landing: DataFrame, strict: bool = True, money="number") -> DataFrame:
    """``latest_orders``: one row per order_id, latest arrival wins.

    Rows with a reject reason or a NULL order_id never enter (D9, D14). In
    permissive mode (``strict=False``) documents with a value that does not
    cast are left out too (D10) and reported by ``rejected_rows``.
    """
    return latest_judged(judged(landing, strict, money))


def latest_judged(rows: DataFrame) -> DataFrame:
    """``latest_orders`` of rows that have ``order_id`` and ``reason``."""
    docs = rows.where(F.col("reason").isNull())
    latest = latest_per_key(docs, ["order_id"], arrival_order())
    return latest.select("order_id", "payload", "file_name", "row_number",
                         F.col("load_ts").alias("ingested_at_ltz"))


def reject_reason(strict: bool = True, money="number") -> Column:
    """Why a landing row cannot become a staged row (NULL when it can); needs ``order_id``."""
    reason = F.coalesce(F.col("reject_reason"), F.when(F.col("order_id").isNull(), F.lit(REASON_NULL_KEY)))
    if not strict:
        reason = F.coalesce(reason, F.when(bad_cast_flag("payload", money), F.lit(REASON_BAD_VALUE)))
    return reason


def rejected_rows(landing: DataFrame, strict: bool = True, money="number") -> DataFrame:
    """Landing rows that cannot become staged rows, with the reason (rejects table)."""
    raw = F.coalesce(F.col("raw"), F.to_json(F.col("payload")))
    return (judged(landing, strict, money).where(F.col("reason").isNotNull())
            .select("file_name", "row_number", "reason", raw.alias("raw"), "load_ts"))


def staged_orders(latest: DataFrame, money="number", strict: bool = True,
                  updated_at: Column | None = None) -> DataFrame:
    """Source rows of ``MERGE INTO stg_orders``: the 12 document paths plus lineage and the number of items.

    The number stays with the order's version, so replacing its items later needs no look at them to count them."""
    ts = now_seconds() if updated_at is None else updated_at
    return latest.select(*order_columns("payload", money, strict), "file_name", "ingested_at_ltz",
                         ts.alias("updated_at_ltz"), item_count("payload", strict).alias("item_count"))


def staged_items(latest: DataFrame, money="number", strict: bool = True, outer: bool = False,
                 updated_at: Column | None = None) -> DataFrame:
    """Rows of ``INSERT INTO stg_order_items``: one per element of ``payload:items``."""
    ts = now_seconds() if updated_at is None else updated_at
    base = latest.select("order_id", get_path("payload", "$.order_date", "date", strict=strict).alias("order_date"),
                         "file_name", "ingested_at_ltz", "payload")
    items = explode_items(base, "payload", keep=["order_id", "order_date", "file_name", "ingested_at_ltz"],
                          outer=outer, money=money, strict=strict)
    return items.select("order_id", "order_date", "product_id", "category", "quantity", "unit_price",
                        "file_name", "ingested_at_ltz", ts.alias("updated_at_ltz"))


def apply_stage1(stg_orders: DataFrame | None, stg_items: DataFrame | None, landing: DataFrame,
                 money="number", strict: bool = True, updated_at: Column | None = None):
    """Pure stage 1: returns ``(orders_after, items_after, latest)``.

    ``orders_after`` carries ``_merge_action`` for the merge counts (K8).
    """
    latest = latest_orders(landing, strict, money)
    src = staged_orders(latest, money, strict, updated_at)
    new_items = staged_items(latest, money, strict, updated_at=updated_at)
    if stg_orders is None:
        orders_after = src.withColumn("_merge_action", F.lit("INSERT"))
    else:
        orders_after = merge_upsert(stg_orders, src, ["order_id"])
    if stg_items is None:
        items_after = new_items
    else:
        items_after = replace_children(stg_items, latest.select("order_id"), new_items, ["order_id"])
    return orders_after, items_after, latest
