"""Declared table schemas of every layer (landing, staged, curated, audit).

Reference ``number`` columns carry no precision, which the warehouse reads as
``decimal(38,0)``: cents are rounded away (half away from zero). ``money_type``
keeps that as the default and offers ``decimal(18,2)`` as an option.
"""

from __future__ import annotations

from pyspark.sql import types as T

NUMBER = T.DecimalType(38, 0)
MONEY_TYPES = {
    "number": T.DecimalType(38, 0),   # reference result: whole currency units
    "cents": T.DecimalType(18, 2),    # keeps cents
}


def money_type(name: str | T.DecimalType = "number") -> T.DecimalType:
    if isinstance(name, T.DecimalType):
        return name
    return MONEY_TYPES[name]


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# Landing row: one row per order document, with file lineage. ``raw`` and
# ``reject_reason`` are set only for text that did not parse into documents.
LANDING = T.StructType([
    _f("file_name", T.StringType()),
    _f("row_number", T.LongType()),
    _f("load_ts", T.TimestampType()),
    _f("payload", T.VariantType()),
    _f("reject_reason", T.StringType()),
    _f("raw", T.StringType()),
])


def stg_orders(money: str | T.DecimalType = "number") -> T.StructType:
    m = money_type(money)
    return T.StructType([
        _f("customer_id", NUMBER), _f("loyalty_tier", T.StringType()), _f("segment", T.StringType()),
        _f("order_date", T.DateType()), _f("order_id", NUMBER), _f("payment_amount", m),
        _f("payment_currency", T.StringType()), _f("payment_method", T.StringType()),
        _f("shipping_city", T.StringType()), _f("shipping_country", T.StringType()),
        _f("shipping_delivery_type", T.StringType()), _f("status", T.StringType()),
        _f("file_name", T.StringType()), _f("ingested_at_ltz", T.TimestampType()),
        _f("updated_at_ltz", T.TimestampType()), _f("item_count", T.LongType()),
    ])


def stg_order_items(money: str | T.DecimalType = "number") -> T.StructType:
    m = money_type(money)
    return T.StructType([
        _f("order_id", NUMBER), _f("order_date", T.DateType()), _f("product_id", NUMBER),
        _f("category", T.StringType()), _f("quantity", NUMBER), _f("unit_price", m),
        _f("file_name", T.StringType()), _f("ingested_at_ltz", T.TimestampType()),
        _f("updated_at_ltz", T.TimestampType()),
    ])


DIM_CUSTOMER = T.StructType([
    _f("customer_id", NUMBER), _f("segment", T.StringType()), _f("loyalty_tier", T.StringType()),
    _f("updated_at", T.TimestampType()),
])

DIM_PRODUCT = T.StructType([
    _f("product_id", NUMBER), _f("category", T.StringType()), _f("updated_at", T.TimestampType()),
])


def fact_orders(money: str | T.DecimalType = "number") -> T.StructType:
    m = money_type(money)
    return T.StructType([
        _f("order_id", NUMBER), _f("customer_id", NUMBER), _f("order_date", T.DateType()),
        _f("payment_amount", m), _f("payment_currency", T.StringType()), _f("payment_method", T.StringType()),
        _f("shipping_city", T.StringType()), _f("shipping_country", T.StringType()),
        _f("shipping_delivery_type", T.StringType()), _f("status", T.StringType()),
        _f("updated_at", T.TimestampType()),
    ])


def fact_order_items(money: str | T.DecimalType = "number") -> T.StructType:
    m = money_type(money)
    ext = T.DecimalType(38, m.scale)
    return T.StructType([
        _f("order_id", NUMBER), _f("product_id", NUMBER), _f("order_date", T.DateType()),
        _f("quantity", NUMBER), _f("unit_price", m), _f("extended_amount", ext),
        _f("updated_at", T.TimestampType()),
    ])


PIPELINE_AUDIT = T.StructType([
    _f("audit_id", T.LongType()), _f("file_name", T.StringType()), _f("procedure_name", T.StringType()),
    _f("stage_step", T.StringType()), _f("event_ts", T.TimestampType()), _f("affected_rows", T.LongType()),
    _f("status", T.StringType()), _f("error_message", T.StringType()), _f("query_id", T.StringType()),
    _f("file_count", T.LongType()), _f("attempt", T.StringType()),
])

REJECTS = T.StructType([
    _f("file_name", T.StringType()), _f("row_number", T.LongType()), _f("reason", T.StringType()),
    _f("raw", T.StringType()), _f("load_ts", T.TimestampType()),
])

COMMITS = T.StructType([
    _f("batch_id", T.LongType()), _f("committed_at", T.TimestampType()), _f("query_id", T.StringType()),
    _f("file_count", T.LongType()), _f("landing_rows", T.LongType()), _f("attempt", T.StringType()),
    _f("source", T.StringType()), _f("epoch", T.LongType()), _f("tables", T.StringType()),
])

# Procedure and audit step names, in the order the steps run.
STAGE1_PROCEDURE = "SP_RAW_TO_STG_ORDERS"
STAGE2_PROCEDURE = "SP_STG_TO_CURATED"
STAGE1_STEPS = ["STREAM_READ_CREATE_TMP", "MERGE_STG_ORDERS", "DELETE_STG_ORDER_ITEMS", "INSERT_STG_ORDER_ITEMS"]
STAGE2_STEPS = ["STREAM_READ_ORDERS", "STREAM_READ_ORDER_ITEMS", "MERGE_DIM_CUSTOMER", "MERGE_DIM_PRODUCT",
                "MERGE_FACT_ORDERS", "DELETE_FACT_ORDER_ITEMS", "INSERT_FACT_ORDER_ITEMS"]
REJECTS_STEP = "ROUTE_REJECTS"          # own step: only in batches that have rejects
