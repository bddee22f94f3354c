"""Analyst star query over the curated layer (revenue by country, category, tier).

Items are first reduced to one row per (order, category) before the join to
orders, so the wide join and the final aggregate see one row per order and
category instead of one per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_revenue(items: DataFrame, orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_order = (items.select("order_id", "product_id", "extended_amount")
                 .join(dim_product.select("product_id", "category"), "product_id", "left")
                 .groupBy("order_id", "category")
                 .agg(F.sum("extended_amount").alias("_rev"), F.count(F.lit(1)).alias("_lines")))
    joined = (per_order.join(orders.select("order_id", "customer_id", "shipping_country"), "order_id")
              .join(dim_customer.select("customer_id", "loyalty_tier"), "customer_id", "left"))
    return joined.groupBy("shipping_country", "category", "loyalty_tier").agg(
        F.sum("_rev").cast("decimal(38,0)").alias("revenue"),
        F.count(F.lit(1)).cast("bigint").alias("orders"),
        F.sum("_lines").cast("bigint").alias("items"))
