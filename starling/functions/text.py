"""Summary text built from step counts (H4, H5, L4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def counts_text(pairs: list[tuple[str, Column]]) -> Column:
    """``'a=' || COALESCE(x, 0) || ', b=' || ...`` with numbers printed as text."""
    parts: list[Column] = []
    for i, (label, value) in enumerate(pairs):
        prefix = f"{label}=" if i == 0 else f", {label}="
        parts += [F.lit(prefix), F.coalesce(value.cast("bigint"), F.lit(0)).cast("string")]
    return F.concat(*parts)


# Labels of the two procedure result texts, in print order.
STAGE1_SUMMARY_LABELS = ["latest", "merged", "deleted", "inserted"]
STAGE2_SUMMARY_LABELS = ["dim_customer", "dim_product", "fact_orders", "items_deleted", "items_inserted"]
