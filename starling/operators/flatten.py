"""Lateral flatten of a document's item array."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.paths import item_columns, items_array


def explode_items(docs: DataFrame, doc_col: str = "payload", keep: list[str] | None = None,
                  outer: bool = False, money="number", strict: bool = True) -> DataFrame:
    """One row per element of ``doc:items``.

    Inner (default, as ``LATERAL FLATTEN``): an empty or missing array drops the
    document. ``outer=True`` keeps it with NULL item fields. ``item_pos`` is the
    element's 0-based position. Runs inside the scan stage: no shuffle.
    """
    keep = keep or []
    gen = F.posexplode_outer if outer else F.posexplode
    exploded = docs.select(*keep, gen(items_array(doc_col, strict)).alias("item_pos", "_item"))
    return exploded.select(*keep, "item_pos", *item_columns("_item", money, strict))
