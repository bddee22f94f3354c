"""Typed extraction of document paths (``payload:a:b::type``).

Everything stays a JVM expression (``variant_get``), so extraction runs inside
whole-stage codegen with no Python on the hot path. ``strict`` extraction
raises on a value that does not cast (the reference fails the batch);
permissive extraction (``try_variant_get``) yields NULL and lets the caller
route the row to rejects.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.schemas import NUMBER, money_type

# Document paths read by the staged layer, with their target
# columns and kinds ("number" = decimal(38,0), "money" = configured money type).
ORDER_PATHS = [
    ("customer_id", "$.customer.customer_id", "number"),
    ("loyalty_tier", "$.customer.loyalty_tier", "string"),
    ("segment", "$.customer.segment", "string"),
    ("order_date", "$.order_date", "date"),
    ("order_id", "$.order_id", "number"),
    ("payment_amount", "$.payment.amount", "money"),
    ("payment_currency", "$.payment.currency", "string"),
    ("payment_method", "$.payment.method", "string"),
    ("shipping_city", "$.shipping.city", "string"),
    ("shipping_country", "$.shipping.country", "string"),
    ("shipping_delivery_type", "$.shipping.delivery_type", "string"),
    ("status", "$.status", "string"),
]
ITEMS_PATH = "$.items"
ITEM_PATHS = [
    ("product_id", "$.product_id", "number"),
    ("category", "$.category", "string"),
    ("quantity", "$.quantity", "number"),
    ("unit_price", "$.unit_price", "money"),
]


def spark_type(kind: str, money="number") -> T.DataType:
    if kind == "number":
        return NUMBER
    if kind == "money":
        return money_type(money)
    if kind == "string":
        return T.StringType()
    if kind == "date":
        return T.DateType()
    if kind == "timestamp":
        return T.TimestampType()
    raise ValueError(kind)


def get_path(doc: Column | str, path: str, kind: str, money="number", strict: bool = True) -> Column:
    """``doc:path::kind`` as a typed column."""
    fn = F.variant_get if strict else F.try_variant_get
    dtype = spark_type(kind, money).simpleString()
    return fn(F.col(doc) if isinstance(doc, str) else doc, path, dtype)


def order_id(doc: Column | str, strict: bool = True) -> Column:
    return get_path(doc, "$.order_id", "number", strict=strict)


def order_columns(doc: Column | str, money="number", strict: bool = True) -> list[Column]:
    return [get_path(doc, p, k, money, strict).alias(name) for name, p, k in ORDER_PATHS]


def item_columns(item: Column | str, money="number", strict: bool = True) -> list[Column]:
    return [get_path(item, p, k, money, strict).alias(name) for name, p, k in ITEM_PATHS]


def items_array(doc: Column | str, strict: bool = True) -> Column:
    """The ``items`` array as ``array<variant>``; missing or JSON null -> NULL."""
    fn = F.variant_get if strict else F.try_variant_get
    return fn(F.col(doc) if isinstance(doc, str) else doc, ITEMS_PATH, "array<variant>")


def item_count(doc: Column | str, strict: bool = True) -> Column:
    """Number of items; the items themselves are only taken out of the document where ``items`` is no array."""
    d = F.col(doc) if isinstance(doc, str) else doc
    return F.coalesce(F.size(F.try_variant_get(d, ITEMS_PATH, "array<struct<>>")), F.size(items_array(d, strict)), F.lit(0)).cast("long")


def _bad_value(doc: Column, paths, money) -> Column:
    """True when some path of ``doc`` holds a value that is present but does not cast; every value casts to a string."""
    out = F.lit(False)
    for _, p, k in paths:
        if k != "string":
            raw = F.variant_get(doc, p, "variant")      # looked at only where the cast gives NULL
            out = out | (get_path(doc, p, k, money, strict=False).isNull() & raw.isNotNull() & ~F.is_variant_null(raw))
    return out


def _typed_items(doc: Column, money) -> Column:
    """All items cast at once, without those of their values that are strings; NULL when ``items`` is no array."""
    fields = ",".join(f"{p.removeprefix('$.')}:{spark_type(k, money).simpleString()}" for _, p, k in ITEM_PATHS if k != "string")
    return F.try_variant_get(doc, ITEMS_PATH, f"array<struct<{fields}>>")


def bad_cast_flag(doc: Column | str, money="number") -> Column:
    """True when the document cannot be staged whole: a value of the order or of an item does not cast, ``items`` is
    present but no array, or an item is no object."""
    d = F.col(doc) if isinstance(doc, str) else doc
    raw, typed = F.variant_get(d, ITEMS_PATH, "variant"), _typed_items(d, money)
    no_array = typed.isNull() & raw.isNotNull() & ~F.is_variant_null(raw)
    # items are looked at one by one only where an item, or a value of one, is NULL after the cast
    some_null = F.exists(typed, lambda x: reduce(or_, [x[p.removeprefix("$.")].isNull() for _, p, k in ITEM_PATHS if k != "string"]))
    bad_item = F.exists(items_array(d, strict=False), lambda x: ~F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False))
                        | _bad_value(x, ITEM_PATHS, money))
    return _bad_value(d, ORDER_PATHS, money) | no_array | (F.coalesce(some_null, F.lit(False)) & F.coalesce(bad_item, F.lit(False)))
