"""Upsert (MERGE ... WHEN MATCHED UPDATE / WHEN NOT MATCHED INSERT): K1-K4, C2, K8.

``merge_upsert`` is a pure DataFrame -> DataFrame function without a join: both
sides are united and one aggregation by key meets them, which combines before
the shuffle. Each output row carries ``_merge_action`` ('INSERT', 'UPDATE' or
NULL for untouched rows) so affected row counts come from the same pass
(``SQLROWCOUNT``).

The target holds one row per key. The source does too (see
``operators.dims.one_row_per_key``), or it may hold several versions of a key if
``version`` tells the latest; however many they are, each task moves one. A row with a NULL
in its key never matches, so such a row is inserted, as in the warehouse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "_merge_action"


def met_by_key(left: DataFrame, right: DataFrame, keys: list[str], version: list[str] | None = None) -> DataFrame:
    """``(*keys, _l, _r)``: the rows of both sides with equal keys as structs, NULL where a side has none.

    One row per key without a NULL; a row with a NULL in its key meets nothing and stays on its own. Of several rows of
    ``right`` with a key that of the greatest ``version`` is taken (none of two equal versions is preferred).
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*[c for c in df.columns if c not in keys], F.lit(True).alias("_there")).alias(name))

    both = side(left, "_l").unionByName(side(right, "_r"), allowMissingColumns=True)
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    latest = F.first("_r", ignorenulls=True)
    if version:
        latest = F.max_by("_r", F.when(F.col("_r").isNotNull(), F.struct(*[F.col(f"_r.{c}") for c in version])))
    met = both.where(keyed).groupBy(*keys).agg(F.first("_l", ignorenulls=True).alias("_l"), latest.alias("_r"))
    return met.unionByName(both.where(~keyed))


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str],
                 update_cols: list[str] | None = None, insert_cols: list[str] | None = None,
                 set_values: dict[str, Column] | None = None, version: list[str] | None = None) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``.

    ``update_cols``/``insert_cols`` default to every target column found by
    name in the source (``UPDATE ALL BY NAME`` / ``INSERT ALL BY NAME``).
    ``set_values`` gives expressions for columns set on both update and insert
    (for example ``updated_at = CURRENT_TIMESTAMP()``). ``version`` names source
    columns of which the greatest values mark a key's latest row (a source row with all
    of them NULL counts as the earliest).
    """
    set_values = set_values or {}
    tcols = [c for c in target.columns if c not in keys]
    scols = [c for c in source.columns if c not in keys]
    by_name = [c for c in tcols if c in scols]
    update_cols = by_name if update_cols is None else update_cols
    insert_cols = by_name if insert_cols is None else insert_cols
    j = met_by_key(target, source, keys, version)
    in_t, in_s = F.col("_l").isNotNull(), F.col("_r").isNotNull()
    matched, inserted = in_s & in_t, in_s & ~in_t
    out = []
    for c in tcols:
        dtype = target.schema[c].dataType
        new_val = set_values[c] if c in set_values else (F.col("_r").getField(c) if c in scols else F.lit(None))
        expr = F.col("_l").getField(c)
        if c in update_cols or c in set_values:
            expr = F.when(matched, new_val.cast(dtype)).otherwise(expr)
        ins_val = new_val.cast(dtype) if (c in insert_cols or c in set_values) else F.lit(None).cast(dtype)
        expr = F.when(inserted, ins_val).otherwise(expr)
        out.append(expr.alias(c))
    action = F.when(matched, F.lit("UPDATE")).when(inserted, F.lit("INSERT"))
    return j.select(*keys, *out, action.alias(ACTION)).select(*target.columns, ACTION)


def merge_counts(merged: DataFrame) -> DataFrame:
    """K8: one row ``(inserted_rows, updated_rows, merged_rows)`` from a merge result."""
    a = F.col(ACTION)
    return merged.agg(
        F.count(F.when(a == "INSERT", 1)).cast("bigint").alias("inserted_rows"),
        F.count(F.when(a == "UPDATE", 1)).cast("bigint").alias("updated_rows"),
        F.count(a).cast("bigint").alias("merged_rows"))
