"""Child-set replacement per parent: DELETE ... WHERE k IN (...) then INSERT.

Items have no key of their own (a product may repeat inside one order), so
they are never merged: every child row of an affected parent is removed and
the parent's new children are appended ("snapshot semantics").
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starling.operators.joins import bounded_broadcast


def parent_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """D-5: the distinct key set (``SELECT DISTINCT k``)."""
    return df.select(*keys).distinct()


def matched_children(target: DataFrame, keys_df: DataFrame, keys: list[str],
                     keys_rows: int | None = None) -> DataFrame:
    """Rows a ``DELETE ... WHERE k IN (keys)`` removes (left semi join)."""
    return target.join(bounded_broadcast(keys_df.select(*keys), keys_rows), keys, "left_semi")


def delete_by_keys(target: DataFrame, keys_df: DataFrame, keys: list[str],
                   keys_rows: int | None = None) -> DataFrame:
    """Survivors of ``DELETE ... WHERE k IN (keys)`` (left anti join; NULL keys survive)."""
    return target.join(bounded_broadcast(keys_df.select(*keys), keys_rows), keys, "left_anti")


def replace_children(target: DataFrame, keys_df: DataFrame, new_rows: DataFrame, keys: list[str],
                     keys_rows: int | None = None) -> DataFrame:
    """K7: drop every child of an affected parent, then append the new children."""
    return delete_by_keys(target, keys_df, keys, keys_rows).unionByName(new_rows.select(*target.columns))
