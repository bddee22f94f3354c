"""Dimension sources: one row per key (D-4, D4, D5).

``SELECT DISTINCT customer_id, loyalty_tier, segment`` gives two rows for a
customer whose tier changed inside one batch, which a MERGE cannot apply
deterministically. The default reduces to the latest row per key; strict mode
raises instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.operators.latest import latest_per_key


class ConflictingVersions(ValueError):
    pass


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """D-4: ``SELECT DISTINCT`` over several columns (partial aggregation before the shuffle)."""
    return df.select(*cols).dropDuplicates(cols)


def one_row_per_key(df: DataFrame, key: str, value_cols: list[str], order_by: list[Column],
                    strict: bool = False) -> DataFrame:
    if strict:
        bad = (df.groupBy(key).agg(F.count_distinct(F.struct(*value_cols)).alias("_n"))
               .where(F.col("_n") > 1).limit(1).collect())
        if bad:
            raise ConflictingVersions(f"{key}={bad[0][0]} has {bad[0][1]} different {value_cols} in one batch")
    return latest_per_key(df, [key], order_by).select(key, *value_cols)
