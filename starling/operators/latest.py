"""Latest version per key.

``ROW_NUMBER() OVER (PARTITION BY k ORDER BY ...) = 1`` as a window plus a
filter. Catalyst turns the filter into ``WindowGroupLimit``: a *partial* top-1
runs on each map task before the shuffle, so a hot key sends at most one row
per map partition across the network, never its whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_number_over(keys: list[str], order_by: list[Column]) -> Column:
    """``row_number() over (partition by keys order by ...)``."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[Column], rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per key in ``order_by`` order (``QUALIFY rn = 1``)."""
    return (df.withColumn(rank_col, row_number_over(keys, order_by))
            .where(F.col(rank_col) == 1).drop(rank_col))


def arrival_order() -> list[Column]:
    """Total order for document versions: latest load first, then file, then row."""
    return [F.col("load_ts").desc_nulls_last(), F.col("file_name").desc_nulls_last(),
            F.col("row_number").desc_nulls_last()]
