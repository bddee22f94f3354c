"""Join helpers with a checked broadcast.

A side is broadcast only when its row count is already known (for example
from an ``Observation`` on the step that produced it) and under a bound;
otherwise the plan is left to Catalyst/AQE, which re-plans at runtime from
the real shuffle sizes and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key set of this many rows stays a few tens of MB when broadcast.
BROADCAST_MAX_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, known_rows: int | None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    if known_rows is not None and known_rows <= max_rows:
        return F.broadcast(df)
    return df
