"""Time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def now() -> Column:
    """``CURRENT_TIMESTAMP()``: one value per query."""
    return F.current_timestamp()


def now_seconds() -> Column:
    """``current_timestamp(0)``: whole seconds."""
    return F.date_trunc("second", F.current_timestamp())


def hours_before(ts: Column, hours: int) -> Column:
    """``DATEADD(hour, -n, ts)``."""
    return ts - F.make_dt_interval(hours=F.lit(hours))


def within_last_hours(ts_col: Column, hours: int, reference: Column | None = None) -> Column:
    """``ts >= DATEADD(hour, -n, reference)``; reference defaults to the clock."""
    ref = now() if reference is None else reference
    return ts_col >= hours_before(ref, hours)
