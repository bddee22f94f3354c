"""Replay of what has landed into a fresh state (I8).

The fresh state shares the landing tables with the old one and has checkpoints
of its own, so nothing is read from source files again: batch loads are taken
from the table they landed in, the stream starts over at the beginning of the
streamed landing table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from starling.store.pipeline import run_batch
from starling.store.tables import Store
from starling.streaming.transform import run_until_drained, start_transform


def replay(spark: SparkSession, store: Store, *, strict: bool = True, strict_dims: bool = False) -> Store:
    """A fresh state beside ``store`` with all that landed there, in the order in which it arrived.

    Batch loads come first, one by one, and then the stream, as they were committed. If loads came after the stream had
    begun, that order isn't kept anywhere but in the load times: then all rows are one batch, in which the latest
    load of an order wins. Rows that landed but were never processed are replayed too. Nothing may land meanwhile.
    """
    fresh = store.reset(keep_landing=True)
    commits = sorted((r["batch_id"], r["source"]) for r in store.commit_rows())
    streams = [b for b, source in commits if source is not None]
    loads = store.landed_batches()
    how = dict(strict=strict, strict_dims=strict_dims)
    if streams and loads and max(loads) > min(streams):
        run_batch(fresh, store.landing(), query_id="replay", source="replay", epoch=0, **how)
        # the stream of the fresh state starts behind what that batch took
        run_until_drained(start_transform(spark, fresh, skip_landed=True))
        return fresh
    for batch in loads:
        run_batch(fresh, store.batch("landing_loads", batch).drop("batch_id"), query_id=f"replay:{batch}", **how)
    if store.has_streamed():
        run_until_drained(start_transform(spark, fresh, **how))
    return fresh
