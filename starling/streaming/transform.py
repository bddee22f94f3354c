"""Query 2: landing table -> staged -> curated, one ``foreachBatch`` per micro-batch.

The landing table is read as a stream (its change stream, I1). Each
micro-batch runs stage 1 then stage 2 (I6) through ``store.pipeline.run_batch``
as the state's next batch. The commit names the stream (the id that its
checkpoint keeps) and the epoch: a replayed epoch that is committed is skipped,
while batch loads and other checkpoints on the same state have numbers of their
own. The checkpoint advances only after ``foreachBatch`` returns
(consume-and-advance, I4); a run with no new rows calls it zero times (I5).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starling import schemas as S
from starling.store.pipeline import run_batch
from starling.store.tables import Store
from starling.streaming.change_log import publish


def start_transform(spark: SparkSession, store: Store, max_files_per_trigger: int | None = None,
                    available_now: bool = True, processing_time: str | None = None,
                    strict: bool = True, name: str | None = None,
                    compact_every: int | None = None, strict_dims: bool = False, publish_changes: bool = False,
                    skip_landed: bool = False) -> StreamingQuery:
    """Start query 2. ``compact_every=N`` compacts the state after every N-th committed batch,
    inside ``foreachBatch`` (so it never runs next to a batch's own writes). ``publish_changes`` appends each batch's
    change images to the change log once it is committed. ``skip_landed`` takes what has landed as processed."""
    reader = spark.readStream.schema(S.LANDING)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    src = reader.parquet(store.landing_path)
    holder: dict = {}
    started = threading.Event()

    def each(df: DataFrame, epoch_id: int) -> None:
        if skip_landed:
            return
        started.wait()
        q = holder["q"]
        out = run_batch(store, df, query_id=f"{q.runId}:{epoch_id}", strict=strict, strict_dims=strict_dims,
                        source=str(q.id), epoch=int(epoch_id))
        if compact_every and not out["skipped"] and (out["batch_id"] + 1) % compact_every == 0:
            store.compact()
        if publish_changes:
            publish(store)

    w = src.writeStream.foreachBatch(each).option("checkpointLocation", store.checkpoint("transform"))
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    q = w.start()
    holder["q"] = q
    started.set()
    return q


def run_until_drained(*queries: StreamingQuery) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
