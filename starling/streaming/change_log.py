"""Change streams of the staged tables that any number of consumers follow.

``publish`` appends the change images of every committed batch to a log of
Parquet files, one set of files per batch and table; ``read_changes`` is a file
stream over it. Each consumer runs it with a checkpoint of its own and so gets
every image once, at its own pace, as a second consumer of a change stream does.

Only committed batches are published, in order. A batch's images are written
beside the log first; when they are whole, their files are moved into it, each
once, under names that tell the batch. So whatever is lost in between, a later
``publish`` goes on with the same files and no image appears twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.sources.json_files import MAX_FILE_AGE
from starling.store.tables import BATCH, KEYS, Store

TABLES = ("stg_orders", "stg_order_items")


def _log(store: Store, table: str) -> str:
    return f"{store.root}/changes/{table}"


def images(store: Store, table: str, batch_id: int) -> DataFrame:
    """What batch ``batch_id`` changed in ``table``: DELETE and INSERT images, keyed tables with ``_is_update``."""
    return store.changes(table, after=batch_id - 1, upto=batch_id).withColumn(BATCH, F.lit(batch_id).cast("long"))


def published(store: Store, table: str) -> set[int]:
    """The batches whose images are all in the log."""
    marks = f"{_log(store, table)}/_published"
    fs, p = store._fs(marks)
    return {int(s.getPath().getName()) for s in fs.listStatus(p)} if fs.exists(p) else set()


def publish(store: Store, tables: tuple[str, ...] = TABLES) -> list[tuple[str, int]]:
    """Append the images of committed batches that the log lacks; returns what was added."""
    added = []
    for table in tables:
        log, done = _log(store, table), published(store, table)
        store._mkdirs(f"{log}/_published")
        for batch in sorted(r["batch_id"] for r in store.commit_rows()):
            if batch in done:
                continue
            staged = f"{store.root}/_changes_staged/{table}/{batch}"
            if not store.exists(f"{staged}/_SUCCESS"):
                images(store, table, batch).write.mode("overwrite").parquet(staged)
            fs, p = store._fs(staged)
            path = store.spark._jvm.org.apache.hadoop.fs.Path
            for f in sorted(s.getPath().getName() for s in fs.listStatus(p)):
                if f.startswith("part-") and not fs.rename(path(f"{staged}/{f}"), path(f"{log}/batch-{batch:09d}-{f}")):
                    raise RuntimeError(f"could not move {staged}/{f} into the change log")
            store._mkdirs(f"{log}/_published/{batch}")
            store._delete(staged)
            added.append((table, batch))
    return added


def read_changes(spark: SparkSession, store: Store, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the change images of ``table`` with their ``batch_id``; the consumer's checkpoint keeps its place."""
    if table not in TABLES and table not in KEYS:
        raise ValueError(f"no change stream for {table!r}")
    store._mkdirs(_log(store, table))
    schema = images(store, table, -1).schema
    reader = spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE).option("pathGlobFilter", "batch-*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(_log(store, table))
