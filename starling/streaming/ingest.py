"""Query 1: new files -> landing table.

A file-source stream over the landing area; the checkpoint records which files
were taken, so each file is loaded once. ``load_ts`` is the micro-batch's
``current_timestamp()``. Rows go to the native Parquet file sink, whose
``_spark_metadata`` log makes the append exactly-once and is what the
transform stream reads. Unparseable files land as rows with a reject reason;
they are routed to ``rejects`` downstream, never dropped.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starling.sources.json_files import PACKED, WHOLE_DOCUMENTS, Discovery, read_landing
from starling.store.tables import Store
from starling.streaming.progress import LANDED


def start_ingest(spark: SparkSession, source_dir: str, store: Store, max_files_per_trigger: int | None = None,
                 available_now: bool = True, processing_time: str | None = None,
                 strict: bool = False, name: str | None = None, fmt: str = "array", max_bytes_per_trigger: int | None = None,
                 archive: str | None = None) -> StreamingQuery:
    """Start query 1. A micro-batch is bounded by files or by bytes; ``archive`` is a folder outside the area to which
    loaded files are moved once a later batch begins (by a thread that a stream which stops may leave behind, so a drain wants
    ``spark.sql.streaming.fileSource.cleaner.numThreads=0``; what isn't moved isn't loaded again either). Every report of the query tells the rows landed and rejected in its micro-batch (L1, L10)."""
    how = Discovery(max_files_per_trigger, max_bytes_per_trigger, archive)
    rows = read_landing(spark, source_dir, fmt, streaming=True, max_files_per_trigger=how, strict=strict).observe(
        LANDED, F.count(F.lit(1)).alias("rows_landed"), F.count("reject_reason").alias("rows_rejected"))
    w = (rows.writeStream.format("parquet").outputMode("append").options(**WHOLE_DOCUMENTS, **PACKED)
         .option("checkpointLocation", store.checkpoint("ingest"))
         .option("path", store.landing_path))
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()
