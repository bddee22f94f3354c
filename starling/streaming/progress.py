"""Load progress rows, one per reported micro-batch.

``ProgressRecorder`` writes each report as it comes, so none is lost to the limit on the reports that a query keeps.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS_SCHEMA = ("query_name string, run_id string, batch_id long, ts string, num_input_rows long, "
                   "input_rows_per_second double, processed_rows_per_second double, duration_ms long, "
                   "rows_landed long, rows_rejected long")

# The name under which the ingest stream counts what lands; a stream without it has no such counts.
LANDED = "landed"


def _row(p) -> tuple:
    d = p if isinstance(p, dict) else json.loads(p.json)
    landed = (d.get("observedMetrics") or {}).get(LANDED) or {}
    if hasattr(landed, "asDict"):
        landed = landed.asDict()
    return (d.get("name"), d.get("runId"), d.get("batchId"), d.get("timestamp"), d.get("numInputRows"),
            float(d.get("inputRowsPerSecond") or 0.0), float(d.get("processedRowsPerSecond") or 0.0),
            int((d.get("durationMs") or {}).get("triggerExecution", 0)), landed.get("rows_landed"), landed.get("rows_rejected"))


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The reports that the query still keeps (small driver-side metadata, not data)."""
    return spark.createDataFrame([_row(p) for p in query.recentProgress], PROGRESS_SCHEMA)


class ProgressRecorder(StreamingQueryListener):
    """Appends every progress report of the session's queries to a table; register with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        rows = self.spark.createDataFrame([_row(event.progress)], PROGRESS_SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
