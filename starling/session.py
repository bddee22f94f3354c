"""Session construction and shared-folder helpers.

Library code never sets cluster-wide configuration on a session it did not
build: jobs pass per-write options instead. ``build_session`` is for tests,
the bench and command-line runs.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = "local[8]", shuffle_partitions: int = 8, app: str = "starling",
                  extra: dict | None = None) -> SparkSession:
    """A session for tests, the bench and the command line; ``master=None`` takes the submitter's session as it is."""
    builder = SparkSession.builder.appName(app)
    conf = dict(extra or {})
    if master:
        builder = builder.master(master)
        conf = {**LOCAL_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if master:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach, and it is
    only read here. When it is unset, a private folder is set for a local master
    (tests); on any other master that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            d = None
    if not d:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="starling-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(d)   # core config: set on the context, not spark.conf
            d = spark.sparkContext.getCheckpointDir() or d
        except Exception:
            pass
    else:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(d)
        except Exception:
            pass
    return d.rstrip("/")


# Spark drops a query's shuffle files when it ends, not when the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DROPPING: dict[str, list] = {}         # by session: how many ask for it, and the setting before
_LOCK = threading.Lock()


@contextmanager
def dropped_shuffles(*sessions: SparkSession) -> Iterator[None]:
    """While this holds, what a query of these sessions shuffled is dropped when the query ends; then their setting is as before.

    For queries that run once, such as writes. Several threads of a session may ask for it; the last one puts the setting back."""
    for s in sessions:
        with _LOCK:
            asked = _DROPPING.setdefault(s._jsparkSession.sessionUUID(), [0, s.conf.get(DROP_SHUFFLES, None)])
            asked[0] += 1
            s.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        for s in sessions:
            with _LOCK:
                name = s._jsparkSession.sessionUUID()
                _DROPPING[name][0] -= 1
                if not _DROPPING[name][0]:
                    _, before = _DROPPING.pop(name)
                    if before is None:
                        s.conf.unset(DROP_SHUFFLES)
                    else:
                        s.conf.set(DROP_SHUFFLES, before)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder, with all in it, from whatever store it lies in; none there is no error."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    tail = "/".join(p.strip("/") for p in parts if p)
    path = f"{base}/starling/{tail}" if tail else f"{base}/starling"
    if unique:
        path = f"{path}/{uuid.uuid4().hex[:12]}"
    return path
