"""Helpers shared by the training-data operators: shared-folder tables, connected components, text columns."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.session import ensure_checkpoint_dir

# Distinct edges that one task may hold to find their components; more are solved by rounds of joins.
LOCAL_EDGES = 500_000

# A side of at most this many rows of a few dozen bytes may be broadcast; the count is taken first.
BROADCAST_MAX_ROWS = 1_000_000


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/starling/llm/{name}-{uuid.uuid4().hex[:12]}"


def table(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most BROADCAST_MAX_ROWS rows (counted unless known), else as it is."""
    if rows is None:
        rows = df.count()
    return F.broadcast(df) if rows <= BROADCAST_MAX_ROWS else df


_KEPT: dict = {}


def keep(key, make):
    """The object of ``key`` that a Python worker keeps from task to task; one at a time, made by ``make`` if it isn't there."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Drop what an earlier task left in this Python worker, for tasks that need the room themselves.

    The freed memory goes back to the system: an allocator that keeps it holds the greatest need of each earlier stage.
    """
    _KEPT.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)         # glibc only
    if trim is not None:
        trim(0)


def binary_values(column: pa.Array | pa.ChunkedArray) -> list:
    """UTF-8 bytes (or None) of each value of a text column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def each_binary(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes | None]:
    """The values of ``binary_values`` one at a time, so that a batch of long texts isn't held twice."""
    return (v.as_py() for v in column.cast(pa.binary()))


def least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index reachable from each of ``n`` points over the links ``a, b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _local_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    high, low, kind = [], [], None
    for batch in batches:
        kind = batch.column("hi").type
        high += batch.column("hi").to_pylist()
        low += batch.column("lo").to_pylist()
    if high:
        nodes = sorted({*high, *low})
        index = {v: i for i, v in enumerate(nodes)}
        label = least_reachable(len(nodes), np.array([index[v] for v in high]), np.array([index[v] for v in low]))
        names = pa.array(nodes, kind)
        yield pa.RecordBatch.from_arrays([names, names.take(pa.array(label))], names=["node", "component"])


def connected_components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """Components of the undirected graph of ``edges(src, dst)`` as ``(node, component)``.

    ``component`` is the least node of the component. Nodes without an edge to another node are absent; null ends are
    ignored. Up to ``local_edges`` distinct edges (counted) are solved in one task; more by rounds that give the same result:
    they alternate large-star and small-star steps (each an aggregation of minima, which combines before the
    shuffle, and an equi-join, whose hot keys AQE splits) until the edges no longer change; every round is written to
    the shared folder and only its count and checksum reach the driver.
    """
    pairs = edges.where("src is not null and dst is not null and src <> dst").select(
        F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
    current = table(pairs.distinct(), "edges")
    if current.count() <= local_edges:
        kind = current.schema["hi"].dataType.simpleString()
        return table(current.coalesce(1).mapInArrow(_local_components, f"node {kind}, component {kind}"), "components")
    seen = None
    while True:
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                 .where("hi <> lo").distinct())
        roots = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(roots, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(roots.select("hi", F.col("m").alias("lo"))).distinct())
        current = table(small, "stars")
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if state == seen:
            roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
        seen = state
