"""Near-duplicate vectors by sorted projection passes.

Each pass orders all distinct vectors by a key of concatenated random hyperplane hashes and compares every vector with the
``window`` that stand before it. Verified pairs of all passes are united. Vectors in places so dense that the windows don't
reach far enough are found by the codes at the windows' edges, and compared with each other in full, tile by tile.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import connected_components, least_reachable, small_side, table

WINDOW = 1024                   # neighbours compared on each side
BLOCK = 4 * WINDOW              # vectors compared in one task, beside the window before them
KEY_BITS = 62
MISS = 1e-6                     # wanted chance of missing a pair at the threshold, for vectors spread evenly
LEAST_PASSES = 24
PASSES_AT_ONCE = 6
TILE_BYTES = 16 << 20           # vectors of a tile of dense places; a task holds two tiles
TILES = 8                       # tiles wanted at least, if they have a block's rows
CELLS = 1 << 22                 # products held at once


def passes_for(n: int, threshold: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes for ``n`` vectors: a pair meets in one if its keys share the bits that cut ``n`` down to a window."""
    bits = max(0.0, math.log2(max(n, 1) / window)) + 1
    together = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return max(LEAST_PASSES, math.ceil(math.log(miss) / math.log1p(-together))) if n > window else 1


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square overflows or vanishes."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def prepared(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, key, dim, vec`` per row: the vector's bytes and their digest, all null for one that can't be linked."""
    fields = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    id_type = fields.schema["id"].dataType.simpleString()
    single = fields.schema["vector"].dataType.elementType.simpleString() == "float"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, dims, vecs = [], [], []
            for value in batch.column("vector"):
                row = None
                if value.is_valid and len(value.values) and not value.values.null_count:
                    row = value.values.to_numpy(zero_copy_only=False).astype(np.float32 if single else np.float64)
                    row = row + 0.0 if np.isfinite(row).all() and row.any() else None      # -0.0 is 0.0
                keys.append(None if row is None else hashlib.blake2b(row.tobytes(), digest_size=16).digest())
                dims.append(None if row is None else len(row))
                vecs.append(None if row is None else row.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.binary()), pa.array(dims, pa.int32()),
                                              pa.array(vecs, pa.binary())], names=["id", "key", "dim", "vec"])

    return fields.mapInArrow(run, f"id {id_type}, key binary, dim int, vec binary")


def _matrix(vecs: list[bytes], single: bool) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), np.float32 if single else np.float64).reshape(len(vecs), -1)


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits that two codes have in common."""
    x = a ^ b
    high = x >> 31
    return KEY_BITS - np.where(high > 0, 31 + np.frexp(high.astype(np.float64))[1], np.frexp((x & 0x7FFFFFFF).astype(np.float64))[1])


def _positions(classes: DataFrame, passes: int, single: bool, threshold: float, window: int) -> DataFrame:
    """``key, places, dense``: each class's place in the order of every pass (an array by pass), and whether windows fall short.

    Rows are range-partitioned and sorted by (pass, dim, hash key, class); a place is the running number in the task plus
    the rows of the tasks before it. Only the tasks' row counts reach the driver.
    All codes that share one bit more with a class than those just outside its window do stand in the window, so the chance
    that a pair at the threshold meets in a pass follows from these bits, however the vectors lie; ``dense`` are the
    classes that miss such a pair in all passes with a chance above MISS.
    """
    reach = window + 1

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            vecs = batch.column("vec").to_pylist()
            for dim in np.unique(dims):
                if dim not in planes:
                    planes[dim] = np.random.default_rng(int(dim)).standard_normal((int(dim), passes * KEY_BITS))
                own = np.flatnonzero(dims == dim)
                for some in np.split(own, range(2048, len(own), 2048)):
                    bits = (_unit(_matrix([vecs[i] for i in some], single)) @ planes[dim] >= 0).reshape(len(some), passes, KEY_BITS)
                    code = np.zeros((len(some), passes), np.int64)
                    for k in range(KEY_BITS):
                        code = (code << 1) | bits[:, :, k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.tile(np.arange(passes, dtype=np.int32), len(some))),
                         pa.array(np.full(len(some) * passes, dim, np.int32)), pa.array(code.ravel()),
                         batch.column("key").take(pa.array(np.repeat(some, passes)))], names=["pass", "dim", "code", "key"])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), schema=arrow)
        part, n = TaskContext.get().partitionId(), rows.num_rows
        step, dim, code = (rows.column(c).to_numpy() for c in ("pass", "dim", "code"))
        bits = np.full(max(n - reach, 0), -1, np.int32)
        if n > reach:
            same = (step[reach:] == step[:-reach]) & (dim[reach:] == dim[:-reach])
            bits[same] = _shared_bits(code[reach:][same], code[:-reach][same])
        beyond = pa.nulls(min(n, reach), pa.int32())                  # stands in another task
        out = pa.table({"pass": rows.column("pass"), "dim": rows.column("dim"), "code": rows.column("code"), "key": rows.column("key"),
                        "part": pa.array(np.full(n, part, np.int32)), "local": pa.array(np.arange(n)),
                        "before": pa.chunked_array([beyond, pa.array(bits)]), "after": pa.chunked_array([pa.array(bits), beyond])})
        yield from out.to_batches(max_chunksize=10_000)

    arrow = pa.schema([("pass", pa.int32()), ("dim", pa.int32()), ("code", pa.int64()), ("key", pa.binary())])
    codes = classes.select("key", "dim", "vec").mapInArrow(hashed, "pass int, dim int, code long, key binary")
    order = ["pass", "dim", "code", "key"]
    ranked = table(codes.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(numbered, "pass int, dim int, code long, key binary, part int, local long, before int, after int")
                   .withColumn("code", F.when(F.col("before").isNull() | F.col("after").isNull(), F.col("code"))), "pass-order")
    sizes = sorted(tuple(r) for r in ranked.groupBy("part").agg(F.count(F.lit(1))).collect())     # one row per task
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = ranked.sparkSession.createDataFrame(starts, "part int, first long")
    ranked = ranked.join(F.broadcast(offsets), "part").withColumn("at", F.col("first") + F.col("local"))
    low, high = (ranked.where(F.col(c).isNull()).select("pass", "dim", "code", "at") for c in ("after", "before"))
    low = low.select(F.col("pass").alias("low_pass"), F.col("dim").alias("low_dim"), F.col("code").alias("low_code"), F.col("at").alias("low_at"))
    across = F.col("code").bitwiseXOR(F.col("low_code"))
    bits = F.when(across == 0, KEY_BITS).otherwise(KEY_BITS - F.length(F.bin(across)))
    met = table(high.join(low, (F.col("at") == F.col("low_at") + reach) & (F.col("pass") == F.col("low_pass")) & (F.col("dim") == F.col("low_dim")))
                .select("at", "low_at", bits.alias("bits")), "task-edges")
    edges = met.select(F.col("at").alias("edge"), "bits").unionByName(met.select(F.col("low_at").alias("edge"), "bits"))
    edges = edges.groupBy("edge").agg(F.max("bits").alias("edge_bits"))
    share = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    ranked = ranked.join(small_side(table(edges, "edge-bits")), F.col("at") == F.col("edge"), "left").withColumn(
        "bits", F.greatest(F.coalesce("before", F.lit(-1)), F.coalesce("after", F.lit(-1)), F.coalesce("edge_bits", F.lit(-1))) + 1)
    miss = F.log(F.greatest(1 - F.pow(F.lit(share), F.col("bits")), F.lit(1e-12)))
    return ranked.select("key", F.struct("pass", "at").alias("p"), miss.alias("miss")).groupBy("key").agg(
        F.sort_array(F.collect_list("p")).alias("p"), F.sum("miss").alias("miss")).select(
        "key", F.col("p.at").alias("places"), (F.col("miss") > math.log(MISS)).alias("dense"))


def _compare(placed: DataFrame, passes: range, threshold: float, window: int, block: int, single: bool) -> DataFrame:
    """``key, links, root`` per class and block: rows linked first in this pass, and the class's root within the block.

    A pair is counted in the first pass in whose window it stands, which both places tell, so no pair is shipped. Pairs of
    two dense classes are left to ``_compare_dense``.
    """
    runs = placed.select("*", F.explode(F.array(*[F.lit(p) for p in passes])).alias("pass"))
    runs = runs.withColumn("at", F.get("places", F.col("pass"))).withColumn("own", F.floor(F.col("at") / block).cast("long"))
    blocks = F.when(F.col("at") % block >= block - window, F.array("own", F.col("own") + 1)).otherwise(F.array("own"))
    runs = runs.select("key", "dim", "vec", "n", "places", "dense", "pass", "at", F.explode(blocks).alias("block"))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        p, number = group.column("pass")[0].as_py(), group.column("block")[0].as_py()
        at, dims, n = (group.column(c).to_numpy() for c in ("at", "dim", "n"))
        places = group.column("places").combine_chunks().flatten().to_numpy().reshape(len(at), -1)
        vecs = group.column("vec").to_pylist()
        dense = group.column("dense").combine_chunks().to_numpy(zero_copy_only=False)
        links, left, right = np.zeros(len(at), np.int64), [], []
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            rows = _unit(_matrix([vecs[i] for i in own], single))
            first = int(np.searchsorted(at[own], number * block))
            for start in range(first, len(own), 512):
                stop, low = min(start + 512, len(own)), max(0, start - window)
                near = rows[start:stop] @ rows[low:stop].T >= threshold
                near[np.ix_(dense[own[start:stop]], dense[own[low:stop]])] = False
                i, j = np.nonzero(near)
                i, j = i + start, j + low
                gap = at[own[i]] - at[own[j]]
                keep = (gap > 0) & (gap <= window)
                i, j = own[i[keep]], own[j[keep]]
                for q in range(p):
                    met = np.abs(places[i, q] - places[j, q]) <= window
                    i, j = i[~met], j[~met]
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                left.append(i)
                right.append(j)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
        root = least_reachable(len(at), a, b)
        keep = pa.array(np.flatnonzero(links > 0))
        keys = group.column("key").combine_chunks()
        return pa.table({"key": keys.take(keep), "links": pa.array(links).take(keep),
                         "root": keys.take(pa.array(root)).take(keep)})

    return runs.groupBy("pass", "block").applyInArrow(run, "key binary, links long, root binary")


def _tiles(dense: DataFrame, block: int, single: bool) -> DataFrame:
    """``dense`` with ``tile``: runs of the first pass's order, each of at most the rows that a tile may hold."""
    fine = max(1, block // 4)
    dense = dense.withColumn("run", F.floor(F.col("at") / fine).cast("long"))
    sizes = sorted(tuple(r) for r in dense.groupBy("run").agg(F.count(F.lit(1))).collect())       # one row per ``fine`` classes
    widest = dense.agg(F.max("dim")).first()[0] * (4 if single else 8)
    most = min(max(fine, TILE_BYTES // widest), max(block, -(-sum(n for _, n in sizes) // TILES)))
    runs, tile, held = [], 0, 0
    for run, n in sizes:
        if held and held + n > most:
            tile, held = tile + 1, 0
        held += n
        runs.append((run, tile))
    return dense.join(F.broadcast(dense.sparkSession.createDataFrame(runs, "run long, tile int")), "run").drop("run")


def _tile_pairs(tiles: DataFrame, threshold: float, single: bool) -> DataFrame:
    """``a, b``: tiles that may hold a link, by the angles of their centres and of the rows farthest from them."""
    widest = math.acos(max(-1.0, min(1.0, threshold))) + 1e-6

    def extent(group: pa.Table) -> pa.Table:
        rows = _unit(_matrix(group.column("vec").to_pylist(), single))
        centre = rows.mean(0)
        centre = _unit((centre if centre.any() else rows[0])[None])[0]
        radius = float(np.arccos(np.clip(rows @ centre, -1, 1)).max())
        return pa.table({"tile": pa.array([group.column("tile")[0].as_py()], pa.int32()), "dim": pa.array([len(centre)], pa.int32()),
                         "centre": [centre.tobytes()], "radius": [radius]})

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("centre").to_pylist(), batch.column("centre_b").to_pylist())
            angle = np.array([np.arccos(np.clip(np.frombuffer(x) @ np.frombuffer(y), -1, 1)) for x, y in pairs])
            keep = angle - batch.column("radius").to_numpy() - batch.column("radius_b").to_numpy() <= widest
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    extents = table(tiles.select("tile", "dim", "vec").groupBy("tile", "dim").applyInArrow(
        extent, "tile int, dim int, centre binary, radius double"), "tile-extents")
    others = extents.select("dim", F.col("tile").alias("b"), F.col("centre").alias("centre_b"), F.col("radius").alias("radius_b"))
    both = extents.withColumnRenamed("tile", "a").join(others, "dim").where("a <= b")
    return table(both.mapInArrow(near, "a int, b int").distinct(), "tile-pairs")


def _compare_dense(dense: DataFrame, threshold: float, block: int, single: bool) -> DataFrame:
    """``key, links, root`` per class and pair of tiles: all links between the classes of ``dense``, counted where they are found."""
    tiles = table(_tiles(dense, block, single), "dense-tiles")
    pairs = _tile_pairs(tiles, threshold, single)
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
    runs = tiles.join(small_side(sides), "tile")

    def run(group: pa.Table) -> pa.Table:
        a, b = group.column("a")[0].as_py(), group.column("b")[0].as_py()
        tile, dims, n = (group.column(c).to_numpy() for c in ("tile", "dim", "n"))
        vecs = group.column("vec").to_pylist()
        links, label = np.zeros(len(n), np.int64), np.arange(len(n), dtype=np.int32)
        for dim in np.unique(dims):
            left, right = (np.flatnonzero((dims == dim) & (tile == t)) for t in (a, b))
            if not len(left) or not len(right):
                continue
            x = _unit(_matrix([vecs[i] for i in left], single))
            y = x if a == b else _unit(_matrix([vecs[i] for i in right], single))
            step = max(1, min(512, CELLS // len(right)))
            for start in range(0, len(left), step):
                rows, cols = left[start:start + step], right[start if a == b else 0:]
                near = x[start:start + step] @ y[start if a == b else 0:].T >= threshold
                if a == b:
                    near[:, :len(rows)] &= np.triu(np.ones((len(rows), len(rows)), bool), 1)
                links[rows] += _weighed(near, n[cols])
                links[cols] += _weighed(near.T, n[rows])
                label = _joined(near, rows, cols, label)
        keep = pa.array(np.flatnonzero(links > 0))
        keys = group.column("key").combine_chunks()
        return pa.table({"key": keys.take(keep), "links": pa.array(links).take(keep), "root": keys.take(pa.array(label)).take(keep)})

    return runs.select("a", "b", "tile", "key", "dim", "vec", "n").groupBy("a", "b").applyInArrow(
        run, "key binary, links long, root binary")


def _weighed(near: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per row the sum of ``n`` where ``near``."""
    total = np.count_nonzero(near, axis=1).astype(np.int64)
    more = np.flatnonzero(n > 1)
    for some in np.split(more, range(1024, len(more), 1024)):
        total += (near[:, some].astype(np.float64) @ (n[some] - 1).astype(np.float64)).astype(np.int64)
    return total


def _joined(near: np.ndarray, rows: np.ndarray, cols: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label`` (the least place reached) after the links of ``near``: each round takes one of each row and column that still
    joins two labels."""
    while True:
        apart = near & (label[rows][:, None] != label[cols][None, :])
        i, j = (np.flatnonzero(apart.any(axis)) for axis in (1, 0))
        if not len(i):
            return label
        a = np.concatenate([label[rows[i]], label[rows[apart[:, j].argmax(0)]]])
        b = np.concatenate([label[cols[apart[i].argmax(1)]], label[cols[j]]])
        label = least_reachable(len(label), a, b).astype(np.int32)[label]


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
                 window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Links are pairs of rows with cosine (double precision) of at least ``threshold``; all of them are verified, so none lies
    below it. Up to ``window`` distinct vectors every pair is compared; beyond, pairs that stand within ``window`` places of
    each other in some pass, and all pairs of dense classes, those that such windows would serve too badly (groups of
    near-copies much larger than a window). ``passes_for`` sets the passes for vectors spread evenly; which classes are dense
    is measured for each, so wherever it lies, a pair at the threshold is missed with a chance of about
    ``MISS`` (closer ones more rarely). Equal vectors are one class that counts all its rows, so copies are linked without
    being paired. Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of
    different lengths never link. ``component_id`` is the least id reachable by links, the row's own included; null ids
    are ignored there, and rows with repeated ids count each. An empty table gives an empty result; other columns are not
    read. A task holds ``block + window`` vectors, or two tiles of at most TILE_BYTES or ``block``, whatever the size of a group; the
    work on dense classes grows with the square of their number, less the tiles too far apart to link.
    """
    single = vectors.schema[vector_col].dataType.elementType.simpleString() == "float"
    rows = table(prepared(vectors, id_col, vector_col), "vectors")
    classes = table(rows.where("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("least_id"), F.first("dim").alias("dim"), F.first("vec").alias("vec")),
        "vector-classes")
    total = passes_for(classes.count(), threshold, window)
    placed = table(classes.select("key", "n", "dim", "vec").join(
        _positions(classes, total, single, threshold, window), "key"), "placed-vectors")
    parts = []
    for start in range(0, total, PASSES_AT_ONCE):
        some = range(start, min(start + PASSES_AT_ONCE, total))
        parts.append(table(_compare(placed, some, threshold, window, block, single), "links"))
    dense = placed.where("dense").select("key", "n", "dim", "vec", F.get("places", F.lit(0)).alias("at"))
    if not dense.isEmpty():
        parts.append(table(_compare_dense(dense, threshold, block, single), "links"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    components = connected_components(found.select(F.col("key").alias("src"), F.col("root").alias("dst")))
    named = (classes.select("key", "n", "least_id").join(links, "key", "left")
             .join(components.select(F.col("node").alias("key"), "component"), "key", "left")
             .withColumn("label", F.coalesce("component", "key")))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "label").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select("id", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
