"""Product-quantised vector codes in integer arithmetic, with LAESA pivots that prune the exact evaluations.

Every part of a vector is measured once against a few fixed pivots. In each round the codebook's entries are measured against
the same pivots: by the triangle inequality the largest difference of the two lists bounds a part's distance to an entry from
below. Entries are tried from the least bound on, and those whose bound exceeds the best distance found are never evaluated.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import small_side, table

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 16                     # per part; more give tighter bounds and wider rows
FIRST = 8                       # entries of least bound that are evaluated before the rest is pruned
BLOCK = 2048                    # vectors compared at once
PAIRS = 1 << 14                 # exact evaluations at once, so that their rows stay in the cache
SLACK = 1e-6                    # relative; far above the rounding of the pivot distances, which are kept in single precision


@dataclass
class Codes:
    """``rows``: id, label, code, error per kept vector. ``codebooks``: (entries, width) integers for each part."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    @property
    def digest(self) -> str:
        text = ",".join(str(v) for book in self.codebooks for v in book.ravel().tolist())
        return hashlib.sha256(text.encode()).hexdigest()


def bounds_of(dim: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector of ``dim`` components begin and end: equal, or as nearly so as can be."""
    return [dim * k // parts for k in range(parts + 1)]


def _limit(dim: int) -> int:
    """Components up to this size give squared distances whose sums over a vector fit a long."""
    return min(math.isqrt((1 << 62) // max(dim, 1)) // 2, (1 << 31) - 1)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of equally many rows."""
    step = x - y
    return np.einsum("ij,ij->i", step, step)


def chosen_pivots(book: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` entries far from each other: the first, then each time the farthest from those taken."""
    taken, far = [0], squared(book, np.broadcast_to(book[0], book.shape))
    while len(taken) < min(n, len(book)) and far.max() > 0:
        taken.append(int(far.argmax()))
        far = np.minimum(far, squared(book, np.broadcast_to(book[taken[-1]], book.shape)))
    return book[taken]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (not squared) of every row of ``x`` to every pivot."""
    return np.sqrt(np.stack([squared(x, np.broadcast_to(p, x.shape)) for p in pivots], 1).astype(np.float64)).astype(np.float32)


def nearest(x: np.ndarray, near: np.ndarray, book: np.ndarray, book_near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``(index, squared distance, evaluations)`` of each row's nearest entry, the lower index at a tie.

    ``near`` and ``book_near`` are the distances of rows and entries to the same pivots.
    """
    n, k = len(x), len(book)
    low = np.zeros((n, k), np.float32)
    for p in range(near.shape[1]):
        np.maximum(low, np.abs(near[:, p, None] - book_near[None, :, p]), out=low)
    scale = near.max(1) + book_near.max()
    best = np.full(n, np.iinfo(np.int64).max)
    at = np.full(n, k)
    some = np.sort(np.argpartition(low, min(FIRST, k) - 1, axis=1)[:, :FIRST], axis=1)
    evaluated = 0

    def evaluate(row: np.ndarray, entry: np.ndarray) -> None:
        """The pairs are ordered by row, then entry."""
        nonlocal evaluated
        if not len(row):
            return
        evaluated += len(row)
        d = np.concatenate([squared(x[row[a:a + PAIRS]], book[entry[a:a + PAIRS]]) for a in range(0, len(row), PAIRS)])
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        own, least = row[starts], np.minimum.reduceat(d, starts)
        tied = d == np.repeat(least, np.diff(np.append(starts, len(row))))
        first = np.minimum.reduceat(np.where(tied, entry, k), starts)
        better = (least < best[own]) | ((least == best[own]) & (first < at[own]))
        best[own[better]], at[own[better]] = least[better], first[better]

    evaluate(np.repeat(np.arange(n), some.shape[1]), some.ravel())
    open_ = low <= (np.sqrt(best.astype(np.float64)) + SLACK * scale)[:, None]
    open_[np.arange(n)[:, None], some] = False
    evaluate(*np.nonzero(open_))
    return at, best, evaluated


def _integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, label, dim, comps`` of the kept rows; ``comps`` (32-bit integers) is null where a component is too large."""
    fields = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = fields.where(F.col("vector").isNotNull()).where(~F.coalesce(odd, F.lit(True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, comps = [], []
            for value in batch.column("vector"):
                row = np.floor(value.values.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
                dims.append(len(row))
                comps.append(row.astype(np.int32).tobytes() if not len(row) or np.abs(row).max() <= _limit(len(row)) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(dims, pa.int32()),
                                              pa.array(comps, pa.binary())], names=["id", "label", "dim", "comps"])

    types = {f.name: f.dataType.simpleString() for f in fields.schema}
    return kept.mapInArrow(run, f"id {types['id']}, label {types['label']}, dim int, comps binary")


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _measured(rows: DataFrame, pivots: list[np.ndarray], cuts: list[int]) -> DataFrame:
    """``rows`` with ``near``: the distances of each part to its pivots, computed once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("comps"), np.int32, cuts[-1]).astype(np.int64)
            near = np.concatenate([pivot_distances(x[:, a:b], p) for a, b, p in zip(cuts, cuts[1:], pivots)], 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "label", "comps")),
                                              pa.array([r.tobytes() for r in near], pa.binary())], names=["id", "label", "comps", "near"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("id", "label", "comps").mapInArrow(
        run, f"id {types['id']}, label {types['label']}, comps binary, near binary")


def _assigned(batch: pa.RecordBatch, books: list[np.ndarray], pivots: list[np.ndarray],
              cuts: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, slice]]:
    """``(components, index per part, squared distance per part, rows)`` of each block of a batch."""
    ends = np.cumsum([0] + [len(p) for p in pivots])
    book_near = [pivot_distances(book, p) for book, p in zip(books, pivots)]
    for low in range(0, batch.num_rows, BLOCK):
        some = slice(low, min(low + BLOCK, batch.num_rows))
        part = batch.slice(low, some.stop - low)
        x = _matrix(part.column("comps"), np.int32, cuts[-1]).astype(np.int64)
        near = _matrix(part.column("near"), np.float32, int(ends[-1]))
        found = [nearest(x[:, cuts[k]:cuts[k + 1]], near[:, ends[k]:ends[k + 1]], books[k], book_near[k]) for k in range(len(books))]
        yield x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1), some


def _moved(rows: DataFrame, books: list[np.ndarray], pivots: list[np.ndarray], cuts: list[int]) -> list[np.ndarray]:
    """The codebooks after one round: each entry is the floored mean of the parts assigned to it; unused ones stay.

    A task sends one row of sums per entry it used; Spark adds them up, and at most parts x entries rows reach the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for x, index, _, _ in _assigned(batch, books, pivots, cuts):
                for k, book in enumerate(books):
                    counts[k] += np.bincount(index[:, k], minlength=len(book))
                    np.add.at(sums[k], index[:, k], x[:, cuts[k]:cuts[k + 1]])
        out = [(k, int(e), int(counts[k][e]), sums[k][e].tolist()) for k in range(len(books)) for e in np.flatnonzero(counts[k])]
        if out:
            part, entry, n, total = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()),
                                              pa.array(total, pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

    width = max(b - a for a, b in zip(cuts, cuts[1:]))
    sums = rows.select("comps", "near").mapInArrow(run, "part int, entry int, n long, total array<long>")
    added = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(
        *[F.coalesce(F.sum(F.get("total", F.lit(i))), F.lit(0)) for i in range(width)]).alias("total"))
    out = [b.copy() for b in books]
    for part, entry, n, total in added.collect():
        out[part][entry] = [v // n for v in total[:out[part].shape[1]]]
    return out


def encode(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS) -> Codes:
    """Codes of all vectors and the codebooks they refer to.

    Rows whose vector is null or holds null or non-finite components are dropped. Components become ``floor(1024 * x)`` and
    vectors are cut into ``parts``. Codebooks start as the parts of the ``entries`` least ids (null ids come last; of rows
    that repeat an id those of lesser components come first) and move ``rounds`` times. Repeated rows count each time. With
    fewer rows than entries the codebooks are shorter. All arithmetic that decides is in integers; pivots only spare
    evaluations, so their number doesn't change the result. The vector length is that of the least id; rows of another length, and
    rows with components so large that a squared distance wouldn't fit a long, are kept with a null code and error and
    move no entry. An empty table gives no rows and empty codebooks.
    A round is one pass over a written table of components and pivot distances; only sums per entry are shuffled.
    """
    spark = vectors.sparkSession
    whole = table(_integers(vectors, id_col, vector_col, label_col), "code-integers")
    usable = whole.where("comps is not null").orderBy(F.col("id").asc_nulls_last(), "dim", "comps")
    first = usable.limit(1).select("dim").first()
    if first is None:
        return Codes(whole.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), [])
    cuts = bounds_of(first.dim, parts)
    fits = whole.where(f"comps is not null and dim = {first.dim}")
    least = fits.orderBy(F.col("id").asc_nulls_last(), "comps").limit(entries).select("comps").collect()
    start = np.stack([np.frombuffer(bytes(r.comps), np.int32) for r in least]).astype(np.int64)
    books = [start[:, a:b] for a, b in zip(cuts, cuts[1:])]
    fixed = [chosen_pivots(b, pivots) for b in books]
    rows = table(_measured(fits, fixed, cuts), "code-parts")
    for _ in range(rounds):
        books = _moved(rows, books, fixed, cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = max(2, len(f"{entries - 1:x}"))
        for batch in batches:
            for _, index, distance, some in _assigned(batch, books, fixed, cuts):
                part = batch.slice(some.start, some.stop - some.start)
                code = ["".join(f"{v:0{digits}x}" for v in row) for row in index.tolist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array(code, pa.string()),
                                                  pa.array(distance.sum(1))], names=["id", "label", "code", "error"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    coded = rows.mapInArrow(run, f"id {types['id']}, label {types['label']}, code string, error long")
    other = whole.where(f"comps is null or dim <> {first.dim}").select(
        "id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return Codes(table(coded.unionByName(other), "codes"), books)


def report(codes: Codes, *, id_col: str = "vec_id") -> DataFrame:
    """One row per kept vector: id, code, error, the errors summed over its label (nulls together), the codebooks' digest."""
    per_label = codes.rows.groupBy("label").agg(F.sum("error").alias("label_error")).select(
        F.col("label").alias("of_label"), "label_error")
    per_label = small_side(table(per_label, "label-errors"))
    joined = codes.rows.join(per_label, F.col("label").eqNullSafe(F.col("of_label")), "left")
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codes.digest).alias("codebooks_sha256"))
