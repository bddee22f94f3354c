"""Near-duplicate documents by HyperMinHash: compressed registers, banding, corrected estimates, exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import connected_components, each_binary, release, small_side, table

REGISTERS = 256                 # a power of two: the top bits of a shingle's hash choose its register
ZERO_BITS, MANTISSA_BITS = 6, 10
EMPTY = 0xFFFF
MISS = 1e-5                     # a pair at the similarity asked for may miss all bands with this probability at most
ESTIMATE_SIGMAS = 4.5
TILE_BYTES = 8 << 20            # texts of a tile, about; a task compares the members of two tiles
LEAST_WEIGHT = 1 << 12          # bytes that a member of a tile counts as at least
CHUNK = 1 << 20                 # bytes of text hashed at once

_U = np.uint64
# Odd 64-bit multipliers: odd multiples of the golden ratio's.
_MIX = [_U((2 * k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) for k in range(16)]


def _scramble(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two rounds of xor-shift and multiply)."""
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(8191).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * _U(2) + _U(1)


class WordHashes:
    """64-bit hashes of the words of a text: a polynomial over random byte values, modulo 2^64.

    With running sums of ``value * base^place``, a word's hash is the difference at its ends, brought back to place 0 by the
    inverse power (the base is odd, so it has one). All words of a chunk are hashed at once.
    """

    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            base = int(_MIX[5])
            for name, factor in (("powers", base), ("inverse", pow(base, -1, 1 << 64))):
                steps = np.full(n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def __call__(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(first byte, hash)`` of each word of ``text`` (bytes, words between white space), about CHUNK bytes at a time."""
        starts, found, at = [], [], 0
        while at < len(text) or not starts:
            stop = self._space_from(text, at + CHUNK)
            first, h = self._words(text[at:stop])
            starts.append(first + at)
            found.append(h)
            at = stop
        return np.concatenate(starts), np.concatenate(found)

    @staticmethod
    def _space_from(text: np.ndarray, at: int) -> int:
        """The first white space from ``at`` on, or the end: no word is divided there."""
        for low in range(at, len(text), 1 << 16):
            space = np.flatnonzero(_SPACE[text[low:low + (1 << 16)]])
            if len(space):
                return low + int(space[0])
        return len(text)

    def _words(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space = np.concatenate([[True], _SPACE[text], [True]])
        edge = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = edge[::2], edge[1::2]
        self._grow(len(text) + 1)
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(_BYTES[text] * self.powers[:len(text)], out=sums[1:])
        return starts, _scramble((sums[ends] - sums[starts]) * self.inverse[starts])


def shingle_sets(texts: Iterable[bytes | None], width: int, hashes: WordHashes) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles: words between ASCII white space, A-Z lower-cased.

    Fewer words than ``width`` make one shingle; no words make none. Texts are hashed in chunks; a longer one alone.
    """
    some, size = [], 0
    for text in texts:
        if some and size + len(text or b"") > CHUNK:
            yield from _sets_of_chunk(some, width, hashes)
            some, size = [], 0
        some.append(text or b"")
        size += len(some[-1]) + 1
    if some:
        yield from _sets_of_chunk(some, width, hashes)


def _sets_of_chunk(texts: list[bytes], width: int, hashes: WordHashes) -> Iterator[np.ndarray]:
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    starts, h = hashes(np.frombuffer(b" ".join(texts).lower(), np.uint8))
    bounds = np.searchsorted(starts, begins)
    total = _rolled(h, width)
    for a, b in zip(bounds, bounds[1:]):
        n = b - a
        yield np.unique(total[a:b - width + 1]) if n >= width else _rolled(h[a:b], n) if n else h[:0]


def _rolled(h: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` word hashes; the place of a word counts, and so does the width."""
    n = len(h) - width + 1
    total = np.full(max(n, 0), width, np.uint64)
    for k in range(width if n > 0 else 0):
        total = (total ^ _scramble(h[k:k + n])) * _MIX[1 + k % 15]
    return _scramble(total)


def registers_of(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set: per bucket, the minimum's leading zeros and the bits after its first one."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    if not len(hashes):
        return out
    low = REGISTERS.bit_length() - 1
    bucket = (hashes >> _U(64 - low)).astype(np.int64)
    first = np.concatenate([[True], bucket[1:] != bucket[:-1]])       # sorted, so the first of a bucket is its minimum
    rest = hashes[first] << _U(low)
    most = (1 << ZERO_BITS) - 2
    top = np.frexp(rest.astype(np.float64))[1]                        # position of the highest set bit, 0 for none
    # rounding to double may carry into the next power of two; the exact bit decides
    over = (top > 0) & ((rest >> np.maximum(top - 1, 0).astype(np.uint64)) == 0)
    zeros = np.minimum(64 - (top - over), most)
    shifted = rest << np.minimum(zeros + 1, 63).astype(np.uint64)
    out[bucket[first]] = (zeros.astype(np.uint16) << np.uint16(MANTISSA_BITS)) | (shifted >> _U(64 - MANTISSA_BITS)).astype(np.uint16)
    return out


def _probes() -> np.ndarray:
    """For each register the order in which an empty one borrows from the others; the same for all documents."""
    return np.argsort(np.random.default_rng(20240229).random((REGISTERS, REGISTERS)), axis=1, kind="stable")


def bands_for(similarity: float) -> tuple[int, int]:
    """``(bands, rows)``: the most registers in a band with which a pair of that Jaccard misses all bands rarely enough.

    36 bands of 7 for 0.85 (missed with 9e-7), 42 of 6 for 0.80 (3e-6).
    """
    for rows in range(REGISTERS, 1, -1):
        if (1 - similarity ** rows) ** (REGISTERS // rows) <= MISS:
            return REGISTERS // rows, rows
    return REGISTERS, 1


def band_hashes(registers: np.ndarray, probes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of each row of registers; empty registers borrow a filled one's value."""
    full = registers.astype(np.uint64)
    filled = registers != EMPTY
    for r in np.flatnonzero(~filled.all(1)):
        empty = np.flatnonzero(~filled[r])
        source = probes[empty, filled[r][probes[empty]].argmax(1)]
        full[r, empty] = full[r, source] + (source.astype(np.uint64) << _U(16))
    total = np.zeros((len(full), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _MIX[0]
    used = full[:, :bands * rows].reshape(len(full), bands, rows)
    for k in range(rows):
        total = _scramble(total * _MIX[1] + used[:, :, k])
    return total


@lru_cache(maxsize=65536)
def _collision_share(step_a: int, step_b: int) -> float:
    """Chance that two unrelated buckets of ``2**(step/4)`` expected values each show the same register.

    Sums, over all cells of (leading zeros, mantissa), the product of the chances that a bucket's minimum falls there.
    """
    zeros = np.arange((1 << ZERO_BITS) - 2)[:, None]
    mantissa = np.arange(1 << MANTISSA_BITS)[None, :]
    low = np.exp2(-(zeros + 1.0)) * (1 + mantissa / (1 << MANTISSA_BITS))
    high = np.exp2(-(zeros + 1.0)) * (1 + (mantissa + 1) / (1 << MANTISSA_BITS))

    def chance(step):
        rate = 2.0 ** (step / 4)
        return np.exp(-rate * low) - np.exp(-rate * high)

    return float((chance(step_a) * chance(step_b)).sum())


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(estimated Jaccard, registers in use)`` per row: equal registers less the expected chance collisions."""
    either = ((a != EMPTY) | (b != EMPTY)).sum(1)
    equal = ((a == b) & (a != EMPTY)).sum(1)
    steps_a = np.rint(4 * np.log2(np.maximum(n_a, 1) / REGISTERS)).astype(int)
    steps_b = np.rint(4 * np.log2(np.maximum(n_b, 1) / REGISTERS)).astype(int)
    share = np.array([_collision_share(int(x), int(y)) for x, y in zip(steps_a, steps_b)])
    raw = equal / np.maximum(either, 1)           # expected to be J + (1 - J) * share
    return np.clip((raw - share) / (1 - share), 0, 1), either


def sketches(documents: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id, version, n_shingles, key, registers`` per row; ``key`` is a digest of the shingle set, null for an empty one,
    ``version`` a hash of the text."""
    fields = documents.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("version"), F.col(text_col).alias("text"))
    id_type = fields.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, registers = [], [], []
            for s in shingle_sets(each_binary(batch.column("text")), width, hashes):
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                registers.append(registers_of(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("version"), pa.array(sizes, pa.int64()),
                                              pa.array(keys, pa.binary()), pa.array(registers, pa.binary())],
                                             names=["id", "version", "n_shingles", "key", "registers"])

    return fields.mapInArrow(run, f"id {id_type}, version long, n_shingles long, key binary, registers binary")


def _banded(classes: DataFrame, similarity: float) -> DataFrame:
    """``band, key``: one row per class and band."""
    n, width = bands_for(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = _probes()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            bands = band_hashes(rows, probes, n, width).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(bands), batch.column("key").take(pa.array(np.repeat(np.arange(len(rows)), n)))], names=["band", "key"])

    return classes.select("key", "registers").mapInArrow(run, "band long, key binary")


def _estimated(pairs: DataFrame, classes: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs ``a, b`` whose sizes and corrected estimate allow the similarity."""
    side = classes.select("key", "registers", "n_shingles")
    wide = (pairs.join(side.select(F.col("key").alias("a"), F.col("registers").alias("ra"), F.col("n_shingles").alias("na")), "a")
            .join(side.select(F.col("key").alias("b"), F.col("registers").alias("rb"), F.col("n_shingles").alias("nb")), "b")
            .where((F.least("na", "nb") * denominator) >= (F.greatest("na", "nb") * numerator)))
    limit = numerator / denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
            found, used = estimate(ra, rb, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            keep = found >= limit - ESTIMATE_SIGMAS * np.sqrt(limit * (1 - limit) / np.maximum(used, 1)) - 1e-9
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    return wide.mapInArrow(run, "a binary, b binary")


def _texts(documents: DataFrame, keys: DataFrame, classes: DataFrame, id_col: str, text_col: str, width: int,
           repeated: bool) -> DataFrame:
    """``key, text``: the whole text of one document of each of the given classes; ``repeated`` if ids may repeat."""
    ids = table(classes.join(small_side(keys), "key", "left_semi").select(F.col("least_id").alias("wanted_id"),
                                                                         F.col("key").alias("wanted_key")), "wanted")
    n = ids.count()
    fields = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = fields.join(small_side(ids.select("wanted_id"), n), F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = shingle_sets(each_binary(batch.column("text")), width, hashes)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("text")], names=["key", "text"])

    found = chosen.select("text").mapInArrow(run, "key binary, text string")
    found = found.join(small_side(ids.select(F.col("wanted_key").alias("key")), n), "key", "left_semi")
    return table(found.dropDuplicates(["key"]) if repeated else found, "class-texts")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, numerator: int, denominator: int) -> DataFrame:
    """Pairs whose full sets meet ``denominator * intersection >= numerator * union``."""
    wide = (pairs.select("a", "b").join(texts.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            keep, known, left = [], None, None
            for i, (key, x, y) in enumerate(zip(batch.column("a").to_pylist(), each_binary(batch.column("ta")),
                                                each_binary(batch.column("tb")))):
                if key != known:                          # joined by a, so equal ones follow each other
                    known, left = key, next(shingle_sets([x], width, hashes))
                right = next(shingle_sets([y], width, hashes))
                both = np.concatenate([left, right])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if denominator * common >= numerator * (len(left) + len(right) - common):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["src", "dst"])

    return wide.mapInArrow(run, "src binary, dst binary")


def _labels(members: DataFrame, components: DataFrame | None) -> DataFrame:
    """``members`` with ``label``: the component of their key, or the key itself."""
    if components is None:
        return members.withColumn("label", F.col("key"))
    named = components.select(F.col("node").alias("key"), F.col("component"))
    return members.join(named, "key", "left").withColumn("label", F.coalesce("component", "key")).drop("component")


def _tiles(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, label, tile``: the classes of ``mixed(band, key, leader, label)`` dealt into tiles of about TILE_BYTES.

    A class's home is the leader with which it shares most buckets. The classes of a home stand in the same tile, or, if they
    weigh more, in as many as it takes, by hash; small homes that buckets connect share tiles. So classes that share
    buckets stand in few tiles.
    """
    homes = table(mixed.groupBy("key", "leader").agg(F.count(F.lit(1)).alias("n"), F.first("label").alias("label")).groupBy("key").agg(
        F.max_by("leader", F.struct("n", "leader")).alias("home"), F.first("label").alias("label")), "homes")
    # homes with members in one bucket are of one cluster
    near = table(mixed.select("band", "key").join(homes.select("key", "home"), "key").select("band", "home").distinct(), "bucket-homes")
    least = near.groupBy("band").agg(F.min("home").alias("dst"))
    clusters = connected_components(near.join(least, "band").select(F.col("home").alias("src"), "dst").where("src <> dst").distinct())
    weight = F.greatest(F.lit(LEAST_WEIGHT), 8 * F.col("n_shingles"))
    placed = (homes.join(clusters.select(F.col("node").alias("home"), "component"), "home", "left")
              .select("key", "label", "home", F.coalesce("component", "home").alias("cluster"))
              .join(classes.select("key", weight.alias("weight")), "key"))
    placed = table(placed, "clusters")
    own = table(placed.groupBy("cluster", "home").agg(F.sum("weight").alias("weight")), "home-weights")
    rest = own.where(F.col("weight") <= TILE_BYTES).groupBy("cluster").agg(F.ceil(F.sum("weight") / TILE_BYTES).cast("long").alias("shared"))
    tiles = own.join(rest, "cluster", "left").select(
        "cluster", "home", F.ceil(F.col("weight") / TILE_BYTES).cast("long").alias("chunks"), "shared")
    tiles = small_side(table(tiles, "home-tiles"))
    tile = F.when(F.col("chunks") > 1, F.xxhash64("cluster", "home", F.pmod(F.xxhash64("key"), F.col("chunks")))).otherwise(
        F.xxhash64("cluster", F.pmod(F.xxhash64("home"), F.col("shared"))))
    return placed.join(tiles, ["cluster", "home"]).select("key", "label", tile.alias("tile"))


def _links_of_tiles(a: list[tuple], b: list[tuple] | None, width: int, numerator: int, denominator: int,
                    hashes: WordHashes, probes: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """Links ``(key, key)`` that connect the members ``(key, label, text)`` of two tiles (or of one, without ``b``).

    All pairs of different labels that share a band and pass the size bound and the estimate are compared by their full sets,
    but for those that links found before connect already.
    """
    rows = a + (b or [])
    sets = list(shingle_sets([r[2] for r in rows], width, hashes))
    registers = np.stack([registers_of(s) for s in sets])
    bands = band_hashes(registers, probes, *bands_for(numerator / denominator))
    size = np.array([len(s) for s in sets])
    names = {label: i for i, label in enumerate(dict.fromkeys(r[1] for r in rows))}
    label = np.array([names[r[1]] for r in rows])          # of linked members the same
    limit = numerator / denominator
    for i in range(len(a)):
        low = i + 1 if b is None else len(a)
        other = low + np.flatnonzero(label[low:] != label[i])
        other = other[(np.minimum(size[other], size[i]) * denominator >= np.maximum(size[other], size[i]) * numerator)]
        other = other[(bands[other] == bands[i]).any(1)]
        if not len(other):
            continue
        found, used = estimate(np.broadcast_to(registers[i], (len(other), REGISTERS)), registers[other],
                               np.full(len(other), size[i]), size[other])
        for j in other[found >= limit - ESTIMATE_SIGMAS * np.sqrt(limit * (1 - limit) / np.maximum(used, 1)) - 1e-9].tolist():
            if label[i] == label[j]:
                continue
            at = np.searchsorted(sets[j], sets[i])
            common = int((sets[j][np.minimum(at, size[j] - 1)] == sets[i]).sum())
            if denominator * common >= numerator * (int(size[i]) + int(size[j]) - common):
                yield rows[i][0], rows[j][0]
                label[label == label[j]] = label[i]


def _links_between(mixed: DataFrame, classes: DataFrame, documents: DataFrame, id_col: str, text_col: str, width: int,
                   numerator: int, denominator: int, repeated: bool) -> DataFrame:
    """``src, dst``: links that connect all labels of the mixed buckets which any link connects.

    The classes stand in tiles; two tiles are met in a task if a bucket has members in both. A task ships no pairs: it
    returns a forest of the links that it found, at most one for each label.
    """
    tiles = table(_tiles(mixed, classes), "tiles")
    texts = _texts(documents, tiles.select("key"), classes, id_col, text_col, width, repeated)
    places = table(mixed.select("band", "key").join(tiles.select("key", "tile"), "key").select("band", "tile").distinct(), "bucket-tiles")
    met = places.join(places.select("band", F.col("tile").alias("second")), "band").where("tile <= second").select(
        F.col("tile").alias("first"), "second").distinct()
    met = table(met, "tile-pairs")
    sent = met.select("first", "second", F.explode(F.array_distinct(F.array("first", "second"))).alias("tile"))
    rows = sent.join(tiles, "tile").join(texts, "key").select("first", "second", "tile", "key", "label", "text")

    def run(group: pa.Table) -> pa.Table:
        tile = group.column("tile").to_numpy()
        rows = list(zip(group.column("key").to_pylist(), group.column("label").to_pylist(), each_binary(group.column("text"))))
        first, second = group.column("first")[0].as_py(), group.column("second")[0].as_py()
        a = sorted(r for r, t in zip(rows, tile) if t == first)
        b = None if first == second else sorted(r for r, t in zip(rows, tile) if t == second)
        found = list(_links_of_tiles(a, b, width, numerator, denominator, WordHashes(), _probes()))
        return pa.table({"src": pa.array([x for x, _ in found], pa.binary()), "dst": pa.array([y for _, y in found], pa.binary())})

    return rows.groupBy("first", "second").applyInArrow(run, "src binary, dst binary")


def near_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    numerator: int = 85, denominator: int = 100) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_shingles, component_id, kept.

    Documents whose shingle sets meet ``denominator * intersection >= numerator * union`` are linked; ``component_id`` is the
    least id that links reach, ``kept`` whether it is the row's own. Rows with equal sets are one class from the start, so
    copies are never paired. Classes share a bucket where all registers of a band are equal. First each class is compared
    with one bucket leader (the least class), that with which it shares most buckets. Then, in every bucket that still holds
    several components, all members of different ones are compared: the classes stand in tiles, tiles that share a bucket meet
    in a task, and what connects components comes back as a forest of links, so no pair is shipped and no component is compared
    with itself. Compared pairs pass the size bound and the corrected estimate (ESTIMATE_SIGMAS standard errors below the
    similarity), then the full sets decide. ``bands_for`` sets the bands by the similarity: two classes right at it share no bucket with a
    chance of MISS at most, closer ones more rarely. Empty and null texts have no shingles, link with nothing and are kept; rows repeated with
    their id are all kept or none; a null id is never a component's least, so such a row is kept only if it has no words or
    all rows of its component have null ids. Other columns are not read. Hot buckets are split by AQE (equi-joins on band and class), and minima combine before shuffles.
    """
    rows, grouped = _groups(documents, id_col, text_col, width, numerator, denominator)
    least = grouped.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = grouped.join(least, "label").select("key", "component_id")
    out = rows.join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def _groups(documents: DataFrame, id_col: str, text_col: str, width: int, numerator: int,
            denominator: int) -> tuple[DataFrame, DataFrame]:
    """The ``sketches`` of all rows, and ``key, least_id, label`` per class: the component that its links reach."""
    rows = table(sketches(documents, id_col, text_col, width), "sketches")
    classes = table(rows.where("key is not null").groupBy("key").agg(
        F.min("id").alias("least_id"), F.first("registers").alias("registers"), F.first("n_shingles").alias("n_shingles")), "classes")
    bands = _banded(classes, numerator / denominator)
    buckets = bands.groupBy("band").agg(F.min("key").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = table(bands.join(buckets.drop("n"), "band"), "bucket-members")

    # only an id that comes twice can give a class two texts
    repeated = not rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    components = None

    shared = members.where("key <> leader").groupBy("leader", "key").agg(F.count(F.lit(1)).alias("n"))
    pairs = shared.groupBy("key").agg(F.max_by("leader", F.struct("n", "leader")).alias("a")).select("a", F.col("key").alias("b"))
    candidates = table(_estimated(pairs, classes, numerator, denominator), "candidates")
    if not candidates.isEmpty():
        keys = table(candidates.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "candidate-keys")
        texts = _texts(documents, keys, classes, id_col, text_col, width, repeated)
        components = connected_components(table(_verified(candidates, texts, width, numerator, denominator), "links"))

    labelled = table(_labels(members, components), "labelled")
    several = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band")
    mixed = table(labelled.join(several, "band", "left_semi"), "mixed-buckets")
    if not mixed.isEmpty():
        more = table(_links_between(mixed, classes, documents, id_col, text_col, width, numerator, denominator, repeated), "more-links")
        if not more.isEmpty():
            known = [] if components is None else [components.select(F.col("node").alias("src"), F.col("component").alias("dst"))]
            components = connected_components(reduce(DataFrame.unionByName, [more, *known]))

    return rows, _labels(classes.select("key", "least_id"), components)


def keep_one(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, numerator: int = 85,
             denominator: int = 100) -> DataFrame:
    """``documents`` with one row of each group of ``near_duplicates``; all their columns stay.

    It is the row of the least id (null ids come last), of several texts of that id the one with the least hash. Rows are
    told apart by id and text hash, so a removed row takes no other text of its id, or of a null id, along; of rows that
    repeat both, one is kept. Rows without words are in no group and all kept.
    """
    rows, grouped = _groups(documents, id_col, text_col, width, numerator, denominator)
    named = rows.where("key is not null").join(grouped.select("key", "label"), "key").groupBy("label", "id", "version").agg(
        F.count(F.lit(1)).alias("n"))
    named = table(named, "group-rows")
    first = named.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "version")).alias("first"))
    named = named.join(first, "label").select(F.col("id").alias("row_id"), F.col("version").alias("row_version"), "n", (
        F.col("id").eqNullSafe(F.col("first.id")) & (F.col("version") == F.col("first.version"))).alias("kept"))
    named = table(named.where("not kept or n > 1"), "near-duplicates")

    def same(side: DataFrame):
        return documents[id_col].eqNullSafe(side["row_id"]) & (F.xxhash64(documents[text_col]) == side["row_version"])

    gone, again = small_side(named.where("not kept")), named.where("kept")
    n = again.count()
    if not n:
        return documents.join(gone, same(gone), "left_anti")
    every = small_side(named)
    again = small_side(again, n)
    version = "version_"
    while version in map(str.lower, documents.columns):
        version += "_"
    once = documents.join(again, same(again), "left_semi").withColumn(version, F.xxhash64(text_col))
    return documents.join(every, same(every), "left_anti").unionByName(once.dropDuplicates([id_col, version]).drop(version))
