"""Document fingerprints: MinHash signatures by universal hash permutations, and their likeness across edits.

A fingerprint holds, for each of PERMUTATIONS universal hash functions, the least value over a text's word shingles; the share
of equal places of two fingerprints estimates the Jaccard similarity of their shingle sets. ``near_documents`` joins bands of
places and verifies the Jaccard similarity on the full sets.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from starling.llm.common import connected_components, each_binary, table
from starling.llm.minhash import WordHashes, _labels, _scramble, _texts, _verified, shingle_sets

PERMUTATIONS = 128
WIDTH = 5                       # words of a shingle
PART_BYTES = 64 << 20           # text of one range of documents
SHINGLES = 1 << 12              # shingles permuted at once
ROWS = 1 << 10                  # rows passed on at once
MISS = 1e-5                     # a pair at the similarity asked for may share no band with this probability at most
SIGMAS = 4.5                    # standard errors by which an estimate may lie below the similarity
TILE_BYTES = 8 << 20            # shingles of a bucket's members that are compared with as many others in one task

_U = np.uint64
_RANDOM = np.random.default_rng(20250711)
_FACTORS = _RANDOM.integers(0, 1 << 64, (PERMUTATIONS, 1), dtype=np.uint64)
_TERMS = _RANDOM.integers(0, 1 << 64, (PERMUTATIONS, 1), dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of ``(a * x + b) mod 2^64 div 2^32`` (multiply-shift, strongly universal) over the shingles, for each (a, b).

    ``x`` is the upper half of a shingle's 64-bit hash. Without shingles all places are the greatest value.
    """
    out = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    x = shingles >> _U(32)
    for low in range(0, len(x), SHINGLES):
        permuted = _FACTORS * x[low:low + SHINGLES]
        permuted += _TERMS
        np.minimum(out, (permuted.min(1) >> _U(32)).astype(np.uint32), out=out)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal places; 1 for two texts without words."""
    return float((a == b).mean())


def text_of(sign: np.ndarray) -> str:
    return sign.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many first characters of ``following`` (all, if it has fewer)."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _in_ranges(documents: DataFrame, id_col: str, text_col: str, part_bytes: int) -> DataFrame:
    """``id, text, extra``: partitions are consecutive ranges of documents in order, each ended by the first row of the
    next range (``extra``; the last by the very first row). Texts move once.

    The order is by id (null ids last), then text hash, then place in the input, which only tells equal rows apart; so
    no id or text, however often it occurs, makes a range larger. Only one key per range reaches the driver.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).select(
        F.col("id").isNull().alias("last"), "id", F.xxhash64("text").alias("version"), F.monotonically_increasing_id().alias("at"), "text")
    order = ["last", "id", "version", "at"]
    keys = table(rows.select(*order, F.octet_length("text").alias("size")), "document-order")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / part_bytes))
    firsts = keys.select(*order).repartitionByRange(parts, *order).groupBy(F.spark_partition_id()).agg(F.min(F.struct(*order)).alias("first"))
    firsts = sorted((r["first"].last, r["first"].id, r["first"].version, r["first"].at) for r in firsts.select("first").collect())
    n = max(len(firsts), 1)

    @arrow_udf("array<int>")
    def parts_of(last: pa.Array, id_: pa.Array, version: pa.Array, at: pa.Array) -> pa.Array:
        out = []
        for key in zip(last.to_pylist(), id_.to_pylist(), version.to_pylist(), at.to_pylist()):
            own = bisect_right(firsts, key) - 1
            out.append([own, -1 - (own - 1) % n] if key == firsts[own] else [own])
        return pa.array(out, pa.list_(pa.int32()))

    dealt = rows.withColumn("to", F.explode(parts_of(*order))).withColumn("extra", F.col("to") < 0)
    dealt = dealt.withColumn("part", F.when(F.col("extra"), -1 - F.col("to")).otherwise(F.col("to")))
    return dealt.repartitionById(n, "part").sortWithinPartitions("extra", *order).select("id", "text", "extra")


def fingerprints(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                 part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last quarter of a text's characters replaced by the first ones of the next document (ascending
    id, after the last the first; of rows that repeat an id, in the order of their text hashes, and null ids last).
    ``near_edited`` and ``near_next`` are the likeness of the document's fingerprint to that of its edited text and of the
    next document. Shingles are runs of ``width`` words between ASCII white space, A-Z lower-cased; a text of fewer words is
    one shingle. A null text is an empty one; two empty texts are alike (1), an empty and another one not (0). A single
    document is its own next one. An empty table gives no rows; other columns are not read.
    Documents are dealt into ranges by their order and each is met with the next one while its range is read once.
    """
    ordered = _in_ranges(documents, id_col, text_col, part_bytes)
    id_type = ordered.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        held = None                                        # the last document met: its id, text and signature

        def pairs() -> Iterator[tuple]:
            nonlocal held
            for batch in batches:
                signs = map(signature, shingle_sets(each_binary(batch.column("text")), width, hashes))
                for id_, text, sign in zip(batch.column("id"), each_binary(batch.column("text")), signs):
                    new = id_, text.decode("utf-8", "replace"), sign
                    if held is not None:
                        yield held, new
                    held = new

        def rows(some: list[tuple]) -> pa.RecordBatch:
            texts = [edited(a[1], b[1]).encode() for a, b in some]
            signs = [signature(s) for s in shingle_sets(texts, width, hashes)]
            return pa.RecordBatch.from_arrays([
                pa.array([a[0].as_py() for a, _ in some], some[0][0][0].type), pa.array([len(a[1]) for a, _ in some], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts]), pa.array([text_of(a[2]) for a, _ in some]),
                pa.array([text_of(s) for s in signs]), pa.array([likeness(a[2], s) for (a, _), s in zip(some, signs)]),
                pa.array([likeness(a[2], b[2]) for a, b in some])],
                names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        some = []
        for pair in pairs():                               # the last row is the next range's: it has no row here
            some.append(pair)
            if len(some) == ROWS:
                yield rows(some)
                some = []
        if some:
            yield rows(some)

    out = ordered.mapInArrow(run, f"id {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)


def bands_for(similarity: float) -> tuple[int, int]:
    """``(bands, rows)``: the most places in a band with which MISS is kept; 32 bands of 4 for 0.80 (missed with 5e-8)."""
    for rows in range(PERMUTATIONS, 1, -1):
        if (1 - similarity ** rows) ** (PERMUTATIONS // rows) <= MISS:
            return PERMUTATIONS // rows, rows
    return PERMUTATIONS, 1


def band_hashes(signs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of each row of signatures; the band's number counts."""
    used = signs[:, :bands * rows].reshape(len(signs), bands, rows).astype(np.uint64)
    total = np.zeros((len(signs), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        total = _scramble((total << _U(32)) + total + used[:, :, k])
    return total.view(np.int64)


def signatures(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``id, n_shingles, key, signature`` per row; ``key`` is a digest of the shingle set, null (as the signature) without words."""
    fields = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = fields.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, signs = [], [], []
            for s in shingle_sets(each_binary(batch.column("text")), width, hashes):
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(signs, pa.binary())], names=["id", "n_shingles", "key", "signature"])

    return fields.mapInArrow(run, f"id {id_type}, n_shingles long, key binary, signature binary")


def _banded(classes: DataFrame, similarity: float) -> DataFrame:
    """``band, key``: one row per class and band."""
    n, rows = bands_for(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, PERMUTATIONS)
                of = pa.array(np.repeat(np.arange(len(signs)), n))
                yield pa.RecordBatch.from_arrays([pa.array(band_hashes(signs, n, rows).ravel()), batch.column("key").take(of)],
                                                 names=["band", "key"])

    return classes.select("key", "signature").mapInArrow(run, "band long, key binary")


def _links_in_buckets(mixed: DataFrame, classes: DataFrame, texts: DataFrame, width: int, numerator: int, denominator: int,
                      tile_bytes: int) -> DataFrame:
    """``src, dst``: links that connect all labels of the buckets ``mixed(band, key, label)`` which any link connects.

    A bucket's members are dealt into tiles; two tiles meet in a task, which returns a forest of the links found. A pair is
    compared in the first band that it shares.
    """
    weighed = mixed.join(classes.select("key", (F.lit(4096) + 8 * F.col("n_shingles")).alias("weight")), "key")
    tiles = weighed.groupBy("band").agg(F.ceil(F.sum("weight") / tile_bytes).cast("long").alias("tiles"))
    dealt = weighed.join(tiles, "band").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).select(
        "band", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "tile", "key", "label")
    n, rows = bands_for(numerator / denominator)
    limit = numerator / denominator
    least = limit - SIGMAS * math.sqrt(limit * (1 - limit) / PERMUTATIONS) - 1e-9

    def run(group: pa.Table) -> pa.Table:
        band, one = group.column("band")[0].as_py(), group.column("first")[0].as_py() == group.column("second")[0].as_py()
        members = sorted(zip(group.column("tile").to_pylist(), group.column("key").to_pylist(), group.column("label").to_pylist(),
                             each_binary(group.column("text"))))
        sets = list(shingle_sets([m[3] for m in members], width, WordHashes()))
        signs = np.stack([signature(s) for s in sets])
        bands = band_hashes(signs, n, rows)
        size = np.array([len(s) for s in sets])
        names = {x: i for i, x in enumerate(dict.fromkeys(m[2] for m in members))}
        label = np.array([names[m[2]] for m in members])              # of linked members the same
        split = len(members) if one else sum(m[0] == members[0][0] for m in members)
        links = []
        for i in range(split):
            low = i + 1 if one else split
            other = low + np.flatnonzero(label[low:] != label[i])
            other = other[np.minimum(size[other], size[i]) * denominator >= np.maximum(size[other], size[i]) * numerator]
            shared = bands[other] == bands[i]
            other = other[shared.any(1) & (bands[i][shared.argmax(1)] == band)]
            for j in other[(signs[other] == signs[i]).mean(1) >= least].tolist():
                if label[i] == label[j]:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if denominator * common >= numerator * int(size[i] + size[j] - common):
                    links.append((members[i][1], members[j][1]))
                    label[label == label[j]] = label[i]
        return pa.table({"src": pa.array([a for a, _ in links], pa.binary()), "dst": pa.array([b for _, b in links], pa.binary())})

    return met.join(texts, "key").groupBy("band", "first", "second").applyInArrow(run, "src binary, dst binary")


def near_documents(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, numerator: int = 80,
                   denominator: int = 100, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """One row per row of ``documents``: id, n_shingles, component_id, kept.

    Documents whose shingle sets meet ``denominator * intersection >= numerator * union`` are linked; ``component_id`` is the
    least id that links reach, ``kept`` whether it is the row's own. Rows with equal sets are one class. Classes whose
    signatures agree in all places of a band share a bucket; each is first verified against the leader (least class) with which it
    shares most buckets, then members of buckets that still hold several components are compared tile by tile, so a group of
    copies is never expanded into pairs. Full sets decide. A pair right at the similarity is missed with a chance of MISS at
    most for the bands and 4e-6 for the estimate. Texts without words and null ones link with nothing and are kept; a null id is never a
    component's least, so such a row is kept only if it has no words or all rows of its component have null ids; rows repeated with
    their id are all kept or none; an empty table gives no rows. Other columns are not read.
    """
    rows = table(signatures(documents, id_col=id_col, text_col=text_col, width=width), "signatures")
    classes = table(rows.where("key is not null").groupBy("key").agg(
        F.min("id").alias("least_id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")), "classes")
    bands = _banded(classes, numerator / denominator)
    leaders = bands.groupBy("band").agg(F.min("key").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = table(bands.join(leaders, "band"), "band-members")
    repeated = not rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()

    def texts_of(keys: DataFrame) -> DataFrame:
        return _texts(documents, table(keys.distinct(), "wanted-keys"), classes, id_col, text_col, width, repeated)

    shared = members.where("key <> leader").groupBy("leader", "key").agg(F.count(F.lit(1)).alias("n"))
    pairs = table(shared.groupBy("key").agg(F.max_by("leader", F.struct("n", "leader")).alias("a")).select("a", F.col("key").alias("b")),
                  "leader-pairs")
    components = None
    if not pairs.isEmpty():
        texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("key")))
        components = connected_components(table(_verified(pairs, texts, width, numerator, denominator), "leader-links"))
    labelled = table(_labels(members.drop("leader"), components), "labelled")
    several = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band")
    mixed = table(labelled.join(several, "band", "left_semi"), "mixed-buckets")
    if not mixed.isEmpty():
        texts = texts_of(mixed.select("key"))
        more = table(_links_in_buckets(mixed, classes, texts, width, numerator, denominator, tile_bytes), "bucket-links")
        known = [] if components is None else [components.select(F.col("node").alias("src"), F.col("component").alias("dst"))]
        components = connected_components(reduce(DataFrame.unionByName, [more, *known]))
    grouped = _labels(classes.select("key", "least_id"), components)
    least = grouped.groupBy("label").agg(F.min("least_id").alias("component_id"))
    out = rows.join(grouped.join(least, "label").select("key", "component_id"), "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
