"""How far each source's use of words lies from its language's, counted through minimal perfect hashes.

A first pass over the texts keeps the terms that occur in enough documents of their language (exact document frequencies).
The kept terms of a language are cut into shards, and each shard gets a minimal perfect hash with the terms stored at their
slots. A second pass looks every term up in the broadcast hashes, checks it against the stored one and increments the slot of
its group's dense counter. All arithmetic is in integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starling.llm.common import each_binary, table

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
SHARD_TERMS = 1 << 15           # kept terms of a shard, about
BLOCK_BYTES = 64 << 20          # perfect hashes broadcast at once; more are taken in further passes over the texts
TERMS_HELD = 1 << 19            # counted terms a task holds before it passes them on
SLOTS_HELD = 1 << 22            # slots of the dense counters a task holds
CELLS = 1 << 21                 # counts (sources x terms) compared in one task
LEVELS = 24
BITS_A_KEY = 2

_U = np.uint64
# Letters A-Z become small, every other ASCII byte but a-z a blank; bytes of other characters stay.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The runs of ASCII letters and non-ASCII characters of a UTF-8 text, A-Z lower-cased."""
    return (text or b"").translate(_LETTERS).split()


def hashes_of(terms: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(t) for t in terms), np.uint64, len(terms))


@dataclass
class PerfectHash:
    """A minimal perfect hash of distinct terms: their slots are 0 to n - 1.

    Level by level, the terms still without a slot fall on twice as many bits; a bit that one term alone hits is set, and
    its rank among all set bits is the term's slot. The few terms left after the last level (and terms whose 64-bit hashes
    are equal) take the last slots, found by their text. ``offsets`` and ``letters`` hold the term at each slot; ``order``
    the place of a slot's term among the sorted ones.
    """

    levels: list[np.ndarray]
    ranks: list[np.ndarray]
    rest: dict[bytes, int]
    offsets: np.ndarray
    letters: bytes
    order: np.ndarray

    @staticmethod
    def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        h = (hashes ^ _U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) * _U(0xD6E8FEB86659FD93)
        return ((h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93) >> _U(20)) % _U(size)

    @classmethod
    def build(cls, terms: list[bytes]) -> PerfectHash:
        hashes = hashes_of(terms)
        slot, left, n = np.full(len(terms), -1), np.arange(len(terms)), 0
        levels, ranks = [], []
        while len(left) and len(levels) < LEVELS:
            size = max(64, BITS_A_KEY * len(left))
            at = cls._places(hashes[left], len(levels), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            rank = n + np.cumsum(alone) - alone
            levels.append(alone)
            ranks.append(rank)
            taken = alone[at]
            slot[left[taken]] = rank[at[taken]]
            n += int(alone.sum())
            left = left[~taken]
        slot[left] = n + np.arange(len(left))
        at_slot = np.empty(len(terms), np.int64)
        at_slot[slot] = np.arange(len(terms))
        placed = [terms[i] for i in at_slot]
        order = np.empty(len(terms), np.int32)
        order[sorted(range(len(terms)), key=placed.__getitem__)] = np.arange(len(terms), dtype=np.int32)
        return cls(levels, ranks, {terms[i]: int(slot[i]) for i in left}, np.cumsum([0] + [len(t) for t in placed]), b"".join(placed), order)

    @classmethod
    def packed(cls, terms: list[bytes]) -> bytes:
        """What ``unpacked`` needs: the bits, the stored terms and their order, without the ranks."""
        built = cls.build(terms)
        head = np.array([len(built.levels), len(terms), len(built.rest), *(len(x) for x in built.levels)], np.int64)
        bits = b"".join(np.packbits(x).tobytes() for x in built.levels)
        return head.tobytes() + built.offsets.astype(np.int64).tobytes() + built.order.tobytes() + bits + built.letters

    @classmethod
    def unpacked(cls, blob: bytes) -> PerfectHash:
        n_levels, n, n_rest = np.frombuffer(blob, np.int64, 3).tolist()
        sizes = np.frombuffer(blob, np.int64, n_levels, 24).tolist()
        at = 24 + 8 * n_levels
        offsets = np.frombuffer(blob, np.int64, n + 1, at)
        order = np.frombuffer(blob, np.int32, n, at + 8 * (n + 1))
        at += 8 * (n + 1) + 4 * n
        levels, ranks, before = [], [], 0
        for size in sizes:
            bits = np.unpackbits(np.frombuffer(blob, np.uint8, (size + 7) // 8, at), count=size).astype(bool)
            levels.append(bits)
            ranks.append((before + np.cumsum(bits) - bits).astype(np.int32))
            before += int(bits.sum())
            at += (size + 7) // 8
        letters = blob[at:]
        rest = {letters[offsets[i]:offsets[i + 1]]: i for i in range(n - n_rest, n)}
        return cls(levels, ranks, rest, offsets, letters, order)

    def slots(self, terms: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The slot of each term, -1 for one that isn't stored."""
        out, left = np.full(len(terms), -1), np.arange(len(terms))
        for k, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            at = self._places(hashes[left], k, len(bits)).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        for i in left.tolist():
            out[i] = self.rest.get(terms[i], -1)
        begin, end, letters = self.offsets[out].tolist(), self.offsets[out + 1].tolist(), self.letters
        same = np.fromiter((letters[a:b] == t for a, b, t in zip(begin, end, terms)), bool, len(terms))
        return np.where(same, out, -1)


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (counts + 1) / total)``; three long divisions by thousands, so no product overflows."""
    part, left = np.zeros(np.broadcast(counts, total).shape, np.int64), counts + 1
    for _ in range(3):
        part = part * 1000 + left * 1000 // total
        left = left * 1000 % total
    return part + 1


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _fields(documents: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return documents.select(*[F.coalesce(documents[c].cast("string"), F.lit("")).alias(name)
                              for c, name in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])


def frequent_terms(fields: DataFrame, min_documents: int) -> DataFrame:
    """``lang, term, hash`` of the terms in at least ``min_documents`` rows of their language.

    A task sends one row per language and term it has met (TERMS_HELD at once), so a frequent term moves one row per task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[str, Counter] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, counts in met.items():
                terms = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(terms)), _strings(terms), pa.array(hashes_of(terms).view(np.int64)),
                     pa.array(list(counts.values()), pa.int64())], names=["lang", "term", "hash", "n"])
            met.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), each_binary(batch.column("text"))):
                met.setdefault(lang, Counter()).update(set(terms_of(text)))
            if sum(map(len, met.values())) > TERMS_HELD:
                yield from passed_on()
        yield from passed_on()

    partial = fields.select("lang", "text").mapInArrow(run, "lang string, term string, hash long, n long")
    return partial.groupBy("lang", "term", "hash").agg(F.sum("n").alias("n")).where(F.col("n") >= min_documents).drop("n")


def perfect_hashes(kept: DataFrame) -> DataFrame:
    """``lang, shard, n_terms, shards, blob`` of each shard of ``kept(lang, shard, shards, term)``."""
    def run(group: pa.Table) -> pa.Table:
        terms = sorted(group.column("term").cast(pa.binary()).to_pylist())
        return pa.table({"lang": group.column("lang").slice(0, 1), "shard": group.column("shard").slice(0, 1),
                         "shards": group.column("shards").slice(0, 1), "n_terms": pa.array([len(terms)], pa.int64()),
                         "blob": pa.array([PerfectHash.packed(terms)], pa.binary())})

    return kept.select("lang", "shard", "shards", "term").groupBy("lang", "shard").applyInArrow(
        run, "lang string, shard long, shards long, n_terms long, blob binary")


def _recount(fields: DataFrame, hashes: list) -> DataFrame:
    """``lang, source, shard, place, n``: occurrences of the terms of the given shards, by their place among the sorted ones.

    The sums of a group's slots over all tasks; a task passes on the slots that aren't zero.
    """
    shards = {r.lang: r.shards for r in hashes}
    sent = fields.sparkSession.sparkContext.broadcast({(r.lang, r.shard): bytes(r.blob) for r in hashes})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, opened = sent.value, {}
        dense: dict[tuple, np.ndarray] = {}
        met: dict[tuple, Counter] = {}

        def count() -> None:
            for (lang, source), counts in met.items():
                terms, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
                own = hashes_of(terms)
                shard = own.view(np.int64) % shards[lang]
                for k in np.unique(shard).tolist():
                    if (lang, k) not in blobs:
                        continue
                    if (lang, k) not in opened:
                        opened[lang, k] = PerfectHash.unpacked(blobs[lang, k])
                    these = np.flatnonzero(shard == k)
                    slot = opened[lang, k].slots([terms[i] for i in these.tolist()], own[these])
                    if (lang, source, k) not in dense:
                        dense[lang, source, k] = np.zeros(len(opened[lang, k].order), np.int64)
                    dense[lang, source, k][slot[slot >= 0]] += n[these][slot >= 0]      # a term comes once in a counter
            met.clear()

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source, k), slots in dense.items():
                used = np.flatnonzero(slots)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(used)), pa.repeat(source, len(used)), pa.array(np.full(len(used), k)),
                     pa.array(opened[lang, k].order[used]), pa.array(slots[used])], names=["lang", "source", "shard", "place", "n"])
            dense.clear()

        for batch in batches:
            held = 0
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), each_binary(batch.column("text"))):
                if lang in shards:
                    counts = met.setdefault((lang, source), Counter())
                    held -= len(counts)
                    counts.update(terms_of(text))
                    held += len(counts)
                    if held > TERMS_HELD:
                        count()
                        held = 0
            count()
            if sum(map(len, dense.values())) > SLOTS_HELD:
                yield from passed_on()
        yield from passed_on()

    rows = fields.mapInArrow(run, "lang string, source string, shard long, place int, n long")
    out = table(rows.groupBy("lang", "source", "shard", "place").agg(F.sum("n").alias("n")), "group-counts")
    sent.unpersist()
    return out


@dataclass
class Counts:
    """``terms``: lang, shard, place, term of every kept term; ``counts``: lang, source, shard, place, n (not zero);
    ``groups``: lang, source, total (of the kept terms), n_terms (kept in the language), n_sources."""

    terms: DataFrame
    counts: DataFrame
    groups: DataFrame


def recount(documents: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
            min_documents: int = MIN_DOCUMENTS, block_bytes: int = BLOCK_BYTES) -> Counts:
    """The kept terms and their exact counts in every (language, source) group.

    Shards of all languages are broadcast together while their hashes take at most ``block_bytes`` (a single shard may be
    more); the texts are read once for the frequencies and once for each block of shards.
    """
    spark = documents.sparkSession
    fields = _fields(documents, text_col, lang_col, source_col)
    kept = table(frequent_terms(fields, min_documents), "kept-terms")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms")).withColumn(
        "shards", F.ceil(F.col("n_terms") / SHARD_TERMS).cast("long"))
    kept = kept.join(sizes, "lang").withColumn("shard", F.pmod("hash", F.col("shards")))
    hashes = table(perfect_hashes(kept), "perfect-hashes")
    order = Window.partitionBy("lang", "shard").orderBy("term")
    terms = kept.select("lang", "shard", (F.row_number().over(order) - 1).alias("place"), "term")
    blocks, held = [[]], 0
    for row in hashes.select("lang", "shard", F.length("blob").alias("size")).orderBy("lang", "shard").collect():
        if blocks[-1] and held + row.size > block_bytes:
            blocks.append([])
            held = 0
        blocks[-1].append((row.lang, row.shard))
        held += row.size
    counts = spark.createDataFrame([], "lang string, source string, shard long, place int, n long")
    for block in blocks:
        if block:
            wanted = F.broadcast(spark.createDataFrame(block, "lang string, shard long"))
            counts = counts.unionByName(_recount(fields, hashes.join(wanted, ["lang", "shard"]).collect()))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    occurring = table(fields.select("lang", "source").distinct(), "groups")
    groups = (occurring.join(totals, ["lang", "source"], "left").join(sizes.select("lang", "n_terms"), "lang", "left")
              .join(occurring.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")), "lang"))
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "n_terms")], "n_sources")
    return Counts(terms, counts, table(groups, "group-totals"))


def _compared(counted: Counts, top: int) -> DataFrame:
    """``lang, source, item, shard, place, value``: the parts of a pair's value (``item`` the other source), and of each group
    the best terms (``item`` null). A task has all groups of a language for some of its terms, at most about CELLS counts."""
    width = F.greatest(F.lit(1), F.floor(F.lit(CELLS) / F.col("n_sources"))).cast("long")
    cells = counted.counts.join(counted.groups.select("lang", "n_sources").distinct(), "lang")
    cells = cells.select("lang", "source", "shard", F.floor(F.col("place") / width).cast("long").alias("piece"), "place", "n")
    pieces = cells.select("lang", "shard", "piece").distinct()
    # every group's total and the language's number of terms go to each piece as rows without a place
    totals = pieces.join(counted.groups, "lang").select("lang", "source", "shard", "piece", F.lit(-1).alias("place"), F.col("total").alias("n"))
    n_terms = pieces.join(counted.groups.groupBy("lang").agg(F.max("n_terms").alias("n")), "lang").select(
        "lang", F.lit("").alias("source"), "shard", "piece", F.lit(-2).alias("place"), "n")

    def run(group: pa.Table) -> pa.Table:
        place, n = group.column("place").to_numpy(), group.column("n").to_numpy()
        source = np.array(group.column("source").to_pylist(), object)
        v = int(n[place == -2][0])
        known = place == -1
        names = sorted(source[known])
        index = {s: i for i, s in enumerate(names)}
        total = np.zeros(len(names), np.int64)
        total[[index[s] for s in source[known]]] = n[known]
        real = place >= 0
        places, column = np.unique(place[real], return_inverse=True)
        counts = np.zeros((len(names), len(places)), np.int64)
        counts[np.array([index[s] for s in source[real]], np.int64), column] = n[real]
        p = shares(counts, (total + v)[:, None])
        q = shares(counts.sum(0), total.sum() + v)
        out = {k: [] for k in ("source", "item", "place", "value")}
        for i, name in enumerate(names):
            sums = ((p[i] - p) ** 2 // p).sum(1)
            others = [j for j in range(len(names)) if j != i]
            best = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            value = (p[i][best] - q[best]) ** 2 // q[best]
            first = np.lexsort((places[best], -value))[:top]
            out["source"] += [name] * (len(others) + len(first))
            out["item"] += [names[j] for j in others] + [None] * len(first)
            out["place"] += [None] * len(others) + places[best][first].tolist()
            out["value"] += sums[others].tolist() + value[first].tolist()
        size = len(out["source"])
        return pa.table({"lang": pa.repeat(group.column("lang")[0], size), "source": pa.array(out["source"], pa.string()),
                         "item": pa.array(out["item"], pa.string()), "shard": pa.repeat(group.column("shard")[0], size),
                         "place": pa.array(out["place"], pa.int32()), "value": pa.array(out["value"], pa.int64())})

    rows = cells.unionByName(totals).unionByName(n_terms)
    return rows.groupBy("lang", "shard", "piece").applyInArrow(
        run, "lang string, source string, item string, shard long, place int, value long")


def audit(documents: DataFrame, *, top: int = TOP_TERMS, **options) -> DataFrame:
    """One row per group and item: lang, source, part, item, value, rank.

    A group is an occurring (language, source); null texts, languages and sources are empty ones. ``p`` of a term is
    ``1 + floor(10^9 * (count + 1) / (N + V))``, with V the kept terms of the language and N their occurrences in the group (or
    the language). Part ``pair`` has each other source of the language, with ``floor((p - q)^2 / q)`` summed over all kept terms
    (0 without any), q the other's p. Part ``term`` has the ``top`` terms that occur in the group with p above the language's q.
    Ranks are by value from the greatest, then by the item's UTF-8 bytes. An empty table gives no rows; repeated rows count
    each time; other columns are not read. Counts move as sums per task, and a task compares at most about CELLS of them.
    """
    counted = recount(documents, **options)
    found = table(_compared(counted, top), "divergences")
    sums = found.where("item is not null").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    groups = counted.groups.select("lang", "source")
    pairs = groups.join(groups.withColumnRenamed("source", "item"), "lang").where("source <> item")
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    best = found.where("item is null").drop("item").join(counted.terms.withColumnRenamed("term", "item"), ["lang", "shard", "place"])
    both = pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return both.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top))
