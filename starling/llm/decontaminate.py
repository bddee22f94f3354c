"""Benchmark decontamination: a distributed positional inverted index searched for exact and near phrases.

The index is document-partitioned: each row is a segment, the posting lists of a few hundred thousand consecutive words
with the terms they belong to, so building it needs no shuffle, a frequent word is spread over all segments, and a search
meets every list of a segment in one task. Benchmarks are searched in blocks of bounded size against the stored segments.
"""

from __future__ import annotations

import math
import uuid
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import each_binary, release, small_side, table

WINDOW = 10
SEGMENT_WORDS = 1 << 18
BLOCK_BYTES = 8 << 20           # benchmark text searched at once; a block is collected and sent to the tasks
ESCAPE = 255
SEGMENT_DOCUMENTS = 1 << 14
STEP = 1 << 17                  # candidates of one intersection step

# A-Z lower-cased; ASCII digits, a-z and every byte of a multi-byte character are word characters.
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                   for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def _postings(terms: list[bytes], codes: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Terms (blank-separated), list lengths, gaps of one byte each, and the gaps too large for a byte, of the numbered words."""
    keys = np.sort((codes.astype(np.int64) << 32) | np.arange(len(codes), dtype=np.int64))
    counts = np.bincount(codes, minlength=len(terms)) if len(codes) else np.zeros(0, np.int64)
    places = keys & 0xFFFFFFFF
    gaps = np.diff(places, prepend=0)
    starts = np.cumsum(counts) - counts
    gaps[starts] = places[starts]
    large = gaps >= ESCAPE
    return (b" ".join(terms), counts.astype("<i4").tobytes(), np.where(large, ESCAPE, gaps).astype(np.uint8).tobytes(),
            gaps[large].astype("<i4").tobytes())


def build_index(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Segments ``(segment, doc_ids, doc_words, terms, counts, gaps, large_gaps)`` over all words of whole texts.

    A segment ends with the document that fills it with ``segment_words`` words or SEGMENT_DOCUMENTS documents; a document is
    never divided. Null texts have no words.
    """
    fields = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = fields.schema["id"].dataType.simpleString()
    names = ["segment", "doc_ids", "doc_words", "terms", "counts", "gaps", "large_gaps"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        ids, lengths, codes, arrow_type = [], [], array("i"), None
        numbers = defaultdict(count().__next__)             # words are numbered as they come, so none is held twice

        def flush():
            row = [uuid.uuid4().hex, ids, np.array(lengths, "<i4").tobytes(), *_postings(list(numbers), np.frombuffer(codes, np.int32))]
            types = [pa.string(), pa.list_(arrow_type)] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            arrow_type = batch.column("id").type
            for i, text in zip(batch.column("id"), each_binary(batch.column("text"))):
                found = words_of(text)
                ids.append(i.as_py())
                lengths.append(len(found))
                codes.extend(map(numbers.__getitem__, found))
                if len(codes) >= segment_words or len(ids) >= SEGMENT_DOCUMENTS:
                    yield flush()
                    ids, lengths, codes = [], [], array("i")
                    numbers = defaultdict(count().__next__)
        if ids:
            yield flush()

    return fields.mapInArrow(build, f"segment string, doc_ids array<{id_type}>, doc_words binary, terms binary, counts binary, "
                                    "gaps binary, large_gaps binary")


class Windows:
    """The windows of a block of items: a matrix of term numbers (-1 beyond a short window) and their items."""

    def __init__(self, items: list[tuple[object, list[bytes]]], width: int):
        numbers, rows, owners, self.items = {}, {}, [], [i for i, _ in items]
        for k, (_, words) in enumerate(items):
            coded = [numbers.setdefault(w, len(numbers)) for w in words]
            for at in range(max(1, len(coded) - width + 1) if coded else 0):
                window = tuple(coded[at:at + width])
                rows.setdefault(window, len(rows))
                owners.append((rows[window], k))
        self.terms = list(numbers)
        self.matrix = np.full((len(rows), width), -1, np.int64)
        for window, r in rows.items():
            self.matrix[r, :len(window)] = window
        self.lengths = (self.matrix >= 0).sum(1)
        owners = np.array(sorted(set(owners)), np.int64).reshape(-1, 2)
        self.owner_items = owners[:, 1]
        self.owner_starts = np.searchsorted(owners[:, 0], np.arange(len(rows) + 1))

    def items_of(self, windows: np.ndarray) -> list:
        found = {int(k) for w in np.unique(windows) for k in self.owner_items[self.owner_starts[w]:self.owner_starts[w + 1]]}
        return [self.items[k] for k in sorted(found)]


def _lists(counts: np.ndarray, gaps: bytes, large: bytes) -> np.ndarray:
    """Word positions of all posting lists, list after list."""
    steps = np.frombuffer(gaps, np.uint8).astype(np.int64)
    steps[steps == ESCAPE] = np.frombuffer(large, "<i4")
    places = np.cumsum(steps)
    starts = np.cumsum(counts) - counts
    before = np.where(starts > 0, places[starts - 1], 0) if len(counts) else np.zeros(0, np.int64)
    return places - np.repeat(before, counts)


def search_segment(block: Windows, doc_words: bytes, terms: bytes, counts: bytes, gaps: bytes, large: bytes,
                   slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(windows, starts)`` of exact occurrences, ``(windows, starts)`` of near ones, and where each document begins.

    Each window's lists are intersected from the rarest on: the positions of the rarest term, less its offset, are the
    candidates; each further list keeps those that it holds at its own offset. A near occurrence needs the three rarest
    terms within ``slop`` words of their places relative to the rarest.
    """
    sizes = np.frombuffer(counts, "<i4").astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    lengths = np.frombuffer(doc_words, "<i4").astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    local = {t: i for i, t in enumerate(terms.split(b" "))} if terms else {}
    number = np.array([local.get(t, -1) for t in block.terms], np.int64)
    frequency = np.where(number >= 0, sizes[number] if len(sizes) else 0, 0)
    never = np.iinfo(np.int64).max
    per_window = np.where(block.matrix >= 0, frequency[block.matrix], never) if len(number) else block.matrix
    alive = np.flatnonzero((per_window > 0).all(1)) if len(number) else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    if not len(alive):
        return none, none, none, none, bounds
    places = _lists(sizes, gaps, large)
    standing = np.full(bounds[-1], -1, np.int64)     # the test term at each position: all test lists at once
    present = np.flatnonzero(frequency)
    for t in present:
        standing[places[starts[number[t]]:starts[number[t]] + frequency[t]]] = t
    flat = np.concatenate([t * bounds[-1] + places[starts[number[t]]:starts[number[t]] + frequency[t]] for t in present])
    order = np.argsort(per_window[alive], axis=1, kind="stable")
    rarest = order[:, 0]
    size = per_window[alive, rarest]
    exact, near = [], []
    upto = np.cumsum(size)
    first = 0
    while first < len(alive):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + STEP, "right")))
        rows = np.arange(first, last)
        which = np.repeat(rows, size[rows])
        term = block.matrix[alive[which], rarest[which]]
        within = np.arange(len(which)) - np.repeat(np.cumsum(size[rows]) - size[rows], size[rows])
        at = places[starts[number[term]] + within] - rarest[which]
        if slop:
            good = np.ones(len(which), bool)
            for k in range(1, min(3, block.matrix.shape[1])):
                offset = order[which, k]
                other = block.matrix[alive[which], offset]
                low = np.searchsorted(flat, other * bounds[-1] + np.clip(at + offset - slop, 0, bounds[-1] - 1))
                reached = np.take(flat, low, mode="clip")
                good &= (other < 0) | ((low < len(flat)) & (reached <= other * bounds[-1] + at + offset + slop)
                                       & (reached // bounds[-1] == other))
            near.append((alive[which[good]], at[good] + rarest[which[good]]))
        keep = (at >= 0) & (at + block.lengths[alive[which]] <= bounds[-1])
        which, at = which[keep], at[keep]
        for k in range(1, block.matrix.shape[1]):
            offset = order[which, k]
            other = block.matrix[alive[which], offset]
            keep = (other < 0) | (standing[np.where(other < 0, 0, at + offset)] == other)
            which, at = which[keep], at[keep]
        ends = at + block.lengths[alive[which]]
        keep = np.searchsorted(bounds, at, "right") == np.searchsorted(bounds, ends - 1, "right")
        exact.append((alive[which[keep]], at[keep]))
        first = last
    windows, at = (np.concatenate([e[i] for e in exact]) for i in (0, 1))
    near_windows, near_at = (np.concatenate([e[i] for e in near]) for i in (0, 1)) if near else (none, none)
    return windows, at, near_windows, near_at, bounds


def _merge(starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Disjoint intervals that cover the given ones."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return [{"start": int(a), "end": int(b)} for a, b in zip(starts[new], ends[last])]


def _search(index: DataFrame, block: Windows, item_type: str, slop: int) -> DataFrame:
    id_type = index.schema["doc_ids"].dataType.elementType.simpleString()
    hit = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        arrow_items = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names if n != "doc_ids"}
                ids = batch.column("doc_ids")[i].values
                windows, at, near_windows, near_at, bounds = search_segment(
                    block, row["doc_words"], row["terms"], row["counts"], row["gaps"], row["large_gaps"], slop)
                n = len(ids)
                hits, items, near = [[]] * n, [[]] * n, [[]] * n
                of = np.searchsorted(bounds, at, "right") - 1
                order = np.argsort(of, kind="stable")
                for d in np.unique(of):
                    mine = order[np.searchsorted(of, d, "left", sorter=order):np.searchsorted(of, d, "right", sorter=order)]
                    begin = at[mine] - bounds[d]
                    hits[d] = _merge(begin, begin + block.lengths[windows[mine]])
                    items[d] = block.items_of(windows[mine])
                of = np.searchsorted(bounds, near_at, "right") - 1
                order = np.argsort(of, kind="stable")
                for d in np.unique(of):
                    mine = order[np.searchsorted(of, d, "left", sorter=order):np.searchsorted(of, d, "right", sorter=order)]
                    near[d] = block.items_of(near_windows[mine])
                arrow_items = pa.list_(pa.int64() if item_type == "bigint" else pa.int32() if item_type == "int" else pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["segment"]] * n, pa.string()), pa.array(np.arange(n), pa.int64()), ids,
                     pa.array(np.diff(bounds), pa.int64()), pa.array(hits, hit), pa.array(items, arrow_items),
                     pa.array(near, arrow_items)],
                    names=["segment", "place", "id", "n_words", "hits", "items", "near_items"])

    return index.mapInArrow(run, f"segment string, place long, id {id_type}, n_words long, hits array<struct<start:long,end:long>>, "
                                 f"items array<{item_type}>, near_items array<{item_type}>")


def find_contamination(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, slop: int = 0,
                       segment_words: int = SEGMENT_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``documents``: doc_id, ``n_words``, ``hits``, ``items`` and ``near_items``.

    Both sides are lower-cased (A-Z) and cut into words. A window is ``window`` consecutive words of an item, or the whole
    of a shorter one; an item without words has none. ``hits`` are the disjoint word ranges covered by occurrences of
    windows, ``items`` the items with an occurrence; with ``slop`` > 0, ``near_items`` have a window whose three rarest
    terms lie that close to their places. Null and empty texts have no words; repeated rows are searched each, repeated
    items count once; without documents or items no row has a hit. Other columns are not read.
    The index is written to the shared folder; the benchmark, without repeated rows, is read in blocks of about
    ``block_bytes`` by the hash of item and text, so rows that share an item are spread. A block's size is known before it is
    collected, and one of more than twice ``block_bytes`` is divided by another hash; only one row that is larger alone makes a
    block larger. Of several blocks each writes its hits before the next is collected.
    """
    index = table(build_index(documents, id_col=id_col, text_col=text_col, segment_words=segment_words), "token-index")
    items = benchmark.select(F.col(item_id_col).alias("item"), F.col(item_text_col).alias("text"))
    item_type = items.schema["item"].dataType.simpleString()
    if item_type not in ("bigint", "int"):
        items, item_type = items.withColumn("item", F.col("item").cast("string")), "string"
    items = table(items.where("text is not null").distinct(), "benchmark-items")
    parts = []

    def search(rows: DataFrame, level: int) -> None:
        total, n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
        if n > 1 and total > (2 if level else 1) * block_bytes:
            blocks = math.ceil(total / block_bytes)
            for b in range(blocks):
                search(rows.where(F.pmod(F.xxhash64(F.lit(level), "item", "text"), F.lit(blocks)) == b), level + 1)
            return
        found = Windows([(r["item"], words_of(r["text"].encode())) for r in rows.collect() if r["text"]], window)
        part = _search(index, found, item_type, slop)
        parts.append(table(part.where("size(hits) > 0 or size(near_items) > 0"), "block-hits") if level else part)

    search(items, 0)
    if len(parts) == 1:
        merged = parts[0]
    else:
        every = _search(index, Windows([], window), item_type, slop)           # each row once, without hits
        for p in parts:
            every = every.unionByName(p)
        merged = every.groupBy("segment", "place").agg(
            F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
            F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("near_items")).alias("near_items"))
        merged = merged.withColumn("hits", _merged_hits(F.array_sort("hits")))
    return merged.select(F.col("id").alias(id_col), "n_words", "hits", F.array_distinct("items").alias("items"),
                         F.array_distinct("near_items").alias("near_items"))


def _merged_hits(hits):
    """Disjoint ranges from ranges sorted by start."""
    def add(done, h):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], h["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= h["start"]), joined).otherwise(
            F.concat(done, F.array(h)))
    return F.aggregate(hits, F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"), add)


def digest(found: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Counts and the SHA-256 of the items, per row of ``find_contamination``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(F.col(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
                        F.size("near_items").cast("long").alias("n_near_items"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """``documents`` without the rows that have a hit; all their columns stay.

    Rows are told apart by id and text hash: a hit takes no other text of its id, or of a null id, along.
    """
    keyed = documents.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version")).alias("row"),
                             F.col(text_col).alias("text"))
    found = find_contamination(keyed, benchmark, id_col="row", text_col="text", **options)
    hit = found.where(F.size("hits") > 0).select(F.col("row.id").alias("hit_id"), F.col("row.version").alias("hit_version"))
    hit = small_side(table(hit.distinct(), "contaminated"))
    return documents.join(hit, documents[id_col].eqNullSafe(hit["hit_id"])
                          & (F.xxhash64(documents[text_col]) == hit["hit_version"]), "left_anti")
