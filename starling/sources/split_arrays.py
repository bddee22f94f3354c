"""Large JSON array files read by many tasks (A1, A2).

The splittable ``text`` source cuts a file at every closing brace, so a split is a run of fragments, whatever the layout of the
file. A first pass describes each split for both states in which it may begin (inside or outside a string): the parity of its
quotes, its change of depth, the commas at each relative depth. Running sums over the splits of a file then give the state in
which each of them really begins, and the number of elements before it. In a second pass every task cuts its splits at the commas of
the outer array; the pieces of an element that reaches over splits are put together by its number. Both passes are narrow;
only the descriptions and those pieces are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starling.operators.joins import BROADCAST_MAX_ROWS
from starling.sources.json_files import (REASON_NULL_DOCUMENT, _one_root, _reader, _reason_of_value, _strictly, logical_name,
                                         parse_json_arrays)

# Array files from this size on are read in splits.
SPLIT_FROM_BYTES = 64 << 20
SEPARATOR = b"}"

_QUOTE, _BACKSLASH, _COMMA = 0x22, 0x5C, 0x2C
_BLANK = np.isin(np.arange(256), [9, 10, 13, 32])
# +1 for an opening bracket or brace, -1 for a closing one.
_STEP = np.zeros(256, np.int8)
_STEP[[0x5B, 0x7B]], _STEP[[0x5D, 0x7D]] = 1, -1
_SIGN = (_STEP != 0) | (np.arange(256) == _COMMA)

_SUMMARY = ("path string, start long, parity int, first int, blank boolean, delta array<long>, low array<long>, "
            "lows array<long>, ended array<boolean>, commas array<map<long,long>>")
_CUT = "path string, start long, row_number long, text string, edge boolean, lone boolean"


def _fragments(spark: SparkSession, path: str, from_bytes: int) -> DataFrame:
    """``path, start, value``: the texts between closing braces, in the order of the file within a split."""
    df = _reader(spark, False, None).option("lineSep", SEPARATOR.decode()).load(path)
    return df.where(F.col("_metadata.file_size") >= from_bytes).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def _runs(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple]:
    """``(split, text, end)`` with the bytes of each split, some at a time; ``split`` is (path, start, *more).

    A separator stands between two fragments, also where the next split goes on; so a file's last byte is left out if it is one,
    and such a file is no array. ``end`` comes last, with no text.
    """
    known = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, bool)
        for c in ("path", "start"):
            change[1:] |= pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, n - 1)).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.flatnonzero(change), [n]])
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), batch.column("value").cast(pa.binary())),
                               pa.scalar(SEPARATOR, pa.binary()))
        for low, text in zip(bounds.tolist(), texts):
            key = tuple(batch.column(c)[low].as_py() for c in ("path", "start", *more))
            text = text.as_py()
            if known is not None and key != known:
                yield known, b"", True
            yield key, text if key != known and key[1] == 0 else SEPARATOR + text, False
            known = key
    if known is not None:
        yield known, b"", True


class _Quotes:
    """Which quotes of a text, read part by part, are not escaped."""

    def __init__(self):
        self.slashes = 0                                   # at the end of the last part

    def read(self, text: np.ndarray) -> np.ndarray:
        quote = text == _QUOTE
        if not len(text):
            return quote
        slash = text == _BACKSLASH
        if not slash.any():
            if self.slashes % 2:
                quote[0] = False
            self.slashes = 0
            return quote
        place = np.arange(len(text))
        last = np.maximum.accumulate(np.where(slash, -1 - self.slashes, place))    # the last byte that is no backslash
        at = np.flatnonzero(quote)
        before = np.where(at > 0, at - 1 - last[at - 1], self.slashes)             # backslashes right before each quote
        quote[at[before % 2 == 1]] = False
        self.slashes = int(place[-1] - last[-1]) if slash[-1] else 0
        return quote


class _State:
    """Where in a JSON text a reader stands: inside a string or not, how many brackets deep."""

    def __init__(self, inside: bool, depth: int):
        self.inside, self.depth = inside, depth

    def read(self, text: np.ndarray, quote: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(places of brackets and commas outside strings, depth after each)``; moves on to the end of ``text``."""
        inside = np.logical_xor.accumulate(quote) ^ self.inside if len(text) else quote
        at = np.flatnonzero(_SIGN[text] & ~inside)
        depth = self.depth + np.cumsum(_STEP[text[at]], dtype=np.int64)
        if len(text):
            self.inside = bool(inside[-1])
        if len(at):
            self.depth = int(depth[-1])
        return at, depth


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: what ``_starts`` needs to know, for a start outside and for one inside a string."""
    def fresh() -> dict:
        return {"quotes": _Quotes(), "states": [_State(False, 0), _State(True, 0)], "first": None, "blank": True, "low": [0, 0],
                "lows": [0, 0], "ended": [True, True], "commas": [{}, {}]}

    seen = fresh()
    for split, text, end in _runs(batches):
        data = np.frombuffer(text, np.uint8)
        solid = np.flatnonzero(~_BLANK[data])
        if seen["first"] is None and len(solid):
            seen["first"] = int(data[solid[0]])
        seen["blank"] &= not len(solid)
        quote = seen["quotes"].read(data)
        for k, state in enumerate(seen["states"]):
            at, depth = state.read(data, quote)
            closing = _STEP[data[at]] < 0
            low = int(depth[closing].min()) if closing.any() else 1 << 40
            if low < seen["low"][k]:
                seen["low"][k], seen["lows"][k] = low, 0
            if low == seen["low"][k]:
                lowest = at[closing & (depth == low)]
                seen["lows"][k] += len(lowest)
                seen["ended"][k] = solid[-1] <= lowest[-1]
            elif len(solid):
                seen["ended"][k] = False
            for level, n in zip(*np.unique(depth[data[at] == _COMMA], return_counts=True)):
                seen["commas"][k][int(level)] = seen["commas"][k].get(int(level), 0) + int(n)
        if end:
            states = seen["states"]
            yield pa.RecordBatch.from_pylist([{
                "path": split[0], "start": split[1], "parity": int(states[0].inside), "first": seen["first"],
                "blank": seen["blank"], "delta": [s.depth for s in states], "low": seen["low"], "lows": seen["lows"],
                "ended": seen["ended"], "commas": [list(c.items()) for c in seen["commas"]]}], schema=pa.schema([
                    ("path", pa.string()), ("start", pa.int64()), ("parity", pa.int32()), ("first", pa.int32()),
                    ("blank", pa.bool_()), ("delta", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())),
                    ("lows", pa.list_(pa.int64())), ("ended", pa.list_(pa.bool_())),
                    ("commas", pa.list_(pa.map_(pa.int64(), pa.int64())))]))
            seen = fresh()


def _starts(described: DataFrame) -> DataFrame:
    """``path, start, inside, depth, before, total, one_array`` per split: its state, the outer commas before it and in the
    whole file, and whether the file is one array and nothing else."""
    so_far = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    df = described.withColumn("inside", F.coalesce(F.sum("parity").over(so_far), F.lit(0)) % 2 == 1)
    k = F.col("inside").cast("int")
    pick = {c: F.get(c, k).alias(c) for c in ("delta", "low", "lows", "ended", "commas")}
    df = df.select("path", "start", "inside", "first", "blank", "parity", *pick.values())
    df = df.withColumn("depth", F.coalesce(F.sum("delta").over(so_far), F.lit(0)))
    outer = F.coalesce(F.try_element_at("commas", 1 - F.col("depth")), F.lit(0))
    df = df.withColumn("outer", outer)
    lowest = F.col("depth") + F.col("low")
    # the outer array is open from the file's first sign to its last one, which closes it
    closed = (lowest == 0) & (F.col("lows") == 1) & F.col("ended")
    first = F.col("start") == F.min("start").over(whole)
    sound = F.when(F.col("blank"), True).when(first, (F.col("first") == ord("[")) & ((F.col("lows") == 0) | closed | (lowest > 0))
                                              ).otherwise((F.col("depth") >= 1) & ((lowest >= 1) | closed))
    ends = (F.sum("delta").over(whole) == 0) & (F.sum("parity").over(whole) % 2 == 0) & ~F.min("blank").over(whole)
    return df.select("path", "start", "inside", "depth", F.coalesce(F.sum("outer").over(so_far), F.lit(0)).alias("before"),
                     F.sum("outer").over(whole).alias("total"), (F.min(sound).over(whole) & ends).alias("one_array"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of the outer array, and as ``edge`` the pieces of those that reach over the ends of a split."""
    known, state, quotes, number, held, edge = None, None, None, 0, [], False
    for split, text, end in _runs(batches, "inside", "depth", "before", "total"):
        if split != known:
            known, state, quotes, held = split, _State(split[2], split[3]), _Quotes(), []
            number, edge = split[4] + 1, split[3] >= 1      # what comes first belongs to an element of an earlier split
        data = np.frombuffer(text, np.uint8)
        begin = state.depth
        signs, depth = state.read(data, quotes.read(data))
        before = np.concatenate([[begin], depth])[:-1]
        mark = ((data[signs] == _COMMA) & (depth == 1)) | ((before == 0) & (depth == 1)) | ((before == 1) & (depth == 0))
        out, at = [], 0
        for place, opens in zip(signs[mark].tolist(), (before[mark] == 0).tolist()):
            if opens:
                held, edge = [], False
            else:
                held.append(text[at:place])
                out.append((number, b"".join(held), edge))
                number, held, edge = number + 1, [], False
            at = place + 1
        if state.depth:
            held.append(text[at:])
        else:
            held = []
        if end and held:
            out.append((number, b"".join(held), True))
        if out:
            numbers, texts, edges = zip(*out)
            n = len(out)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(split[0], n), pa.array(np.full(n, split[1])), pa.array(numbers, pa.int64()),
                 pa.array(texts, pa.binary()).cast(pa.string()), pa.array(edges, pa.bool_()), pa.array(np.full(n, split[5] == 0))],
                names=["path", "start", "row_number", "text", "edge", "lone"])


def array_elements(spark: SparkSession, path: str, from_bytes: int = SPLIT_FROM_BYTES) -> tuple[DataFrame, list[str]]:
    """``(path, row_number, text)`` of the elements of each file of at least ``from_bytes`` that is one array, and the paths of
    the others of that size (a bare object, lines, several roots, a cut-off file), which need a whole-file parse."""
    from starling.session import shared_path

    fragments = _fragments(spark, path, from_bytes)
    folder = shared_path(spark, "split-arrays")
    _starts(fragments.mapInArrow(_described, _SUMMARY)).write.parquet(folder)         # one small row per split
    starts = spark.read.parquet(folder)
    other = sorted(r.path for r in starts.where("not one_array").select("path").distinct().collect())
    starts = starts.where("one_array").drop("one_array")
    # a split's row goes to the tasks by broadcast, some files at a time if there are very many splits
    blocks = -(-max(starts.count(), 1) // BROADCAST_MAX_ROWS)
    cut = []
    for block in range(blocks):
        own = F.pmod(F.xxhash64("path"), F.lit(blocks)) == block
        rows = fragments.where(own).join(F.broadcast(starts.where(own)), ["path", "start"])
        cut.append(rows.select("path", "start", "value", "inside", "depth", "before", "total").mapInArrow(_cut, _CUT))
    pieces = cut[0]
    for more in cut[1:]:
        pieces = pieces.unionByName(more)
    joined = pieces.where("edge").groupBy("path", "row_number").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "").alias("text"), F.first("lone").alias("lone"))
    rows = pieces.where("not edge").select("path", "row_number", "text", "lone").unionByName(joined)
    # an array without any comma and without content has no element
    return rows.where(~F.col("lone") | (F.trim("text", F.lit(" \r\n\t")) != "")).drop("lone"), other


def read_split_arrays(spark: SparkSession, path: str, strict: bool = False, from_bytes: int = SPLIT_FROM_BYTES) -> DataFrame:
    """The rows of ``parse_json_arrays(read_files(path))``, large array files read by several tasks.

    Smaller files, and large ones that are no single array, are read whole. In a large array an element that is no JSON is
    a reject of its own, with its row number and text; in a file read whole the whole text is.
    """
    elements, other = array_elements(spark, path, from_bytes)
    root = elements.select("path", "row_number", "text", _one_root(F.col("text"), "variant").alias("payload"))
    reason = _reason_of_value(F.col("payload"))
    reason = F.when(reason.isNull() | F.col("payload").isNull() | F.is_variant_null("payload"), reason)    # as in a file read whole, any value is a row
    split = root.select(logical_name(F.col("path"), path).alias("file_name"), "row_number", "payload",
                        _strictly(reason, strict).alias("reject_reason"),
                        F.when(reason.isNotNull() & (reason != REASON_NULL_DOCUMENT), F.col("text")).alias("raw"))
    size = F.col("_metadata.file_size")
    whole = _reader(spark, False, None).option("wholetext", True).load(path)
    small = whole.where((size < from_bytes) | F.col("_metadata.file_path").isin(other) if other else size < from_bytes)
    small = small.select(logical_name(F.col("_metadata.file_path"), path).alias("file_name"), "value")
    return parse_json_arrays(small, strict=strict).unionByName(split)
