"""Best-fit packing of tokenised documents by a configuration linear program over the length histogram.

Lengths never exceed the sequence size, so the histogram (one count per length) is bounded whatever the input: it alone
reaches the driver, where multiplicative weights with knapsack pricing solve the program. The rounded configurations are a
table of (length, rank range) -> (sequence, offset), and every piece looks its place up by its rank among equal lengths.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starling.llm.common import keep, small_side, table

CAPACITY = 1024
END_ID = 2
MEMO_ENTRIES = 500_000
# White space other than blank and line feed; texts with any of it are encoded whole.
RARE_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


# Marks that neither letters, digits nor white space join, and that start no contraction.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable Latin-1 characters stand for themselves, the rest follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


class _Marks(dict):
    def __init__(self, encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, marks: str) -> bytes:
        found = self.encoder.whole(marks)
        if len(self) < 10_000:
            self[marks] = found
        return found


class _Words(dict):
    """Ids of the words that stand behind ``before``; one that isn't there is learnt when it is looked up."""

    def __init__(self, encoder, before: str):
        super().__init__()
        self.encoder, self.before = encoder, before

    def __missing__(self, word: str) -> bytes:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        found = self[word] = self.encoder._word(self.before, word)
        return found


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids (little-endian unsigned 32-bit) of whole texts by ``tokenizers``, remembered per word.

    The byte-level pre-tokenizer starts a new token at a blank or line feed that stands between two characters that
    are no white space, and no merge crosses a token, so the ids of such a text are those of its words in order (a word
    takes the blank before it). Texts with other white space or runs of it, and texts with the string of a special token
    (which becomes that token's id), are encoded whole.
    """

    def __init__(self, path: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_tokenizer())
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.first, self.later = _Words(self, ""), _Words(self, " ")
        self.feed = self.whole("\n")
        self.marks = _Marks(self)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, before: str, word: str) -> bytes:
        """Ids of a word with what stands before it; letters alone are one token of the pre-tokenizer, so the model suffices."""
        if word.isalpha():
            mapped = (before + word).encode().decode("latin-1").translate(BYTE_LETTERS)
            return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped)])
        letters = word.rstrip(MARKS)
        if letters != word and letters.isalpha():         # a run of marks after letters is a token of its own
            return self._word(before, letters) + self.marks[word[len(letters):]]
        return self.whole(before + word)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n"
                or any(c in text for c in RARE_SPACE) or any(s in text for s in self.special)):
            return self.whole(text)
        out = []
        for line in text.split("\n"):
            words = line.split(" ")
            out.append(self.first[words[0]])
            out += map(self.later.__getitem__, words[1:])
            out.append(self.feed)
        out.pop()
        return b"".join(out)


def _encoder(path: str | None) -> Encoder:
    """One encoder for all tasks of a Python worker: its vocabulary is read, and its words are learnt, once."""
    return keep(("encoder", path), lambda: Encoder(path))


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: full ones, but the first may be shorter."""
    first = (n - 1) % capacity + 1 if n else 0
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces_of(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
              capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their running number per length within the task (``part``, ``local``)."""
    fields = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = fields.schema["id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = _encoder(tokenizer_path), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows, which = [], []
            for i, text in enumerate(batch.column("text")):         # one at a time: a batch of long texts isn't held twice
                ids = encoder.encode(text.as_py() or "") + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start:4 * (start + length)]
                    rows.append((piece, start, length, zlib.crc32(own), part, seen[length],
                                 np.frombuffer(own, "<u4").astype(np.int32) if with_ids else None))
                    seen[length] += 1
                    which.append(i)
            cols = list(zip(*rows)) if rows else [()] * 7
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = ["piece", "start", "length", "ids_crc32", "part", "local", "ids"]
            keep = 7 if with_ids else 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(which, pa.int64()))] + [pa.array(c, t) for c, t in zip(cols[:keep], types)],
                names=["id"] + names[:keep])

    return fields.mapInArrow(run, f"id {id_type}, piece int, start long, length long, ids_crc32 long, part int, local long"
                                  + (", ids array<int>" if with_ids else ""))


def price(values: np.ndarray, capacity: int, slack: float, most: int) -> list[tuple[int, ...]]:
    """Up to ``most`` configurations worth at least ``1 - slack`` of the best that fits, no length in two of them.

    Knapsack dynamic programming over the room; ``values[l]`` is -inf for absent lengths. The best one comes first.
    """
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        sums = values[1:c + 1] + best[c - 1::-1] if c > 1 else values[1:2] + best[:1]
        k = int(sums.argmax())
        if sums[k] > best[c - 1]:
            best[c], choice[c] = sums[k], k + 1
        else:
            best[c] = best[c - 1]
    through = values[1:] + best[capacity - 1::-1]         # the best configuration that holds a given length
    found, taken = [], set()
    for length in np.argsort(-through, kind="stable") + 1:
        if through[length - 1] < (1 - slack) * best[capacity] or len(found) == most:
            break
        lengths, c = [int(length)], capacity - int(length)
        while c > 0:
            if choice[c]:
                lengths.append(int(choice[c]))
                c -= choice[c]
            else:
                c -= 1
        if taken.isdisjoint(lengths):
            found.append(tuple(sorted(lengths, reverse=True)))
            taken.update(lengths)
    return found


def solve_fractional(counts: dict[int, int], capacity: int, cover: float, step: float, rate: float, slack: float,
                     most: int) -> dict[tuple[int, ...], float]:
    """Multiplicative weights for the covering program: how often to use each configuration.

    A length's weight is its size times ``exp(-rate * covered share)``. Each round prices configurations and uses each
    until the scarcest of its lengths is covered by a further ``step``; lengths covered to ``cover`` leave.
    """
    amounts = np.zeros(capacity + 1)
    for length, n in counts.items():
        amounts[length] = n
    covered, used = np.zeros(capacity + 1), defaultdict(float)
    sizes = np.arange(capacity + 1) / capacity
    while True:
        share = np.divide(covered, amounts, out=np.ones(capacity + 1), where=amounts > 0)
        open_ = share < cover - 1e-9
        if not open_.any():
            return used
        weights = np.where(open_, sizes * np.exp(-rate * (share - share[open_].min())), -np.inf)
        for lengths in price(weights, capacity, slack, most):
            inside = Counter(lengths)
            amount = min(min(step * amounts[k], cover * amounts[k] - covered[k]) / a for k, a in inside.items())
            used[lengths] += amount
            for k, a in inside.items():
                covered[k] += a * amount


def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Best-fit decreasing on counts: configurations and how often each occurs."""
    bins, by_room = Counter(), defaultdict(Counter)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = next((r for r in range(length, capacity) if by_room[r]), None)
            if room is None:
                fit = capacity // length
                whole, rest = divmod(left, fit)
                for config, n in (((length,) * fit, whole), ((length,) * rest, min(rest, 1))):
                    if n:
                        by_room[capacity - sum(config)][config] += n
                left = 0
            else:
                config, n = next(iter(by_room[room].items()))
                n = min(n, left)
                by_room[room][config] -= n
                if not by_room[room][config]:
                    del by_room[room][config]
                by_room[room - length][(*config, length)] += n
                left -= n
    for configs in by_room.values():
        bins.update(configs)
    return bins


def configurations(counts: dict[int, int], capacity: int = CAPACITY, *, cover: float = 0.9, step: float = 0.1,
                   rate: float = 4.0, slack: float = 0.02, most: int = 64) -> Counter:
    """Configurations (lengths) and how often each is used; together they hold exactly the counted pieces.

    Full pieces stand alone. The program is solved to a covered share of ``cover`` (so that no length runs out early), its
    full configurations are rounded down, and what is left is solved again while that takes a tenth of it or more. The
    rest (few pieces, or lengths that leave gaps) is packed best-fit decreasing.
    """
    left = {k: n for k, n in counts.items() if 0 < k < capacity and n}
    out = Counter({(capacity,): counts[capacity]} if counts.get(capacity) else {})
    while left:
        before = sum(left.values())
        used = solve_fractional(left, capacity, cover, step, rate, slack, most)
        for config in sorted(used, key=lambda c: (-used[c], c)):
            inside = Counter(config)
            n = min(math.floor(used[config] + 1e-9), *(left[k] // a for k, a in inside.items()))
            if n > 0 and sum(config) == capacity:
                out[config] += n
                for k, a in inside.items():
                    left[k] -= a * n
        left = {k: n for k, n in left.items() if n}
        if sum(left.values()) > 0.9 * before:
            break
    out.update(best_fit(left, capacity))
    return out


def places(configs: Counter, first_sequence: int = 0) -> dict[int, np.ndarray]:
    """Per length the columns rank_start, sequence, offset of its slots, by rank."""
    slots, rank, sequence = defaultdict(list), Counter(), first_sequence
    for config in sorted(configs, reverse=True):
        n, offset = configs[config], 0
        for length in config:
            slots[length].append((rank[length], sequence, offset))
            rank[length] += n
            offset += length
        sequence += n
    return {k: np.array(v, np.int64) for k, v in slots.items()}


def pack(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset.

    A document's ids are those of its whole text and ``end_id``; null and empty texts have ``end_id`` only. Longer ones are
    cut into pieces of ``capacity``, the first may be shorter. Pieces fill sequences of at most ``capacity`` without gaps.
    Repeated rows are packed each; an empty table gives an empty result; other columns are not read. Ranks among equal
    lengths are running numbers within the writing tasks plus offsets per (length, task), so a length that a third of all
    pieces share is never sorted or gathered.
    """
    rows = table(pieces_of(documents, id_col=id_col, text_col=text_col, tokenizer_path=tokenizer_path, capacity=capacity,
                           end_id=end_id, with_ids=with_ids), "pieces")
    groups = table(rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "piece-groups")
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = places(configurations(counts, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    ranked = rows.join(small_side(groups.select("length", "part", before.alias("before"))), ["length", "part"])
    ranked = ranked.drop("part").withColumn("rank", F.col("before") + F.col("local")).drop("before", "local")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for own in np.split(order, edges[1:]) if len(order) else []:
                slot = slots[int(length[own[0]])]
                at = np.searchsorted(slot[:, 0], rank[own], "right") - 1
                sequence[own] = slot[at, 1] + rank[own] - slot[at, 0]
                offset[own] = slot[at, 2]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)],
                                             names=names + ["sequence_id", "offset"])

    packed = ranked.mapInArrow(look_up, schema + ", sequence_id long, offset long")
    return packed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []),
                         "sequence_id", "offset")
