"""Toxicity severity by cumulative-link ordinal regression on sparse word and word-stem features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import binary_values, table
from starling.llm.decontaminate import words_of

SAMPLE_PER_SIDE = 6000          # the bound of the training sample: labelled rows of either class, by hash of their id
FEATURES = 4096                 # features kept, by strength of their association with the label
LEAST_DOCS = 3
STEMS = (4, 5, 6)
GRADES = 4                      # 0 clean, then thirds of the toxic sample by the share of marked words
MEMO_WORDS = 400_000


def features_of(word: bytes) -> list[bytes]:
    """A word and its stems (first characters); stems are marked so that they never equal words."""
    text = word.decode("utf-8", "replace")
    return [word] + [b"\x00" + text[:k].encode() for k in STEMS if len(text) > k]


class Weights(dict):
    """Indices of a word's known features, remembered."""

    def __init__(self, index: dict[int, int]):
        super().__init__()
        self.index = index

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > MEMO_WORDS:
            self.clear()
        codes = (xxhash.xxh3_64_intdigest(f) for f in features_of(word))
        found = self[word] = tuple(self.index[c] for c in codes if c in self.index)
        return found


@dataclass
class OrdinalModel:
    """``P(grade >= k) = sigmoid(weights . features - thresholds[k-1])``, one weight vector for all thresholds."""

    index: dict[int, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, np.inf))

    def at_least(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logits[:, None] - self.thresholds[None, :], -50, 50)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_features: int, n_grades: int, *, l1: float = 2e-4,
                l2: float = 1e-3, rounds: int = 400, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the cumulative-link (proportional odds) model, by accelerated proximal gradient.

    Thresholds are a first one and non-negative steps, so they stay in order. Classes weigh alike in the loss.
    """
    which = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    share = np.bincount(grades, minlength=n_grades).clip(1)
    toxic = share[1:].sum()
    sample = np.where(grades == 0, 0.5 / share[0], 0.5 / toxic)
    w, steps = np.zeros(n_features), np.concatenate([[1.0], np.full(n_grades - 2, 1.0)])
    prev_w, prev_s = w, steps
    for t in range(rounds):
        momentum = t / (t + 3)
        vw, vs = w + momentum * (w - prev_w), steps + momentum * (steps - prev_s)
        theta = np.concatenate([[-np.inf], np.cumsum(vs), [np.inf]])
        z = np.bincount(which, vw[what], len(rows))
        upper, lower = _sigmoid(theta[grades + 1] - z), _sigmoid(theta[grades] - z)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p * sample, lower * (1 - lower) / p * sample
        grad_w = np.bincount(what, (du - dl)[which], n_features) + l2 * vw
        grad_theta = -np.bincount(grades + 1, du, n_grades + 1) + np.bincount(grades, dl, n_grades + 1)
        grad_s = np.cumsum(grad_theta[1:n_grades][::-1])[::-1]
        prev_w, prev_s = w, steps
        w = vw - rate * grad_w
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)
        steps = vs - rate * grad_s
        steps[1:] = np.maximum(steps[1:], 1e-3)
    return w, np.cumsum(steps)


def _sample(labels: DataFrame, id_col: str, label_col: str, per_side: int) -> DataFrame:
    """Up to ``per_side`` labelled ids of either class, by hash order."""
    clean = labels.select(F.col(id_col).alias("sample_id"), (F.col(label_col) > 0).alias("toxic")).dropna()
    clean = clean.groupBy("sample_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("sample_id", F.lit(7))
    return (clean.where("toxic").orderBy(order, "sample_id").limit(per_side)
            .unionByName(clean.where("not toxic").orderBy(order, "sample_id").limit(per_side)))


def _features(texts: DataFrame) -> DataFrame:
    """``id, toxic, feature`` once per document and feature hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(binary_values(batch.column("text"))):
                codes = {xxhash.xxh3_64_intdigest(f) for w in set(words_of(text)) for f in features_of(w)}
                values = np.fromiter(codes, np.uint64, len(codes)).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("toxic").take(pa.array(np.full(len(values), i))), pa.array(values)],
                                                 names=["toxic", "feature"])

    return texts.mapInArrow(run, "toxic boolean, feature long")


def train(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_id_col: str = "doc_id", label_col: str = "toxic", per_side: int = SAMPLE_PER_SIDE,
          n_features: int = FEATURES) -> OrdinalModel:
    """Fit on a sample of at most ``2 * per_side`` labelled documents (whole texts).

    Features are the ``n_features`` words and stems most associated with the label. Grades: 0 for clean documents; toxic
    ones are split into thirds by the share of their words that hold a feature seen almost only in toxic documents.
    Without labelled documents of both classes the model rates everything 0.
    """
    chosen = table(_sample(labels, label_id_col, label_col, per_side), "toxicity-sample")
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    texts = table(texts.join(F.broadcast(chosen), F.col("id") == F.col("sample_id")).select("id", "text", "toxic"), "toxicity-texts")
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return OrdinalModel()
    counts = _features(texts).groupBy("feature").agg(F.count(F.when(F.col("toxic"), 1)).alias("t"),
                                                     F.count(F.when(~F.col("toxic"), 1)).alias("c"))
    counts = counts.where(F.col("t") + F.col("c") >= LEAST_DOCS)
    odds = F.log((F.col("t") + 0.5) / (sizes[True] - F.col("t") + 0.5)) - F.log((F.col("c") + 0.5) / (sizes[False] - F.col("c") + 0.5))
    spread = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    best = counts.select("feature", "t", "c", (odds / spread).alias("z")).orderBy(F.abs("z").desc(), "feature").limit(n_features).collect()
    mask = (1 << 64) - 1
    index = {r["feature"] & mask: i for i, r in enumerate(best)}
    marks = {i for i, r in enumerate(best) if r["z"] > 3 and r["c"] * sizes[True] <= 0.02 * r["t"] * sizes[False]}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Weights(index)
        for batch in batches:
            found, shares = [], []
            for text in binary_values(batch.column("text")):
                words = words_of(text)
                found.append(sorted(set().union(*map(known.__getitem__, set(words)))))
                shares.append(sum(not marks.isdisjoint(known[w]) for w in words) / max(1, len(words)))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int32())), pa.array(shares)],
                                             names=["toxic", "found", "share"])

    rows = texts.select("toxic", "text").mapInArrow(extract, "toxic boolean, found array<int>, share double").toArrow()
    toxic = rows.column("toxic").to_numpy()
    share = rows.column("share").to_numpy()
    cuts = np.quantile(share[toxic], np.arange(1, GRADES - 1) / (GRADES - 1))
    grades = np.where(toxic, 1 + np.searchsorted(cuts, share, "right"), 0).clip(0, GRADES - 1)
    sparse = [np.array(v, np.int64) for v in rows.column("found").to_pylist()]
    weights, thresholds = fit_ordinal(sparse, grades, len(index), GRADES)
    return OrdinalModel({h: i for h, i in index.items() if weights[i]}, weights, thresholds)


def rate(documents: DataFrame, model: OrdinalModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, expected_severity, grade, p_toxic, toxic.

    ``expected_severity`` is the sum over the thresholds of the chance to reach them, ``grade`` the most reached threshold
    with a chance of one half, ``p_toxic`` the chance of grade 1 or more, ``toxic`` whether that is at least one half. A
    feature counts once per document. Null and empty texts have no features; repeated rows are rated each; an empty table
    gives an empty result; other columns are not read. A narrow map; the model holds at most FEATURES weights.
    """
    fields = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = fields.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Weights(model.index)
        for batch in batches:
            logits = np.array([sum(model.weights[i] for i in set().union(*map(known.__getitem__, set(words_of(t)))))
                               for t in binary_values(batch.column("text"))], np.float64)
            chances = model.at_least(logits.reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(chances.sum(1)), pa.array((chances >= 0.5).sum(1).astype(np.int32)),
                 pa.array(chances[:, 0]), pa.array(chances[:, 0] >= 0.5)],
                names=["id", "expected_severity", "grade", "p_toxic", "toxic"])

    out = fields.mapInArrow(run, f"id {id_type}, expected_severity double, grade int, p_toxic double, toxic boolean")
    return out.withColumnRenamed("id", id_col)
