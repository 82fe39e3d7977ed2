"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios, trained on labelled text.

A text's features are the distinct character n-grams it holds, hashed into
``2**bits`` columns. Each column is scaled by the log ratio of its smoothed
frequency in toxic and in other training texts, and a logistic regression is
fitted on the scaled columns. The model is one vector of weights and a bias.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiscore.llm import textops as tx
from entiscore.llm.tables import fresh

# Code points are lower-cased for A-Z and the Latin-1 capitals; everything that
# is no letter or digit in ASCII becomes one and the same blank.
_FOLD = np.arange(0x110000, dtype=np.uint32)
_FOLD[ord("A"):ord("Z") + 1] += 32
_FOLD[0xC0:0xDF] += 32
for _a, _b in ((0, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0xC0)):
    _FOLD[_a:_b] = 0x20


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (4, 5)   # ascending
    bits: int = 18
    sample_per_class: int = 2_500   # bound of the training sample
    min_texts: int = 3              # texts of the sample that must have a column
    smoothing: float = 1.0
    l2: float = 1e-3
    steps: int = 150
    seed: int = 5


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of a slice and the offsets of its texts among them."""
    texts = tx.Texts(column)
    lead = np.concatenate([[0], np.cumsum((texts.raw & 0xC0) != 0x80)])
    points = np.frombuffer(texts.raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return _FOLD[points], lead[texts.offsets]


class Features:
    """Distinct hashed n-grams of texts."""

    def __init__(self, s: Settings):
        self.s, self.seen = s, np.zeros(1 << s.bits, bool)

    def of(self, column: pa.Array) -> Iterator[np.ndarray]:
        points, offsets = _points(column)
        grams = self._grams(tx.mix64(points.astype(np.uint64) + np.uint64(1)))
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            for n, g in zip(self.s.orders, grams, strict=True):
                self.seen[g[a:max(a, b - n + 1)]] = True
            found = np.flatnonzero(self.seen)
            self.seen[found] = False
            yield found

    def _grams(self, codes: np.ndarray) -> list[np.ndarray]:
        """Columns of the n-grams at every place, for each order."""
        out, at = [], codes.copy()
        for n in range(1, max(self.s.orders) + 1):
            if n > 1 and len(at):  # at[i] so far covers n - 1 codes from i on
                at = at[:-1] * np.uint64(0x9E3779B97F4A7C15)
                at += codes[n - 1:]
            if n in self.s.orders:
                out.append(((at * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - self.s.bits)).astype(np.int32))
        return out


def fit(rows: list[np.ndarray], labels: np.ndarray, class_weight: tuple[float, float], s: Settings) -> tuple[np.ndarray, float]:
    """Weights over the hashed columns, and the bias."""
    width, out = 1 << s.bits, np.zeros(1 << s.bits, np.float32)
    y = labels.astype(np.float64)
    if not len(y) or y.min() == y.max():  # nothing to tell apart
        return out, (0.0 if not len(y) else (4.0 if y[0] else -4.0))
    count = [np.full(width, s.smoothing), np.full(width, s.smoothing)]
    texts = np.zeros(width, np.int32)
    for r, label in zip(rows, labels.tolist(), strict=True):
        count[label][r] += class_weight[label]
        texts[r] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    used = texts >= s.min_texts
    if not used.any():
        used = texts > 0
    rows = [r[used[r]] for r in rows]
    # Columns in use, renumbered; the scaled design matrix as one flat list.
    columns = np.flatnonzero(used)
    at = np.zeros(width, np.int32)
    at[columns] = np.arange(len(columns))
    scale, flat = ratio[columns], at[np.concatenate(rows)]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    filled = np.flatnonzero(np.diff(first))
    weight = np.where(y == 1, class_weight[1], class_weight[0])
    weight = weight / weight.sum()
    w, bias = np.zeros(len(columns)), float(np.log((weight * y).sum() / (weight * (1 - y)).sum()))
    m1, m2, b1, b2 = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, s.steps + 1):  # Adam on the full sample
        z = np.full(len(y), bias)
        z[filled] += np.add.reduceat((w * scale)[flat], first[filled])
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.bincount(flat, np.repeat(error, np.diff(first)), len(columns)) * scale + s.l2 * w
        gb = error.sum()
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        b1, b2 = 0.9 * b1 + 0.1 * gb, 0.99 * b2 + 0.01 * gb**2
        rate, c1, c2 = 0.02, 1 - 0.9**step, 1 - 0.99**step
        w -= rate * (m1 / c1) / (np.sqrt(m2 / c2) + 1e-8)
        bias -= rate * (b1 / c1) / (np.sqrt(b2 / c2) + 1e-8)
    out[columns] = w * scale
    return out, bias


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> tuple[np.ndarray, float]:
    """Fit on at most ``sample_per_class`` labelled texts of each class (those
    with the least id hashes); both classes weigh the same, so the score is a
    probability at equal odds.

    The sample is bounded by its parameter, so it is broadcast as ids, trained
    on in one task, and one weight vector returns. Null labels and ids are left
    out; an id labelled more than once counts as toxic if any label says so, and
    of an id with several texts one (that of the least hash) is trained on.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id IS NOT NULL AND y IN (0, 1)")
             .groupBy("id").agg(F.max("y").alias("y")))
    picked = None
    for y in (0, 1):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64(F.lit(s.seed), "id"), "id").limit(s.sample_per_class)
        picked = part if picked is None else picked.unionByName(part)
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
              .groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
              .repartition(1).sortWithinPartitions("id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, rows, y = Features(s), [], []
        for part in tx.slices(batches, "text"):
            rows += [r.astype(np.int32) for r in features.of(tx.column_of(part, "text"))]
            y += tx.column_of(part, "y").to_pylist()
        labels = np.array(y, np.int64)
        w, b = fit(rows, labels, tuple(1 / max(1, int((labels == c).sum())) for c in (0, 1)), s)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([b], pa.float64())], ["w", "b"])

    got = sample.mapInArrow(run, "w binary, b double").collect()  # one row of 4 * 2**bits bytes
    return (np.frombuffer(got[0]["w"], np.float32), got[0]["b"]) if got else (np.zeros(1 << s.bits, np.float32), 0.0)


def score(docs: DataFrame, model: tuple[np.ndarray, float], s: Settings = Settings(), text_col: str = "text", threshold: float = 0.7,
          keep: list[str] | None = None) -> DataFrame:
    """Every row with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    Null and empty texts have no features and get the score of the bias. Rows
    are scored one by one; an empty table gives an empty result; input columns
    named like an output are replaced. ``keep`` names the columns to carry.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("score", "predicted")]
    text = fresh(docs.select(*keep), "judged")["judged"]
    carried = docs.select(*keep, F.col(text_col).alias(text))
    # 4 * 2**bits bytes, fixed by the settings.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        features = Features(s)
        for part in tx.slices(batches, text, 1 << 18):
            z = np.array([weights[found].sum(dtype=np.float64) for found in features.of(tx.column_of(part, text))]) + bias
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            columns = [tx.column_of(part, c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*keep, "score", "predicted"])

    out = T.StructType([carried.schema[c] for c in keep]).add("score", T.DoubleType()).add("predicted", T.IntegerType())
    return carried.mapInArrow(run, out)
