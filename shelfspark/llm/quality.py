"""Quality classifier: naive Bayes support vectors.

Features are indicators of the byte 1-, 2- and 3-grams of the whole text, each scaled by the log ratio of its smoothed
counts in the two classes, rows scaled to length one. A linear hinge-loss model is fitted to them by dual coordinate
descent, which is sequential and runs on the driver over a sample of at most about SAMPLE documents of each class;
that bound is a parameter, and so is the bound of their bytes. A logistic curve fitted on margins of halves left out turns margins into scores.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import scratch
from shelfspark.llm.ngrams import DIMS, indicators, labelled_sample, with_columns
from shelfspark.llm.textbytes import ragged_binary, text_chunks

SAMPLE = 4000
THRESHOLD = 0.3


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    counts = np.full((2, DIMS), smooth)
    for x, label in zip(rows, y, strict=True):
        counts[label, x] += 1
    share = counts / counts.sum(1, keepdims=True)
    return np.log(share[1] / share[0])


def row_scales(rows: list[np.ndarray], ratio: np.ndarray) -> np.ndarray:
    """What brings each row of indicators, scaled by ratio, to length one."""
    square = ratio * ratio
    return 1 / np.sqrt(np.maximum(np.array([square[x].sum() for x in rows]), 1e-12))


def dual_coordinate_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = 1.0, epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise half their square plus the hinge losses; classes cost the same in total.

    Row i has the value ratio[x] at its places x, scaled to length one; values are made from the places when they are needed.
    """
    sign = np.where(y == 1, 1.0, -1.0)
    share = np.bincount(y, minlength=2) / len(y)
    top = np.where(y == 1, cost * 0.5 / max(share[1], 1e-9), cost * 0.5 / max(share[0], 1e-9))
    w, bias, alpha = np.zeros(DIMS), 0.0, np.zeros(len(y))
    scale, squares = row_scales(rows, ratio), ratio * ratio
    square = np.array([squares[x].sum() * z * z + 1.0 for x, z in zip(rows, scale, strict=True)])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            x = rows[i]
            v = ratio[x] * scale[i]
            slope = sign[i] * (float(w[x] @ v) + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), top[i])
            if (step := (new - alpha[i]) * sign[i]) != 0.0:
                w[x] += step * v
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a * margin + b))), fitted by Newton steps with a little damping."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - y) * margin).sum() + 1e-2 * a, (p - y).sum()])
        s = p * (1 - p) + 1e-6
        h = np.array([[(s * margin * margin).sum() + 1e-2, (s * margin).sum()], [(s * margin).sum(), s.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return float(a), float(b)


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # of a feature in a row of length one: class ratio times weight
    square: np.ndarray  # of the class ratio
    bias: float
    slope: float
    shift: float

    def margins(self, column: pa.Array) -> np.ndarray:
        out, scratch = np.zeros(len(column)), np.zeros(DIMS, bool)
        for lo, _, buf, off in text_chunks(column, lower=False):
            for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
                x = indicators(buf[a:b], scratch)
                out[lo + i] = self.weight[x].sum() / np.sqrt(max(self.square[x].sum(), 1e-12)) + self.bias
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(column) + self.shift, -30, 30)))


def _fit(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    ratio = log_count_ratios(rows, y)
    w, bias = dual_coordinate_descent(rows, ratio, y)
    return w * ratio, ratio * ratio, bias


def fit_model(rows: list[np.ndarray], y: np.ndarray) -> Model:
    """With labels of one kind only, all texts score as that kind; with none, one half."""
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(DIMS), np.zeros(DIMS), 0.0, 0.0, 0.0 if not len(y) else 30.0 * (2 * int(y[0]) - 1))
    margin, half = np.zeros(len(y)), np.arange(len(y)) % 2
    for part in (0, 1):
        inside, outside = np.flatnonzero(half != part), np.flatnonzero(half == part)
        weight, square, bias = _fit([rows[i] for i in inside], y[inside])
        margin[outside] = [weight[rows[i]].sum() / np.sqrt(max(square[rows[i]].sum(), 1e-12)) + bias for i in outside]
    return Model(*_fit(rows, y), *logistic_curve(margin, y))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scratch = np.zeros(DIMS, bool)
        for lo, hi, buf, off in text_chunks(batch.column("text"), lower=False):
            found = [indicators(buf[a:b], scratch).astype(np.uint32) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            part = batch.slice(lo, hi - lo)
            at = np.concatenate([[0], np.cumsum([len(x) for x in found])])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), ragged_binary(np.concatenate([*found, np.zeros(0, np.uint32)]), at)], names=["doc_id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fitted on about `sample` labelled documents, and SAMPLE_BYTES of text, of each class at most, in the order of a hash of their ids.

    The driver holds up to three places of four bytes for each byte of the sample.
    """
    with scratch(docs.sparkSession):
        return _train(docs, labels, text, doc_id, label, sample)


def _train(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, sample: int) -> Model:
    found = labelled_sample(docs, labels, text, doc_id, label, sample).select(F.col("doc_id").cast("string").alias("doc_id"), "y", "text").mapInArrow(_features, "doc_id string, y int, x binary").toArrow()
    ids, y = found["doc_id"].to_pylist(), np.asarray(found["y"].combine_chunks().to_numpy(zero_copy_only=False), int)
    order = sorted(range(len(ids)), key=lambda i: (hash_of(ids[i]), ids[i]))
    # one flat array of places, of which the rows are views
    flat = found["x"].cast(pa.large_binary()).combine_chunks()
    off = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1] // 4 if len(flat) else np.zeros(1, np.int64)
    places = np.frombuffer(flat.buffers()[2], np.uint32) if len(flat) and flat.buffers()[2] is not None else np.zeros(0, np.uint32)
    return fit_model([places[off[i] : off[i + 1]] for i in order], y[order])


def hash_of(value: str) -> int:
    import zlib

    return zlib.crc32(value.encode() + b"order")


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows and columns of docs with score (0 to 1, higher: label 1 likelier) and predicted (1 from THRESHOLD on).

    Null and empty texts have no n-gram and get the score of the bias. Texts are read in whole, however long. Repeated
    rows score alike. An empty table gives an empty result. The two columns replace input columns with their names.
    """

    def run(column: pa.Array) -> list[pa.Array]:
        s = model.scores(column)
        return [pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))]

    return with_columns(docs, text, {"score": "double", "predicted": "int"}, run)
