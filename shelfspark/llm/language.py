"""Language identification by error-correcting output codes.

Each language gets a codeword. For each bit, a binary classifier over byte 1-, 2- and 3-grams (case folded in A-Z)
tells the languages with that bit from the others: it averages log ratios of smoothed n-gram shares over the text. The bits are
decoded by loss weights: the language with the least sum of exponential losses, each bit weighed by how well it
separates its sides in fitting. Two nearly equal sums flag a text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.ngrams import DIMS, gram_ids, sampled, with_columns
from shelfspark.llm.textbytes import text_chunks

SAMPLE = 3000
AMBIGUOUS = 0.2
UNKNOWN = "und"


def codewords(n: int) -> np.ndarray:
    """n rows of -1 and 1: all ways to part up to five languages, else the random code with the largest least distance."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 5:
        ways = 2 ** (n - 1) - 1
        return np.array([[1.0 if (k >> i) & 1 else -1.0 for k in range(1, ways + 1)] for i in range(n - 1)] + [[-1.0] * ways])
    bits = int(np.ceil(10 * np.log2(n)))
    best, far = None, -1
    for seed in range(50):
        code = np.where(np.random.default_rng(seed).random((n, bits)) < 0.5, -1.0, 1.0)
        code = code[:, np.abs(code.sum(0)) < n]
        apart = (code.shape[1] - code @ code.T) / 2 + 1e9 * np.eye(n)
        if apart.min() > far:
            best, far = code, apart.min()
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit
    weight: np.ndarray  # n-gram x bit
    scale: np.ndarray  # of a bit's margins
    trust: np.ndarray  # of a bit, from its fitted separation

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its weight among all languages, and whether another is nearly as close."""
        m = np.clip(margins / self.scale, -4, 4)
        loss = np.stack([(self.trust * np.exp(-m * row)).sum(1) for row in self.code], 1) / self.trust.sum()
        w = np.exp(-(loss - loss.min(1, keepdims=True)))
        w = (w**4) / (w**4).sum(1, keepdims=True)
        best = w.argmax(1)
        top = np.sort(w, 1)
        return best, top[:, -1], (top[:, -1] - top[:, -2] < AMBIGUOUS) if w.shape[1] > 1 else np.zeros(len(w), bool)

    def margins(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        out = np.zeros((len(off) - 1, self.weight.shape[1]))
        for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
            if b - a:
                counts = np.bincount(gram_ids(buf[a:b]) if b - a > 2 else buf[a:b].astype(np.int64), minlength=DIMS)
                there = np.flatnonzero(counts)
                out[i] = counts[there].astype(np.float32) @ self.weight[there] / counts.sum()
        return out


def has_letter(text: str | None) -> bool:
    """A letter of any script; digits, other numerals and marks alone are none."""
    return bool(text) and any(map(str.isalpha, text))


def _counts(languages: list[str]):
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), DIMS), np.int64)
        for batch in batches:
            lang = batch.column("lang").to_pylist()
            for lo, _, buf, off in text_chunks(batch.column("text")):
                for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
                    if b - a > 2:
                        total[place[lang[lo + i]]] += np.bincount(gram_ids(buf[a:b]), minlength=DIMS)
        at, gram = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(gram.astype(np.int32)), pa.array(total[at, gram])], names=["at", "gram", "n"])

    return run


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Fitted on about `sample` documents of each language at most; rows with a null language are left out."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).filter("lang is not null")
    chosen = sampled(rows, F.col("doc_id"), "lang", sample).select("lang", "text")
    languages = sorted(r[0] for r in chosen.select("lang").distinct().collect())
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((DIMS, 1), np.float32), np.ones(1), np.ones(1))
    found = chosen.mapInArrow(_counts(languages), "at int, gram int, n long").groupBy("at", "gram").agg(F.sum("n").alias("n")).toArrow()  # at most DIMS rows for each language
    counts = np.full((len(languages), DIMS), 0.5)
    counts[np.asarray(found["at"]), np.asarray(found["gram"])] += np.asarray(found["n"])
    share = counts / counts.sum(1, keepdims=True)
    weight = np.stack([np.log(share[bit > 0].mean(0) / share[bit < 0].mean(0)) for bit in code.T], 1).astype(np.float32)
    expected = share @ weight  # the margin that each language's own n-grams give on average
    scale = np.maximum(np.abs(expected).mean(0), 1e-9)
    right = (np.sign(expected) == code).mean(0)
    return Model(languages, code, weight, scale, np.maximum(right - 0.5, 0.05))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows and columns of docs with lang_pred, score (0 to 1) and ambiguous.

    lang_pred is `und` with score 0 for a null or empty text, one without a letter of any script, and where no language was
    learned. Texts are read in whole, however long. Repeated rows are judged alike. Ties go to the first language
    by name and are flagged. An empty table gives an empty result. The columns replace input columns with their names.
    """

    def run(column: pa.Array) -> list[pa.Array]:
        n = len(column)
        best, score, flag = np.zeros(n, int), np.zeros(n), np.ones(n, bool)
        known = np.array([has_letter(x) for x in column.to_pylist()], bool) if model.languages else np.zeros(n, bool)
        for lo, hi, buf, off in text_chunks(column):
            if model.languages:
                best[lo:hi], score[lo:hi], flag[lo:hi] = model.decode(model.margins(buf, off))
        return [pa.array([model.languages[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist(), strict=True)], pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(np.where(known, flag, True))]

    return with_columns(docs, text, {"lang_pred": "string", "score": "double", "ambiguous": "boolean"}, run)
