"""Vector codes: product quantisation in integers, with nearest entries searched by LAESA pivots.

Vectors become integers and are cut into equal consecutive parts; each part position has a codebook, which starts as that
part of the vectors with the smallest ids. The distances of every part to a few fixed pivots are computed once and kept with the
parts. In each round the distances of the entries to the same pivots give, by the triangle inequality, a lower bound
|d(part, pivot) - d(entry, pivot)| for each part and entry: entries are tried in the order of their bounds with exact integer
distances, and a part stops at the first entry whose bound exceeds its best distance. So every assignment is exact.

Rounds are jobs over one stored table of parts. A task adds up its parts by entry before anything is shuffled, and the driver holds
nothing but the codebooks (parts x entries x length of a part).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from shelfspark.llm.common import hide, materialise, restore, scratch
from shelfspark.llm.textbytes import binary_column, matrix

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
PIVOTS = 16
#: Parts that are looked at together, which bounds a task's memory.
ROWS_AT_ONCE = 4096
#: Label sums up to so many rows are broadcast; more are joined, each label dealt out SALTS ways.
BROADCAST_ROWS = 100_000
SALTS = 16
#: Bounds are computed in floating point; they are lowered by this share, far more than rounding can add.
SLACK = 1e-9


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """Components as integers floor(scale * x), all rounded down; null where the vector is null or holds a null or non-finite one."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & ~bad, F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long")))


def distances(parts: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances of parts (n x d) to a few points (p x d)."""
    out = np.empty((len(parts), len(points)))
    for k, point in enumerate(points):
        out[:, k] = np.sqrt(((parts - point) ** 2).sum(1, dtype=np.int64))
    return out


def far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the points, each the farthest from those before it (the first one starts), without repeats."""
    chosen = [0]
    near = ((points - points[0]) ** 2).sum(1, dtype=np.int64)
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[chosen[-1]]) ** 2).sum(1, dtype=np.int64))
    return points[chosen]


def nearest(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each part (ties to the lower index), its squared distance, and how many distances were evaluated."""
    bound = np.zeros((len(parts), len(entries)))
    for p in range(to_pivots.shape[1]):
        a, b = to_pivots[:, p, None], entry_pivots[None, :, p]
        np.maximum(bound, np.abs(a - b) - SLACK * (a + b), out=bound)
    bound *= bound
    order = np.argsort(bound, axis=1, kind="stable").astype(np.int32)
    best, at = np.full(len(parts), np.iinfo(np.int64).max), np.full(len(parts), len(entries))
    active, tried = np.arange(len(parts)), 0
    for k in range(len(entries)):
        entry = order[active, k]
        open_ = bound[active, entry] * (1 - SLACK) <= best[active]
        active, entry = active[open_], entry[open_]
        if not active.size:
            break
        tried += len(active)
        apart = parts[active] - entries[entry]
        d = np.einsum("ij,ij->i", apart, apart)  # exact in the parts' own type, see Books.kind
        better = (d < best[active]) | ((d == best[active]) & (entry < at[active]))
        best[active[better]], at[active[better]] = d[better], entry[better]
    return at, best, tried


@dataclass(frozen=True)
class Books:
    """A codebook and its pivots for each part position."""

    entries: np.ndarray  # part x entry x component
    pivots: tuple[np.ndarray, ...]  # of each part: pivot x component
    kind: type = np.int64  # 32 bits where all squared distances fit them

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()

    def assign(self, parts: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """parts (n x part x component) and their distances to all pivots, one after the other -> entry and squared distance, n x part."""
        at, d, first = np.empty(parts.shape[:2], np.int64), np.empty(parts.shape[:2], np.int64), 0
        for k, pivots in enumerate(self.pivots):
            known = to_pivots[:, first : first + len(pivots)]
            first += len(pivots)
            at[:, k], d[:, k], _ = nearest(np.ascontiguousarray(parts[:, k]), known, self.entries[k].astype(self.kind), distances(self.entries[k], pivots))
        return at, d


def _stored(width: int, books: Books) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to rows with ints (array of long) the padded parts and their distances to the pivots, as binaries."""
    n_parts, _, size = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(lo, ROWS_AT_ONCE)
                ints = batch.column("__ints")
                off = np.frombuffer(ints.buffers()[1], np.int32)[ints.offset : ints.offset + len(ints) + 1]
                values = np.asarray(ints.values, np.int64)[off[0] : off[-1]] if width else np.zeros(0, np.int64)
                lens = np.diff(off)
                parts = np.zeros((len(batch), n_parts * size), np.int32)
                parts[np.repeat(np.arange(len(batch)), lens), np.arange(len(values)) - np.repeat(off[:-1] - off[0], lens)] = values
                cut = parts.reshape(len(batch), n_parts, size).astype(np.int64)
                known = np.concatenate([distances(cut[:, k], p) for k, p in enumerate(books.pivots)], 1)
                kept = [batch.column(c) for c in batch.schema.names if c != "__ints"]
                names = [c for c in batch.schema.names if c != "__ints"]
                yield pa.RecordBatch.from_arrays([*kept, binary_column(parts.view(np.uint8).reshape(len(batch), -1)), binary_column(known.view(np.uint8).reshape(len(batch), -1))], names=[*names, "__parts", "__known"])

    return run


def _cut(batch: pa.RecordBatch, books: Books) -> tuple[np.ndarray, np.ndarray]:
    n_parts, _, size = books.entries.shape
    n_pivots = sum(map(len, books.pivots))
    parts = matrix(batch.column("__parts"), 4 * n_parts * size, np.int32).reshape(len(batch), n_parts, size)
    return parts.astype(books.kind), matrix(batch.column("__known"), 8 * n_pivots, np.float64)


SUMS = "part int, entry int, n long, sums array<long>"


def _added_up(books: Books) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Number and component sums of a task's parts by (part, entry)."""
    n_parts, n_entries, size = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((n_parts, n_entries), np.int64), np.zeros((n_parts, n_entries, size), np.int64)
        for whole in batches:
            for lo in range(0, len(whole), ROWS_AT_ONCE):
                parts, known = _cut(whole.slice(lo, ROWS_AT_ONCE), books)
                at, _ = books.assign(parts, known)
                for k in range(n_parts):
                    n[k] += np.bincount(at[:, k], minlength=n_entries)
                    np.add.at(sums[k], at[:, k], parts[:, k])
        part, entry = np.nonzero(n)
        lists = pa.ListArray.from_arrays(pa.array((np.arange(len(part) + 1) * size).astype(np.int32)), pa.array(sums[part, entry].reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), lists], names=["part", "entry", "n", "sums"])

    return run


def _moved(books: Books, parts: DataFrame) -> Books:
    """Each entry replaced by the component means, rounded down, of the parts nearest to it; unused entries stay."""
    found = parts.select("__parts", "__known").mapInArrow(_added_up(books), SUMS)
    # a row for each entry and component, added up in Spark: the driver receives as many numbers as the codebooks have
    cells = found.select("part", "entry", "n", F.posexplode("sums").alias("pos", "s")).groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow()
    entries = books.entries.copy()
    part, entry, pos, n, s = (np.asarray(cells[c]) for c in ("part", "entry", "pos", "n", "s"))
    entries[part, entry, pos] = np.floor_divide(s, n)
    return Books(entries, books.pivots, books.kind)


def _coded(books: Books) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(lo, ROWS_AT_ONCE)
                at, d = books.assign(*_cut(batch, books))
                code = pa.array([row.tobytes().hex() for row in at.astype(np.uint8)], pa.string())
                names = [c for c in batch.schema.names if c not in ("__parts", "__known")]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), code, pa.array(d.sum(1))], names=[*names, "code", "error"])

    return run


def _label_errors(coded: DataFrame, label: str) -> DataFrame:
    """coded with label_error, the sum of error over equal labels."""
    sums = materialise(coded.groupBy(F.col(label).alias("__label")).agg(F.sum("error").alias("label_error")), "label-errors", keep=True)
    if sums.count() <= BROADCAST_ROWS:
        return coded.join(F.broadcast(sums), F.col(label).eqNullSafe(F.col("__label")))
    salted = sums.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = coded.withColumn("__s", F.pmod(F.xxhash64("code", "error", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    return rows.join(salted, F.col(label).eqNullSafe(F.col("__label")) & (F.col("__s") == F.col("__salt")))


def compress_vectors(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    scale: int = SCALE, pivots: int = PIVOTS,
) -> DataFrame:
    """The rows and columns of vectors with code, error, label_error and codebooks_sha256.

    code has two hex digits for each part, in order; error is the squared integer distance between a vector and its coded form;
    label_error is its sum over equal labels (null is a label of its own); codebooks_sha256 is the digest of the codebooks'
    decimal components, joined by commas. The codebooks start from the vectors with the smallest ids and move so many rounds; up to 256 entries.

    Rows whose vector is null or holds a null or non-finite component are left out. Null ids come last when the first vectors are
    chosen, ties go by the components. Vectors shorter than the longest, or than a multiple of parts, count as padded with
    zeros; an empty vector is all zeros. Repeated rows are coded alike and all count. With fewer vectors than entries the
    codebooks are so small. Squared distances must fit 62 bits (components up to 300 million at 64 components); larger ones raise a
    ValueError. An empty table gives an empty result. Result columns replace input columns with their names.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    results = ("code", "error", "label_error", "codebooks_sha256")
    given, names = hide(vectors)
    ident = names[vec_id]
    rows = given.withColumn("__ints", scaled(F.col(names[vector]), scale)).filter("__ints IS NOT NULL")
    shape = rows.agg(F.max(F.size("__ints")), F.max(F.array_max(F.transform("__ints", lambda v: F.abs(v))))).first()
    width, largest = shape[0] or 0, shape[1] or 0
    size = -(-width // parts)
    if 4 * largest * largest * max(1, parts * size) >= 1 << 62 or largest >= 1 << 31:
        raise ValueError("components are too large for exact 64-bit distances")
    first = rows.orderBy(F.col(ident).asc_nulls_last(), "__ints").limit(entries).select("__ints").collect()  # up to 256 vectors
    start = np.zeros((max(1, len(first)), parts * size), np.int64)
    for i, r in enumerate(first):
        start[i, : len(r[0])] = r[0]
    book = np.ascontiguousarray(start.reshape(len(start), parts, size).transpose(1, 0, 2))
    books = Books(book, tuple(far_apart(b, pivots) for b in book), np.int32 if 4 * largest * largest * max(1, size) < 1 << 31 else np.int64)
    kept = given.schema.fields
    schema = StructType([*kept, StructField("__parts", BinaryType()), StructField("__known", BinaryType())])
    with scratch(vectors.sparkSession):
        stored = materialise(rows.mapInArrow(_stored(width, books), schema), "parts")
        for _ in range(rounds):
            books = _moved(books, stored)
        coded = stored.mapInArrow(_coded(books), StructType([*kept, StructField("code", StringType()), StructField("error", LongType())]))
        coded = materialise(coded, "coded", keep=True)
    out = _label_errors(coded, names[label]).withColumn("codebooks_sha256", F.lit(books.sha256))
    return restore(out, names, *results)
