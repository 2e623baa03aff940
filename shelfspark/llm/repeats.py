"""Repeated passages: winnowed anchors joined over all documents, extended both ways, kept as maximal stretches.

A window is `window` consecutive words of one document; it is repeated if the same words start anywhere else, too. Its anchor is
its k-gram with the least hash (the leftmost of equal ones), so equal windows have equal anchors at equal places, and the windows
that share one anchor follow each other: an anchor owns a stretch of at most window - k + 1 window starts.

1. Seed. Each anchor is one row: its k-gram, its text and stretch, and a hash of all words of its stretch (its kind). Anchors whose
   k-gram occurs once in the corpus can't be repeated and go.
2. Extend. Anchors of one kind agree in all words to both sides, so a kind that occurs twice is repeated as a whole; copies of a text
   or passage are settled here, one row an anchor. Where a k-gram occurs in several kinds, a passage may begin or end in them: each
   kind is looked up in one text that has it. A window that two kinds share reaches at least half of its other words to the left or to the right
   of the anchor, so kinds that share neither half with another are done; the windows of all others are compared one by one.
3. Repeated windows of a text are merged into maximal stretches, and its rows take them by two 64-bit hashes of the text.

Groups are only counted and joined, never paired: rows grow with the words, however often a passage occurs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from shelfspark.llm.common import hide, materialise, restore, scratch
from shelfspark.llm.decontaminate import Gate, _bitmap
from shelfspark.llm.textbytes import NOT_BLANK, U, hash_words, mix, text_chunks, words

WINDOW = 35
K = 8
#: Tables up to this size are broadcast to the texts, larger ones are joined by a shuffle.
BROADCAST_BYTES = 8 << 20
#: Bits of a bitmap for each place that is looked up, and the most it has (16 MB); more places are joined with the texts.
BITS_A_PLACE, MOST_BITS = 8, 1 << 27
_STEP, _OTHER = U(0x9E3779B97F4A7C15), U(0x6A09E667F3BCC909)

ANCHOR_SCHEMA = "t1 long, t2 long, at int, n int, h long, kind long"
LOOK_SCHEMA = "h long, kind long, sides array<long>, w1 array<long>, w2 array<long>"
SPAN_SCHEMA = "t1 long, t2 long, spans array<struct<at:int,len:int>>"


def span_hash(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` words from each place on, built from stretches of doubled length."""
    have, out = 1, mix(h + U(size))
    while have < size:
        step = min(have, size - have)
        out = mix(out[: len(out) - step] * _STEP + out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def least_places(x: np.ndarray, w: int) -> np.ndarray:
    """For each place the leftmost of the least of the w values from there on."""
    have, at = 1, np.arange(len(x))
    while have < w:
        step = min(have, w - have)
        if len(at) <= step:
            return at[:0]
        left, right = at[: len(at) - step], at[step:]
        at = np.where(x[right] < x[left], right, left)
        have += step
    return at


def window_starts(first: np.ndarray, window: int) -> np.ndarray:
    """All places where a window starts; first has where the words of each text begin, and their number."""
    size = np.diff(first)
    end = np.repeat(first[1:], size)
    at = np.arange(len(end))
    return at[at + window <= end]


@dataclass(frozen=True)
class Stretches:
    """The anchors of some texts and the stretches of window starts that they own."""

    h: np.ndarray  # hashes of words
    row: np.ndarray  # text of each stretch
    first: np.ndarray  # first window start
    last: np.ndarray
    anchor: np.ndarray
    at: np.ndarray  # first start within the text
    gram: np.ndarray  # hash of the anchor
    kind: np.ndarray  # hash of all words of the stretch, and of the anchor's place

    @staticmethod
    def of(buf: np.ndarray, off: np.ndarray, window: int, k: int) -> Stretches | None:
        s, ln, first = words(buf, off, NOT_BLANK)
        starts = window_starts(first, window)
        if not len(starts):
            return None
        h = hash_words(buf, s, ln)
        gram, whole = span_hash(h, k), span_hash(h, window)
        anchor = least_places(gram, window - k + 1)[starts]
        begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        a, b, p = starts[begin], starts[np.append(begin[1:], len(starts)) - 1], anchor[begin]
        # fewer starts than words in a window: the first and last window hold all words of the stretch
        kind = mix(mix(whole[a] * _STEP + whole[b]) + (b - a).astype(U) * _OTHER + (p - a).astype(U))
        row = np.searchsorted(first, a, "right") - 1
        return Stretches(h, row, a, b, p, a - first[row], gram[p], kind)


def _anchors(window: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = np.asarray(batch.column("t1")), np.asarray(batch.column("t2"))
            for lo, _, buf, off in text_chunks(batch.column("text"), lower=False):
                if (x := Stretches.of(buf, off, window, k)) is not None:
                    out = [t1[lo + x.row], t2[lo + x.row], x.at.astype(np.int32), (x.last - x.first + 1).astype(np.int32), x.gram.view(np.int64), x.kind.view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in out], names=["t1", "t2", "at", "n", "h", "kind"])

    return run


def place_key(t1: np.ndarray, t2: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of a text and a place in it."""
    return mix(t1.view(U) ^ mix(t2.view(U) * _STEP + at.astype(U)))


def _place_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = place_key(*(np.asarray(batch.column(c)) for c in ("t1", "t2", "at")))
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64))], names=["x"])


def _looked_up(window: int, k: int, bitmap: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts -> the kinds at the wanted places (those in the bitmap, or in the column ats), with hashes of both halves and of all windows.

    A place that is in the bitmap by chance brings a kind that others have looked up, too, or that nobody asked for; both change nothing.
    """
    half = -(-(window - k) // 2)

    def lists(values: np.ndarray, n: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values.view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = np.asarray(batch.column("t1")), np.asarray(batch.column("t2"))
            for lo, hi, buf, off in text_chunks(batch.column("text"), lower=False):
                if (x := Stretches.of(buf, off, window, k)) is None:
                    continue
                if bitmap is not None:
                    found = np.flatnonzero(Gate._may(bitmap, place_key(t1[lo + x.row], t2[lo + x.row], x.at)))
                else:
                    ats = batch.column("ats").slice(lo, hi - lo)
                    rows = np.repeat(np.arange(hi - lo), np.asarray(ats.value_lengths()))
                    found = np.flatnonzero(np.isin(x.row * (1 << 32) + x.at, rows * (1 << 32) + np.asarray(ats.flatten(), np.int64)))
                if not len(found):
                    continue
                a, b, p = x.first[found], x.last[found], x.anchor[found]
                side = span_hash(x.h, half) if half else np.zeros(len(x.h) + 1, U)
                left, right = p - a >= half, b + window - p - k >= half
                both = np.stack([np.where(left, side[np.maximum(p - half, 0)], U(0)), np.where(right, mix(side[np.minimum(p + k, len(side) - 1)] ^ _OTHER), U(0))], 1)
                there = np.stack([left, right], 1)
                n = b - a + 1
                at = np.repeat(a, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                w1, w2 = span_hash(x.h, window)[at], span_hash(mix(x.h ^ _OTHER), window)[at]
                out = [pa.array(x.gram[found].view(np.int64)), pa.array(x.kind[found].view(np.int64)), lists(both[there], there.sum(1)), lists(w1, n), lists(w2, n)]
                yield pa.RecordBatch.from_arrays(out, names=["h", "kind", "sides", "w1", "w2"])

    return run


def _stretches(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(t1, t2, parts of (at, n, offs)) -> maximal stretches of words that repeated windows cover; without offs all windows are repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("at", pa.int32()), ("len", pa.int32())]))
        for batch in batches:
            out = []
            for parts in batch.column("parts").to_pylist():
                starts = np.unique(np.concatenate([np.arange(p["at"], p["at"] + p["n"]) if p["offs"] is None else p["at"] + np.array(p["offs"]) for p in parts]))
                begin = np.flatnonzero(np.concatenate([[True], starts[1:] > starts[:-1] + window]))
                last = starts[np.append(begin[1:], len(starts)) - 1]
                out.append([{"at": int(a), "len": int(b) + window - int(a)} for a, b in zip(starts[begin], last, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("t1"), batch.column("t2"), pa.array(out, kind)], names=["t1", "t2", "spans"])

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to rows with __text and __spans the number of words, of removed words, and the kept words with one blank between."""
    for batch in batches:
        listed = batch.column("__spans")
        span_row = np.repeat(np.arange(len(listed)), np.asarray(listed.value_lengths().fill_null(0)))
        flat = listed.flatten()
        span_at, span_len = np.asarray(flat.field("at"), np.int64), np.asarray(flat.field("len"), np.int64)
        for lo, hi, buf, off in text_chunks(batch.column("__text"), lower=False):
            s, ln, first = words(buf, off, NOT_BLANK)
            a, b = np.searchsorted(span_row, [lo, hi])
            change = np.zeros(len(s) + 1, np.int64)
            begin = first[span_row[a:b] - lo] + span_at[a:b]
            np.add.at(change, begin, 1)
            np.add.at(change, begin + span_len[a:b], -1)
            keep = np.cumsum(change[:-1]) == 0
            upto = np.concatenate([[0], np.cumsum(keep)])[first]  # kept words before each row
            s, ln = s[keep], ln[keep]
            lead = np.ones(len(s), np.int64)
            lead[upto[:-1][np.diff(upto) > 0]] = 0
            ends = np.cumsum(ln + lead)
            text = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
            inside = np.arange(int(ln.sum())) - np.repeat(np.cumsum(ln) - ln, ln)
            text[np.repeat(ends - ln, ln) + inside] = buf[np.repeat(s, ln) + inside]
            cut = np.concatenate([[0], ends])[upto]
            kept = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(text)).cast(pa.string())
            n = np.diff(first)
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n), pa.array(n - np.diff(upto)), kept], names=[*part.schema.names, "__n", "__removed", "__kept"])


def _text_id(text: str) -> list:
    """Two 64-bit hashes that stand for a text; null is the empty text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(29), whole).alias("t2")]


def _small(rows: DataFrame, size) -> DataFrame:
    """rows to be broadcast if they have BROADCAST_BYTES at most, by the column expression of a row's size."""
    held = rows.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(rows) if held <= BROADCAST_BYTES else rows


def repeated_spans(texts: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """texts(text) -> (t1, t2, spans) of each distinct text that has a repeated window; rows with equal texts repeat each other."""
    known = texts.select(*_text_id("text"), "text")
    with scratch(texts.sparkSession):
        anchors = materialise(known.mapInArrow(_anchors(window, k), ANCHOR_SCHEMA), "anchors")
        # a k-gram's anchors: how many there are, and whether they are of several kinds
        seeds = anchors.groupBy("h").agg(F.count("*").alias("all"), (F.min("kind") != F.max("kind")).alias("mixed")).filter(F.col("all") > 1).select("h", "mixed")
        seeded = materialise(anchors.join(seeds, "h"), "seeded")
        kinds = seeded.groupBy("h", "kind").agg(F.count("*").alias("all"), F.max("mixed").alias("mixed"), F.min(F.struct("t1", "t2", "at", "n")).alias("of"))
        kinds = materialise(kinds, "kinds")
        open_ = kinds.filter("mixed").select("of.t1", "of.t2", "of.at")
        n_open = open_.count()
        if BITS_A_PLACE * n_open <= MOST_BITS:  # no text is shuffled
            bits = max(1 << 16, 1 << (BITS_A_PLACE * n_open - 1).bit_length())
            look = known.mapInArrow(_looked_up(window, k, _bitmap(open_.mapInArrow(_place_keys, "x long"), bits)), LOOK_SCHEMA)
        else:
            ats = open_.groupBy("t1", "t2").agg(F.collect_list("at").alias("ats"))  # as many as a text has anchors
            look = known.join(ats, ["t1", "t2"]).mapInArrow(_looked_up(window, k, None), LOOK_SCHEMA)
        look = materialise(look, "looked-up")
        halves = look.select("h", "kind", F.explode("sides").alias("side"))
        shared = halves.groupBy("h", "side").agg((F.min("kind") != F.max("kind")).alias("again")).filter("again").select("h", "side")
        alive = materialise(halves.join(shared, ["h", "side"]).select("h", "kind").distinct(), "alive")
        pairs = look.join(_small(alive, F.lit(16)), ["h", "kind"]).select("h", "kind", F.posexplode(F.arrays_zip("w1", "w2")).alias("off", "w"))
        windows = materialise(pairs.select("h", "kind", "off", "w.w1", "w.w2"), "windows")
        again = windows.groupBy("w1", "w2").agg((F.min("kind") != F.max("kind")).alias("again")).filter("again").select("w1", "w2")
        parts = windows.join(again, ["w1", "w2"]).groupBy("h", "kind").agg(F.array_sort(F.collect_set("off")).alias("offs"))  # up to window - k + 1
        whole = kinds.filter(F.col("all") > 1).select("h", "kind", F.lit(None).cast("array<int>").alias("offs"))
        found = seeded.select("t1", "t2", "at", "n", "h", "kind").join(whole.union(parts), ["h", "kind"])
        found = found.groupBy("t1", "t2").agg(F.collect_set(F.struct("at", "n", "offs")).alias("parts"))  # as many as a text has anchors
        return materialise(found.mapInArrow(_stretches(window), SPAN_SCHEMA), "spans", keep=True)


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """The rows and columns of docs with n_words, n_removed, spans and kept.

    Words are runs of characters other than ASCII blanks, unchanged. spans are the maximal stretches (first word, number of words) that
    repeated windows cover, overlapping and adjoining ones merged; their words are removed, and kept has the others with one blank between. Windows
    are judged on docs as it is given: of equal passages none stays.

    Null and empty texts have no words; texts of fewer than `window` words have no window and stay. Equal texts of `window` words or
    more lose all words, whatever their ids; so do repeated rows. A text that repeats itself (also with overlap) loses those
    words. Texts are read in whole, however long. An empty table gives an empty result. Windows are equal when two 64-bit hashes of
    their words agree. Result columns replace input columns with their names.
    """
    if not 1 <= k <= window:
        raise ValueError("an anchor has 1 to `window` words")
    given, names = hide(docs)
    body = names[text]
    spans = repeated_spans(given.select(F.col(body).alias("text")), window, k)
    rows = given.select(*(n for n in names.values() if n != body), F.col(body).alias("__text"), *_text_id(body))
    rows = rows.join(_small(spans, 24 + 8 * F.size("spans")), ["t1", "t2"], "left").drop("t1", "t2").withColumnRenamed("spans", "__spans")
    kinds = [*rows.schema.fields, StructField("__n", LongType()), StructField("__removed", LongType()), StructField("__kept", StringType())]
    done = rows.mapInArrow(_kept, StructType(kinds))
    none = F.array().cast(ArrayType(StructType([StructField("at", IntegerType()), StructField("len", IntegerType())])))
    out = done.withColumns({body: F.col("__text"), "n_words": F.col("__n"), "n_removed": F.col("__removed"), "spans": F.coalesce("__spans", none), "kept": F.col("__kept")})
    return restore(out, names, "n_words", "n_removed", "spans", "kept")
