"""Benchmark decontamination by winnowing: minimum k-gram hashes per window, a join of fingerprints, extension of hits.

A shared span of `window` words holds window - k + 1 consecutive k-grams on both sides, and both sides keep the k-gram
whose hash is the least of such a stretch, so every shared span shares a kept fingerprint. Items shorter than a window are
one window themselves; their fingerprint is the hash of all their words.

1. Items become a table of windows with their fingerprints. Two bitmaps of bounded size tell which fingerprints and
   which windows may be among them; nothing else of the benchmark goes through the driver.
2. Documents, in one pass and without a shuffle, keep the fingerprints that may be shared, extend each to the windows around
   it, and yield runs: stretches covered by windows that may be shared. Bits that agree by chance only cost rows.
3. Equal runs are one row from here on, so a passage that many documents share is looked up once. Windows of
   runs are joined with those of the benchmark on the fingerprint, and a hit stands where all words agree (by two 64-bit hashes). A window is
   one row there, with the set of items that have it: a prompt that many items share costs its windows and these items, not their product.
   A document's items are one array, as the result asks for it.
4. Hits go back to the documents with the run. Texts, not rows, are judged: copies share a verdict.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfspark.llm.common import column, materialise, scratch
from shelfspark.llm.textbytes import ALNUM, U, hash_words, kgrams, mix, text_chunks, words

K = 5
WINDOW = 13
#: Bits for each window of the benchmark, and the most that a bitmap has (16 MB); with more windows, more bits agree by chance.
BITS_A_WINDOW = 32
MOST_BITS = 1 << 27
#: Verdicts up to this size are broadcast, larger ones are joined by a shuffle.
BROADCAST_BYTES = 8 << 20
CHECK = U(0x6A09E667F3BCC909)


def _sliding(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over each w neighbours; the result is w - 1 shorter."""
    have, out = 1, x
    while have < w:
        step = min(have, w - have)
        out = f(out[: len(out) - step], out[step:])
        have += step
    return out


def fingerprints(grams: np.ndarray, w: int) -> np.ndarray:
    """The positions of all k-grams that are the least of some w consecutive ones (all of equal ones)."""
    if len(grams) < w:
        return np.zeros(0, np.int64)
    least = _sliding(grams, w, np.minimum)
    padded = np.concatenate([np.zeros(w - 1, U), least, np.zeros(w - 1, U)])
    return np.flatnonzero(grams == _sliding(padded, w, np.maximum))


def _bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """A bit for the low bits of each value(x); Spark builds it in pieces of 4 KB."""
    place = F.col("x").bitwiseAND(F.lit(bits - 1)) + 1
    pieces = values.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in pieces.toLocalIterator():
        out[(r["piece"] - 1) * 4096 : r["piece"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


@dataclass(frozen=True)
class Gate:
    """Which fingerprints and windows may be among those of the items, and how many words their windows have."""

    k: int
    window: int
    sizes: tuple[int, ...]
    marks: np.ndarray
    keys: np.ndarray

    @staticmethod
    def _may(bitmap: np.ndarray, x: np.ndarray) -> np.ndarray:
        at = x & U(8 * len(bitmap) - 1)
        return (bitmap[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & np.uint8(1) == 1

    def spans(self, h: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and number of words of all windows that may be shared; end has where the text of each word ends."""
        found = []
        for size in self.sizes:
            if size == self.window:
                grams = kgrams(h, self.k)
                around = self.window - self.k + 1
                marks = fingerprints(grams, around)
                marks = marks[self._may(self.marks, grams[marks])]
                starts = np.unique(marks[:, None] - np.arange(around)[None, :])
            else:
                starts = np.arange(len(h))
            starts = starts[(starts >= 0) & (starts + size <= len(h))]
            starts = starts[starts + size <= end[starts]]
            starts = starts[self._may(self.keys, _span_hash(h, starts, size))]
            found.append((starts, np.full(len(starts), size)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, size = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((size, at))
        return at[order], size[order]


def _span_hash(h: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """What kgrams(h, size) has at the starts."""
    g = mix(h[starts] + U(size))
    for j in range(1, size):
        g = mix(g * U(0x9E3779B97F4A7C15) + h[starts + j])
    return g


WINDOW_SCHEMA = "t1 long, t2 long, at int, size int, mark long, key long, check long"


def _windows(k: int, window: int, gate: Gate | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(t1, t2, text) -> the windows of each text: all of an item's, or those of a run that pass the gate."""

    def spans(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        end = np.repeat(first[1:], np.diff(first))
        if gate is not None:
            return gate.spans(h, end)
        size = np.minimum(np.repeat(np.diff(first), np.diff(first)), window)
        at = np.arange(len(h))
        at = at[at + size <= end]
        return at, size[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = np.asarray(batch.column("t1")), np.asarray(batch.column("t2"))
            for lo, _, buf, off in text_chunks(batch.column("text")):
                s, ln, first = words(buf, off, ALNUM)
                h = hash_words(buf, s, ln)
                at, size = spans(h, first)
                mark, key, check = (np.zeros(len(at), U) for _ in range(3))
                for n in np.unique(size).tolist():
                    here = np.flatnonzero(size == n)
                    key[here] = _span_hash(h, at[here], n)
                    check[here] = _span_hash(mix(h ^ CHECK), at[here], n)
                    mark[here] = _sliding(kgrams(h, k), window - k + 1, np.minimum)[at[here]] if n == window else key[here]
                row = np.searchsorted(first, at, "right") - 1
                out = [t1[lo + row], t2[lo + row], (at - first[row]).astype(np.int32), size.astype(np.int32), *(x.view(np.int64) for x in (mark, key, check))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["t1", "t2", "at", "size", "mark", "key", "check"])

    return run


RUN_SCHEMA = "h1 long, h2 long, run string, ats array<int>"


def _runs(gate: Gate) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(h1, h2, text) -> each text's distinct runs (their words, one blank between) and the words where they begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = batch.column("h1"), batch.column("h2")
            for lo, _, buf, off in text_chunks(batch.column("text")):
                s, ln, first = words(buf, off, ALNUM)
                if not len(s):
                    continue
                at, size = gate.spans(hash_words(buf, s, ln), np.repeat(first[1:], np.diff(first)))
                if not len(at):
                    continue
                # windows that overlap are one run; windows of two texts never do
                upto = np.maximum.accumulate(at + size)
                begin = np.flatnonzero(np.concatenate([[True], at[1:] >= upto[:-1]]))
                ends = upto[np.append(begin[1:] - 1, len(at) - 1)]
                found: dict[tuple[int, bytes], list[int]] = {}
                for a, b in zip(at[begin].tolist(), ends.tolist(), strict=True):
                    row = int(np.searchsorted(first, a, "right")) - 1
                    text = b" ".join(buf[s[x] : s[x] + ln[x]].tobytes() for x in range(a, b))
                    found.setdefault((row, text), []).append(a - int(first[row]))
                rows = pa.array([lo + row for row, _ in found])
                texts = pa.array([text.decode() for _, text in found], pa.string())
                yield pa.RecordBatch.from_arrays([h1.take(rows), h2.take(rows), texts, pa.array(list(found.values()), pa.list_(pa.int32()))], names=["h1", "h2", "run", "ats"])

    return run


VERDICT_SCHEMA = "h1 long, h2 long, n_hit long, items array<string>, spans array<struct<at:int,len:int>>"


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for at, size in sorted(spans):
        if out and at <= out[-1]["at"] + out[-1]["len"]:
            out[-1]["len"] = max(out[-1]["len"], at + size - out[-1]["at"])
        else:
            out.append({"at": at, "len": size})
    return out


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, parts, names) -> the merged spans and the items of each text; parts are the hits of its runs, and where these begin."""
    kind = pa.list_(pa.struct([("at", pa.int32()), ("len", pa.int32())]))
    for batch in batches:
        spans, items = [], []
        for parts, names in zip(batch.column("parts").to_pylist(), batch.column("names").to_pylist(), strict=True):
            spans.append(_merged([(a + x["at"], x["size"]) for p in parts for a in p["ats"] for x in p["hits"]]))
            items.append(sorted({i for some in names for i in some}))
        n_hit = pa.array([sum(x["len"] for x in some) for some in spans], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), n_hit, pa.array(items, pa.list_(pa.string())), pa.array(spans, kind)], names=["h1", "h2", "n_hit", "items", "spans"])


def _with_n_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = np.zeros(len(batch), np.int64)
        for lo, hi, buf, off in text_chunks(batch.column("__text")):
            n[lo:hi] = np.diff(words(buf, off, ALNUM)[2])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n)], names=[*batch.schema.names, "__n"])


def _text_id(text: str, *names: str) -> list:
    """Two 64-bit hashes that stand for a text; null is the empty text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(*salt, whole).alias(n) for n, salt in zip(names, ([], [F.lit(17)]), strict=True)]


def _judged(texts: DataFrame, benchmark: DataFrame, k: int, window: int) -> DataFrame:
    """texts(text), benchmark(item, text) -> (h1, h2, n_hit, items, spans) for each text that has a hit."""
    items = benchmark.filter("text IS NOT NULL").select(*_text_id("text", "t1", "t2"), "item", "text")
    with scratch(texts.sparkSession):
        windows = items.groupBy("t1", "t2").agg(F.first("text").alias("text")).mapInArrow(_windows(k, window), WINDOW_SCHEMA)
        # one row for each window of the benchmark, with the set of texts that have it; windows of a shared prompt have one set in common
        windows = windows.groupBy("mark", "key", "check", "size").agg(F.array_sort(F.collect_set(F.struct("t1", "t2"))).alias("texts"))
        windows = materialise(windows.withColumns({"s1": F.xxhash64("texts"), "s2": F.xxhash64(F.lit(17), "texts")}), "windows")
        n, sizes = windows.agg(F.count("*"), F.collect_set("size")).first()  # up to `window` sizes
        bits = min(MOST_BITS, max(1 << 16, 1 << (BITS_A_WINDOW * n).bit_length()))
        gate = Gate(k, window, tuple(sorted(sizes)), *(_bitmap(windows.select(F.col(c).alias("x")), bits) for c in ("mark", "key")))
        runs = texts.select(*_text_id("text", "h1", "h2"), "text").mapInArrow(_runs(gate), RUN_SCHEMA)
        runs = materialise(runs.select("*", *_text_id("run", "t1", "t2")).dropDuplicates(["h1", "h2", "t1", "t2"]), "runs")
        look = runs.groupBy("t1", "t2").agg(F.first("run").alias("text")).mapInArrow(_windows(k, window, gate), WINDOW_SCHEMA)
        hits = look.join(windows.drop("texts"), ["mark", "key", "check", "size"])
        hits = materialise(hits.select("t1", "t2", "at", "size", "s1", "s2"), "hits")
        spans = hits.groupBy("t1", "t2").agg(F.collect_set(F.struct("at", "size")).alias("hits"))
        # items are attached last, once for each set that was hit
        sets = windows.join(hits.select("s1", "s2").distinct(), ["s1", "s2"], "left_semi").groupBy("s1", "s2").agg(F.first("texts").alias("texts"))
        listed = items.filter("item IS NOT NULL").select("t1", "t2", "item").distinct()
        named = sets.select("s1", "s2", F.explode("texts").alias("t")).select("s1", "s2", "t.*").join(listed, ["t1", "t2"]).groupBy("s1", "s2").agg(F.collect_set("item").alias("names"))
        named = hits.select("t1", "t2", "s1", "s2").distinct().join(named, ["s1", "s2"]).groupBy("t1", "t2").agg(F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"))
        known = spans.join(named, ["t1", "t2"], "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))
        parts = runs.select("h1", "h2", "t1", "t2", "ats").join(known, ["t1", "t2"]).groupBy("h1", "h2")
        parts = parts.agg(F.collect_list(F.struct("ats", "hits")).alias("parts"), F.collect_list("names").alias("names"))
        return materialise(parts.mapInArrow(_verdicts, VERDICT_SCHEMA), "verdicts", keep=True)


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """The rows and columns of docs with n_words, n_hit, items, spans and contaminated.

    Words are runs of ASCII digits, ASCII letters (lower-cased) and non-ASCII characters. A window is `window`
    consecutive words of an item, or the whole of an item with fewer. A document word is hit inside any occurrence of a window;
    spans are the merged stretches of hit words, items the sorted item ids (as strings) with an occurring window. A document
    is contaminated if a twentieth of its words or more are hit.

    Null and empty texts have no words and are clean; null and wordless items have no window. Windows of items with a null id hit
    words but are not listed. Repeated rows are judged alike; items that share windows are all listed. Texts are read in
    whole, however long. An empty benchmark leaves all clean, an empty table gives an empty result. Result columns replace input
    columns with their names.
    """
    names = {c: f"__in{i}" for i, c in enumerate(docs.columns)}
    items = benchmark.select(column(item_id).cast("string").alias("item"), column(item_text).alias("text"))
    verdicts = _judged(docs.select(column(text).alias("text")), items, k, window)
    held = verdicts.agg(F.sum(40 + 8 * F.size("spans") + F.octet_length(F.array_join("items", ",")))).first()[0] or 0
    rows = docs.select(*(column(c).alias(n) for c, n in names.items() if c != text), column(text).alias("__text"))
    rows = rows.mapInArrow(_with_n_words, StructType([*rows.schema.fields, StructField("__n", LongType())])).select("*", *_text_id("__text", "h1", "h2"))
    rows = rows.join(F.broadcast(verdicts) if held <= BROADCAST_BYTES else verdicts, ["h1", "h2"], "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    results = {
        "n_words": F.col("__n"), "n_hit": hit, "items": F.coalesce("items", F.array().cast("array<string>")),
        "spans": F.coalesce("spans", F.array().cast("array<struct<at:int,len:int>>")), "contaminated": (hit > 0) & (20 * hit >= F.col("__n")),
    }
    return rows.select(*((F.col("__text") if c == text else F.col(n)).alias(c) for c, n in names.items() if c not in results), *(x.alias(c) for c, x in results.items()))
