"""Byte n-grams of whole texts, and bounded samples of documents for fitting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from shelfspark.llm.common import column, materialise

#: Where the n-grams of each order begin: single bytes have 2^8 places, pairs and hashed triples 2^16 each.
PAIRS, TRIPLES, DIMS = 256, 256 + 65536, 256 + 2 * 65536


def gram_ids(text: np.ndarray) -> np.ndarray:
    """The places of the 1-, 2- and 3-grams of one text's bytes, with repeats."""
    b = text.astype(np.uint32)
    two = (b[:-1] << np.uint32(8)) | b[1:]
    three = (((two[:-1] << np.uint32(8)) | b[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return np.concatenate([b, two + np.uint32(PAIRS), three + np.uint32(TRIPLES)])


def indicators(text: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """The distinct places of one text, ascending; scratch is an all-false array of DIMS that is left so."""
    ids = gram_ids(text) if len(text) > 2 else text.astype(np.uint32)
    scratch[ids] = True
    found = np.flatnonzero(scratch)
    scratch[found] = False
    return found


def sampled(rows: DataFrame, key: Column, stratum: str, bound: int) -> DataFrame:
    """About `bound` rows of each stratum at most, chosen by a hash of the key, so that reruns agree.

    The strata are classes or languages. Their counts are aggregated before they reach the driver; of more than MOST_STRATA
    the counts stay a table that is joined.
    """
    counts = rows.groupBy(stratum).agg(F.count("*").alias("__n"))
    known = {r[0]: r[1] for r in counts.limit(MOST_STRATA + 1).collect()}
    place = F.pmod(F.xxhash64(key, F.lit(71)), F.lit(PLACES))
    if len(known) > MOST_STRATA:
        shares = counts.select(stratum, (F.lit(float(PLACES)) * F.least(F.lit(1.0), F.lit(bound) / F.col("__n"))).cast("long").alias("__share"))
        return rows.join(shares, stratum).filter(place < F.col("__share")).select(*rows.columns)
    share = F.lit(0).cast("long")
    for value, n in known.items():
        share = F.when(F.col(stratum) == F.lit(value), F.lit(share_of(bound, n))).otherwise(share)
    return rows.filter(place < share)


MOST_STRATA = 512
#: Places of the hash: so many that a stratum of any size keeps a share.
PLACES = 1 << 62
#: Bytes of text of each label that a sample has at most.
SAMPLE_BYTES = 24 << 20


def share_of(bound: int, n: int) -> int:
    """How many of the PLACES keep about bound of n rows."""
    return PLACES * min(bound, n) // max(n, 1)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "utf-8")), F.lit(parts)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, bound: int, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(doc_id, text, y): about `bound` documents of each label at most; only their ids are joined, so texts aren't shuffled.

    The texts are stored, and of a label whose texts have more than most_bytes so many documents stay, chosen by another hash, that
    about most_bytes are left; texts are never cut.
    Contradicting labels of an id count as their mean, rounded; null ids and labels are left out.
    """
    known = labels.select(column(doc_id).alias("doc_id"), column(label).cast("double").alias("y")).dropna().groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    chosen = sampled(known, F.col("doc_id"), "y", bound)  # two strata of `bound` ids
    found = materialise(docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")).join(F.broadcast(chosen), "doc_id"), "sample")
    held = {r["y"]: r["b"] for r in found.groupBy("y").agg(F.sum(F.octet_length("text")).alias("b")).collect()}  # two rows
    share = F.lit(PLACES)
    for y, n in held.items():
        share = F.when(F.col("y") == y, F.lit(share_of(most_bytes, n or 0) if n and n > most_bytes else PLACES)).otherwise(share)
    return found.filter(F.pmod(F.xxhash64("doc_id", F.lit(72)), F.lit(PLACES)) < share)


def with_columns(docs: DataFrame, text: str, types: dict[str, str], score) -> DataFrame:
    """docs with columns that score(batches of texts) yields, in the order of rows; the columns replace such with their names."""
    names = {c: f"__in{i}" for i, c in enumerate(docs.columns)}
    body = names[text]
    rows = docs.select(*(column(c).alias(n) for c, n in names.items()))
    schema = StructType(list(rows.schema.fields))
    for c, t in types.items():
        schema = schema.add(f"__out_{c}", DataType.fromDDL(t))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = score(batch.column(body))
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, *(f"__out_{c}" for c in types)])

    done = rows.mapInArrow(run, schema)
    return done.select(*(F.col(n).alias(c) for c, n in names.items() if c not in types), *(F.col(f"__out_{c}").alias(c) for c in types))
