"""Exact duplicates by a content sort: sampled splitters, external sort, comparison with the neighbours.

Normalised texts are range-partitioned by Spark's sampled splitters over (first bytes, hash), sorted in each partition by
the whole text, and rows next to each other are compared in full. The splitter key is short, so that the samples that reach the
driver are small; equal texts have equal keys and so meet in one partition.

Texts so frequent that they would fill half a partition (there are at most two for each partition) carry a
salt in the splitter key. It comes from a row's place in its input partition, not from its id, so repeated and null ids
are dealt out, too. Each of their runs yields one row, and the runs of equal texts are compared once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import hide, materialise, restore, shuffle_partitions

SPLITTER_CHARS = 32


def lower_ascii(c):
    """Lower-case in A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_salt(n: int):
    """One of n salts for each row, by its place in its partition."""
    return F.pmod(F.monotonically_increasing_id(), F.lit(n))


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest") -> DataFrame:
    """The columns of docs but the text, with keep_id, group_size, kept and text_sha256, for each row.

    Texts are equal when they are identical after lower-casing A-Z. Of each group the row with the `smallest` or `largest`
    id stays. A null text is an empty one. Null ids come after all others; the keep_id of a group with null ids only is null.
    Of rows with the same text and id one stays (of rows with null ids in a group without others, too). Very long texts are compared
    in whole. An empty table gives an empty result. Result columns replace input columns with their names. docs should come from
    storage, whose partitions have one order of rows each time they are read, as a row's place in its partition is its salt.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    given, names = hide(docs)
    names = {c: n for c, n in names.items() if c != text}
    body = next(c for c in given.columns if c not in names.values())
    ident = names[doc_id]
    order = F.col(ident).asc_nulls_last() if keep == "smallest" else F.col(ident).desc_nulls_last()
    norm = lower_ascii(F.coalesce(F.col(body), F.lit("")))
    rows = given.select(*names.values(), norm.alias("__norm")).withColumn("__hash", F.xxhash64("__norm"))
    parts = shuffle_partitions(docs.sparkSession)
    counts = materialise(rows.groupBy("__hash").agg(F.count("*").alias("n")).groupBy(F.when(F.col("n") > 1, F.col("__hash")).alias("__hash")).agg(F.sum("n").alias("n")), "counts")
    n_rows = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.filter(F.col("__hash").isNotNull() & (F.col("n") > max(1, n_rows // (2 * parts)))).select("__hash", F.lit(True).alias("__hot"))
    salted = rows.join(F.broadcast(hot), "__hash", "left").withColumns({  # hot has fewer than 2 * parts rows
        "__hot": F.coalesce("__hot", F.lit(False)),
        "__salt": F.when(F.col("__hot"), row_salt(4 * parts)).otherwise(F.lit(0)).cast("long"),
        "__head": F.substring("__norm", 1, SPLITTER_CHARS),
    })
    key = ["__head", "__hash", "__salt"]
    first = Window.partitionBy(*key, "__norm").orderBy(order)
    whole = first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = salted.repartitionByRange(parts, *key).withColumns({"__keep": F.first(ident).over(whole), "__size": F.count("*").over(whole), "__at": F.row_number().over(first)})
    seen = seen.select(
        *names.values(), "__hot", "__salt", "__keep", "__size", "__at", F.sha2(F.encode("__norm", "utf-8"), 256).alias("text_sha256"),
        F.when(F.col("__hot") & (F.col("__at") == 1), F.col("__norm")).alias("__run"),
    )
    seen = materialise(seen, "sorted")
    # of the runs of a text that hold the id to keep, one keeps it; null ids come last
    known = F.col("__keep").isNotNull()
    best = F.min(F.struct(~known, "__keep", "__salt")) if keep == "smallest" else F.max(F.struct(known, "__keep", "__salt"))
    runs = seen.filter(F.col("__run").isNotNull()).groupBy("__run").agg(best.alias("__best"), F.sum("__size").alias("__all_size"), F.first("text_sha256").alias("text_sha256"))
    runs = runs.select("text_sha256", "__all_size", F.col("__best.__keep").alias("__all_keep"), F.col("__best.__salt").alias("__at_salt"))
    joined = seen.join(F.broadcast(runs), "text_sha256", "left").withColumns({  # fewer than 2 * parts rows
        "group_size": F.coalesce("__all_size", "__size"),
        "keep_id": F.when(F.col("__hot"), F.col("__all_keep")).otherwise(F.col("__keep")),
        "kept": (F.col("__at") == 1) & (~F.col("__hot") | F.col("__salt").eqNullSafe(F.col("__at_salt"))),
    })
    return restore(joined, names, "keep_id", "group_size", "kept", "text_sha256")
