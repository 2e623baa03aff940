"""Connected components of a link table: stretches of it are contracted in tasks, then large-star and small-star steps alternate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shelfspark.llm.common import materialise

#: Links that one task contracts at once; of a larger table each partition has about so many.
LINKS_A_TASK = 500_000


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()


def _contract(limit: int):
    """Stretches of up to about limit links (u, v) -> (u, v): each linked node but the smallest of its part, with that smallest one."""

    def stars(stretch: list[pa.RecordBatch]) -> pa.RecordBatch:
        links = pa.Table.from_batches(stretch)
        codes = pa.chunked_array([*links.column("u").chunks, *links.column("v").chunks]).combine_chunks().dictionary_encode()
        order = np.asarray(pc.sort_indices(codes.dictionary))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        u, v = np.split(rank[np.asarray(codes.indices)], 2)
        label = np.arange(len(order))
        while True:
            a, b = label[u], label[v]
            cross = a != b
            if not cross.any():
                break
            u, v, a, b = u[cross], v[cross], a[cross], b[cross]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while ((up := label[label]) != label).any():
                label = up
        far = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([codes.dictionary.take(pa.array(order[x])) for x in (far, label[far])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= limit:
                yield stars(held)
                held, rows = [], 0
        if rows:
            yield stars(held)

    return run


def connected_components(links: DataFrame, rounds: int = 64, links_a_task: int = LINKS_A_TASK) -> DataFrame:
    """links(u, v) of any ordered type -> (node, root): the smallest node that each linked node reaches.

    Nodes without a link have no row. Repeated links and self links change nothing. Stretches of links_a_task links are contracted
    first; a table that is one such stretch is done then. Each round after that costs a few shuffles of the links that are left and halves the
    depth; the partial minimum of a star with very many links is taken before the shuffle.
    """
    given = links.select("u", "v").filter("u <> v")
    stretches = max(1, -(-given.count() // links_a_task))
    kind = StructType([StructField(c, given.schema["u"].dataType) for c in "uv"])
    # one stretch: links_a_task rows at most, and one more batch closes none
    edges = materialise(given.coalesce(stretches).mapInArrow(_contract(links_a_task if stretches > 1 else 2 * links_a_task), kind), "edges")
    before = None
    for _ in range(rounds if stretches > 1 else 0):
        edges = materialise(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    else:
        if stretches > 1:
            raise RuntimeError(f"no fixed point after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
