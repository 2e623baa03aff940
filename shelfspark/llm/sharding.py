"""Shards of near-equal bytes: the minimax contiguous partition of ordered atomic groups.

Groups are equal texts, ordered by their digest, and are never split. The smallest feasible capacity is found by binary
search; a capacity is feasible if filling shard after shard up to it, group by group, needs no more shards than asked for.

The running sizes of the groups stay in a table. The greedy check needs to know, for a position, the last group end at
or below it; the driver holds the last group end of at most BINS equal bins of the positions in question, which bounds
every such answer from below and above. So each capacity is feasible, infeasible or undecided; only the bins in which
undecided capacities could cut are read again, in finer bins, until no capacity is left undecided. A bin that is read
again is cut in two at least and a bin of one byte holds one end, so the search ends however the sizes lie. Shards are then told
by comparing a row's digest with the cut digests, which needs no join and no shuffle.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import hide, materialise, numbered, restore, slices_for

BINS = 8192
GROUPS_A_BUCKET = 100_000
MOST_BUCKETS = 16**4


def running_sizes(groups: DataFrame, n_groups: int) -> DataFrame:
    """groups(digest, bytes) -> (digest, end): the total size up to each group in the order of digests, in two levels."""
    digits = 1
    while digits < 4 and 16**digits * GROUPS_A_BUCKET < n_groups:
        digits += 1
    rows = groups.withColumn("bucket", F.substring("digest", 1, digits))
    before = rows.groupBy("bucket").agg(F.sum("bytes").alias("b")).select("bucket", (F.sum("b").over(Window.orderBy("bucket")) - F.col("b")).alias("before"))  # at most MOST_BUCKETS rows
    inner = F.sum("bytes").over(Window.partitionBy("bucket").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("inner", inner).join(F.broadcast(before), "bucket").select("digest", (F.col("before") + F.col("inner")).alias("end"))


def _chain(capacity: int, shards: int, total: int, floor) -> list[int]:
    """Where the shards end when each is filled up to the capacity."""
    ends, at = [], 0
    for _ in range(shards):
        at = total if at + capacity >= total else floor(at, at + capacity)
        ends.append(at)
    return ends


def _search(lo: int, hi: int, feasible) -> int:
    """The smallest feasible value of lo..hi, of which hi is feasible."""
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if feasible(mid) else (mid + 1, hi)
    return hi


def minimax_cuts(ends: DataFrame, shards: int, total: int, largest: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and where its greedy shards end."""
    most = max(BINS, 64 * shards)
    known, unsure = [0, total], {}  # unsure: the last end of a bin that holds several -> the bits of the bin's width
    lo, hi = max(largest, -(-total // shards)), total
    bits, rows = max(0, (total - 1).bit_length() - (most.bit_length() - 1)), ends

    def start(last: int) -> int:
        return ((last - 1) >> unsure[last] << unsure[last]) + 1

    def at_least(frm: int, to: int) -> int:
        return max(frm, known[bisect_right(known, to) - 1])

    def at_most(frm: int, to: int) -> int:
        k = bisect_right(known, to)
        # ends that aren't known lie only in bins that hold several, below the last one of the bin
        unknown = k < len(known) and known[k] in unsure and start(known[k]) <= to
        return max(frm, to if unknown else known[k - 1])

    while True:
        bins = rows.groupBy(F.shiftright(F.col("end") - 1, bits)).agg(F.max("end").alias("last"), F.count("*").alias("n")).collect()  # at most `most` rows
        known = sorted({*known, *(r["last"] for r in bins)})
        unsure |= {r["last"]: bits for r in bins if r["n"] > 1}
        hi = _search(lo, hi, lambda c: _chain(c, shards, total, at_least)[-1] == total)
        lo = _search(lo, hi, lambda c: _chain(c, shards, total, at_most)[-1] == total)
        first, last = _chain(lo, shards, total, at_least), _chain(hi, shards, total, at_most)
        if lo == hi and first == last:
            return hi, first
        # an undecided cut lies in such a bin; the widest of these bins are read again, each cut in two at least
        touched = [x for x in sorted(unsure) if (i := bisect_left(last, start(x))) < shards and first[i] < x]
        wide = max(unsure[x] for x in touched)
        picked = [x for x in touched if unsure[x] == wide][: most // 2]
        for x in picked:
            del unsure[x]
        bits = max(0, wide - ((most // len(picked)).bit_length() - 1))
        rows = ends.filter(F.col("end").between(picked[0] - (1 << wide), picked[-1]) & F.shiftright(F.col("end") - 1, wide).isin([(x - 1) >> wide for x in picked]))


def shard(docs: DataFrame, shards: int = 16, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows and columns of docs with size, text_crc32, law, shard, slot and grown_shard.

    size is the UTF-8 length of the text plus 1, text_crc32 the unsigned CRC-32 of those bytes. The law is `bytes`: the
    largest shard is as small as contiguous shards of whole groups allow; grown_shard is null as only the law `key` has one.
    slot numbers the rows of a shard from 0 without gaps.

    A null text is an empty one (size 1, CRC 0) and of its group. Repeated rows, ids and null ids are rows like others; rows
    that agree in id and text share slots in any order. One group may hold most rows: its shard is that large, other groups share the
    other shards. Fewer groups than shards leave shards empty. An empty table gives an empty result. Result columns
    replace input columns with their names.
    """
    given, names = hide(docs)
    whole = F.coalesce(F.col(names[text]), F.lit(""))
    rows = given.withColumns({"size": (F.octet_length(whole) + 1).cast("long"), "text_crc32": F.crc32(F.encode(whole, "utf-8")), "__digest": F.sha2(F.encode(whole, "utf-8"), 256)})
    groups = materialise(rows.groupBy(F.col("__digest").alias("digest")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "groups")
    n, total, largest, n_rows = groups.agg(F.count("*"), F.sum("bytes"), F.max("bytes"), F.sum("rows")).first()
    out = rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
    if not n:
        return restore(out.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}), names, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    ends = materialise(running_sizes(groups, n), "ends")
    _, cuts = minimax_cuts(ends, shards, total, largest)
    # the first digest of a shard is the one after the cut; a digest belongs to the shard after all cuts below it
    last = sorted(r["digest"] for r in ends.filter(F.col("end").isin(sorted({c for c in cuts if c < total}))).collect())
    at = F.lit(0)
    for d in last:
        at = at + (F.col("__digest") > d).cast("int")
    placed = out.withColumn("shard", at.cast("int"))
    order = [F.col(names[doc_id]), F.col("__digest")]
    return restore(numbered(placed, ["shard"], order, slices_for(n_rows), "slot"), names, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
