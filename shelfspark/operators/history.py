"""Windows over runs and keys: first seen, last runs, previous run, suggested thresholds, current state, run ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FACTOR, HISTORY = 0.7, 4


def first_seen(rows: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """The first row of each key by explicit positions; never by physical order. Needs positions that don't tie."""
    order = Window.partitionBy(*keys).orderBy(*position)
    return rows.withColumn("__k", F.row_number().over(order)).filter("__k = 1").drop("__k")


def top_per_key(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= n)


def suggested_thresholds(counts: DataFrame, keys: list[str], include_current: bool = False) -> DataFrame:
    """counts(keys, run_id, n) with `suggested`: 0.7 times the median of the last four positive counts, truncated; null below four.

    The history is that of the run ids current - 4 to current - 1, by value, so missing runs leave gaps. With
    include_current, the current count comes last and the last four of all count.
    """
    before = Window.partitionBy(*keys).orderBy("run_id").rangeBetween(-HISTORY, -1)
    history = F.filter(F.collect_list(F.struct("run_id", "n")).over(before), lambda x: x["n"] > 0)
    values = F.transform(F.array_sort(history), lambda x: x["n"])
    if include_current:
        values = F.concat(values, F.filter(F.array("n"), lambda x: x > 0))
    last = F.array_sort(F.slice(values, F.greatest(F.size(values) - HISTORY + 1, F.lit(1)), HISTORY))
    median = (F.element_at(last, 2) + F.element_at(last, 3)) / 2.0
    return counts.withColumn("suggested", F.when(F.size(values) >= HISTORY, (F.lit(FACTOR) * median).cast("long")))


def last_runs(rows: DataFrame, n: int = HISTORY) -> DataFrame:
    """The rows of the n highest run ids. Ranks run ids, not rows: the window sees one row for each run."""
    runs = rows.select("run_id").distinct().withColumn("__k", F.dense_rank().over(Window.orderBy(F.col("run_id").desc()))).filter(F.col("__k") <= n)
    return rows.join(runs.select("run_id"), "run_id", "left_semi")


def previous_run(runs: DataFrame) -> DataFrame:
    """(run_id, previous_run_id): the highest earlier run that exists."""
    ids = runs.select("run_id").distinct()
    return ids.withColumn("previous_run_id", F.lag("run_id").over(Window.orderBy("run_id")))


def current_rows(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """The rows of the latest successful run."""
    latest = runs.filter("status = 'success'").agg(F.max("run_id").alias("run_id"))
    return rows.join(F.broadcast(latest), "run_id", "left_semi")  # one row


def run_state(events: DataFrame) -> DataFrame:
    """The state of each run from its events(run_id, seq, kind, status, fail_reason): created is running, the first finalise counts
    only while it runs, and a failure wins always."""
    fold = events.groupBy("run_id").agg(
        F.max(F.when(F.col("kind") == "fail", F.col("seq"))).alias("failed_at"), F.max_by("fail_reason", F.when(F.col("kind") == "fail", F.col("seq"))).alias("why"),
        F.min_by("status", F.when(F.col("kind") == "finalize", F.col("seq"))).alias("final"),
    )
    status = F.when(F.col("failed_at").isNotNull(), "failed").otherwise(F.coalesce("final", F.lit("running")))
    return fold.select("run_id", status.alias("status"), F.when(F.col("failed_at").isNotNull(), F.col("why")).alias("fail_reason"))


def stats_now(patches: DataFrame) -> DataFrame:
    """(run_id, key, value): the last patch of each key; patches with null values are refused."""
    return patches.filter("value IS NOT NULL").groupBy("run_id", "key").agg(F.max_by("value", "seq").alias("value"))


def stats_map(patches: DataFrame) -> DataFrame:
    return stats_now(patches).groupBy("run_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("stats"))


def run_comparison(snapshots: DataFrame, found: DataFrame) -> DataFrame:
    """Base, competitor and match counts of each run, and their change against the run before; found(run_id, n) has the counts of matches."""
    n = snapshots.groupBy("run_id").agg(F.count(F.when(F.col("retailer") == "base", 1)).alias("base"), F.count(F.when(F.col("retailer") == "competitor", 1)).alias("competitor"))
    out = n.join(found.select("run_id", F.col("n").alias("matches")), "run_id", "left").na.fill(0)
    before = Window.orderBy("run_id")  # one row for each run
    return out.select("*", *((F.col(c) - F.lag(c).over(before)).alias(f"{c}_change") for c in ("base", "competitor", "matches")))


def new_keys(rows: DataFrame, key: str) -> DataFrame:
    """(run_id, key) that the previous existing run hasn't; the first run has none. Removals are ignored."""
    here = rows.select("run_id", key).distinct()
    pairs = here.join(previous_run(here), "run_id").filter("previous_run_id IS NOT NULL")
    old = here.select(F.col("run_id").alias("previous_run_id"), key)
    return pairs.join(old, ["previous_run_id", key], "left_anti").select("run_id", key)
