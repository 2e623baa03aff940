"""Helpers shared by the text operators: hide input columns, number rows; and tables in shared storage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.storage import materialise, scratch

__all__ = ["column", "hide", "materialise", "numbered", "restore", "scratch", "shuffle_partitions", "slices_for"]


def column(name: str) -> Column:
    """The column of that name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def hide(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns renamed to names that no operator uses, and the new name of each; pruning still reaches the scan."""
    names = {c: f"__in{i}" for i, c in enumerate(df.columns)}
    return df.select(*(column(c).alias(n) for c, n in names.items())), names


def restore(df: DataFrame, names: dict[str, str], *results: str) -> DataFrame:
    """The input's columns under their own names, then the results; a result replaces an input column of its name."""
    return df.select(*(F.col(n).alias(c) for c, n in names.items() if c not in results), *results)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ROWS_PER_SLICE = 200_000
MOST_SLICES = 4096


def numbered(df: DataFrame, keys: list[str], order: list[Column], slices: int, out: str, facts: DataFrame | None = None) -> DataFrame:
    """A number for each row, from 0 without gaps within each group of keys, however large a group is.

    A group is cut into slices by a hash of the ordering columns; rows are numbered within a slice, and the counts of
    the slices before it are added. At most `slices` counts exist for each group, and one slice is all that a task sorts.

    facts has a row for each group: the key columns under the names __f0, __f1 and so on, then what its rows are to get. It is joined with the
    counts, so that rows meet it slice by slice and never by their group alone.
    """
    rows = df.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    part = [*keys, "__slice"]
    counts = rows.groupBy(*part).agg(F.count("*").alias("__n"))
    before = counts.select(
        *(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__slice").alias("__s"),
        (F.sum("__n").over(Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")).alias("__before"),
    )
    if facts is not None:
        same = [F.col(f"__k{i}").eqNullSafe(F.col(f"__f{i}")) for i in range(len(keys))]
        before = before.join(facts, reduce(Column.__and__, same)).drop(*(f"__f{i}" for i in range(len(keys))))
    match = F.col("__slice") == F.col("__s")
    for i, k in enumerate(keys):
        match &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
    inner = F.row_number().over(Window.partitionBy(*part).orderBy(*order)) - 1
    return rows.withColumn("__inner", inner).join(before, match, "left").withColumn(out, (F.col("__before") + F.col("__inner")).cast("long")).drop("__slice", "__inner", "__s", "__before", *(f"__k{i}" for i in range(len(keys))))


def slices_for(n_rows: int) -> int:
    return max(1, min(MOST_SLICES, -(-n_rows // ROWS_PER_SLICE) * 8))
