"""A mix of sources with target token counts: entropy balancing, then rounding to whole copies.

Each document d of source s gets a rate r = min(2, exp(lambda_s * x_d)), x_d its size relative to the source's mean: of all
rates between 0 and 2 that give each source its target of tokens, this one has the largest entropy relative to taking each
document once. The dual is convex and has one variable for each source; Newton steps, held between bounds that
halve where a step leaves them, solve all sources in parallel over size histograms that Spark aggregates.

Rates become copies by systematic rounding in the order of sizes: each running sum of copies is within one of
the running sum of rates, so a source misses its target by no more than about its largest document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.common import hide, materialise, numbered, restore, slices_for

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
STEPS = 60
#: Sizes up to here have a bin each; above, bins are at most 1/256 of their size wide.
EXACT_SIZES = 512


def word_count(c):
    """The number of runs of characters other than ASCII blanks; null has none."""
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> with weight and target: weights 5, 2, 1 in turn by code point, null last, and 150% of all sizes
    shared by weight; targets stop at twice their source's size, and what they leave is shared again by weight.

    The capped shares have the form min(2 * size, level * weight). The level is found in the order of
    2 * size / weight: sources up to some place in it are at their cap, the others share what is left.
    """
    # one row for each source: a window over all of them sorts names, never documents
    ranked = sizes.withColumn("pos", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("pos") % len(WEIGHTS) + 1).cast("int")).cast("double"))
    weighed = weighed.withColumns({"cap": MOST * F.col("source_size"), "ratio": MOST * F.col("source_size") / F.col("weight")})
    up = Window.orderBy("ratio", "pos").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio", "pos").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy("ratio", "pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (SHARE * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(up), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = weighed.withColumn("level", level)
    # the first place whose cap isn't below the level: from there on sources share
    found = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "pos", "level"))).over(every)["level"]
    return levels.withColumn("target", F.least(F.col("cap"), F.coalesce(found * F.col("weight"), F.col("cap")))).drop("pos", "cap", "ratio", "level")


def _solved(bins, target, mean):
    """The dual variable of a source from its histogram bins(x, tokens): safeguarded Newton steps."""

    def rate(lam, x):
        return F.least(F.lit(MOST), F.exp(F.least(lam * x / mean, F.lit(2.0))))

    def step(state, _):
        lam = state["lam"]
        sums = F.aggregate(bins, F.struct(F.lit(0.0).alias("t"), F.lit(0.0).alias("d")), lambda acc, b: F.struct(
            (acc["t"] + b["tokens"] * rate(lam, b["x"])).alias("t"),
            (acc["d"] + F.when(rate(lam, b["x"]) < MOST, b["tokens"] * b["x"] / mean * rate(lam, b["x"])).otherwise(0.0)).alias("d")))
        lo = F.when(sums["t"] < target, lam).otherwise(state["lo"])
        hi = F.when(sums["t"] < target, state["hi"]).otherwise(lam)
        newton = lam - (sums["t"] - target) / F.when(sums["d"] > 0, sums["d"])
        nxt = F.when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2)
        return F.struct(F.when(F.abs(sums["t"] - target) <= 1e-9 * target, lam).otherwise(nxt).alias("lam"), lo.alias("lo"), hi.alias("hi"))

    start = F.struct(F.lit(0.0).alias("lam"), F.lit(-1e4).alias("lo"), F.lit(1e4).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)["lam"]


def mix_sources(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", size: str | None = None) -> DataFrame:
    """The rows and columns of docs with size, source_size, target, rate, copies and taken (copies times size).

    size is the number of blank-separated words of the whole text; they are counted once and written with the rows. If
    the column named by `size` has that number, the column `text` only tells rows of an id apart and may hold a hash of the text. A null or empty text has size 0 and takes nothing; its
    copies are 1, as it costs none. A null source is a source of its own and comes last. copies are 0, 1 or 2 and the same
    in each run; ties and repeated rows are told apart by nothing and may swap copies. A source whose target is twice its size
    takes each document twice. An empty table gives an empty result. Result columns replace input columns with their names.
    """
    given, names = hide(docs)
    src, ident = names[source], names[doc_id]
    rows = materialise(given.withColumn("size", F.col(names[size]).cast("long") if size else word_count(F.col(names[text]))), "sized", keep=True)
    scale = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)).cast("double") / (EXACT_SIZES / 2)))).cast("long")
    rows = rows.withColumn("__bin", F.when(F.col("size") < EXACT_SIZES, F.col("size")).otherwise(F.floor(F.col("size") / scale) * scale).cast("long"))
    cells = materialise(rows.groupBy(F.col(src).alias("source"), F.col("__bin").alias("x")).agg(F.count("*").alias("n"), F.sum("size").alias("tokens")), "sizes")
    sizes = cells.groupBy("source").agg(F.sum("tokens").alias("source_size"), F.sum("n").alias("docs"), F.collect_list(F.struct(F.col("x").cast("double").alias("x"), F.col("tokens").cast("double").alias("tokens"))).alias("bins"))  # a few thousand bins for each source at most
    small = source_targets(sizes.select("source", "source_size"))
    solved = small.join(sizes.select(F.col("source").alias("__s"), "docs", "bins"), F.col("source").eqNullSafe(F.col("__s"))).withColumn("mean", F.col("source_size") / F.col("docs"))
    full = F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12)
    solved = solved.withColumn("lam", F.when(full | (F.col("source_size") == 0), F.lit(None).cast("double")).otherwise(_solved(F.col("bins"), F.col("target"), F.col("mean"))))
    solved = materialise(solved.select("source", "source_size", "target", "mean", "lam"), "targets")
    rated = cells.withColumnRenamed("source", "__c").join(solved, F.col("__c").eqNullSafe(F.col("source"))).withColumn(
        "rate", F.when(F.col("x") == 0, F.lit(1.0)).when(F.col("lam").isNull(), F.lit(MOST)).otherwise(F.least(F.lit(MOST), F.exp(F.least(F.col("lam") * F.col("x") / F.col("mean"), F.lit(2.0)))))
    )
    upto = F.sum(F.col("n") * F.col("rate")).over(Window.partitionBy("source").orderBy("x").rowsBetween(Window.unboundedPreceding, -1))
    rates = rated.select(F.col("source").alias("__f0"), F.col("x").alias("__f1"), "source_size", "target", "rate", F.coalesce(upto, F.lit(0.0)).alias("__upto"))
    n_rows = cells.agg(F.sum("n")).first()[0] or 0
    # a slice of a source's bin is all that a task sorts, and all that its rate is joined with
    order = [F.col(ident), F.xxhash64(names[text])]
    out = numbered(rows, [src, "__bin"], order, slices_for(n_rows), "__i", materialise(rates, "rates"))
    running = lambda i: F.floor(F.round(F.col("__upto") + i * F.col("rate"), 6) + 0.5)
    out = out.withColumn("copies", F.when(F.col("size") == 0, F.lit(1)).otherwise(F.least(running(F.col("__i") + 1) - running(F.col("__i")), F.lit(int(MOST)))).cast("int"))
    return restore(out.withColumn("taken", F.col("copies") * F.col("size")), names, "size", "source_size", "target", "rate", "copies", "taken")
