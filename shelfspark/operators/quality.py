"""Data quality: row checks, rates and gates. Rates are aggregated at scale; verdicts are expressions over one row for each run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.schema import BASE, COMPETITOR

MOST_LISTED = 50
LEAST_BASE, LEAST_COMPETITOR, LEAST_MATCHES = 100, 1000, 20
MOST_NULL, MOST_DRIFT, MOST_REJECTED = 0.05, 0.5, 0.05


def blank(c: str) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def reasons() -> Column:
    """What is wrong with a row; an empty array if nothing is. The competitor must have a volume text; an unknown retailer skips the checks."""
    checks = [F.when(blank(c), F.lit(f"{c}:missing")) for c in ("sku_id", "url", "name", "brand")]
    checks.append(F.when(F.coalesce(F.col("current_price"), F.lit(0)) <= 0, F.lit("current_price:not_positive")))
    checks.append(F.when((F.col("retailer") == COMPETITOR) & blank("volume_raw"), F.lit("volume_raw:missing")))
    return F.when(F.col("retailer").isin(BASE, COMPETITOR), F.array_compact(F.array(*checks))).otherwise(F.array().cast("array<string>"))


def valid_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.size(reasons()) == 0)


def rejected_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reasons", reasons()).filter(F.size("reasons") > 0)


def rejections(rows: DataFrame) -> DataFrame:
    """For each run and retailer: attempted and rejected rows, the rate, and the first 50 rejections by sku."""
    checked = rows.withColumn("reasons", reasons())
    totals = checked.groupBy("run_id", "retailer").agg(F.count("*").alias("attempted"), F.count(F.when(F.size("reasons") > 0, 1)).alias("rejected"))
    rank = F.row_number().over(Window.partitionBy("run_id", "retailer").orderBy("sku_id"))
    first = checked.filter(F.size("reasons") > 0).withColumn("k", rank).filter(F.col("k") <= MOST_LISTED)
    entry = F.concat(F.coalesce("sku_id", F.lit("")), F.lit(" "), F.array_join("reasons", ","))
    listed = first.groupBy("run_id", "retailer").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", entry.alias("e")))), lambda x: x["e"]), "; ").alias("listed"))
    return totals.join(listed, ["run_id", "retailer"], "left").select("run_id", "retailer", "attempted", "rejected", rate(F.col("rejected"), F.col("attempted")).alias("rejected_rate"), F.coalesce("listed", F.lit("")).alias("listed"))


def rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def null_rates(rows: DataFrame) -> DataFrame:
    """For each run and retailer: shares of rows without volume, without brand, and without a required field."""
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    return rows.groupBy("run_id", "retailer").agg(
        share(F.col("volume_norm").isNull()).alias("volume_null_rate"), share(F.col("brand_norm").isNull() | (F.col("brand_norm") == "")).alias("brand_null_rate"),
        F.round(share(F.col("volume_norm").isNull()), 4).alias("volume_null_rate_4"),
        F.round(share(F.col("brand_norm").isNull() | (F.col("brand_norm") == "")), 4).alias("brand_null_rate_4"),
        share(F.col("name").isNull() | F.col("current_price").isNull() | F.col("url").isNull()).alias("required_null_rate"),
    )


def filled_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("run_id", "retailer").agg(F.count("*").alias("rows"), F.count(F.when(~blank("volume_norm"), 1)).alias("with_volume"), F.count("current_price").alias("with_price"))


def duplicate_keys(rows: DataFrame) -> DataFrame:
    return rows.groupBy("run_id", "retailer", "sku_id").agg(F.count("*").alias("n")).filter("n > 1")


def brand_in_name(rows: DataFrame) -> DataFrame:
    """How many names contain their brand: a warning, no rejection."""
    inside = F.contains(F.lower("name"), F.lower("brand")) & ~blank("brand")
    return rows.groupBy("run_id", "retailer").agg(F.count(F.when(inside, 1)).alias("brand_in_name"), F.count("*").alias("rows"))


def count_gate(n: Column, least: int) -> Column:
    return F.coalesce(n, F.lit(0)) >= least


def drift_reason(volume: Column, brand: Column, most: float = MOST_DRIFT) -> Column:
    return F.when(volume > most, "parser_drift_null_volume_rate").when(brand > most, "parser_drift_null_brand_rate")


def cascade(rates: DataFrame, counts: DataFrame, matches: DataFrame, least: tuple[int, int, int] = (LEAST_BASE, LEAST_COMPETITOR, LEAST_MATCHES)) -> DataFrame:
    """The first gate that each run fails, or null: base fields, base count, competitor count, drift, matches.

    rates(run_id, retailer, ...) are those of null_rates, counts(run_id, retailer, n) rows built, matches(run_id, n).
    """
    of = lambda df, r, cols: df.filter(F.col("retailer") == r).select("run_id", *(F.col(c).alias(f"{r}_{c}") for c in cols))
    run = rates.select("run_id").union(counts.select("run_id")).distinct()
    for df, r, cols in ((rates, BASE, ["required_null_rate"]), (rates, COMPETITOR, ["volume_null_rate", "brand_null_rate"]), (counts, BASE, ["n"]), (counts, COMPETITOR, ["n"])):
        run = run.join(of(df, r, cols), "run_id", "left")
    run = run.join(matches.select("run_id", F.col("n").alias("match_n")), "run_id", "left")
    reason = (
        F.when(F.coalesce("base_required_null_rate", F.lit(0.0)) > MOST_NULL, "base_required_null_rate")
        .when(~count_gate(F.col("base_n"), least[0]), "base_count").when(~count_gate(F.col("competitor_n"), least[1]), "competitor_count")
    )
    drift = drift_reason(F.coalesce("competitor_volume_null_rate", F.lit(0.0)), F.coalesce("competitor_brand_null_rate", F.lit(0.0)))
    failed = F.coalesce(reason, drift, F.when(~count_gate(F.col("match_n"), least[2]), "match_count"))
    return run.select("run_id", failed.alias("failed_gate"), failed.isNull().alias("passed"))


def publish_route(runs: DataFrame) -> DataFrame:
    """runs(run_id, status, path, size_ok, summary) with route, failed check and reason: the first check that fails, else business."""
    check = (
        F.when(F.coalesce("status", F.lit("")) != "success", "run_status").when(blank("path"), "path")
        .when(~F.coalesce("size_ok", F.lit(False)), "size_guard").when(blank("summary"), "summary_text")
    )
    reason = F.when(check == "run_status", F.concat(F.lit("upstream_status_"), F.coalesce("status", F.lit("None")))).when(check == "path", "no_report").when(check == "size_guard", "oversize").when(check == "summary_text", "empty_summary_text")
    return runs.select("run_id", F.when(check.isNull(), "business").otherwise("ops_only").alias("route"), check.alias("failed_check"), reason.alias("reason"))


def upstream_skip(status: Column) -> Column:
    """Why a later phase doesn't run; null if it does."""
    return F.when(status.isNull(), "missing_run_row").when(status == "failed", "failed_upstream").when(status == "running", "in_progress_upstream")


def probe_verdict(captures: DataFrame) -> DataFrame:
    """Did every probe of a run get its price, with status 200 or 304 and no block?"""
    good = F.col("price_extracted") & F.col("status").isin(200, 304) & ~F.col("block")
    return captures.groupBy("run_id").agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("passed"), F.count("*").alias("probes"))
