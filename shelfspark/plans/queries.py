"""The registered queries: each operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators import matching
from shelfspark.plans.more_queries import MORE, matched
from shelfspark.schema import BASE, COMPETITOR
from shelfspark.sources.adapter import snapshots

Query = Callable[[SparkSession, str], DataFrame]


def _snap(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(snapshots(spark, sf_dir))


def _product_types(rows: DataFrame) -> DataFrame:
    both = [matching.features(rows, r).withColumn("retailer", F.lit(r)) for r in (BASE, COMPETITOR)]
    words = lambda c: F.array_join(F.array_sort(c), " ").alias(c)
    return both[0].unionByName(both[1]).select("run_id", "retailer", "sku_id", "type", words("tokens"), words("telling"))


MATCHING: dict[str, Query] = {
    "snapshots": _snap(lambda s: s),
    "product_types": _snap(_product_types),
    "matches": _snap(matching.match_products),
    "price_deltas": matched(lambda s, m: matching.sorted_deltas(m, s)),
    "price_deltas_top": _snap(lambda s: matching.top_deltas(matching.match_classes(s), 20)),
    "gaps_by_key": matched(lambda s, m: matching.gaps(s, m).orderBy("brand_norm", "name_norm")),
    "gaps_by_sku": matched(lambda s, m: matching.gaps(s, m, by="sku").orderBy("brand_norm", "name_norm")),
    "promotions": _snap(lambda s: matching.promotions(s).orderBy(F.col("discount_pct").desc(), "sku_id")),
    "comparable_counts": _snap(matching.comparable_counts),
    "brand_overlap_rows": _snap(lambda s: matching.brand_overlap(s).select("run_id", "sku_id", "brand_norm")),
    "match_rates": matched(matching.match_rates),
    "overlap_by_brand": _snap(matching.overlap_by_brand),
    "skus_per_brand_top": _snap(lambda s: matching.skus_per_brand(s, 30)),
}


def queries() -> dict[str, Query]:
    return MATCHING | MORE
