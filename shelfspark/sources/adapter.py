"""Two catalogues from a star schema: parts are the base's products, line items the competitor's offers.

Runs 1 and 2 are the line items shipped before and since 1998; the base shows all parts in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions.text import brand_slug, normalise_name
from shelfspark.functions.volume import is_multipack, volume_norm
from shelfspark.operators.scope import resolve_aliases
from shelfspark.schema import BASE, COMPETITOR

PHRASES = {"STANDARD": "Туалетная вода", "MEDIUM": "Крем для рук", "PROMO": "Набор", "ECONOMY": "Помада", "LARGE": "Гель для тела", "SMALL": "Парфюмерная вода"}
OTHER_PHRASE = "Крем для лица"
RUNS = (1, 2)
SPLIT_YEAR = 1998


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def phrase(kind: Column) -> Column:
    out = F.lit(OTHER_PHRASE)
    for k, v in PHRASES.items():
        out = F.when(kind == k, v).otherwise(out)
    return out


def cents(c: Column) -> Column:
    return F.floor(c * 100 + 0.5).cast("long")


def in_runs(rows: DataFrame) -> DataFrame:
    return rows.withColumn("run_id", F.explode(F.array(*(F.lit(r).cast("long") for r in RUNS))))


def base_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base's raw products, which are the same in each run."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    size = F.concat(F.col("p_size").cast("string"), F.lit(" мл"))
    price = cents(F.col("p_retailprice"))
    return part.select(
        key.cast("string").alias("sku_id"), F.concat(F.lit("https://base.example/item/"), key.cast("string")).alias("url"),
        F.concat_ws(" ", phrase(F.col("p_type")), "p_name").alias("name"), F.col("p_brand").alias("brand_raw"),
        price.alias("current_price"), F.when(key % 4 == 0, price + 2500).alias("was_price"), F.lit("KZT").alias("currency"),
        F.when(key % 29 == 0, "DELISTED").when(key % 13 == 0, "OUT_OF_STOCK").otherwise("IN_STOCK").alias("availability"),
        F.when(key % 10 == 0, F.lit(None)).when(key % 17 == 0, F.concat(F.lit("3 x "), size)).otherwise(size).alias("raw_volume_text"),
    )


def competitor_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the competitor's products are in every run, all parts, without prices."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    kind = F.when(key % 11 == 0, F.lit(OTHER_PHRASE)).otherwise(phrase(F.col("p_type")))
    url = F.concat(F.lit("https://competitor.example/"), key.cast("string"), F.lit("-"), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))
    return part.select(
        F.concat(F.lit("c"), key.cast("string")).alias("sku_id"), url.alias("url"),
        F.concat_ws(" ", kind, "p_name", F.when(key % 6 == 0, "intense")).alias("name"), F.col("p_brand").alias("brand_raw"),
        F.lit(None).cast("long").alias("current_price"), F.lit(None).cast("long").alias("was_price"), F.lit("KZT").alias("currency"),
        F.when(key % 31 == 0, "DELISTED").otherwise("IN_STOCK").alias("availability"),
        F.when(key % 9 != 0, F.concat(F.col("p_size").cast("string"), F.lit(" ml"))).alias("raw_volume_text"),
    )


def offered(spark: SparkSession, sf_dir: str, products: DataFrame) -> DataFrame:
    """The competitor's products with the prices of each run that offers them: the highest unit price."""
    run = F.when(F.year("l_shipdate") < SPLIT_YEAR, F.lit(1)).otherwise(F.lit(2)).cast("long")
    unit = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity") + 0.5)
    offers = table(spark, sf_dir, "lineitem").groupBy(run.alias("run_id"), "l_partkey").agg(F.max(unit).cast("long").alias("price"))
    rows = offers.withColumn("sku_id", F.concat(F.lit("c"), F.col("l_partkey").cast("string"))).join(products.drop("current_price", "was_price"), "sku_id")
    prices = rows.withColumnsRenamed({"price": "current_price"}).withColumn("was_price", F.when(F.col("l_partkey") % 7 == 0, F.col("current_price") + 1000))
    return prices.select("run_id", *products.columns)


def raw_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, raw product) of the base."""
    return in_runs(base_products(spark, sf_dir))


def raw_competitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, raw product) of the competitor."""
    return offered(spark, sf_dir, competitor_products(spark, sf_dir))


SNAPSHOT_ROW = (
    "run_id", "retailer", "sku_id", "url", "name", "brand", "brand_norm", "name_norm", "volume_raw", "volume_norm",
    "multipack_flag", "parse_error_flag", "current_price", "was_price", "currency", "stock_state",
)


def normalise(raw: DataFrame, retailer: str, volume_text: Column | None = None, pack_text: Column | None = None, aliases: DataFrame | None = None) -> DataFrame:
    """Raw products as snapshot rows. Paths differ in the text that volumes and multipacks are read from; both default to the raw volume.

    A brand is its slug; where that is an alias of aliases(alias_slug, canonical), it is the canonical brand.
    """
    volume = F.col("raw_volume_text") if volume_text is None else volume_text
    pack = F.col("raw_volume_text") if pack_text is None else pack_text
    out = raw.select(
        *(["run_id"] if "run_id" in raw.columns else []), F.lit(retailer).alias("retailer"), "sku_id", "url", "name",
        F.col("brand_raw").alias("brand"), brand_slug(F.col("brand_raw")).alias("brand_norm"), normalise_name(F.col("name")).alias("name_norm"),
        volume.alias("volume_raw"), volume_norm(volume).alias("volume_norm"), is_multipack(pack).alias("multipack_flag"),
        F.lit(False).alias("parse_error_flag"), "current_price", "was_price", "currency", F.coalesce("availability", F.lit("UNKNOWN")).alias("stock_state"),
    )
    return out if aliases is None else resolve_aliases(out, "brand_norm", aliases)


def dealt(products: DataFrame) -> DataFrame:
    """Products dealt out by their key: a file of them is small, but to normalise one costs more than to move it, and offers are
    joined on the same key."""
    return products.repartition(int(products.sparkSession.conf.get("spark.sql.shuffle.partitions")), "sku_id")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides in both runs. Products are normalised once, before runs multiply them."""
    base = in_runs(normalise(dealt(base_products(spark, sf_dir)), BASE))
    competitor = offered(spark, sf_dir, normalise(dealt(competitor_products(spark, sf_dir)), COMPETITOR))
    return base.select(*SNAPSHOT_ROW).unionByName(competitor.select(*SNAPSHOT_ROW))
