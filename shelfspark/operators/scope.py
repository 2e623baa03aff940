"""Which brands and pages of the competitor are in scope: aliases, slugs, prefixes, fuzzy keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.text import bilingual_slugs, brand_key, kebab
from shelfspark.operators.history import top_per_key
from shelfspark.storage import materialise

PREFIX_DEPTH = 3
LEAST_KEY = 3
MOST_CANDIDATES = 5
#: Addresses in a piece of a token's list.
PIECE_URLS = 1000
#: Characters of the grams under which keys are filed.
GRAM = 3


def alias_dimension(aliases: DataFrame, slug: Column) -> DataFrame:
    """aliases(canonical, alias, pos) -> (alias_slug, canonical): every alias, and each canonical key as its own; the last entry wins."""
    own = aliases.select(F.col("canonical").alias("alias_slug"), "canonical", F.lit(-1).cast("long").alias("pos"))
    every = own.unionByName(aliases.select(slug.alias("alias_slug"), "canonical", F.col("pos").cast("long")))
    return every.groupBy("alias_slug").agg(F.max_by("canonical", F.struct("pos", "canonical")).alias("canonical"))


def resolve_aliases(rows: DataFrame, slug: str, dimension: DataFrame, out: str = "brand_norm") -> DataFrame:
    """The canonical brand of a slug, else the slug. Spark broadcasts the dimension where its size allows."""
    known = dimension.select(F.col("alias_slug").alias("__slug"), F.col("canonical").alias("__canonical"))
    return rows.join(known, F.col(slug) == F.col("__slug"), "left").withColumn(out, F.coalesce("__canonical", slug)).drop("__slug", "__canonical")


def aliases_of(brands: DataFrame, aliases: DataFrame) -> DataFrame:
    """(brand, alias): a brand's aliases, else itself."""
    known = aliases.select(F.col("canonical").alias("brand"), "alias")
    return brands.select("brand").join(known, "brand", "left").withColumn("alias", F.coalesce("alias", "brand"))


def brand_path(rows: DataFrame, brand: str, overrides: DataFrame) -> DataFrame:
    """The brand's path at the competitor: an override(brand, path), else the kebab form."""
    known = overrides.select(F.col("brand").alias("__b"), F.col("path").alias("__p"))
    return rows.join(known, F.col(brand) == F.col("__b"), "left").withColumn("path", F.coalesce(F.nullif("__p", F.lit("")), kebab(F.col(brand)))).drop("__b", "__p")


def longest_prefix(slugs: DataFrame, tokens: DataFrame, depth: int = PREFIX_DEPTH) -> DataFrame:
    """(slug, url, token): the longest of a slug's first 1 to 3 parts that is a known token(token); slugs without one go.

    All prefixes are joined at once and the deepest hit is kept. Only its depth is aggregated, which is hashed in place; tokens as values would
    be sorted with their addresses in each task. The join is a semi join, for which Spark may broadcast tokens but never addresses: their size
    is guessed from the file's, and tasks by tokens would be few and hold all addresses.
    """
    parts = F.split("slug", "-")
    prefix = lambda k: F.array_join(F.slice(parts, 1, k), "-").alias("token")
    prefixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(depth))), lambda k: F.struct(k.alias("depth"), prefix(k)))
    rows = slugs.filter((F.col("slug") != "") & (F.element_at(parts, 1) != "")).withColumn("p", F.explode(prefixes)).select("slug", "url", "p.depth", "p.token")
    hit = rows.join(tokens.select("token").distinct(), "token", "left_semi")
    return hit.groupBy("slug", "url").agg(F.max("depth").alias("depth")).select("slug", "url", prefix(F.col("depth")))


def urls_by_token(indexed: DataFrame, most: int = PIECE_URLS) -> DataFrame:
    """(token, piece, urls): a token's addresses in order, cut into pieces of `most`; pieces are numbered from 0 without gaps.

    Rows are sorted over all tokens and addresses by sampled ranges, so that a token with many addresses spans several tasks: each
    numbers its own, and the counts of the ranges before are added. So no task holds more of a token than a piece, besides what it sorts.
    """
    session = indexed.sparkSession
    ranges = int(session.conf.get("spark.sql.shuffle.partitions"))
    rows = indexed.select("token", "url").repartitionByRange(ranges, "token", "url").withColumn("range", F.spark_partition_id())
    rows = materialise(rows, "ranges", keep=True)  # ranges are sampled: they must not be drawn twice
    counts = rows.groupBy("token", "range").agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("token").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    before = counts.select("token", "range", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("token", "range").orderBy("url")) - 1
    placed = rows.withColumn("inner", inner).join(before, ["token", "range"]).withColumn("piece", F.floor((F.col("before") + F.col("inner")) / most))
    return placed.groupBy("token", "piece").agg(F.array_sort(F.collect_list("url")).alias("urls"))


def brand_pool(brands: DataFrame, aliases: DataFrame, indexed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(brand, url) of brands any of whose aliases' slugs is a token of the index, and the brands without any."""
    slugs = aliases_of(brands, aliases).withColumn("token", F.explode(bilingual_slugs(F.col("alias")))).select("brand", "token").distinct()
    found = slugs.join(indexed.select("token", "url"), "token").select("brand", "url").distinct()
    return found, brands.select("brand").join(found, "brand", "left_anti")


def resolve_labels(brands: DataFrame, index: DataFrame) -> DataFrame:
    """Brands whose aggressive key is that of a label of index(label, path, pos); the first record of a key wins."""
    keys = index.withColumn("key", brand_key(F.col("label"))).groupBy("key").agg(F.min_by(F.struct("label", "path"), "pos").alias("r"))
    return brands.withColumn("key", brand_key(F.col("brand"))).join(keys, "key").select("brand", "key", "r.label", "r.path")


def _grams(c: str) -> Column:
    """The distinct stretches of 1 to GRAM characters of a key: at most GRAM for each of its characters."""
    n = F.length(c)
    of = lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substr(F.col(c), i, F.lit(k)))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*(F.when(n >= k, of(k)).otherwise(none) for k in range(1, GRAM + 1))))


def key_grams(long: DataFrame, short: DataFrame) -> tuple[DataFrame, DataFrame]:
    """long(key) and short(key), each with the column `gram` by which they meet: all grams of a long key, and of a short key the rarest among
    the long keys of its grams with GRAM characters (or of all its characters, if it has fewer)."""
    index = long.withColumn("gram", F.explode(_grams("key")))
    size = F.least(F.length("key"), F.lit(GRAM))
    wanted = short.withColumn("gram", F.explode(F.filter(_grams("key"), lambda g: F.length(g) == size)))
    counts = index.groupBy("gram").agg(F.count("*").alias("n"))
    # a gram that no long key has can't be contained: the inner join drops its key's row, and other grams would find nothing either
    best = wanted.join(counts, "gram", "left").groupBy(*short.columns).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))["gram"].alias("gram"))
    return index, best


def fuzzy_labels(brands: DataFrame, index: DataFrame, most: int = MOST_CANDIDATES) -> DataFrame:
    """Up to five labels for each brand, one of whose keys contains the other, nearest in length first; proposed marks a first one whose
    key starts with the other's.

    Keys meet through an index of their grams: the longer key is filed under each of its grams, the shorter one is looked up under its rarest,
    and containment is verified. Rows before that grow with the length of keys, and no brand meets all labels.
    """
    b = brands.select("brand", brand_key(F.col("brand")).alias("bk")).filter("bk <> ''")
    k = index.select("label", brand_key(F.col("label")).alias("lk"), "pos").filter(F.length("lk") >= LEAST_KEY)
    k = k.groupBy("lk").agg(F.min_by("label", "pos").alias("label"), F.min("pos").alias("pos"))

    def met(long: DataFrame, short: DataFrame) -> DataFrame:
        long, short = key_grams(long.withColumnRenamed(long.columns[0], "key"), short.withColumnRenamed(short.columns[0], "key"))
        return long.withColumnRenamed("key", "long_key").join(short.withColumnRenamed("key", "short_key"), "gram").filter(F.col("long_key").contains(F.col("short_key")))

    labels, names = k.select("lk"), b.select("bk").distinct()
    in_label = met(labels, names).select(F.col("short_key").alias("bk"), F.col("long_key").alias("lk"))
    in_brand = met(names, labels).select(F.col("long_key").alias("bk"), F.col("short_key").alias("lk"))
    both = in_label.union(in_brand).distinct().join(b, "bk").join(k, "lk").select("brand", "bk", "lk", "label", "pos")
    ranked = top_per_key(both, ["brand"], [F.abs(F.length("lk") - F.length("bk")), F.col("pos"), F.col("lk")], most)
    proposed = (F.col("rank") == 1) & (F.col("lk").startswith(F.col("bk")) | F.col("bk").startswith(F.col("lk")))
    return ranked.select("brand", "label", "rank", proposed.alias("proposed"))


def review_queue(unmatched: DataFrame, new_slugs: DataFrame) -> DataFrame:
    """(run_id, item, source, status) of brands without a match and slugs not seen before."""
    a = unmatched.select("run_id", F.col("brand").alias("item"), F.lit("unmatched_brand").alias("source"))
    return a.union(new_slugs.select("run_id", F.col("slug").alias("item"), F.lit("new_slug").alias("source"))).withColumn("status", F.lit("pending"))


def pending_brands(queue: DataFrame) -> DataFrame:
    return queue.filter("source = 'unmatched_brand' AND status = 'pending'").select("run_id", F.col("item").alias("brand"))


def uncovered_brands(active: DataFrame, covered: DataFrame) -> DataFrame:
    """Brands (lower-cased, trimmed) of active that covered(brand) hasn't."""
    key = F.lower(F.trim("brand")).alias("brand")
    return active.filter("brand IS NOT NULL").select(key).distinct().join(covered.select(key).distinct(), "brand", "left_anti")


def totals_by_brand(found: DataFrame, advertised: DataFrame, fallback: DataFrame) -> DataFrame:
    """found(brand, sku) against advertised(brand, total): complete from 80 percent on, else the larger of found and fallback(brand, n)."""
    n = found.groupBy("brand").agg(F.count_distinct("sku").alias("found"))
    rows = advertised.join(n, "brand", "left").join(fallback.select("brand", F.col("n").alias("fallback")), "brand", "left").na.fill(0, ["found", "fallback"])
    done = F.col("found") >= 0.8 * F.col("total")
    return rows.select("brand", "total", "found", "fallback", done.alias("complete"), F.when(done, F.col("found")).otherwise(F.greatest("found", "fallback")).alias("taken"))
