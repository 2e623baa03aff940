"""Entity resolution between two catalogues of a run, and what follows from it: deltas, gaps, promotions and rates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.pricing import DELISTED, delta, percent
from shelfspark.functions.tokens import latin_tokens, names_match, product_type, telling_tokens, url_tokens
from shelfspark.operators.history import top_per_key
from shelfspark.schema import BASE, COMPETITOR
from shelfspark.storage import materialise


def side(snapshots: DataFrame, retailer: str) -> DataFrame:
    return snapshots.filter(F.col("retailer") == retailer)


def comparable() -> Column:
    """No multipack and not delisted. The stock state is never null in snapshots; a null one would not be comparable."""
    return ~F.col("multipack_flag") & (F.col("stock_state") != DELISTED)


def eligible() -> Column:
    return comparable() & F.col("current_price").isNotNull()


def reportable() -> Column:
    return comparable() & F.col("volume_norm").isNotNull()


def on_promotion() -> Column:
    return F.col("was_price").isNotNull() & (F.col("was_price") > F.col("current_price"))


def _worded(snapshots: DataFrame, retailer: str) -> DataFrame:
    """Eligible rows of a side with their tokens. A competitor's tokens are those of its URL and its name."""
    own = latin_tokens(F.col("name_norm"))
    return side(snapshots, retailer).filter(eligible()).withColumn("tokens", own if retailer == BASE else F.array_union(url_tokens(F.col("url")), own))


def _told(worded: DataFrame, *more: str) -> DataFrame:
    return worded.select(
        *more, "run_id", "brand_norm", "name_norm", "volume_norm", "tokens",
        telling_tokens(F.col("tokens"), F.col("brand_norm")).alias("telling"), product_type(F.col("name_norm")).alias("type"),
    )


def features(snapshots: DataFrame, retailer: str) -> DataFrame:
    """What the name test needs, once for each product."""
    return _told(_worded(snapshots, retailer), "sku_id", "current_price", "was_price")


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{prefix}_{c}") for c in df.columns))


#: A key whose rows of one side are more than a fair share of that many partitions is dealt out.
SHARES = 64
#: Fewer rows than these are never dealt out.
LEAST_HEAVY = 2000


def with_rarest(base: DataFrame, competitor: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the rarest of each product's tokens and telling tokens (null if it has none): the one that the fewest products of its run
    and brand have. Products are told apart by a column `id`."""
    both = base.withColumn("side", F.lit(0)).unionByName(competitor.withColumn("side", F.lit(1)))
    tokens = both.select("side", "id", "run_id", "brand_norm", "telling", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("run_id", "brand_norm", "token").agg(F.count("*").alias("n"))
    known = tokens.withColumn("tells", F.array_contains("telling", F.col("token"))).drop("telling").join(counts, ["run_id", "brand_norm", "token"])
    order = F.struct("n", "token")
    best = known.groupBy("side", "id").agg(F.min(order)["token"].alias("rare"), F.min(F.when(F.col("tells"), order))["token"].alias("rare_telling"))
    best = materialise(best, "rarest", keep=True)  # both sides and the count of keys read it
    return tuple(rows.join(best.filter(F.col("side") == k).drop("side"), "id", "left") for k, rows in enumerate((base, competitor)))


def token_keys(whole: bool) -> Column:
    """The keys under which a product is looked up, one for each way in which names_match can hold.

    Names match only if all the competitor's tokens are among the base's, so its rarest one is (`all`); or if telling tokens overlap and
    one side's are all among the other's, so the rarest telling one of that side is (`own` for the competitor's, `his` for the base's); or if
    neither has a token and the names are equal (`name`).
    """
    tagged = lambda tag, c: F.transform(c, lambda x: F.concat(F.lit(tag), x))
    one = lambda tag, c: F.when(F.col(c).isNotNull(), F.array(F.concat(F.lit(tag), F.col(c)))).otherwise(F.array().cast("array<string>"))
    bare = F.when(F.size("tokens") == 0, F.array(F.concat(F.lit("name "), F.coalesce("name_norm", F.lit(""))))).otherwise(F.array().cast("array<string>"))
    if whole:
        return F.concat(tagged("all ", F.col("tokens")), tagged("own ", F.col("telling")), one("his ", "rare_telling"), bare)
    return F.concat(one("all ", "rare"), one("own ", "rare_telling"), tagged("his ", F.col("telling")), bare)


def _first_way() -> Column:
    """A pair that meets under several keys is taken under the first one only."""
    all_ = F.coalesce(F.array_contains("b_tokens", F.col("c_rare")), F.lit(False))
    own = F.coalesce(F.array_contains("b_telling", F.col("c_rare_telling")), F.lit(False))
    way = F.substring("b_token_key", 1, 3)
    return (way == "all") | (way == "nam") | ((way == "own") & ~all_) | ((way == "his") & ~all_ & ~own)


def candidate_pairs(base: DataFrame, competitor: DataFrame) -> DataFrame:
    """Pairs of one run and brand whose volumes are equal or known on one side only, and whose tokens don't rule out a match; each pair once.

    One equi join. Its key tells the cases of volumes apart (equal, known at the competitor only, known at the base only), as an OR over
    volumes would leave the brand as the only key; and it has a token, as products without a shared one can't match. Keys with more than
    a fair share of a side's rows are counted and dealt out: these rows go to so many salts, and the other side's go to each of them.
    """
    known_left, known_right = F.lit("competitor only"), F.lit("base only")
    base, competitor = with_rarest(base, competitor)

    def keyed(rows: DataFrame, other: Column, own: Column, whole: bool) -> DataFrame:
        volumes = F.when(F.col("volume_norm").isNull(), F.array(own)).otherwise(F.array("volume_norm", other))
        rows = rows.withColumn("token_key", F.explode(token_keys(whole)))
        return rows.withColumn("volume_key", F.explode(volumes))

    b, c = keyed(base, known_right, known_left, True), keyed(competitor, known_left, known_right, False)
    keys = ("run_id", "brand_norm", "volume_key", "token_key")
    b, c = _dealt_out(b, c, keys)
    same = F.col("b_salt") == F.col("c_salt")
    for k in keys:
        same &= F.col(f"b_{k}") == F.col(f"c_{k}")
    return _renamed(b, "b").join(_renamed(c, "c"), same).filter(_first_way())


def heavy_keys(b: DataFrame, c: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, b_salts, c_salts) of the keys that have more than a fair share of a side's rows; at most SHARES for each side."""
    n = [rows.groupBy(*keys).agg(F.count("*").alias("n")) for rows in (b, c)]
    found = []
    for counts, salts in zip(n, ("b_salts", "c_salts"), strict=True):
        share = counts.agg(F.greatest(F.ceil(F.sum("n") / SHARES), F.lit(LEAST_HEAVY)).alias("share"))  # one row
        found.append(counts.join(F.broadcast(share), F.col("n") > F.col("share")).select(*keys, F.ceil(F.col("n") / F.col("share")).cast("int").alias(salts)))
    return found[0].join(found[1], list(keys), "full").na.fill(1, ["b_salts", "c_salts"])


def _dealt_out(b: DataFrame, c: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: a row of a heavy key has one of its side's own salts and meets all of the other side's."""
    heavy = materialise(heavy_keys(b, c, keys), "heavy", keep=True)
    if heavy.isEmpty():
        return b.withColumn("salt", F.lit(0)), c.withColumn("salt", F.lit(0))

    def salted(rows: DataFrame, mine: str, other: str, number: Callable[[Column, Column], Column]) -> DataFrame:
        rows = rows.join(F.broadcast(heavy), list(keys), "left").na.fill(1, ["b_salts", "c_salts"])  # at most 2 * SHARES rows
        own = F.pmod(F.xxhash64("id"), F.col(mine)).cast("int")
        every = F.transform(F.sequence(F.lit(0), F.col(other) - 1), lambda x: number(own, x))
        return rows.withColumn("salt", F.explode(every)).drop("b_salts", "c_salts")

    of_pair = lambda i, j: i * F.col("c_salts") + j  # noqa: E731  of a row with salt i of the base's and one with j of the competitor's
    return salted(b, "b_salts", "c_salts", of_pair), salted(c, "c_salts", "b_salts", lambda own, x: of_pair(x, own))


#: What a match depends on: products that agree in these are one class.
CLASS = ("run_id", "brand_norm", "name_norm", "volume_norm", "tokens")
_MATCH = (
    "run_id", "base_sku", "competitor_sku", "brand_norm", "name_norm", "volume_norm", "base_price", "competitor_price",
    "base_was_price", "competitor_was_price", "price_delta", "price_delta_pct",
)


@dataclass(frozen=True)
class Listed:
    """Matches as rows, one for each."""

    matches: DataFrame

    def rows(self) -> DataFrame:
        return self.matches

    def stored(self) -> DataFrame:
        """As STORED_MATCHES, without its columns that are null."""
        return self.matches

    def counts(self) -> DataFrame:
        """(run_id, n) of the runs that have matches."""
        return self.matches.groupBy("run_id").agg(F.count("*").alias("n"))

    def keys(self) -> DataFrame:
        """The distinct (run_id, brand_norm, name_norm, volume_norm)."""
        return self.matches.select("run_id", "brand_norm", "name_norm", "volume_norm").distinct()

    def competitors(self) -> DataFrame:
        """The distinct (run_id, sku_id) of the competitor's matched products."""
        return self.matches.select("run_id", F.col("competitor_sku").alias("sku_id")).distinct()

    def with_urls(self, base: DataFrame, competitor: DataFrame) -> DataFrame:
        """Matches with base_url and competitor_url, from (run_id, sku_id, url) of both sides."""
        of = lambda df, p: df.select("run_id", F.col("sku_id").alias(f"{p}_sku"), F.col("url").alias(f"{p}_url"))
        return self.matches.join(of(base, "base"), ["run_id", "base_sku"]).join(of(competitor, "competitor"), ["run_id", "competitor_sku"])

    def leading(self, n: int) -> DataFrame:
        """Rows that hold each run's n largest deltas, and few others."""
        return _leading(self.matches, n)


def _leading(priced: DataFrame, n: int) -> DataFrame:
    """The rows of each run whose delta is among its n largest different ones. These are found by values: rows are not sorted."""
    size = F.coalesce(F.abs("price_delta_pct"), F.lit(-1.0))
    values = priced.select("run_id", size.alias("size")).distinct()
    least = top_per_key(values, ["run_id"], [F.col("size").desc()], n).groupBy("run_id").agg(F.min("size").alias("least"))
    return priced.join(F.broadcast(least), "run_id").filter(size >= F.col("least")).drop("least")  # one row for each run


@dataclass(frozen=True)
class Classed:
    """Matches of whole classes: every base product of b_id matches every competitor's of c_id. Copies of a product, however many, are one class,
    so counts, gaps and the largest deltas never see the pairs of copies; only rows() and with_urls() write them out.

    pairs(b_id, c_id, run_id, brand_norm, name_norm, volume_norm, n); base and competitor(id, run_id, sku_id, current_price, was_price). Ids are
    those of a run: two runs may use the same.
    """

    pairs: DataFrame
    base: DataFrame
    competitor: DataFrame

    def rows(self) -> DataFrame:
        return written_out(self.lines(), self.base, self.competitor).select(*_MATCH)

    def stored(self) -> DataFrame:
        """As STORED_MATCHES: pairs of classes, and the products of matched classes."""
        of = lambda p, name: self._matched(p).select(F.lit(name).alias("kind"), "run_id", F.col("id").alias(f"{p}_id"), F.col("sku_id").alias(f"{name}_sku"), F.col("current_price").alias(f"{name}_price"), F.col("was_price").alias(f"{name}_was_price"))
        out = self.pairs.withColumn("kind", F.lit("pair"))
        for rows in (of("b", BASE), of("c", COMPETITOR)):
            out = out.unionByName(rows, allowMissingColumns=True)
        return out

    def counts(self) -> DataFrame:
        return self.pairs.groupBy("run_id").agg(F.sum("n").alias("n"))

    def keys(self) -> DataFrame:
        return self.pairs.select("run_id", "brand_norm", "name_norm", "volume_norm").distinct()

    def competitors(self) -> DataFrame:
        return self._matched("c").select("run_id", "sku_id").distinct()

    def with_urls(self, base: DataFrame, competitor: DataFrame) -> DataFrame:
        """URLs join the products, not their pairs."""
        return written_out(self.lines(), *self.offers(base, competitor))

    def offers(self, base: DataFrame, competitor: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Both sides' products of matched classes with their url, from (run_id, sku_id, url) of both sides."""
        return tuple(self._matched(p).join(urls.select("run_id", "sku_id", "url"), ["run_id", "sku_id"]) for p, urls in (("b", base), ("c", competitor)))

    def leading(self, n: int) -> DataFrame:
        """Of products that differ in nothing but the sku, n of each class and price can lead."""
        found = _leading(self.lines(), n)

        def few(rows: DataFrame, p: str) -> DataFrame:
            wanted = found.select("run_id", F.col(f"{p}_id").alias("id"), F.col(f"{p}_current_price").alias("current_price")).distinct()
            return top_per_key(rows.join(wanted, ["run_id", "id", "current_price"], "left_semi"), ["run_id", "id", "current_price", "was_price"], [F.col("sku_id")], n).drop("rank")

        return written_out(found, few(self.base, "b"), few(self.competitor, "c")).select(*_MATCH)

    def lines(self) -> DataFrame:
        """Pairs of classes with the different prices of both and their delta: what matches are written out from."""
        offers = lambda rows, p: rows.select("run_id", F.col("id").alias(f"{p}_id"), F.col("current_price").alias(f"{p}_current_price"), F.col("was_price").alias(f"{p}_was_price")).distinct()
        price = F.col("b_current_price"), F.col("c_current_price")
        both = self.pairs.drop("n").join(offers(self.base, "b"), ["run_id", "b_id"]).join(offers(self.competitor, "c"), ["run_id", "c_id"])
        return both.withColumns({"price_delta": delta(*price), "price_delta_pct": percent(delta(*price), price[0])})

    def _matched(self, p: str) -> DataFrame:
        """Products of one side whose class has a match."""
        rows, ids = self.base if p == "b" else self.competitor, self.pairs.select("run_id", F.col(f"{p}_id").alias("id")).distinct()
        return rows.join(ids, ["run_id", "id"], "left_semi")


def written_out(lines: DataFrame, base: DataFrame, competitor: DataFrame) -> DataFrame:
    """Every match of lines of classes and prices, from both sides' products(run_id, id, current_price, was_price, and more): their product
    is made by joins and shuffled no more, so disk goes with lines and products, not with matches."""
    out = lines
    for rows, p, name in ((base, "b", "base"), (competitor, "c", "competitor")):
        out = out.join(_named(rows, name), _same(p)).drop(*_OWN).withColumnsRenamed({f"{p}_current_price": f"{name}_price", f"{p}_was_price": f"{name}_was_price"})
    return out.drop("b_id", "c_id")


def from_stored(rows: DataFrame) -> Classed:
    """The matches by class that Classed.stored made rows of; pairs keep `matched_at`."""
    pairs = rows.filter(F.col("kind") == "pair").select("b_id", "c_id", "run_id", "brand_norm", "name_norm", "volume_norm", "n", "matched_at")
    of = lambda p, name: rows.filter(F.col("kind") == name).select(F.col(f"{p}_id").alias("id"), "run_id", F.col(f"{name}_sku").alias("sku_id"), F.col(f"{name}_price").alias("current_price"), F.col(f"{name}_was_price").alias("was_price"))
    return Classed(pairs, of("b", BASE), of("c", COMPETITOR))


_OWN = ("__run", "__id", "__price", "__was")


def _named(rows: DataFrame, name: str) -> DataFrame:
    return rows.withColumnsRenamed({"run_id": "__run", "id": "__id", "current_price": "__price", "was_price": "__was", "sku_id": f"{name}_sku", "url": f"{name}_url"})


def _same(p: str) -> Column:
    """A line's class and prices of one side are those of a product."""
    return (F.col("run_id") == F.col("__run")) & (F.col(f"{p}_id") == F.col("__id")) & (F.col(f"{p}_current_price") == F.col("__price")) & F.col(f"{p}_was_price").eqNullSafe(F.col("__was"))


def line_counts(lines: DataFrame, base: DataFrame, competitor: DataFrame) -> DataFrame:
    """Lines with the number `n` of matches that each stands for."""
    out = lines.withColumn("n", F.lit(1).cast("long"))
    for rows, p in ((base, "b"), (competitor, "c")):
        counts = rows.groupBy("run_id", "id", "current_price", "was_price").agg(F.count("*").alias("__n"))
        out = out.join(_named(counts, "counted"), _same(p)).withColumn("n", F.col("n") * F.col("__n")).drop(*_OWN, "__n")
    return out


def match_classes(snapshots: DataFrame) -> Classed:
    """All matches of products, N to M, by class. Products are stored once with their tokens, and classes with their features, as keys are
    counted before they are joined; names are tested once for each two classes."""
    kept = (*CLASS, "sku_id", "current_price", "was_price")
    products = [_worded(snapshots, r).select(F.lit(r).alias("retailer"), *kept) for r in (BASE, COMPETITOR)]
    products = materialise(products[0].unionByName(products[1]), "products", keep=True)

    def classes(retailer: str) -> DataFrame:
        found = side(products, retailer).groupBy(*CLASS).agg(F.count("*").alias("n"))
        return materialise(_told(found, "n").withColumn("id", F.monotonically_increasing_id()), "features", keep=True)

    def members(retailer: str, known: DataFrame) -> DataFrame:
        named = known.select("id", *(F.col(c).alias(f"__{c}") for c in CLASS))
        same = F.lit(True)
        for c in CLASS:
            same &= F.col(c).eqNullSafe(F.col(f"__{c}")) if c in ("name_norm", "volume_norm") else F.col(c) == F.col(f"__{c}")
        return side(products, retailer).join(named, same).select("id", "run_id", "sku_id", "current_price", "was_price")

    sides = [classes(r) for r in (BASE, COMPETITOR)]
    of = lambda p: {"name": F.col(f"{p}_name_norm"), "type": F.col(f"{p}_type"), "tokens": F.col(f"{p}_tokens"), "telling": F.col(f"{p}_telling")}
    hit = candidate_pairs(*sides).filter(names_match(of("b"), of("c")))
    pairs = hit.select(
        "b_id", "c_id", F.col("b_run_id").alias("run_id"), F.col("b_brand_norm").alias("brand_norm"), F.col("b_name_norm").alias("name_norm"),
        F.coalesce("b_volume_norm", "c_volume_norm").alias("volume_norm"), (F.col("b_n") * F.col("c_n")).alias("n"),
    )
    return Classed(materialise(pairs, "pairs", keep=True), members(BASE, sides[0]), members(COMPETITOR, sides[1]))


def match_products(snapshots: DataFrame) -> DataFrame:
    """All pairs of products that match, N to M, with prices and their delta; the name is the base's."""
    return match_classes(snapshots).rows()


Matches = DataFrame | Listed | Classed


def matches_of(found: Matches) -> Listed | Classed:
    return Listed(found) if isinstance(found, DataFrame) else found


def brand_overlap(snapshots: DataFrame) -> DataFrame:
    """Base rows whose brand the competitor has in the same run."""
    brands = side(snapshots, COMPETITOR).select("run_id", "brand_norm").distinct()
    return side(snapshots, BASE).join(brands, ["run_id", "brand_norm"], "left_semi")


def comparable_counts(snapshots: DataFrame) -> DataFrame:
    return snapshots.filter(comparable()).groupBy("run_id", "retailer").agg(F.count("*").alias("n"))


def match_rates(snapshots: DataFrame, matches: Matches) -> DataFrame:
    """For each run: matches, the comparable base rows of shared brands, shared brands, and the rate in percent.

    The rate may exceed 100, as a product may have several matches; without a denominator it is 0.
    """
    shared = brand_overlap(snapshots)
    counts = shared.groupBy("run_id").agg(F.count(F.when(comparable(), 1)).alias("denominator"), F.count_distinct("brand_norm").alias("brand_overlap"))
    found = matches_of(matches).counts().withColumnRenamed("n", "match_count")
    runs = snapshots.select("run_id").distinct()
    out = runs.join(counts, "run_id", "left").join(found, "run_id", "left").na.fill(0)
    return out.withColumn("match_rate", F.when(F.col("denominator") > 0, percent(F.col("match_count"), F.col("denominator"))).otherwise(F.lit(0.0)))


DELTAS = (
    "run_id", "brand_norm", "name_norm", "volume_norm", "base_price", "base_was_price", "base_url", "competitor_price", "competitor_was_price",
    "competitor_url", "price_delta", "price_delta_pct",
)


def price_deltas(matches: Matches, snapshots: DataFrame) -> DataFrame:
    """Matches with the URLs of both products."""
    return matches_of(matches).with_urls(side(snapshots, BASE), side(snapshots, COMPETITOR)).select(*DELTAS)


def by_delta(deltas: DataFrame) -> DataFrame:
    return deltas.orderBy(F.abs("price_delta_pct").desc(), *(F.col(c) for c in ("base_sku", "competitor_sku", "base_url", "competitor_url") if c in deltas.columns))


#: Matches that are sorted as rows; more are written out in order.
MOST_SORTED = 1 << 22
#: Matches that a task writes out in order, about.
TASK_ROWS = 1 << 21


def sorted_deltas(matches: Matches, snapshots: DataFrame, most: int = MOST_SORTED, task_rows: int = TASK_ROWS) -> DataFrame:
    """price_deltas in the order of by_delta. Many matches by class are written out in order, so that none of them is shuffled or spilled."""
    found = matches_of(matches)
    if isinstance(found, Classed):
        lines, n = found.lines(), found.counts().agg(F.sum("n")).first()[0] or 0
        if n > most:
            return _in_order(lines, *found.offers(side(snapshots, BASE), side(snapshots, COMPETITOR)), -(-n // task_rows)).select(*DELTAS)
    return by_delta(price_deltas(found, snapshots))


def _in_order(lines: DataFrame, base: DataFrame, competitor: DataFrame, tasks: int) -> DataFrame:
    """Rows of written_out, largest delta first, then by base_url and competitor_url.

    A head is a line with one base product. Heads are few beside matches: they are dealt out by ranges of their order, and each range gets
    the competitor's products that its heads ask for, once for each line. A task puts its heads in order and unfolds each into the URLs
    of its products, which are sorted once; heads of one delta and base_url are unfolded together. A base product's matches of one delta are
    one array.
    """
    key, same = ["part", "run_id", "c_id", "c_current_price", "c_was_price"], F.lit(True)
    heads = lines.withColumn("size", F.abs("price_delta_pct")).join(_named(base, "base"), _same("b")).drop(*_OWN, "b_id", "base_sku")
    order = [F.col("size").desc_nulls_last(), F.col("base_url")]
    heads = materialise(heads.repartitionByRange(tasks, *order).withColumn("part", F.spark_partition_id()), "heads", keep=True)  # read twice: ranges are sampled
    asked = heads.select(*key).distinct().join(_named(competitor, "competitor"), _same("c")).select(*key, "competitor_url")
    urls = asked.repartitionById(tasks, F.col("part")).groupBy(*key).agg(F.array_sort(F.collect_list("competitor_url")).alias("urls"))
    for k in key:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}")) if k == "c_was_price" else F.col(k) == F.col(f"__{k}")
    both = heads.repartitionById(tasks, F.col("part")).hint("merge").join(urls.withColumnsRenamed({k: f"__{k}" for k in key}), same)  # broadcast, heads would leave their parts
    told = [c for c in lines.columns if c not in ("b_id", "c_id")]
    lists = both.groupBy("part", "size", "base_url").agg(F.collect_list(F.struct(*told, "urls")).alias("lists")).sortWithinPartitions(*order)
    placed = lambda x, i: F.transform(x["urls"], lambda u: F.struct(u.alias("url"), i.alias("i")))
    merged = F.when(F.size("lists") == 1, placed(F.col("lists")[0], F.lit(0))).otherwise(F.array_sort(F.flatten(F.transform("lists", placed))))
    one = lists.select("base_url", "lists", F.explode(merged).alias("m")).select("base_url", F.col("m.url").alias("competitor_url"), F.col("lists")[F.col("m.i")].alias("l"))
    prices = {f"{p}_{c}_price": f"{name}_{'was_price' if c == 'was' else 'price'}" for p, name in (("b", "base"), ("c", "competitor")) for c in ("current", "was")}
    return one.select("base_url", "competitor_url", *(F.col(f"l.{c}").alias(prices.get(c, c)) for c in told))


def top_deltas(matches: Matches, n: int = 3) -> DataFrame:
    return by_delta(matches_of(matches).leading(n)).limit(n)


def gaps(snapshots: DataFrame, matches: Matches, by: str = "key") -> DataFrame:
    """Reportable competitor rows without a match.

    by="key" compares brand, name and volume, where matches hold the base's name: a product matched by tokens under another name still
    shows up. by="sku" looks for the product itself.
    """
    rows = side(snapshots, COMPETITOR).filter(reportable())
    if by == "sku":
        missing = rows.join(matches_of(matches).competitors(), ["run_id", "sku_id"], "left_anti")
    elif by == "key":
        missing = rows.join(matches_of(matches).keys(), ["run_id", "brand_norm", "name_norm", "volume_norm"], "left_anti")
    else:
        raise ValueError("by is key or sku")
    return missing.select("run_id", "sku_id", "brand_norm", "name_norm", "volume_norm", "current_price", "was_price", "url")


def promotions(snapshots: DataFrame) -> DataFrame:
    rows = side(snapshots, COMPETITOR).filter(on_promotion() & reportable())
    off = F.col("was_price") - F.col("current_price")
    return rows.select("run_id", "sku_id", "brand_norm", "name_norm", "volume_norm", "current_price", "was_price", off.alias("discount_amount"), percent(off, F.col("was_price")).alias("discount_pct"), "url")


def overlap_by_brand(snapshots: DataFrame) -> DataFrame:
    """Distinct products of both sides for each shared brand; each side is aggregated before the join."""
    count = lambda r: side(snapshots, r).groupBy("run_id", "brand_norm").agg(F.count_distinct("sku_id").alias(f"{r}_skus"))
    return count(BASE).join(count(COMPETITOR), ["run_id", "brand_norm"])


def skus_per_brand(snapshots: DataFrame, top: int | None = None) -> DataFrame:
    counts = snapshots.groupBy("run_id", "retailer", "brand_norm").agg(F.count("*").alias("skus"))
    return counts if top is None else counts.orderBy(F.col("skus").desc(), "run_id", "retailer", "brand_norm").limit(top)
