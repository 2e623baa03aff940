"""Candidate pairs by tokens against all pairs of a run and brand, and heavy brands."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from shelfspark.functions.tokens import names_match
from shelfspark.operators import matching, report
from shelfspark.plans.ledger import Ledger
from shelfspark.schema import BASE, COMPETITOR
from tests.test_catalogue import PLANTED

WORDS = ["rose", "aqua", "noir", "intense", "sport", "eau", "gel", "крем", "для", "рук", "набор", "chrome", "united", "50", "123", "x"]


def products(spark, n, seed, brands=("azzaro", "solo", "dior"), half=False):
    rng, rows = random.Random(seed), []
    for side in (BASE, COMPETITOR):
        for i in range(n):
            name = " ".join(rng.sample(WORDS, rng.randrange(5)))
            brand = "azzaro" if half and rng.random() < 0.5 else rng.choice(brands)
            volume = None if rng.random() < (0.8 if half and brand == "azzaro" else 0.3) else rng.choice(["(50,ml,1)", "(30,ml,1)"])
            url = f"https://x.example/{i}-{'-'.join(rng.sample(WORDS[:7], rng.randrange(3)))}"
            rows.append((rng.choice([1, 2]), side, f"{side[0]}{i}", url, name, brand, brand, name or None, "50 ml", volume, False, False, 1000 + i, None, "KZT", "IN_STOCK"))
    return spark.createDataFrame(rows, PLANTED)


def all_pairs(rows):
    """Matches by the name test over every pair of a run and brand with compatible volumes."""
    b, c = (matching._renamed(matching.features(rows, r), p) for r, p in ((BASE, "b"), (COMPETITOR, "c")))
    volumes = (F.col("b_volume_norm") == F.col("c_volume_norm")) | (F.col("b_volume_norm").isNull() != F.col("c_volume_norm").isNull())
    pairs = b.join(c, (F.col("b_run_id") == F.col("c_run_id")) & (F.col("b_brand_norm") == F.col("c_brand_norm")) & volumes)
    of = lambda p: {"name": F.col(f"{p}_name_norm"), "type": F.col(f"{p}_type"), "tokens": F.col(f"{p}_tokens"), "telling": F.col(f"{p}_telling")}
    return pairs, pairs.filter(names_match(of("b"), of("c")))


def ids(df, a, b):
    return sorted((r[0], r[1], r[2]) for r in df.select(*("run_id" if "run_id" in df.columns else "b_run_id",), a, b).collect())


def test_pairs_by_tokens_are_all_pairs(spark):
    rows = products(spark, 150, 1)
    pairs, expected = all_pairs(rows)
    got = matching.match_products(rows)
    assert ids(got, "base_sku", "competitor_sku") == ids(expected, "b_sku_id", "c_sku_id") and got.count() > 100
    sides = [matching.features(rows, r).withColumn("id", F.monotonically_increasing_id()) for r in (BASE, COMPETITOR)]
    tried = matching.candidate_pairs(*sides)
    assert tried.count() < 0.7 * pairs.count() and tried.select("b_id", "c_id").distinct().count() == tried.count()


def test_a_brand_with_half_of_all_rows_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(matching, "LEAST_HEAVY", 10)
    monkeypatch.setattr(matching, "SHARES", 1000)
    rows = products(spark, 250, 2, half=True)
    expected = ids(all_pairs(rows)[1], "b_sku_id", "c_sku_id")
    assert ids(matching.match_products(rows), "base_sku", "competitor_sku") == expected
    seen = []
    real = matching._dealt_out

    def kept(b, c, keys):
        out = real(b, c, keys)
        seen.extend([(side.count(), side.groupBy(*keys, "salt").count().agg(F.max("count")).first()[0], given.groupBy(*keys).count().agg(F.max("count")).first()[0]) for side, given in zip(out, (b, c), strict=True)])
        return out

    monkeypatch.setattr(matching, "_dealt_out", kept)
    matching.match_products(rows)
    for _, largest, before in seen:
        assert largest <= before
    assert any(largest < 0.7 * before for _, largest, before in seen), seen


def copied(rows, n):
    """Each product n times, with skus, prices and stock of its own."""
    k = F.col("k").cast("int")
    again = rows.crossJoin(rows.sparkSession.range(n).withColumnRenamed("id", "k")).withColumns({"sku_id": F.concat("sku_id", F.lit("-"), k.cast("string")), "current_price": F.col("current_price") + k % 3 * 7, "was_price": F.when(k % 2 == 0, F.lit(9999))})
    return again.drop("k")


def test_copies_are_matched_once(spark):
    """Pairs that are tested and stored don't grow with copies, and what follows from matches is that of all pairs of rows."""
    rows = products(spark, 60, 3)
    many = copied(rows, 8).localCheckpoint()
    one, classed = matching.match_classes(rows), matching.match_classes(many)
    assert classed.pairs.count() == one.pairs.count() > 20
    listed = all_pairs(many)[1].select(
        F.col("b_run_id").alias("run_id"), F.col("b_sku_id").alias("base_sku"), F.col("c_sku_id").alias("competitor_sku"), F.col("b_brand_norm").alias("brand_norm"), F.col("b_name_norm").alias("name_norm"),
        F.coalesce("b_volume_norm", "c_volume_norm").alias("volume_norm"), F.col("b_current_price").alias("base_price"), F.col("c_current_price").alias("competitor_price"), F.col("b_was_price").alias("base_was_price"),
        F.col("c_was_price").alias("competitor_was_price"), (F.col("c_current_price") - F.col("b_current_price")).alias("price_delta"), F.round((F.col("c_current_price") - F.col("b_current_price")) * 100.0 / F.col("b_current_price"), 2).alias("price_delta_pct"),
    ).localCheckpoint()
    same = lambda a, b: sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(a.columns)).collect()))
    assert same(classed.rows(), listed) and listed.count() > 64 * 20
    for of in (
        lambda m: matching.match_rates(many, m), lambda m: matching.gaps(many, m), lambda m: matching.gaps(many, m, by="sku"), lambda m: matching.price_deltas(m, many), lambda m: report.sheet_counts(many, m),
        lambda m: report.summary(many, m), lambda m: report.best_deltas(m, 5),
    ):
        assert same(of(classed), of(listed))
    ranked = listed.orderBy(F.abs("price_delta_pct").desc(), "base_sku", "competitor_sku").limit(40).collect()
    for m in (classed, listed):
        assert [(r["base_sku"], r["competitor_sku"], r["price_delta_pct"]) for r in matching.top_deltas(m, 40).collect()] == [(r["base_sku"], r["competitor_sku"], r["price_delta_pct"]) for r in ranked]


def test_sheets_of_copies_are_stored_by_class(spark, tmp_path):
    """What is written of the sheet of deltas grows with products; read back, it has a row for each match, whose texts are guarded."""
    many = copied(products(spark, 60, 3), 24).withColumn("url", F.concat(F.when(F.col("sku_id").endswith("-3"), "=").otherwise(""), "url")).localCheckpoint()
    found, ledger = matching.match_classes(many), Ledger(spark, str(tmp_path))
    folder, _ = ledger.write_sheets(report.sheets(many, found), 1)
    wanted = report.guard_formulas(matching.price_deltas(found, many))
    stored, n = ledger.read_sheets(folder), wanted.count()
    assert sum(rows.count() for name, rows in stored.items() if name.startswith("deltas")) < n / 2 and n > 64 * 20
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(report.whole(stored)["deltas"], wanted) and wanted.filter("base_url LIKE '\\'=%' AND competitor_url LIKE '\\'=%'").count()
    counts = report.sheet_counts(many, found).groupBy("sheet").agg(F.sum("rows").alias("rows"))
    assert same(report.rows_of_sheets(stored), counts) and set(report.whole(stored)) == {"deltas", "gaps", "promotions", "summary"}
    listed, _ = ledger.write_sheets(report.sheets(many, found.rows()), 2)  # matches that are given as rows
    again = ledger.read_sheets(listed)
    assert same(report.whole(again)["deltas"], wanted) and same(report.rows_of_sheets(again), counts)


def test_many_deltas_are_written_out_in_order(spark):
    """The rows and order of a sort, in several parts, but only lines and products are shuffled; deltas may agree, and URLs, too."""
    few = (F.floor(F.col("current_price") / 40) * 40).cast("long")
    many = copied(products(spark, 60, 3), 8).withColumn("current_price", few).localCheckpoint()
    found = matching.match_classes(many)
    wanted, got = matching.by_delta(matching.price_deltas(found, many)), matching.sorted_deltas(found, many, 10, 700)
    plan = got._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("\n") if "Exchange" in line]
    assert "rangepartitioning" not in plan and "SortMergeJoin [part" in plan and shuffled and not any("urls" in line or "size" in line for line in shuffled)
    place = lambda r: (-abs(r["price_delta_pct"]), r["base_url"], r["competitor_url"])
    a, b = wanted.collect(), got.collect()
    assert got.columns == wanted.columns and sorted(map(str, a)) == sorted(map(str, b)) and [place(r) for r in a] == [place(r) for r in b] and len(b) > 64 * 20
    assert len({place(r) for r in b}) < len(b)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and matching.sorted_deltas(found.rows(), many).count() == len(b)
