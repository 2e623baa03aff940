"""Keys that contain each other, addresses in bounded pieces, and pages with many or deeply nested prices."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import scope
from shelfspark.sources.pages import _facts
from shelfspark.storage import spread

OFFER = "<div itemprop='offers' itemtype='https://schema.org/Offer'><link itemprop='availability' href='https://schema.org/InStock'>{}</div>"


def test_labels_that_contain_or_are_contained(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    brands = [(word(rng.randrange(1, 9)),) for _ in range(25)]
    labels = [(word(rng.randrange(2, 10)), f"/{i}", i) for i in range(40)]
    got = scope.fuzzy_labels(spark.createDataFrame(brands, "brand string"), spark.createDataFrame(labels, "label string, path string, pos long"), 1000)
    first = {}
    for x, _, pos in labels:
        first.setdefault(x, pos)
    want = {(b, x) for (b,) in brands for x in first if len(x) >= 3 and (x in b or b in x)}
    assert {(r["brand"], r["label"]) for r in got.collect()} == want and len(want) > 50


def test_rows_before_verification_grow_with_the_length_of_keys(spark):
    rows = []
    for n in (50, 100):
        long = spark.createDataFrame([("".join(chr(97 + (i * i + k) % 26) for i in range(n)),) for k in range(20)], "key string")
        index, wanted = scope.key_grams(long, spark.createDataFrame([("abcdefg",), ("xy",), ("q",)], "key string"))
        rows.append(index.count())
        assert wanted.count() == 3 and index.count() <= 3 * n * 20
    assert rows[1] <= 2 * rows[0]


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_pieces_of_addresses(spark, most):
    rows = [("hot", f"u{i:05}") for i in range(500)] + [(f"t{i}", "x") for i in range(20)]
    random.Random(1).shuffle(rows)
    got = scope.urls_by_token(spark.createDataFrame(rows, "token string, url string"), most).collect()
    assert all(len(r["urls"]) <= most for r in got)
    hot = sorted((r["piece"], r["urls"]) for r in got if r["token"] == "hot")
    assert [p for p, _ in hot] == list(range(-(-500 // most))) and [u for _, some in hot for u in some] == [f"u{i:05}" for i in range(500)]
    assert all(len(some) == most for _, some in hot[:-1]) and len(got) == len(hot) + 20
    assert scope.urls_by_token(spark.createDataFrame([], "token string, url string"), most).count() == 0


@pytest.mark.parametrize("piece", ["<meta itemprop='price' content='500'><i>x</i>", "<div><meta itemprop='price' content='500'>"])
def test_pages_take_time_by_their_length(piece):
    def seconds(n):
        page, best = OFFER.format(piece * n), 9.0
        for _ in range(3):
            began = time.thread_time()
            assert len(_facts(page)["prices"]) == n
            best = min(best, time.thread_time() - began)
        return best

    seconds(200)
    assert seconds(4000) < 3 * seconds(2000)


def test_prices_that_do_not_count():
    price = "<meta itemprop='price' content='{}'>".format
    spec = "<div itemprop='priceSpecification'><link itemprop='priceType' href='https://schema.org/{}'><meta itemprop='price' content='900'></div>".format
    cases = {
        price(500) + spec("StrikethroughPrice"): ([500], 900), spec("ListPrice") + price(500): ([500], None),
        f"<p><link itemprop='priceType' href='x/ListPrice'>{price(300)}</p><u>{price(400)}</u>": ([400], None), f"<p><b><link itemprop='priceType' href='x/ListPrice'></b>{price(300)}</p><u>{price(400)}</u>": ([400], None),
        f"<div><span>Цена при авторизации</span>{price(300)}</div><div>{price(350)}</div>": ([350], None), f"<div><b>при авторизации</b>{price(300)}</div>": ([300], None),
        price(5) + price("x") + price(99): ([], None), f"<section><div itemprop='priceSpecification'>{price(300)}</div></section>": ([], None), price(100) + price(1_000_000): ([100, 1_000_000], None),
    }
    for html, (prices, was) in cases.items():
        got = _facts(OFFER.format(html))
        assert ([p["value"] for p in got["prices"]], got["was_price"]) == (prices, was), html
    nested = OFFER.format(OFFER.format(price(700) + "<meta itemprop='priceCurrency' content='usd'>"))
    assert _facts(nested)["prices"] == [{"value": 700, "currency": "usd"}] and _facts("")["prices"] == [] and _facts("</div></p>")["title"] == ""


def test_small_inputs_are_spread(spark):
    one = spark.range(10).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and spread(one).agg(F.sum("id")).first()[0] == 45
    many = spark.range(0, 100, 1, 9)
    assert spread(many) is many


@pytest.mark.parametrize("keys", [(), ("id",)])
def test_a_file_of_one_row_group_is_spread(spark, tmp_path, keys):
    """Its partitions, cut by bytes, are as many as the cores, but one of them has all rows."""
    spark.range(20000).coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        one = spark.read.parquet(f"{tmp_path}/one").select("id")
        sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        assert one.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and sizes(one) == [20000]
        dealt = spread(one, *keys)
        assert sum(sizes(dealt)) == 20000 and sizes(dealt)[-1] <= 20000 * 1.2 / dealt.rdd.getNumPartitions() and dealt.agg(F.sum("id")).first()[0] == 199990000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_longest_prefix_sorts_nothing(spark):
    """The depth is hashed, where tokens as values of an aggregate would be sorted; results are those of a dictionary."""
    import itertools

    from shelfspark.operators import scope

    known = ["a", "a-b", "a-b-c", "b-b", "c", "x-y-z"]
    slugs = ["-".join(x) for n in (1, 2, 3, 4) for x in itertools.product("abcx", repeat=n)] + ["", "-a"]
    rows = spark.createDataFrame([(s, f"u{i % 2}/{s}") for s in slugs for i in (0, 1, 2)], "slug string, url string")
    found = scope.longest_prefix(rows, spark.createDataFrame([(t,) for t in known], "token string"))
    deepest = lambda s: max((t for t in known if s and (s + "-").startswith(t + "-") and t.count("-") < 3), key=len, default=None)
    assert sorted(map(tuple, found.collect())) == sorted((s, f"u{i}/{s}", deepest(s)) for s in slugs for i in (0, 1) if deepest(s))
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_longest_prefix_never_broadcasts_addresses(spark):
    """Were the addresses, here fewer than the tokens, sent to the tasks of the tokens, one task could have to make all rows."""
    rows = spark.createDataFrame([(f"b{i % 7}-x", f"u{i}") for i in range(50)], "slug string, url string")
    found = scope.longest_prefix(rows, spark.createDataFrame([(f"b{i}",) for i in range(1, 5000)], "token string"))
    assert sorted(map(tuple, found.collect())) == sorted((f"b{i % 7}-x", f"u{i}", f"b{i % 7}") for i in range(50) if i % 7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and "BuildRight" in plan


def test_parts_of_one_file_are_dealt_out(spark):
    """A file of parts is one partition however many it has; JSON and prefixes are made from it on all cores."""
    from shelfspark.plans import more_queries

    small = "/root/testdata/sf0.001"
    assert spark.read.parquet(f"{small}/part.parquet").rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
    assert more_queries.sitemap(spark, small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert more_queries.catalogue(spark, small)._jdf.queryExecution().executedPlan().toString().count("RoundRobinPartitioning") >= 2
