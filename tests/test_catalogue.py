"""Catalogue operators: rules restated in plain Python, planted runs, and every registered query against DuckDB."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfspark.functions import text, volume
from shelfspark.functions.tokens import product_type
from shelfspark.functions.vocabulary import SET_OF_VOLUME, TIMES_VOLUME
from shelfspark.operators import history, matching, quality
from shelfspark.plans.ledger import Ledger
from shelfspark.plans.more_oracle import MORE_SQL
from shelfspark.plans.oracle import SQL
from shelfspark.plans.runs import weekly_run
from shelfspark.schema import BASE, COMPETITOR

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", ["snapshots", "null_rates", "document_names", "page_captures", "sheet_counts", "summary_text", "ledger_weeks", "ledger_edits", "ledger_queue", "report_sheets", "scope_of_runs", "aliased_matches", "parsed_pages", "product_types", "gaps_by_key", "rejections", "suggested_thresholds", "run_states", "brand_pool", "fuzzy_labels", "cards_with_variants", "catalogue_products", "microdata_products", "volumes", "iso_weeks", "document_names"])
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    sql = (SQL | MORE_SQL)[name]
    quoted = ", ".join(f'"{c}"' for c in columns)
    norm = lambda rows: sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in rows)
    assert norm(df.select(*columns).collect()) == norm(duck.sql(f"SELECT {quoted} FROM ({sql})").fetchall())


def every(spark, values, *functions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [tuple(r)[1:] for r in df.select("i", *(f(F.col("x")).alias(f"y{k}") for k, f in enumerate(functions))).orderBy("i").collect()]


def test_volumes(spark):
    cases = [
        ("50 мл", "(50,ml,1)", False), ("12,5 г", "(12.5,g,1)", False), ("3 шт x 50мл", "(50,ml,3)", True), ("Set of 3 × 50ml", "(50,ml,3)", True), ("набор пробников", None, True), ("10 шт", None, True), ("", None, False), (None, None, False),
        ("Крем Nutri 100 мл", "(100,ml,1)", False), ("0 мл", None, False), ("5 попугаев", None, False), ("Travel kit 30 ml", None, True),
    ]
    assert every(spark, [c[0] for c in cases], volume.volume_norm, volume.is_multipack) == [c[1:] for c in cases]


def test_slugs(spark):
    cases = {"Estée Lauder": ["estee-lauder"], "Эсте Лаудер": ["este-lauder", "эсте-лаудер"], "L'Oréal Paris": ["loreal-paris"], "Жильет": ["zhilet", "жильет"], "": []}
    assert every(spark, list(cases), text.bilingual_slugs) == [(v,) for v in cases.values()]


def test_folding(spark):
    import unicodedata

    plain = lambda x: "".join(y for y in unicodedata.normalize("NFKD", x.lower()) if not unicodedata.combining(y))
    cases = ["ﬁne ﬂower", "½ l", "Ǆ…", "３５ ｍｌ", "Éa ﬀ №", "plain", "㎡ x", "ё й"]
    assert every(spark, cases, lambda c: text.fold(F.lower(c))) == [(plain(x),) for x in cases]
    letters = [f"a{chr(k)}b" for k in (*range(0xA0, 0x3400), *range(0xFB00, 0xFB50)) if len(text._plain(chr(k))) > 1]
    assert len(letters) > 500 and every(spark, letters, text.fold) == [(text._plain(x),) for x in letters]
    assert every(spark, ["Été — ½ ﬁn!", "A  b\t,c", None], text.normalise_name) == [("ete 1 2 fin",), ("a b c",), ("",)]


def test_folding_of_every_code_point(spark):
    """Against the standard library, a code point and its neighbours at a time; surrogates are no characters."""
    points = [k for k in range(0x20, 0x110000) if not 0xD800 <= k < 0xE000]
    stretches = ["".join(map(chr, points[k : k + 8])) for k in range(0, len(points), 8) if points[k] < 0x31000 or 0xE0000 <= points[k] < 0xE0200]
    assert every(spark, stretches, text.fold) == [(text._plain(x),) for x in stretches]
    assert every(spark, ["한국 café", None, "𝔸𝟙 a"], text.normalise_name, text.slugify, lambda c: text.name_and_slug(c)["name"], lambda c: text.name_and_slug(c)["slug"]) == [
        (*(pair := (text._plain("한국 cafe"), "cafe")), *pair), ("", None, "", None), ("A1 a", "1-a", "A1 a", "1-a"),  # letters without a lower case fold to capitals
    ]


def test_deep_markup_and_missing_pages(spark):
    from shelfspark.sources import pages

    offer = "<div itemprop='offers' itemtype='https://schema.org/Offer'><link itemprop='availability' href='https://schema.org/InStock'><meta itemprop='price' content='500'></div>"
    html = "<h1>" + "<b>" * 5000 + " Name " + "</b>" * 3 + "</h1>" + "<div>" * 5000 + offer
    (got,) = pages.microdata_products(spark.createDataFrame([("https://x/1-a", html), ("https://x/2-b", None)], "url string, html string"), 100).collect()
    assert (got["sku_id"], got["name"], got["current_price"]) == ("1", "Name", 500)
    assert every(spark, [None, "x"], lambda c: pages.page_state(c, F.lit(None).cast("string"))) == [("stale-sku",), ("stale-sku",)]


def test_first_of_a_repeated_key_by_position(spark, tmp_path):
    rows = planted(spark).filter("sku_id = '1'")
    both = rows.withColumns({"name": F.lit("later"), "pos": F.lit(2)}).unionByName(rows.withColumns({"name": F.lit("zfirst"), "pos": F.lit(1)}))
    ledger = Ledger(spark, str(tmp_path))
    assert [r["name"] for r in ledger.append_snapshots(both, 1).collect()] == ["zfirst"]
    assert ledger.append_snapshots(both.withColumn("pos", -F.col("pos")), 1).count() == 1 and ledger.append_snapshots(both, 2).count() == 1


def test_product_types(spark):
    cases = {
        "парфюмерная вода good girl": "perfume_edp", "туалетная вода chrome": "perfume_edt", "парфюмерныи набор": "set", "рефил крем для рук rose": "cream_hands", "крем основа для области вокруг глаз": "foundation_base_eye", "крем nutri": "cream_face",
        "палетка для лица хаилаитер": "palette_highlighter", "свеча ароматическая": "candle", "code": None, "рефил": None, None: None, "тушь для ресниц": "mascara",
    }
    assert every(spark, list(cases), product_type) == [(v,) for v in cases.values()]


PLANTED = "run_id long, retailer string, sku_id string, url string, name string, brand string, brand_norm string, name_norm string, volume_raw string, volume_norm string, multipack_flag boolean, parse_error_flag boolean, current_price long, was_price long, currency string, stock_state string"


def planted(spark, run_id=1):
    def row(side, sku, name, brand="azzaro", vol="(50,ml,1)", price=1000, was=None, stock="IN_STOCK", pack=False):
        url = f"https://x.example/{sku}-{name.replace(' ', '-')}"
        return (run_id, side, sku, url, name, brand, brand, name, "50 ml", vol, pack, False, price, was, "KZT", stock)

    return spark.createDataFrame([
        row(BASE, "1", "chrome aqua"), row(BASE, "2", "chrome united", vol=None), row(BASE, "3", "wanted", price=2000), row(BASE, "4", "gone", stock="DELISTED"), row(BASE, "5", "other", brand="solo"),
        row(COMPETITOR, "11", "chrome aqua", price=1200), row(COMPETITOR, "12", "chrome united", price=900, was=1000), row(COMPETITOR, "13", "wanted extreme", price=1500), row(COMPETITOR, "14", "wanted", price=1500, pack=True), row(COMPETITOR, "15", "lone", vol=None),
    ], PLANTED)


def test_planted_run(spark):
    rows = planted(spark)
    found = matching.match_products(rows)
    assert {(r["base_sku"], r["competitor_sku"], r["price_delta_pct"]) for r in found.collect()} == {("1", "11", 20.0), ("2", "12", -10.0)}
    assert "BroadcastNestedLoopJoin" not in (plan := found._jdf.queryExecution().executedPlan().toString()) and "CartesianProduct" not in plan and "Python" not in plan
    assert matching.match_rates(rows, found).first().asDict() == {"run_id": 1, "denominator": 3, "brand_overlap": 1, "match_count": 2, "match_rate": 66.67}
    assert {r["sku_id"] for r in matching.gaps(rows, found, by="sku").collect()} == {"13"}
    assert [r["discount_pct"] for r in matching.promotions(rows).collect()] == [10.0]


def test_weekly_run_and_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    rows = planted(spark)
    sides = [rows.filter(F.col("retailer") == r) for r in (BASE, COMPETITOR)]
    assert weekly_run(ledger, 1, *sides, "2026-W19", (2, 2, 1)) is None
    assert ledger.status(1) == "success" and ledger.stats(1)["match.count"] == "2" and "Совпало: 2" in ledger.stats(1)["report.summary_text"]
    assert weekly_run(ledger, 2, *sides, "2026-W20", (2, 2, 99)) == "match_count" and ledger.status(2) == "failed"
    ledger.finalize(2)
    assert ledger.status(2) == "failed" and ledger.matches().count() == 4
    ledger.replace_matches(ledger.matches().limit(0), 2)
    assert ledger.matches().filter("run_id = 2").count() == 0 and ledger.matches().count() == 2
    ledger.clone_side(BASE, 1, 3)
    assert ledger.snapshots().filter("run_id = 3").count() == 5
    new = rows.filter("sku_id = '11'").withColumn("sku_id", F.lit("99"))
    ledger.replace_brands(new, 1, COMPETITOR, rows.limit(0))
    assert {r["sku_id"] for r in ledger.snapshots().filter("run_id = 1 AND retailer = 'competitor'").collect()} == {"99"}
    with pytest.raises(ValueError):
        ledger.patch_stats(1, {"x": None})


def test_gates_at_their_edges(spark):
    reason = spark.range(1).select(quality.drift_reason(F.lit(0.5), F.lit(0.5)).alias("a"), quality.drift_reason(F.lit(0.6), F.lit(0.9)).alias("b"), quality.rate(F.lit(0), F.lit(0)).alias("c")).first()
    assert (reason["a"], reason["b"], reason["c"]) == (None, "parser_drift_null_volume_rate", 0.0)
    counts = spark.createDataFrame([("k", 1, 100), ("k", 2, 0), ("k", 3, 100), ("k", 4, 200), ("k", 5, 300), ("k", 6, 9)], "k string, run_id long, n long")
    got = {r["run_id"]: r["suggested"] for r in history.suggested_thresholds(counts, ["k"]).collect()}
    assert got == {1: None, 2: None, 3: None, 4: None, 5: None, 6: None}
    assert {r["run_id"]: r["suggested"] for r in history.suggested_thresholds(counts, ["k"], True).collect()}[5] == int(0.7 * 150)


def test_streamed_captures(spark, tmp_path):
    from shelfspark.schema import PAGE_CAPTURES
    from shelfspark.streaming.ingest import append_stream, fetch_counters, once_per_url, read_captures

    source = str(tmp_path / "in")
    rows = spark.range(20).selectExpr("concat('u', id % 5) url", "200 status", "'t' title", "'h' html", "id % 2 = 0 block", "cast(null as string) block_reason", "id * 100 timing_ms", "timestamp'2026-05-10 14:00:00' + make_interval(0,0,0,0,0,cast(id as int)*10,0) fetched_at")
    rows.selectExpr("url", "status", "title", "html", "block", "block_reason", "timing_ms", "fetched_at").write.parquet(source)
    assert PAGE_CAPTURES.count(" ") >= 8
    query = append_stream(once_per_url(read_captures(spark, source)), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    assert fetch_counters(spark.read.parquet(source)).agg(F.sum("fetches")).first()[0] == 20


def test_volumes_are_searched_once(spark):
    """The parts of a pattern are taken only from texts that have it, and the next pattern is tried where the parts are no volume."""
    texts = ["50 мл", "set of 2 x 30 ml", "3 x 50 мл", "3 x 50 zz", "set of 2 7 zz, 4 x 5 g", "0 x 50 ml", "5 zz 20 ml", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", volume.volume_norm(F.col("t")).alias("v"))
    assert [r["v"] for r in rows.orderBy("i").collect()] == ["(50,ml,1)", "(30,ml,2)", "(50,ml,3)", None, "(5,g,4)", None, "(20,ml,1)", None, None]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert all(f"(?U){pattern})" in plan for pattern in (SET_OF_VOLUME, TIMES_VOLUME))  # extractions have a number after it
