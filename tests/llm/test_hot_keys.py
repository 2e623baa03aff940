"""Hot addresses and tokens: the same results whichever way they are joined."""

from __future__ import annotations

from collections import Counter

import pytest

from shelfspark.llm.mixing import mix_sources
from shelfspark.llm.registry import URL_RULES
from shelfspark.llm.url_filter import filter_urls
from tests.llm.test_operators import judged


@pytest.mark.parametrize("rules", [50_000, 0])
def test_hot_addresses_and_tokens(spark, monkeypatch, rules):
    monkeypatch.setattr("shelfspark.llm.url_filter.BROADCAST_RULES", rules)
    urls = [None] * 200 + ["http://example.com/en/1"] * 300 + ["http://a.example.net/de/8"] * 100 + [f"http://h{i}.com/en/{i}" for i in range(80)] + ["http://x.de/"] * 150
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    out = filter_urls(pages, spark.createDataFrame(URL_RULES, "host string, path string, action string")).collect()
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out) == Counter((i, *judged(u)) for i, u in enumerate(urls))


def test_a_source_of_texts_of_one_size(spark, monkeypatch):
    monkeypatch.setattr("shelfspark.llm.common.ROWS_PER_SLICE", 100)
    rows = [(i, f"a{i} b c d", "hot") for i in range(2000)] + [(2000 + i, "x " * (i % 40), None if i % 2 else "other") for i in range(400)]
    out = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    hot = [r for r in out if r["source"] == "hot"]
    assert {r["source_size"] for r in hot} == {8000} and abs(sum(r["taken"] for r in hot) - hot[0]["target"]) <= 4
    assert {r["copies"] for r in hot} <= {1, 2} or {r["copies"] for r in hot} <= {0, 1}  # one rate, rounded down or up
