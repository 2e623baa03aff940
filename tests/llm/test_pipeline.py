"""The pipeline's stages: what each keeps, on its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from shelfspark.llm.registry import oracle_sql, queries, table
from tests.llm.test_operators import DOCS, SMALL, brute_components, brute_contamination


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]
    good = steps["quality"](spark, docs, SMALL)
    good = spark.createDataFrame(good.collect(), docs.schema)
    labels = table(spark, SMALL, "labels")
    assert good.columns == columns and good.join(labels.filter("quality = 1"), "doc_id").count() > 0.9 * labels.filter("quality = 1").count()

    single = spark.createDataFrame(steps["near_dedup"](spark, good, SMALL).collect(), docs.schema)
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, _, c in brute_components(rows, 5) if i == c)

    clean = spark.createDataFrame(steps["decontamination"](spark, single, SMALL).collect(), docs.schema)
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    expected = {r["doc_id"] for r in single.collect() for n, hit, _ in [brute_contamination(r["text"], items)] if not (hit and 20 * hit >= n)}
    assert {r["doc_id"] for r in clean.collect()} == expected

    mixed = spark.createDataFrame(steps["mixing"](spark, clean, SMALL).collect(), docs.schema)
    assert mixed.columns == columns and max(Counter(r["doc_id"] for r in mixed.collect()).values()) == 2
    last = steps["sharding"](spark, mixed, SMALL).collect()
    assert len(last) == mixed.count() and {r["shard"] for r in last} <= set(range(16))


def test_stages_on_nothing_and_on_clashing_columns(spark):
    rows = [(1, "the quick brown fox jumps over the lazy dog", "en", "a"), (None, None, None, None), (2, "", "en", "b")]
    docs = spark.createDataFrame([(*r, 0, "s", "q", "h", "w") for r in rows], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, SMALL)
            assert out.count() <= 2 * given.count()
            if name != "sharding":
                assert out.columns == docs.columns


def test_registry(spark):
    q = queries()
    assert [k for k in q if k.startswith("op")] and {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in q if k.startswith("op")} and "pipeline" in q
    assert set(oracle_sql()) <= set(q) and corpus_pipeline.ORACLE_SQL is None
