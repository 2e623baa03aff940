"""Cases at the limits of operators: letters, shares of huge strata, prompts that all items share, large nodes, threads with tables of their own."""

from __future__ import annotations

import threading
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import decontaminate, language, toxicity
from shelfspark.llm.decontaminate import contamination
from shelfspark.llm.near_dup import near_duplicates
from shelfspark.llm.ngrams import PLACES, labelled_sample, sampled, share_of
from shelfspark.storage import materialise, new_path, scratch, settled
from tests.llm.test_operators import brute_contamination


@pytest.mark.parametrize(("text", "letter"), [("½ ²", False), ("①", False), ("Ⅳ", False), ("٣ 12_", False), ("́̀", False), ("日本", True), ("ъ", True), ("1a", True), ("ª", True), ("", False), (None, False)])
def test_what_a_letter_is(text, letter):
    assert language.has_letter(text) is letter


def test_letterless_texts_have_no_language(spark):
    rows = [(i, ("the cat and the dog " if i % 2 else "der Hund und die Katze ") * 5, ("en", "de")[i % 2 == 0]) for i in range(40)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = spark.createDataFrame([(1, "½ ²"), (2, "①"), (3, "Ⅳ"), (4, "́"), (5, "the dog"), (6, "日本")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(odd, model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 4)) and got[5][0] == "en" and got[6][0] != "und"


def test_shares_of_huge_strata():
    for n in (10, 3000, 3000 << 21, 1 << 50):
        assert share_of(3000, n) > 0 and abs(share_of(3000, n) / PLACES * n - min(n, 3000)) < 1
    assert share_of(5, 0) == 0


@pytest.mark.parametrize("strata", [512, 1])
def test_samples_of_strata(spark, monkeypatch, strata):
    monkeypatch.setattr("shelfspark.llm.ngrams.MOST_STRATA", strata)
    rows = spark.range(20_000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    got = {r["y"]: r["count"] for r in sampled(rows, F.col("id"), "y", 3000).groupBy("y").count().collect()}
    assert got[1] == 2000 and 2700 < got[0] < 3300


def test_samples_are_bounded_in_bytes(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.when(F.col("id") % 2 == 0, 1000).otherwise(10).cast("int")).alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    found = labelled_sample(docs, labels, "text", "doc_id", "toxic", 500, most_bytes=50_000)
    got = {r["y"]: (r["n"], r["b"]) for r in found.groupBy("y").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("b")).collect()}
    assert got[1] == (200, 2000) and 25_000 < got[0][1] < 80_000


def test_the_prior_counts_documents():
    text = ["bad bad bad words", "bad", "good words words", None]
    known = np.sort(np.unique(np.concatenate(toxicity.token_hashes(*_worded("bad words")))))
    known = known[known != 0]
    (out,) = toxicity._corpus_counts(known)(iter([pa.RecordBatch.from_arrays([pa.array(text)], names=["text"])]))
    got = dict(zip(np.asarray(out.column("token")).view(np.uint64).tolist(), out.column("n").to_pylist(), strict=True))
    assert got[0] == 4 and sorted(v for k, v in got.items() if k) == [2, 2, 2]  # bad, words, and the first four letters of words


def _worded(text):
    from shelfspark.llm.textbytes import ALNUM, text_chunks, words

    ((_, _, buf, off),) = text_chunks(pa.array([text]))
    s, ln, _ = words(buf, off, ALNUM)
    return buf, s, ln


def test_a_prompt_that_all_items_share(spark):
    prompt = " ".join(f"p{i}" for i in range(40))
    items = [(i, f"{prompt} own{i} " + " ".join(f"q{i}_{j}" for j in range(12))) for i in range(300)]
    rows = [(1, f"a b {prompt} c"), (2, items[7][1]), (3, "p0 p1 p2"), (4, f"{prompt} {prompt}")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    made = []
    real = decontaminate.materialise

    def counted(df, label, keep=False):
        out = real(df, label, keep)
        made.append((label, out.count()))
        return out

    decontaminate.materialise = counted
    try:
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in contamination(docs, bench).collect()}
    finally:
        decontaminate.materialise = real
    assert got == {i: brute_contamination(t, items) for i, t in rows} and len(got[1][2]) == 300
    assert dict(made)["hits"] < 200  # windows, not windows times items


def family(n, shared, own, first=0):
    """n texts with the same words in front and words of their own behind; each second one shares all but two of these with the one before."""
    out = []
    for i in range(n):
        mine = [f"o{first}_{i - 1 if i % 2 and j < own - 2 else i}_{j}" for j in range(own)]
        out.append((first + i, " ".join([f"s{first}_{j}" for j in range(shared)] + mine)))
    return out


def test_a_family_that_fills_nodes_at_all_levels(spark, monkeypatch):
    monkeypatch.setattr("shelfspark.llm.near_dup.NODE_ROWS", 100)
    rows = family(600, 60, 10)  # 0.73 alike, pairs 0.95
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_full_sets_follow_candidates_only(spark, monkeypatch):
    from shelfspark.llm import near_dup

    monkeypatch.setattr(near_dup, "NODE_ROWS", 200)
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 50)
    met = []
    real = near_dup.materialise

    def counted(df, label, keep=False):
        out = real(df, label, keep)
        if label in ("met", "partial"):
            met.append((label, out.count()))
        return out

    monkeypatch.setattr(near_dup, "materialise", counted)
    rows = family(1200, 40, 20)  # 0.48 alike: blocks meet, but few digits agree
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
    assert dict(met).get("met", 0) <= 2 * len(rows)


def test_threads_have_tables_of_their_own(spark):
    import os

    paths, seen, ready, done = {}, [], threading.Event(), threading.Event()

    def slow():
        with scratch(spark):
            paths["slow"] = materialise(spark.range(3), "slow")
            ready.set()
            done.wait(60)
            seen.append(paths["slow"].count())

    t = threading.Thread(target=slow)
    t.start()
    ready.wait(60)
    with scratch(spark):
        materialise(spark.range(2), "fast")
    done.set()
    t.join()
    assert seen == [3]
    with scratch(spark):
        kept = materialise(spark.range(4), "kept", keep=True)
    out, path = settled(spark, lambda: materialise(spark.range(5), "inner", keep=True).filter("id > 0"), "outer")
    assert kept.count() == 4 and out.count() == 4
    folder = os.path.dirname(path).removeprefix("file:").replace("//", "/")
    assert not [d for d in os.listdir(folder) if d.startswith(("inner-", "fast-", "slow-"))] and new_path(spark, "x").startswith("file:")


def test_odd_column_names(spark):
    from shelfspark.llm.common import hide, restore

    df = spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, `a``b.c` string")
    rows, names = hide(df)
    assert restore(rows, names).columns == df.columns
    assert contamination(df, spark.createDataFrame([(1, "x")], "item_id long, text string")).columns[:3] == df.columns
    assert Counter(r["a`b.c"] for r in restore(rows, names).collect()) == Counter(["b"])
