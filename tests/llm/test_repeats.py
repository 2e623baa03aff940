"""Repeated passages against a count of all windows, against SQL, and on awkward rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from shelfspark.llm import repeats
from shelfspark.llm.registry import oracle_sql, queries
from shelfspark.llm.repeats import remove_repeats

SMALL = "/root/testdata/sf0.001"


def brute(texts, window):
    """(n_words, n_removed, spans, kept) of each text."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = sorted({j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)})
        spans = []
        for j in gone:
            if spans and j == sum(spans[-1]):
                spans[-1][1] += 1
            else:
                spans.append([j, 1])
        out.append((len(w), len(gone), tuple(map(tuple, spans)), " ".join(x for k, x in enumerate(w) if k not in set(gone))))
    return out


def found(df):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], tuple(map(tuple, r["spans"])), r["kept"]) for r in df.collect())


@pytest.mark.parametrize(("window", "k", "joined"), [(35, 8, False), (35, 8, True), (6, 2, False), (6, 6, False), (4, 1, True)])
def test_repeats_against_all_windows(spark, monkeypatch, window, k, joined):
    if joined:
        monkeypatch.setattr(repeats, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(repeats, "MOST_BITS", -1)
    rng = random.Random(window * 10 + k)
    few = [f"w{i}" for i in range(4)]
    passage = [f"p{i}" for i in range(3 * window)]
    texts = [" ".join(rng.choice(few) for _ in range(rng.randrange(3 * window))) for _ in range(12)]  # many repeats, overlaps and periods
    for i in range(40):  # cuts of a passage between words of their own: some one word short of a window
        a = rng.randrange(len(passage))
        cut = passage[a : a + rng.choice([window - 1, window, window + 1, 2 * window])]
        texts.append(" ".join([f"a{i}_{j}" for j in range(rng.randrange(4))] + cut + [f"b{i}_{j}" for j in range(rng.randrange(4))]))
    texts += [" ".join(passage).upper(), " ".join(passage)] * 3 + ["\t".join(passage[:window]), "same " * (window + 1), "same " * window, "x y z"]
    got = found(remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), window=window, k=k))
    assert got == Counter((i, *r) for i, r in enumerate(brute(texts, window)))


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    expected = con.sql(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({oracle_sql()['op13_substring_dedup']})").fetchall()
    got = queries()["op13_substring_dedup"](spark, SMALL).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(expected) and sum(r["n_removed"] for r in got) > 0


def test_awkward_texts(spark):
    long = " ".join(f"l{i}" for i in range(30_000))
    texts = [None, "", " \n\t ", "a", long, long + " end", "é " * 36, "x" * 70_000, None, "c d " * 20, "c d " * 20]
    rows = [(i if i % 4 else None, t, "s", "q", "z") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, spans string, `n``t1` string")
    got = found(remove_repeats(df))
    assert got == Counter((r[0], *b) for r, b in zip(rows, brute(texts, 35), strict=True))
    assert remove_repeats(df).columns == ["doc_id", "text", "n`t1", "n_words", "n_removed", "spans", "kept"]
    assert remove_repeats(df.limit(0)).count() == 0 and {r["text"] for r in remove_repeats(df).collect()} == set(texts)


def test_leftmost_least_place_and_span_hashes():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 5, 60).astype(np.uint64)
    for w in (1, 2, 7, 28):
        assert repeats.least_places(x, w).tolist() == [i + int(np.argmin(x[i : i + w])) for i in range(60 - w + 1)]
        h = repeats.span_hash(x, w)
        same = {tuple(x[i : i + w]): h[i] for i in range(60 - w + 1)}
        assert all(same[tuple(x[i : i + w])] == h[i] for i in range(60 - w + 1)) and len(set(same.values())) == len(same)
    assert len(repeats.least_places(x[:3], 7)) == 0 and len(repeats.span_hash(x[:3], 7)) == 0
