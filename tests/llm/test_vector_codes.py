"""Vector codes against exhaustive search in plain integers and against SQL, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from shelfspark.llm.registry import oracle_sql, queries
from shelfspark.llm.vector_codes import compress_vectors, distances, far_apart, nearest

SMALL = "/root/testdata/sf0.001"


def brute(rows, parts=4, entries=256, rounds=4):
    """rows(vec_id, vector, label) in the order of ids -> code, error and label_error of each, and the digest."""
    kept = [(i, v, c) for i, v, c in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [[math.floor(1024 * x) for x in v] for _, v, _ in kept]
    size = len(ints[0]) // parts
    cut = [[v[k * size : (k + 1) * size] for k in range(parts)] for v in ints]
    books = [[cut[i][k] for i in range(min(entries, len(cut)))] for k in range(parts)]

    def find(piece, book):
        return min((sum((a - b) ** 2 for a, b in zip(piece, e, strict=True)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            members = defaultdict(list)
            for v in cut:
                members[find(v[k], books[k])[1]].append(v[k])
            for n, found in members.items():
                books[k][n] = [sum(x) // len(found) for x in zip(*found, strict=True)]
    got = [[find(v[k], books[k]) for k in range(parts)] for v in cut]
    error, by = [sum(d for d, _ in g) for g in got], defaultdict(int)
    for (_, _, c), e in zip(kept, error, strict=True):
        by[c] += e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return {(i, "".join(f"{n:02x}" for _, n in g), e, by[c], digest) for (i, _, c), g, e in zip(kept, got, error, strict=True)}


def table_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def found(df):
    return {tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()}


@pytest.mark.parametrize(("entries", "pivots"), [(256, 16), (7, 1), (16, 3)])
def test_codes_against_exhaustive_search(spark, entries, pivots):
    rng = random.Random(entries)
    rows = [(i, [np.float32(rng.gauss(0, 0.3)).item() for _ in range(16)], rng.choice([1, 2, None])) for i in range(150)]
    rows += [(200 + i, rows[3][1], 1) for i in range(40)] + [(300, [0.0] * 16, 2), (301, [-0.0004] * 16, 2)]
    got = found(compress_vectors(table_of(spark, rows), entries=entries, pivots=pivots))
    assert got == brute(rows, entries=entries) and len(got) == len(rows)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    expected = con.sql(f"SELECT vec_id, code, error, label_error, codebooks_sha256 FROM ({oracle_sql()['op11_vector_codes']})").fetchall()
    assert found(queries()["op11_vector_codes"](spark, SMALL)) == set(expected) and len(expected) == 500


def test_pivots_prune_and_ties_go_to_the_lower_entry():
    rng = np.random.default_rng(4)
    entries = np.repeat(rng.integers(-2000, 2000, (40, 4)), 2, axis=0)  # each entry twice
    parts = np.concatenate([entries[::7], rng.integers(-2000, 2000, (300, 4))])
    pivots = far_apart(entries, 6)
    at, d, tried = nearest(parts, distances(parts, pivots), entries, distances(entries, pivots))
    every = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert (at == every.argmin(1)).all() and (d == every.min(1)).all() and (at % 2 == 0).all()
    assert tried < 0.5 * every.size


def test_awkward_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, None, 1), (2, [], 1), (3, [nan] * 4, 1), (4, [inf, 0.0, 0.0, 0.0], 1), (5, [1.0, None, 2.0, 3.0], 1), (None, [1.0, 2.0, 3.0, 4.0], None), (6, [1.0, 2.0, 3.0, 4.0], None),
        (6, [1.0, 2.0, 3.0, 4.0], None), (7, [1.0, 2.0], 2), (8, [1.0, 2.0, 3.0, 4.0, 5.0], 2),
    ]
    df = spark.createDataFrame([(*r, "c", 9, "x") for r in rows], "vec_id long, embedding array<double>, label int, code string, error int, `a``b` string")
    out = compress_vectors(df, entries=3).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"]) for r in out) == [(False, 2), (False, 6), (False, 6), (False, 7), (False, 8), (True, None)]
    assert {len(r["code"]) for r in out} == {8} and len({r["codebooks_sha256"] for r in out}) == 1 and {r["a`b"] for r in out} == {"x"}
    assert len({(r["code"], r["error"]) for r in out if r["embedding"] == [1.0, 2.0, 3.0, 4.0]}) == 1
    assert compress_vectors(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="too large"):
        compress_vectors(table_of(spark, [(1, [1e30] * 4, 1)]))


def test_labels_beyond_the_broadcast_bound(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], None if i % 3 == 0 else i % 7) for i in range(60)]
    df = table_of(spark, rows)
    expected = found(compress_vectors(df, entries=8))
    monkeypatch.setattr("shelfspark.llm.vector_codes.BROADCAST_ROWS", 0)
    assert found(compress_vectors(df, entries=8)) == expected
