"""Conversation repair against a search through all edit sequences, against SQL, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import duckdb
import pytest

from shelfspark.llm import repair
from shelfspark.llm.registry import oracle_sql, queries
from shelfspark.llm.repair import apply_repairs, damage, digests, plan_repairs, repair_report

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def cheapest(rows):
    """(cost, audit, repaired rows) by trying every edit of rows (role, text, fault) on the spelled initials; no tables."""

    def fits(new, last):
        return new == {"": "u", "s": "u", "a": "u", "u": "a"}[last] or (new == "s" and last == "")

    @cache
    def best(i, last, inserts):
        """From row i on, after a row whose initial is last and so many inserted ones in a row."""
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def after(cost, edit, role, text, k, n):
            more, edits, kept = best(k, role[:1], n)
            found.append((cost + more, edit + edits, ((role, text), *kept)))

        role, text, fault = rows[i] if i < len(rows) else ("", "", "end")
        late = 5 * (fault == "truncated")
        for new in ("user", "assistant"):
            if fits(new[0], last) and inserts < 2:
                after(5, "I", new, "", i, inserts + 1)
            if fits(new[0], last) and fault not in ("blank", "duplicate", "end"):
                after(1 + late, "R", new, text, i + 1, 0)
        if role and fits(role[0], last) and fault not in ("blank", "duplicate", "end"):
            after(late, "K", role, text, i + 1, 0)
        if fault != "end":
            more, edits, kept = best(i + 1, last, 0)
            found.append((2 + more, "D" + edits, kept))
        return min(found) if found else (1 << 30, "", ())

    cost, audit, out = best(0, "", 0)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    return cost, audit, out


def expected(turns):
    """The contract in plain Python, over damaged (conv_id, turn, role, text)."""
    by = {}
    for c, t, role, text in sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())):
        by.setdefault(c, []).append((t, role, text))
    out = {}
    for c, rows in by.items():
        seen, told = set(), []
        for _, role, text in rows:
            body = text.strip(BLANKS)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            told.append((role, text, fault))
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        count = [sum(f == x for _, _, f in told) for x in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))
        cost, audit, kept = cheapest(tuple(told))
        out[c] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        of = lambda x: " " if x is None else x
        kind, role, text = zlib.crc32(f"{of(c)}:{of(t)}".encode()) % 20, of(role), of(text)
        if kind:
            row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return out


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.select(*COLUMNS).collect()}


NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def odd_rows(seed, n):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "User", "ü"], ["Yes.", "No!", "and", "", " \n", None, "a.b", "x?  ", "Yes."]
    return [(rng.choice([c, None] if c % 9 == 0 else [c]), rng.choice([None, *range(7)]), rng.choice(roles[:3] + roles), rng.choice(texts)) for c in range(n) for _ in range(rng.randrange(1, 9))]


@pytest.mark.parametrize("seed", [1, 2])
def test_reports_against_all_edits(spark, seed):
    rows = odd_rows(seed, 120)
    turns = spark.createDataFrame(rows, TURNS)
    want = {c: NOTHING for c, *_ in rows} | expected(damaged(rows))
    assert sorted(map(repr, damage(turns).collect())) == sorted(repr(r) for r in spark.createDataFrame(damaged(rows), TURNS).collect())
    assert got(repair_report(damage(turns), turns)) == want


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    sql = f"SELECT {', '.join(COLUMNS)} FROM ({oracle_sql()['op12_conversation_repair']})"
    answer = {r[0]: tuple(r[1:]) for r in con.sql(sql).fetchall()}
    assert got(queries()["op12_conversation_repair"](spark, SMALL)) == answer and len(answer) == 20
    rows = odd_rows(3, 60)
    con.execute("DROP VIEW conversations")
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert {r[0]: tuple(r[1:]) for r in con.sql(sql).fetchall()} == {c: NOTHING for c, *_ in rows} | expected(damaged(rows))


@pytest.mark.parametrize("block", [1, 3, 4])
def test_block_tables_against_all_edits(block):
    tables, rng = repair.Tables(block), random.Random(block)
    faults = [None, None, "truncated", "blank"]
    assert len(tables.vectors) < 100
    for _ in range(300):
        rows = tuple((rng.choice(["user", "assistant", "system", "x"]), str(i), rng.choice(faults)) for i in range(rng.randrange(9)))
        symbols = bytes(8 if f == "blank" else "suax".index(r[0]) + 4 * (f == "truncated") for r, _, f in rows)
        assert tables.repair(symbols) == cheapest(rows)[:2]


def test_a_long_conversation_and_copies_across_turns(spark):
    n = 30_000
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}.") for i in range(n)] + [(1, n + i, "user", "t0.") for i in range(500)] + [(2, 0, "user", "q?"), (2, 1, "assistant", "a.")]
    turns = spark.createDataFrame(rows, TURNS)
    plans = plan_repairs(turns)
    by = {r["conv_id"]: r for r in plans.collect()}
    assert (by[1]["duplicate"], by[1]["cost"], by[1]["audit"]) == (500, 1000, "K" * n + "D" * 500) and by[2]["audit"] == "KK"
    fixed = apply_repairs(turns, plans)
    assert fixed.groupBy("conv_id").count().collect() and fixed.filter("conv_id = 1").count() == n
    text = "\n".join(f"{r}:{t}" for _, _, r, t in rows[:n])
    assert {r["conv_id"]: r["repaired_sha256"] for r in digests(fixed).collect()}[1] == hashlib.sha256(text.encode()).hexdigest()


def test_awkward_turns(spark):
    rows = [("a", 1, None, None), ("a", 1, None, None), (None, None, "user", "x" * 50_000 + "."), (None, None, "assistant", "ok."), ("b", 5, "user", "hi.")]
    turns = spark.createDataFrame([(*r, "k", 3, "z") for r in rows], "conv_id string, turn int, role string, text string, audit string, pos int, `h``1` string")
    out = got(repair_report(turns, turns))
    assert out["a"][:7] == (0, 2, 0, 0, 1, 4, "DD") and out[None][5:7] == (2, "RR")
    assert out["b"][5:7] == (2, "D")
    fixed = apply_repairs(turns, plan_repairs(turns))
    assert {(r["conv_id"], r["edit"]) for r in fixed.collect()} == {(None, "R")}
    empty = turns.limit(0)
    assert plan_repairs(empty).count() == 0 and repair_report(empty, empty).count() == 0
    assert got(repair_report(empty, turns)) == {c: NOTHING for c in ("a", "b", None)}
    assert damage(empty).count() == 0
