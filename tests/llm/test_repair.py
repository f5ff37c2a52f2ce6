"""Conversation structure repair against all edits of small conversations, against SQL, and over chunks."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from storyloom.llm import repair
from storyloom.llm.queries import ORACLES

KIND = "conv_id long, turn long, role string, text string"
TEXTS = ["Hello.", "Well?", "cut off", "Hello.", "", " \n", "\u2003", None, "Yes!\n ", "a\nb. c"]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "unknown"]


def table(seed, conversations=30, most=7):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        turns = sorted(rng.sample(range(12), rng.randrange(1, most)))
        rows += [(c, t, rng.choice(ROLES), rng.choice(TEXTS)) for t in turns]
    odd = [(None, 0, "user", "x."), (None, None, "assistant", "y."), (90, None, "user", "a."), (90, None, "user", "a."), (90, 3, "user", "a."), (91, -(1 << 63), "user", "."), (91, (1 << 63) - 1, "assistant", "."), (92, 5, "user", None)]
    return rows + odd


def plain_damage(rows):
    out: dict = {}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        out.setdefault(c, [])
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            out[c] += [(t, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    first = lambda t: (t is not None, t or 0)
    return {c: sorted(x, key=lambda r: (first(r[0]), r[1].encode(), r[2].encode())) for c, x in out.items()}


def faults(rows):
    out = []
    for k, (_, role, text) in enumerate(rows):
        body = re.sub(r"[\x20\x09-\x0d]+\Z", "", text)
        out.append("b" if not body else "d" if (role, text) in [r[1:] for r in rows[:k]] else "" if body[-1] in ".!?" else "t")
    return out


INSERTS = [x for n in range(3) for x in itertools.product(("user", "assistant"), repeat=n)]


def all_repairs(rows):
    """(cost, letters, lines) of every way to keep, rerole, delete and insert, two at most in a row, that ends in order."""
    marks = faults(rows)
    ways = [(5 * len(x), "I" * len(x), tuple((r, "") for r in x)) for x in INSERTS]
    for (_, role, text), mark in zip(rows, marks):
        cut = 5 if mark == "t" else 0
        edits = [(2, "D", ())]
        if mark not in ("b", "d"):
            edits += [(cut, "K", ((role, text),)), *((1 + cut, "R", ((r, text),)) for r in ("user", "assistant"))]
        ways = [(c + w, a + e, x + y) for c, a, x in ways for w, e, y in edits]
        ways = [(c + 5 * len(x), a + "I" * len(x), y + tuple((r, "") for r in x)) for c, a, y in ways for x in INSERTS]
        least: dict = {}  # of ways with the same beginning of roles, only the cheapest and least can be the best
        for c, a, x in ways:
            state = "".join(r[:1] or "-" for r, _ in x)
            if re.fullmatch("s?(ua)*u?", state):
                end = (state[:1] == "s" and len(state) == 1, state[-1:])
                least[end] = min(least.get(end, (c, a, x)), (c, a, x), key=lambda w: w[:2])
        ways = list(least.values())
    return min((w for w in ways if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in w[2]))), key=lambda w: w[:2])


def wanted(rows):
    out = []
    for c, x in plain_damage(rows).items():
        turns = [t for t, *_ in x if t is not None]
        marks = faults(x)
        cost, audit, made = all_repairs(x)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(x, x[1:])]
        gap = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, min(gap, (1 << 63) - 1), marks.count("b"), marks.count("d"), marks.count("t"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_repairs_like_all_edits(spark, seed):
    rows = table(seed)
    got = repair.repair(repair.damaged(spark.createDataFrame(rows, KIND)))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == wanted(rows)


def test_all_edits_without_pruning():
    """The brute force above keeps the least way to each end of roles; for two rows it is the least of all."""
    rng = random.Random(1)
    for _ in range(40):
        rows = [(t, rng.choice([r or " " for r in ROLES]), rng.choice([t or " " for t in TEXTS])) for t in range(2)]
        marks, every = faults(rows), []
        for edits in itertools.product(*(["D"] if m in ("b", "d") else ["D", "K", "user", "assistant"] for m in marks)):
            for gaps in itertools.product(INSERTS, repeat=3):
                cost, audit, roles = 0, "", ""
                for k, gap in enumerate(gaps):
                    cost, audit, roles = cost + 5 * len(gap), audit + "I" * len(gap), roles + "".join(r[0] for r in gap)
                    if k < 2:
                        e, role = edits[k], rows[k][1]
                        cost += 2 if e == "D" else (0 if e == "K" else 1) + 5 * (marks[k] == "t")
                        audit += e if e in "DK" else "R"
                        roles += "" if e == "D" else (role[:1] or "-") if e == "K" else e[0]
                if re.fullmatch("(s?(ua)+)?", roles):
                    every.append((cost, audit))
        assert min(every) == all_repairs(rows)[:2]


@pytest.mark.parametrize("size", [1, 2, 5])
def test_chunks_change_nothing(spark, size):
    rng = random.Random(size)
    hot = [(500, t, rng.choice(ROLES), rng.choice(TEXTS) if rng.random() < 0.5 else f"Text {t}.") for t in range(300)]
    rows = table(7, 12) + hot
    got = repair.repair(repair.damaged(spark.createDataFrame(rows, KIND).repartition(3)), chunk_rows=size)
    assert sorted(map(tuple, got.collect()), key=repr) == wanted(rows)
    short = repair.repair(repair.damaged(spark.createDataFrame(rows, KIND)), chunk_chars=7)
    assert sorted(map(tuple, short.collect()), key=repr) == wanted(rows)


def test_repair_query(spark, tmp_path):
    rows = table(11, 60) + [(700, t, "user", "Same.") for t in range(400)] + [(701, 1, "user", "long " * 200_000 + ".")]
    for name, some in (("all", rows), ("none", [])):
        spark.createDataFrame(some, KIND).selectExpr("*", "'own' as n", "1 as seen", "2 as copies", "3 as chunk", "4 as range").write.parquet(str(tmp_path / name / "conversations.parquet"))
        got = repair.op12_structure_repair(spark, str(tmp_path / name))
        c = duckdb.connect()
        c.sql(f"create view conversations as select * from '{tmp_path / name}/conversations.parquet/*.parquet' where conv_id is null or conv_id <> 91")
        want = c.sql(ORACLES["op12_structure_repair"])
        assert sorted(got.columns) == sorted(want.columns)
        rows_of = lambda each, names: sorted(repr(tuple(r[names.index(x)] for x in got.columns)) for r in each)
        assert rows_of((tuple(r) for r in got.collect() if r["conv_id"] != 91), got.columns) == rows_of(want.fetchall(), want.columns)
