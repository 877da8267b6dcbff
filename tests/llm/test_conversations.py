"""Conversation repair against brute force."""

import hashlib
import itertools
import os
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from orbis.llm import conversation_repair as C, queries  # noqa: E402

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def well_formed(tokens):
    return re.fullmatch(r"(s?(ua)+)?", tokens) is not None


def all_edits(rows, most_inserts):
    """Every repair of (class, fault) rows: (cost, audit, tokens)."""
    options = []
    for c, f in rows:
        own = [(3, "D", "")]
        if f in (0, 3):
            own += [(2 + (f == 3), "R", t) for t in "ua"]
            if c != "?":
                own.append((int(f == 3), "K", c))
        options.append(own)
    inserts = [p for n in range(most_inserts + 1) for p in itertools.product("ua", repeat=n)]
    for edits in itertools.product(*options):
        for ins in itertools.product(inserts, repeat=len(rows) + 1):
            audit, tokens, cost = "", "", 0
            for k, more in enumerate(ins):
                audit += "I" * len(more)
                tokens += "".join(more)
                cost += 2 * len(more)
                if k < len(rows):
                    cost += edits[k][0]
                    audit += edits[k][1]
                    tokens += edits[k][2]
            if well_formed(tokens):
                yield cost, audit, tokens


def by_suffix(rows):
    """The same by recursion over (row, state), for longer conversations."""
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, state, room):
        out = [(0, "")] if i == len(rows) and state in "0a" else []
        more = []
        if room:
            more += [(2, "I", i, step[state, t], room - 1) for t in "ua" if (state, t) in step]
        if i < len(rows):
            c, f = rows[i]
            more.append((3, "D", i + 1, state, 2))
            if f in (0, 3):
                more += [(2 + (f == 3), "R", i + 1, step[state, t], 2) for t in "ua" if (state, t) in step]
                if (state, c) in step:
                    more.append((int(f == 3), "K", i + 1, step[state, c], 2))
        for price, e, j, to, left in more:
            if got := best(j, to, left):
                out.append((price + got[0], e + got[1]))
        return min(out, default=None)
    return best(0, "0", 2)


def as_symbols(rows):
    return bytes(4 * C.CLASSES.index(c) + f for c, f in rows)


def test_parse_against_all_repairs():
    kinds = [(c, f) for c in "sua?" for f in (0, 3)] + [("u", 1), ("a", 2)]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            want = min(all_edits(rows, 2), key=lambda x: x[:2])
            cost, audit, tokens = C.parse(as_symbols(rows))
            assert (cost, audit) == want[:2] == by_suffix(rows), rows
            assert well_formed(tokens.replace("-", "")) and len(tokens) == len(audit)


def test_parse_longer_conversations():
    r = random.Random(4)
    sys.setrecursionlimit(10_000)
    for _ in range(3000):
        rows = tuple((r.choice("suuaaua?"), r.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(r.randint(0, 14)))
        assert C.parse(as_symbols(rows))[:2] == by_suffix(rows), rows
    rows = tuple((r.choice("ua"), r.choice([0, 0, 3, 1])) for _ in range(400))
    assert C.parse(as_symbols(rows))[:2] == by_suffix(rows)


def brute(original):
    """The contract, row by row."""
    convs, ids = defaultdict(list), set()
    blank = lambda x: " " if x is None else x
    for conv, turn, role, text in original:
        ids.add(conv)
        role, text = blank(role), blank(text)
        code = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        for _ in range((code != 0) + (code == 3)):
            convs[conv].append((turn, role, text))
    out = set()
    for conv in ids:
        own = sorted(convs[conv], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, rows = set(), []
        for turn, role, text in own:
            cut = text.rstrip(SPACE)
            fault = 1 if not cut else 2 if (role, text) in seen else 3 if cut[-1] not in ".!?" else 0
            seen.add((role, text))
            rows.append((role[:1] if role[:1] in ("s", "u", "a") else "?", fault))
        cost, audit = by_suffix(tuple(rows))
        turns, n, lines = iter(own), 0, []
        for e in audit:
            row = next(turns) if e != "I" else None
            if e == "D":
                continue
            if e == "K" and row[1].startswith("s"):
                lines.append(f"{row[1]}:{row[2]}")
                continue
            token = ("user", "assistant")[n % 2]
            n += 1
            lines.append(f"{row[1] if e == 'K' else token}:{row[2] if row else ''}")
        known = [t for t, _, _ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        counts = [sum(f == k for _, f in rows) for k in (1, 2, 3)]
        out.add((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def made(r, n=60):
    rows = []
    for conv in range(n):
        for turn in range(r.randint(1, 9)):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "usher", "", None])
            text = r.choice([f"Say {turn}.", "Say it again!", " \t\n", "", None, f"no end {turn}", "x" * 300 + "?",
                             "ends with blanks.  \n", "...", "Fünf?  ", "a.b!c?"])
            rows.append((conv, r.choice([turn, turn, turn, turn + 5, -turn, None]), role, text))
    rows += [(None, None, None, None), (None, 1, "user", "Who?"), (None, 2, "assistant", "No one.")]
    rows += [(n, t, "ua"[t % 2] + "x", f"Turn {t // 3}.") for t in range(700)]           # a long one
    rows += [(n + 1, 3, "user", "The same row.")] * 40
    rows += rows[:30]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


def report(spark, df):
    got = C.repair_report(C.damage(df), df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                           "repaired_sha256"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_report_against_brute_force(spark, seed):
    rows = made(random.Random(seed))
    assert report(spark, frame(spark, rows)) == brute(rows)


def test_turns_are_the_repaired_conversations(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Hello."), (1, 2, "user", "And now?"), (1, 3, "tool", "Well."),
            (2, 0, "system", "Be brief."), (3, 0, "user", " ")]
    df = frame(spark, rows).withColumns({"pos": C.F.lit(1), "uid": C.F.lit(2), "digest": C.F.lit("x")})
    plan, turns = C.repair_conversations(df)
    assert {(r.conv_id, r.cost, r.audit) for r in plan.collect()} == {(1, 7, "KDIKR"), (2, 3, "D"), (3, 3, "D")}
    assert sorted((r.pos, r.edit, r.role, r.text) for r in turns.collect()) == [
        (0, "K", "user", "Hello."), (1, "I", "assistant", ""), (2, "K", "user", "And now?"),
        (3, "R", "assistant", "Well.")]


def test_empty_and_dropped(spark):
    assert report(spark, frame(spark, [])) == set()
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert report(spark, frame(spark, [(gone, 0, "user", "Hi.")])) == {(gone, 0, 0, 0, 0, 0, 0, "", empty)}


def test_query_against_brute_force_and_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    df = queries.QUERIES["op12_conversation_repair"](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert len(got) == 100 and set(got) == brute(rows)
    sql = queries.ORACLE_SQL["op12_conversation_repair"]
    assert set(con.sql(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()) == set(got)
