"""Conversation repair: against a search over all edits and SQL, many chunks, nulls, ties, repeats, empty tables."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import ordered, repair
from tidemark.llm.common import Scratch, table

SCHEMA = "conv_id long, turn long, role string, text string, conv int, pos string"  # the last two clash with inner names
LEGAL = re.compile("(s?(ua)+)?")


def all_edits(rows):
    """(cost, audit, repaired) of the cheapest, then ASCII-least edits of (role, text, must_go, truncated) rows, by a
    search over whole edit strings in order of (cost, audit)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, said = heapq.heappop(heap)
        if i == len(rows) and LEGAL.fullmatch(initials):
            return cost, audit, "\n".join(f"{r}:{t}" for r, t in said)
        state = (i, initials[-1:], len(initials) > 0)
        if state in seen:  # equal states are left alike, and the first came cheapest and least
            continue
        seen.add(state)
        ways = [("I", 2, i, r, "") for r in ("user", "assistant")]
        if i < len(rows):
            role, text, must_go, truncated = rows[i]
            ways.append(("D", 3, i + 1, None, None))
            if not must_go:
                ways += [("K", truncated, i + 1, role, text)] + [("R", 2 + truncated, i + 1, r, text) for r in ("user", "assistant")]
        for letter, more, to, role, text in ways:
            new = initials + (role[:1] or "?") if role is not None else initials
            if any(LEGAL.fullmatch(new + rest) for rest in ("", "a", "ua")):
                heapq.heappush(heap, (cost + more, audit + letter, to, new, said + ((role, text),) if role is not None else said))


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        stripped = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        kind = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(kind)
    return out


def brute(rows, every):
    """Report rows of damaged (conv_id, turn, role, text) rows, for the conversations ``every``."""
    out = []
    for conv in every:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        kinds = faults([(r[2], r[3]) for r in mine])
        cost, audit, text = all_edits([(r[2], r[3], k in ("blank", "duplicate"), int(k == "truncated")) for r, k in zip(mine, kinds)])
        turns = {r[1] for r in mine if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(mine)]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        row = (conv, turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
        out += [row] * (2 if k == 3 else 1)
    return out


def test_tables_match_a_search_over_all_edits():
    rng = random.Random(1)
    kinds = [("x", "t", True, 0)] + [(r, "t", False, k) for r in ("s", "u", "a", "x") for k in (0, 1)]
    cases = [c for n in range(4) for c in itertools.product(range(9), repeat=n)] + [rng.choices(range(9), k=rng.randint(4, 14)) for _ in range(600)]
    for block in (1, 3):
        known = repair.Tables(block)
        for case in cases:
            symbols = np.array([k + 1 for k in case], np.int64)
            letters, state = known.trace(symbols, 0, 0)
            audit = letters + "I" * repair.last_inserts(state)
            before, added, leave = known.summary([symbols])
            cost = int(added[0, 0]) + known.vectors[before[0, 0]][0]
            assert (cost, audit) == all_edits([kinds[k] for k in case])[:2], case
            assert leave[0, 0, 0] == state


def odd_rows(seed=2):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    texts = ["Yes.", "No", "", " \t", None, "Why?\n ", "é!", "x" * 3000, ". a"]
    rows = [(c, rng.choice([None, *range(9)]) if rng.random() < 0.3 else t, rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], rng.choice(texts))
            for c in range(40) for t in range(rng.randint(1, 10))]
    rows += [(77, t, ("user", "assistant")[t % 2 if rng.random() < 0.8 else 0], f"t{t}" + rng.choice([".", "", "?"])) for t in range(300)]
    return rows + [(None, t, "user", "a.") for t in (None, 1, 2)] + [(78, t, None, None) for t in range(4)]


def report(spark, df):
    found, turns = repair.repair(df, Scratch(spark, "t"))
    rows = found.join(repair.digests(turns), "conv", "left").collect()
    empty = hashlib.sha256(b"").hexdigest()
    return sorted(((None if r.conv == " " else int(r.conv), *list(r)[1:8], r.repaired_sha256 or empty) for r in rows), key=str)


@pytest.mark.parametrize("bits", [12, 2])
def test_repair_matches_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(ordered, "CHUNK_BITS", bits)  # 2: a chunk is four rows
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in odd_rows()]
    df = spark.createDataFrame([(*r, 1, "x") for r in odd_rows()], SCHEMA).repartition(3)
    assert report(spark, df) == brute(rows, {r[0] for r in rows})


def test_query_matches_brute_force_and_sql(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = brute(damage(rows), {r[0] for r in rows})
    assert sorted((tuple(r) for r in repair.query(spark, SF_SMALL).collect()), key=str) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    assert sorted(con.execute(repair.ORACLE).fetchall(), key=str) == want


def test_query_on_odd_rows(spark, tmp_path):
    rows = odd_rows(seed=3)
    gone = next(c for c in range(100, 10_000) if zlib.crc32(f"{c}:5".encode()) % 20 == 0)
    rows += [(gone, 5, "user", "lost.")]  # no row is left of it
    spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    want = brute(damage(rows), {r[0] for r in rows})
    assert sorted((tuple(r) for r in repair.query(spark, str(tmp_path)).collect()), key=str) == want
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/empty/conversations.parquet")
    assert repair.query(spark, f"{tmp_path}/empty").count() == 0


def test_repaired_turns_come_in_order(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "More."), (1, 2, "tool", "x."), (1, 3, "assistant", "End.")]
    _, turns = repair.repair(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), Scratch(spark, "t"))
    got = [(r.place, r.edit, r.turn, r.role, r.text) for r in turns.collect()]
    assert [g[0] for g in got] == list(range(1, len(got) + 1))
    assert LEGAL.fullmatch("".join(g[3][0] for g in got))
    assert [(g[2], g[4]) for g in got if g[1] != "I"] == [(k, t) for _, k, _, t in rows if (k, t) in {(g[2], g[4]) for g in got}]
