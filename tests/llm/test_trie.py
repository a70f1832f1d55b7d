"""Prefix tries: against brute force and SQL, long paths over many bands, nulls, ties, repeats, empty tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import ordered, trie
from tidemark.llm.common import Scratch, table

SCHEMA = "conv_id long, turn long, role string, text string, place int, node string"  # the last two clash with inner names
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuild(rows, plain=False):
    """{conv_id: [(role, text)]} of rows (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    if plain:
        return own
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[:h[c]] + own[c][h[c]:] for c in own}


def brute(built):
    members, children = {}, {}
    for c, said in built.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        totals[p] = (sum(totals[k][0] for k in kids) if kids else 1, own + sum(totals[k][1] for k in kids))
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *totals[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def some_rows(seed=4, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(2 * convs), convs):
        rows += [(c, t, rng.choice(["user", "assistant", "", None]), rng.choice(["hi", "é" * 3, "", None, "a,b"]))
                 for t in range(rng.randint(1, 12))]
    rows += [(c, t, "user", f"t{t}") for c in (200, 201, 202, 203) for t in range(40)]  # the same long conversation
    rows += [(300, None, "user", "x"), (300, 1, "user", "y"), (None, 1, "user", "lost"), (300, 1, "user", "y")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("band,bits", [(16, 12), (2, 1), (3, 2)])
def test_trie_of_rebuilt_conversations_matches_brute_force(spark, monkeypatch, band, bits):
    monkeypatch.setattr(ordered, "CHUNK_BITS", bits)  # 1: a chunk is two turns
    monkeypatch.setattr(trie, "CHUNK_BITS", bits)
    rows = some_rows()
    scratch = Scratch(spark, "t")
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    turns = scratch.write(trie.turns_in_order(df, scratch), "turns")
    found = trie.prefix_trie(*trie.rebuilt(turns, scratch), scratch, band)
    assert found.columns == COLUMNS
    assert sorted(tuple(r) for r in found.collect()) == brute(rebuild(rows))


def test_trie_of_plain_conversations(spark):
    rows = some_rows(seed=5, convs=20)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert sorted(tuple(r) for r in trie.trie(df, band=4).collect()) == brute(rebuild(rows, plain=True))
    assert trie.trie(df.limit(0)).count() == 0


def test_query_matches_brute_force_and_sql(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = brute(rebuild(rows))
    assert sorted(tuple(r) for r in trie.query(spark, SF_SMALL).collect()) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    assert sorted(tuple(r) for r in con.execute(trie.ORACLE).fetchall()) == want
