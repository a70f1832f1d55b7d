"""Near duplicates, repeated byte strings, components: against brute force, nulls, ties, repeats, empty tables."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import neardup, suffixdedup
from tidemark.llm.common import Scratch
from tidemark.llm.components import connected_components

SCHEMA = "doc_id long, text string, node int, hits string"  # the last two clash with inner names
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_sets(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) >= words:
        return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1))
    return frozenset([tuple(w)] if w else [])


def brute_groups(rows, words, percent=80):
    """{row number: least id of its group} for (doc_id, text) rows with unique ids."""
    sets = [brute_sets(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    return [min(groups[root(i)]) for i in range(len(rows))], [len(s) for s in sets]


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t\n ", "one", "ONE", "one two", "One  TWO", "é è"]
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(6, 120))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    texts.append(" ".join(rng.choices(words, k=30_000)))
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("words,small", [(2, 64), (5, 64), (2, 1)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, words, small):
    monkeypatch.setattr(neardup, "SMALL_BUCKET", small)  # 1: every open bucket goes through families
    monkeypatch.setattr(neardup, "BLOCK", 5)
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in neardup.near_duplicates(df, words).collect()}
    groups, sizes = brute_groups(rows, words)
    assert got == {i: (g, n) for (i, _), g, n in zip(rows, groups, sizes)}


def test_near_duplicates_of_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(5, text, 1, ""), (5, text, 1, ""), (None, text + " x", 1, ""), (5, "other one here", 1, ""),
                                (None, None, 1, "")], SCHEMA)
    got = sorted(((r.doc_id, r.component_id, r.n_shingles) for r in neardup.near_duplicates(df, 2).collect()), key=str)
    assert got == sorted([(5, 5, 49), (5, 5, 49), (None, 5, 50), (5, 5, 2), (None, None, 0)], key=str)
    assert neardup.near_duplicates(df.limit(0), 2).count() == 0
    assert neardup.deduplicated(df, 2).columns == df.columns


def test_many_rows_without_an_id(spark):
    rng = random.Random(7)
    base = [" ".join(f"{x}{rng.randrange(10 ** 6)}" for _ in range(40)) for x in range(100)]
    rows = [(None, t) for t in base] + [(None, t + " one more") for t in base] + [(None, base[0])] * 30
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(3)
    assert len(neardup.deduplicated(df, 2).collect()) == 100
    sets = neardup._describe(df, 2)
    assert sets.select("node").distinct().count() == 200


def test_one_row_of_each_group_stays(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(50)) for x in "abcd")
    rows = [(3, a), (5, a), (5, b), (7, c), (7, c), (None, c + " x"), (None, d), (None, d), (None, d + " x"), (None, None),
            (None, None), (9, ""), (9, "")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(3)
    got = [(r.doc_id, r.text) for r in neardup.deduplicated(df, 2).collect()]
    last = [t for i, t in got if i is None and t]
    assert len(last) == 1 and last[0] in (d, d + " x")
    want = [(3, a), (5, b), (7, c), (None, last[0]), (None, None), (None, None), (9, ""), (9, "")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert neardup.deduplicated(df.limit(0), 2).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1200)]
    edges = path + star + [(7, 7), (None, 3)] + path[:20]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long")
    got = dict(connected_components(df, Scratch(spark, "t")).collect())
    assert got == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1200)}
    assert connected_components(df.limit(0), Scratch(spark, "t")).count() == 0


def brute_repeats(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def repeat_rows():
    rng = random.Random(3)
    letters = "abcdefghij \n"
    passage = ["".join(rng.choices(letters, k=k)) for k in (399, 400, 401, 900, 60)]
    fresh = lambda k: "".join(rng.choices(letters, k=k))
    texts = ["a" * 1500, "ab" * 700, None, "", "xyz" * 200 + "q" * 399, "q" * 399 + "zz", "é" * 300, "w" + "é" * 300 + "v",
             "hello" * 100, "hello" * 100, "hello" * 100 + "tail"]
    for _ in range(30):
        texts.append(fresh(rng.randint(0, 600)) + rng.choice(passage) + fresh(rng.randint(0, 300)) + rng.choice(passage))
    ids = [None, 7, 7] + list(range(len(texts) - 3))
    return list(zip(ids, texts))


@pytest.mark.parametrize("hot,bucket", [(2000, 3000), (2, 4)])
def test_repeated_strings_match_brute_force(spark, monkeypatch, hot, bucket):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    monkeypatch.setattr(suffixdedup, "BUCKET_ROWS", bucket)
    rows = repeat_rows()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    got = sorted((tuple(r)[:5] for r in suffixdedup.deduplicated(df).collect()), key=str)
    want = brute_repeats([(t or "").encode() for _, t in rows], 400)
    assert got == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=str)


def test_repeated_strings_of_an_empty_table(spark):
    assert suffixdedup.deduplicated(spark.createDataFrame([], SCHEMA)).count() == 0
