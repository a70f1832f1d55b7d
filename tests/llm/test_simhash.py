"""SimHash near-dedup: against brute force, crowded cells, nulls, ties, repeats, empty tables."""

from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.llm import simhash
from tidemark.llm.common import Scratch, table

SCHEMA = "doc_id long, text string, point int, cell string"  # the last two clash with inner names


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(points, ids, radius=2):
    parent = list(range(len(points)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(points):
        for j in range(i):
            if bin(a ^ points[j]).count("1") <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, k in enumerate(ids):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return [least.get(root(i)) for i in range(len(points))]


def near_texts(seed=3):
    rng = random.Random(seed)
    base = [rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(400)]
    texts = [None, "", " \t\n", "One", "one", "One  two", "é É", "a b c a b c a b c"]
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(50)}"
        texts.append("\n".join(copy))
    return texts + [" ".join(rng.choices(base, k=70_000))]


@pytest.mark.parametrize("small_cell", [128, 1])
def test_query_shape_matches_brute_force(spark, monkeypatch, small_cell):
    texts = near_texts() + [r.text for r in table(spark, SF_SMALL, "documents").orderBy("doc_id").limit(60).collect()]
    rows = [(k * 2, t, 1, "x") for k, t in enumerate(texts)]
    monkeypatch.setattr(simhash, "SMALL_CELL", small_cell)
    real = simhash.links
    monkeypatch.setattr(simhash, "links", lambda p, r, s: real(p, r, s, small_cell))
    got = {r.doc_id: (r.point % (1 << 64), r.component_id) for r in
           simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    points = [brute_fingerprint(t) for t in texts]
    want = brute_components(points, [r[0] for r in rows])
    assert got == {r[0]: (p, c) for r, p, c in zip(rows, points, want)}
    assert len(set(want)) < len(set(points))  # some different fingerprints are linked


@pytest.mark.parametrize("radius,small_cell", [(1, 128), (2, 128), (2, 1), (2, 4)])
def test_links_of_crowded_cells_match_brute_force(spark, radius, small_cell):
    rng = random.Random(radius)
    points = {0, (1 << 64) - 1, 1 << 63, (1 << 63) - 1}
    for centre in (0, (1 << 64) - 1, rng.getrandbits(64)):
        for _ in range(120):
            flips = rng.sample(range(64), rng.randint(0, 6))
            points.add(centre ^ sum(1 << f for f in flips))
    points |= {1 << b for b in range(64)}  # 65 points within two bits of each other, with zero
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    df = spark.createDataFrame([(p,) for p in signed], "point long")
    found = simhash.links(df, radius, Scratch(spark, "t"), small_cell).collect()
    parent = {p: p for p in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in found:
        assert bin((u ^ v) % (1 << 64)).count("1") <= 2 * radius * 65  # both ends are points of one component
        parent[root(u)] = root(v)
    want = brute_components(points, list(range(len(points))), radius)
    groups = {}
    for p, c in zip(signed, want):
        groups.setdefault(root(p), set()).add(c)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_embedding_bounds_the_distance(spark):
    rng = random.Random(9)
    values = [0, -1, 1 << 62, -(1 << 63)] + [rng.getrandbits(63) - (1 << 62) for _ in range(50)]
    for width in simhash.WIDTHS:
        rows = spark.createDataFrame([(v,) for v in values], "v long").select(
            "v", simhash.embedded(F.col("v"), width).alias("e")).collect()
        for v, e in rows:
            for k in range(0, 64, width):
                assert (e % (1 << 64)) >> k & ((1 << width) - 1) == bin((v % (1 << 64)) >> k & ((1 << width) - 1)).count("1")


def test_null_and_repeated_ids_and_an_empty_table(spark):
    df = spark.createDataFrame([(7, "a b c", 1, ""), (7, "a b c", 1, ""), (None, "A b\nc", 1, ""), (None, "other words", 1, ""),
                                (9, None, 1, ""), (4, "", 1, "")], SCHEMA)
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(7, 7), (7, 7), (None, 7), (None, None), (9, 4), (4, 4)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
