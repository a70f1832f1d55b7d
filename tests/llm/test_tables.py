"""WARC, mixing, neighbours, search and the pipeline: against brute force, on odd rows and empty tables."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.llm import ann, mixing, ordered, search, warc
from tidemark.llm.common import SHUFFLE_CLEANUP, Scratch, shuffles_dropped, table

PAGES = "page_id long, url string, html string, digest int, first string"
BLOCK = "WARC/1.1\r\nfoo: bar\r\n\r\n" * 10


def test_captures_survive_writing_and_reading(spark):
    rows = [(1, "http://a b\r\n/x", BLOCK), (2, None, BLOCK), (None, "u", None), (3, "u", ""), (4, "é", "a" * 20_000_000),
            (None, "z", BLOCK), (1, "again", BLOCK), (7, "nul", "\x00" * 200 + "\x1f\x8b"), (8, "s", "short"), (9, "s", "short")]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], PAGES)
    scratch = Scratch(spark, "warc-test")
    path = scratch.path("archives")
    warc.write_archives(df, path, max_captures=3)
    found = scratch.write(warc.read_archives(spark, path, payload=True), "records")
    assert found.count() == 3 * len(rows)
    captures = [r.asDict(recursive=True) for r in warc.assemble(found).collect()]
    assert len(captures) == len(rows)
    got = collections.Counter()
    for c in captures:
        fields = c["metadata"]["fields"] or {}
        response = c["response"]
        assert c["request"]["record_id"] and (response["type"] == "revisit") == (response["payload"] is None)
        if response["payload"] is not None:
            assert hashlib.sha256(response["payload"]).hexdigest() == response["payload_digest"]
        got[fields.get("page_id"), response["type"], fields.get("refers_to_page"), response["payload_bytes"], response["payload_digest"]] += 1
    want = collections.Counter()
    for page, _, html in rows:
        raw = (html or "").encode()
        revisit = html == BLOCK and page != 1
        want[page if page is None else str(page), "revisit" if revisit else "response", "1" if revisit else None, len(raw),
             hashlib.sha256(raw).hexdigest()] += 1
    assert got == want


def test_archives_of_an_empty_table(spark):
    scratch = Scratch(spark, "warc-test")
    path = scratch.path("archives")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.assemble(warc.read_archives(spark, path)).count() == 0


def test_plain_and_broken_archives():
    record = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [bytes(b) for _, b in warc.records(memoryview(record * 2))] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.records(memoryview(record[:-6])))


def mix_rows():
    rng = random.Random(8)
    rows = [(i, " ".join("w" * rng.randint(1, 60)), f"s{i % 4}" if i % 9 else None) for i in range(400)]
    rows += [(1000, "x " * 3000, "tiny"), (1001, "x", "tiny"), (1002, None, "void"), (None, "a b c", "s1"), (5, rows[5][1], rows[5][2])]
    return rows


def brute_targets(sizes, weights):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    budget, clamped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in clamped]
        left = budget - sum(2 * sizes[n] for n in clamped)
        over = [n for n in free if weight[n] * left / sum(weight[f] for f in free) >= 2 * sizes[n]]
        if not over:
            return {n: 2.0 * sizes[n] if n in clamped else weight[n] * left / sum(weight[f] for f in free) for n in names}
        clamped |= set(over)


def test_mix_meets_its_targets(spark):
    rows = mix_rows()
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, source string, size int, key string")
    got = mixing.mix(df, [3, 1, 2]).collect()
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    targets = brute_targets(sizes, [3, 1, 2])
    taken = collections.Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6
        assert r.taken == r.repeats * r["size"] and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for source, target in targets.items():
        smallest = min([r["size"] for r in got if r.source == source and r["size"]], default=0)
        assert abs(taken[source] - target) <= max(smallest, 1500 if source == "tiny" else 30), source
    key = lambda rs: sorted((str(r.doc_id), r["size"], r.taken) for r in rs)
    assert key(mixing.mix(df.repartition(7), [3, 1, 2]).collect()) == key(got)
    whole = mixing.repeated(df, [3, 1, 2])
    assert whole.columns == df.columns and whole.count() == sum(r.repeats for r in got)
    assert mixing.mix(df.limit(0), [3, 1, 2]).count() == 0


@pytest.mark.parametrize("nulls,texts", [(2000, 1), (2000, 2000), (1000, 7)])
def test_rows_that_are_alike_are_decided_one_by_one(spark, monkeypatch, nulls, texts):
    monkeypatch.setattr(ordered, "CHUNK_BITS", 6)
    rows = [(None if i < nulls else i, f"a b c d{i % texts} e f", "one") for i in range(2000)] + [(5000 + i, "x y", "two") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(df, [1, 5]).collect()
    for source in ("one", "two"):
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r["size"] for r in mine)
    tally = lambda rs: collections.Counter((r.doc_id, r["size"], r.taken) for r in rs)
    assert tally(mixing.mix(df.repartition(3), [1, 5]).collect()) == tally(got)
    again = collections.Counter(r.text for r in mixing.repeated(df, [1, 5]).collect())
    assert sum(again.values()) == sum(r.repeats for r in got)


def test_every_source_comes_near_its_target(spark):
    got = collections.defaultdict(list)
    for r in mixing.mix(table(spark, SF_SMALL, "documents"), [3, 1, 2]).collect():
        got[r.source].append(r)
    for rows in got.values():
        least = min(r.repeats for r in rows)
        out = [r["size"] for r in rows if r.repeats == least and r["size"]]
        miss = sum(r.taken for r in rows) - rows[0].target
        assert -max(min(out) / 2, 1) <= miss <= max(r["size"] for r in rows) / 2 or least == 2


def test_mix_ranges_give_the_same_run(spark, monkeypatch):
    rows = [(i, "w " * (1 + i % 7), "one" if i % 3 else "two") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = sorted((r.doc_id, r.taken) for r in mixing.mix(df, [1, 3]).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 40)
    assert one == sorted((r.doc_id, r.taken) for r in mixing.mix(df, [1, 3]).collect())


def test_neighbours_reach_the_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "UNIT_ROWS", 150)
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((20, 16)) * 3
    x = (centers[rng.integers(0, 20, 1200)] + rng.standard_normal((1200, 16))).astype(np.float32)
    x[:300] = x[0]  # a third of equal vectors
    rows = [(int(i), [float(v) for v in row], 1, "c") for i, row in enumerate(x)]
    rows += [(2000, None, 1, "c"), (2020, [0.0] * 16, 1, "c"), (2040, [float("nan")] * 16, 1, "c"), (2060, [1.0] * 3, 1, "c"),
             (2080, [None] + [1.0] * 15, 1, "c"), (None, [1.0] * 16, 1, "c"), (2100, [], 1, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, v string")
    index = ann.Index(df, "vec_id", "embedding", unit_rows=150, leaf_rows=32)
    got = collections.defaultdict(list)
    for r in index.search(index.found.where(F.col("id") % 20 == 0), 20).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    y, hits = x.astype(float), 0
    assert set(got) == set(range(0, 1200, 20))
    for q, found in got.items():
        found.sort()
        scores = y @ y[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(len(y)), -scores))[:20]
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(scores[v] - s) < 1e-9 for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(best.tolist()))
    assert hits / (20 * len(got)) >= 0.95


def test_neighbours_of_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<double>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 2.0]), (20, [5.0, 5.0])], schema)
    index = ann.Index(few, "vec_id", "embedding")
    got = sorted(tuple(r) for r in index.search(index.found.where(F.col("id") % 20 == 0), 20).collect())
    assert got == [(0, 1, 20, 15.0), (0, 2, 20, 5.0), (0, 3, 1, 4.0), (20, 1, 0, 5.0), (20, 2, 1, 4.0)]
    none = ann.Index(few.limit(0), "vec_id", "embedding")
    assert none.search(none.found, 20).count() == 0


def terms(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").translate(lower))


def brute_search(docs, text, k):
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    n, df = len(bags), collections.Counter()
    for _, bag in bags:
        df.update(bag.keys())
    mean = sum(sum(b.values()) for _, b in bags) / n
    out = []
    for i, bag in bags:
        norm = 1.2 * (0.25 + 0.75 * sum(bag.values()) / mean)
        s = sum(c * math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * bag[t] * 2.2 / (bag[t] + norm)
                for t, c in collections.Counter(terms(text)).items() if bag[t])
        if s:
            out.append((-round(s, 9), i))
    return [(i, -s) for s, i in sorted(out)[:k]]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 20_000])
def test_search_matches_brute_force(spark, shard_bytes):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    docs += [(9001, None), (9002, ""), (9003, docs[3][1]), (9004, docs[3][1])]
    asked = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").limit(8).collect()] + [(77, docs[3][1]), (78, ""), (79, None)]
    scratch = Scratch(spark, "search-test")
    frame = spark.createDataFrame([(i, t, 1, "c") for i, t in docs], "doc_id long, text string, shard int, term string")
    index = scratch.write(search.build_index(frame.repartition(3), shard_bytes), "index")
    got = collections.defaultdict(list)
    queries = spark.createDataFrame(asked + [(None, "the")], "query_id long, text string")
    for r in search.search(index, queries, 10, scratch).collect():
        got[r.query_id].append((r["rank"], r.doc_id, r.score))
    for q, text in asked:
        want, found = brute_search(docs, text, 10), sorted(got.get(q, []))
        assert [f[1] for f in found] == [w[0] for w in want], q
        assert all(abs(f[2] - w[1]) < 1e-6 for f, w in zip(found, want))
    assert None not in got
    empty = scratch.write(search.build_index(frame.limit(0)), "index")
    assert search.search(empty, queries, 10, scratch).count() == 0


@pytest.mark.parametrize("share,block", [(40, 8), (12, 1), (0, 4), (1 << 20, 16)])
def test_registered_search_asks_documents(spark, monkeypatch, share, block):
    for name, value in {"DENSE_SHARE": share, "BLOCK": block, "QUERY_BLOCK": 3, "SPAN_QUERIES": 4,
                        "GROUP_BYTES": 300_000, "STEP_QUERIES": 2, "STEP_POSTINGS": 64}.items():
        monkeypatch.setattr(search, name, value)
    monkeypatch.setattr(search.build_index, "__defaults__", (30_000,))
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    got = collections.defaultdict(list)
    for r in search.query(spark, SF_SMALL).collect():
        got[r.query_id].append((r["rank"], r.doc_id, r.score))
    asked = [(i, t) for i, t in docs if i % 20 == 0 and terms(t)]
    assert len(asked) > 5 and set(got) == {i for i, _ in asked}
    for q, text in asked:
        want, found = brute_search(docs, text, 20), sorted(got[q])
        assert [f[:2] for f in found] == [(k + 1, w[0]) for k, w in enumerate(want)], q
        assert all(abs(f[2] - w[1]) < 1e-6 for f, w in zip(found, want))


def test_search_over_long_texts_copies_and_empty_texts(spark):
    rng = random.Random(10)
    words = [f"w{int(rng.paretovariate(0.7)) % 5000}" for _ in range(60_000)]
    docs = [(0, " ".join(words)), (20, " ".join(words[:9000])), (40, "w1 w2 w3"), (41, ""), (42, None)]
    docs += [(100 + i, "w1 w2 w3" if i % 3 else " ".join(words[i * 7:i * 9 + 5])) for i in range(150)]
    asked = [(0, docs[0][1]), (20, docs[1][1]), (40, docs[2][1])]
    scratch = Scratch(spark, "search-test")
    index = scratch.write(search.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), 100_000), "index")
    got = collections.defaultdict(list)
    for r in search.search(index, spark.createDataFrame(asked, "query_id long, text string"), 10, scratch).collect():
        got[r.query_id].append((r["rank"], r.doc_id))
    for q, text in asked:
        assert [f[1] for f in sorted(got[q])] == [w[0] for w in brute_search(docs, text, 10)]


def test_pruning_skips_documents_below_the_threshold(spark):
    docs = [(i, f"the rare{i % 50} " + "of and " * 5) for i in range(1000)]
    row = search.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()[0].asDict()
    shard = search._Searched({c: pa.scalar(bytes(v) if isinstance(v, bytearray) else v) for c, v in row.items()}, 12.0)
    shard.bound()
    query = np.zeros(4, np.int64)
    term = np.r_[np.argsort(-np.diff(shard.cuts))[:3], np.argmin(np.diff(shard.cuts))]
    weight = np.array([0.01, 0.01, 0.01, 3.0])
    _, found, lower, upper = shard._left(query, term, weight, np.array([1.0]), 10)
    assert len(found) == 10 and (lower >= 1).all() and (upper > lower).all()  # of 20 alike the first 10 by id
    assert not len(shard._left(query, term, weight, np.array([9.0]), 10)[0])


def test_search_goes_through_the_groups_in_rounds(spark, monkeypatch):
    rounds = list(search._rounds(940))
    assert [g for at, end in rounds for g in range(at, end)] == list(range(940)) and len(rounds) < 12
    for name, value in {"GROUP_BYTES": 3_000, "QUERY_BLOCK": 2, "SPAN_QUERIES": 4}.items():
        monkeypatch.setattr(search, name, value)
    rng, kept = random.Random(11), []
    docs = [(i, "same words again" if i % 4 == 1 else " ".join(f"w{int(rng.paretovariate(1))}" for _ in range(12))) for i in range(200)]
    docs += [(None, "same words again"), (500, docs[0][1]), (501, docs[40][1]), (3, "same words again")]
    asked = [(i, docs[i][1]) for i in range(0, 200, 40)] + [(1, docs[1][1])]
    scratch = Scratch(spark, "search-test")
    monkeypatch.setattr(scratch, "drop", lambda *frames: kept.extend(frames))
    index = scratch.write(search.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), 500), "index")
    got = collections.defaultdict(list)
    for r in search.search(index, spark.createDataFrame(asked, "query_id long, text string"), 10, scratch).collect():
        got[r.query_id].append((r["rank"], -1 if r.doc_id is None else r.doc_id))
    for q, text in asked:
        want = brute_search([(-1 if i is None else i, t) for i, t in docs], text, 10)
        assert [f[1] for f in sorted(got[q])] == [w[0] for w in want], q
    assert len(kept) >= 5  # the terms and, for each span, a table a round but for the last


def test_search_deals_documents_to_shards_by_kind_and_passes_over_shards_out_of_reach(spark, monkeypatch):
    rng = random.Random(12)
    docs = [(i, " ".join(f"{'abc'[i % 3]}{int(rng.paretovariate(0.8)) % 400}" for _ in range(20 + i % 7))) for i in range(600)]
    docs += [(1000, None), (1001, "")]
    asked = [(i, docs[i][1]) for i in range(0, 600, 20)]
    scratch = Scratch(spark, "search-test")
    index = scratch.write(search.build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), 20_000), "index")
    held = [np.frombuffer(r.doc_ids, np.int64) for r in index.collect()]
    assert sorted(i for ids in held for i in ids) == sorted(i for i, _ in docs)
    assert len(held) > 5 and all(len(set(ids[ids < 1000] % 3)) == 1 for ids in held)
    scored, left = [], search._Searched._left
    monkeypatch.setattr(search._Searched, "_left", lambda self, query, term, weight, least, k: (
        scored.append((len(least), self.n)), left(self, query, term, weight, least, k))[1])
    terms = search._query_terms(spark.createDataFrame(asked, "query_id long, text string"))
    blocks = search._packed(terms, search._frequency(index), 1).toArrow()
    words = sum(len(t.split()) for _, t in docs if t)
    got = {int(q): [int(i) for i in ids[qs == q]] for qs, ids, _ in search._best_of(
        index.toArrow(), blocks.append_column("known", pa.nulls(1)), len(docs), words / len(docs), 10) for q in np.unique(qs)}
    for q, text in asked:
        assert got[q] == [w[0] for w in brute_search(docs, text, 10)], q
    assert sum(n * m for n, m in scored) < 0.4 * len(asked) * len(docs)


def test_search_returns_only_what_comes_before_the_kth_best_so_far(spark):
    texts = spark.createDataFrame([(i, "the same" if i < 30 else f"the other{i}") for i in range(60)], "doc_id long, text string")
    index = search.build_index(texts.coalesce(1))
    row = index.collect()[0]
    assert len(row.docs) == len(row.tfs) == 120 and len(row["counts"]) == 32  # a byte a number
    terms = search._query_terms(spark.createDataFrame([(7, "the same"), (8, "other30")], "query_id long, text string"))
    blocks = search._packed(terms, search._frequency(index), 1)

    def found(known):
        packed = [r.asDict() | {"known": known} for r in blocks.collect()]
        return {int(q): sorted(zip(i[qs == q].tolist(), s[qs == q].tolist()))
                for qs, i, s in search._best_of(index.toArrow(), pa.Table.from_pylist(packed), 60, 2.0, 10) for q in np.unique(qs)}

    every = found(None)
    assert [i for i, _ in every[7]] == list(range(10)) and [i for i, _ in every[8]] == [30]
    score = every[7][0][1]
    assert found([{"query_id": 7, "doc_id": 3, "score": score}]) == {7: every[7][:3], 8: every[8]}
    assert found([{"query_id": 7, "doc_id": -1, "score": score}]) == {8: every[8]}


def test_shuffle_files_go_with_their_job(spark):
    def held():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for d in folders for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}

    rows, scratch, before = spark.range(1000).groupBy(F.col("id") % 7).count(), Scratch(spark, "t"), spark.conf.get(SHUFFLE_CLEANUP)
    with shuffles_dropped(spark):
        start = held()
        written = scratch.write(rows, "rows")
        assert held() <= start
    assert written.count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP) == before


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as pipeline
    from tests.llm.test_dedup import brute_groups

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    kept = pipeline.keep_quality(spark, docs, "/root/testdata/sf0.01")
    kept = Scratch(spark, "t").write(kept, "kept")
    labels = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns
    assert sum(i in ids for i, q in labels.items() if q) >= 0.98 * sum(labels.values())
    assert sum(i in ids for i, q in labels.items() if not q) <= 0.1 * sum(not q for q in labels.values())
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    groups, _ = brute_groups(rows, 5)
    single = Scratch(spark, "t").write(pipeline.drop_near_duplicates(spark, kept, ""), "single")
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups))
    masked = pipeline.mask_secrets(spark, single, "")
    assert masked.columns == docs.columns and masked.count() == single.count()
    assert masked.where(F.col("text").rlike("(password|token) ?= ?\"?[0-9a-f]{12}")).count() == 0
    mixed = pipeline.mix_sources(spark, masked, "")
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().where("count > 2").count() == 0
    coded = pipeline.encode(spark, mixed, "")
    assert coded.count() == mixed.count() and [n for n, _ in pipeline.STAGES][1] == "near_duplicates"


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline as pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    rows = [(1, None, None, None, None, 0.5), (None, "", "en", "a", 0, None), (2, "x y z", "en", "a", 5, 0.1), (2, "x y z", "en", "a", 5, 0.1)]
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = frame
        for _, stage in pipeline.STAGES[:-1]:
            docs = Scratch(spark, "t").write(stage(spark, docs, SF_SMALL), "stage")
            assert docs.columns == frame.columns
        assert pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == docs.count()
