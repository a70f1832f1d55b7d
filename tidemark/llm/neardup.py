"""MinHash near-dedup: hash minima, banding, verification and connected components (operator 5).

1. Every document becomes the set of its distinct word shingles (64-bit hashes), a 128-bit digest of the set
   and ``BANDS * ROWS`` universal hash minima. Equal sets form one class; only one signature a class goes on.
2. Bands: classes that agree in all rows of a band share a bucket. In each bucket every class is paired with
   the bucket's least class, so a bucket of any size gives as many pairs as classes.
3. Pairs whose signatures agree in too few places go; the rest are confirmed on the full sets.
4. Connected components by alternating large-star and small-star.
5. Buckets that still hold several components: in those of at most ``SMALL_BUCKET`` classes, all pairs of
   different components are confirmed like the others. Larger ones are joined to families (components of
   the graph of classes and buckets); a family is cut into blocks of about ``BLOCK`` classes, and each pair
   of blocks is one task's work, which holds two blocks of signatures and sets. It tests pairs of different
   components, the most similar signatures first, skips what its own links have joined, and puts out links
   alone. So every two classes that share a bucket end up tested or in one component, and no group's
   pairs are ever rows.

At 80 % similarity a pair shares no bucket with probability (1 - 0.8^5)^32, about 3e-6.

Nulls and edge cases: a null text or one without words has no shingles and is linked with nothing; a text
with fewer words than a shingle has one shingle, all its words. Rows with equal ids each get a result; a
null id gets its group's component, and ``kept`` false. Very long texts are taken whole. Other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, NOT_SPACE, Scratch, doc_chunks, mix64, span_hashes, table, word_spans
from tidemark.llm.components import connected_components

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: signatures of two sets at 80 % similarity agree in fewer places with a probability below 1e-9
SIGNATURE_LEAST = 0.6
SMALL_BUCKET = 64
BLOCK = 384

_rng = np.random.default_rng(5)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a run of texts."""
    n = len(offs) - 1
    starts, ends, row = word_spans(data, offs, NOT_SPACE)
    h = span_hashes(data, starts, ends, LOWER)
    cuts = np.searchsorted(row, np.arange(n + 1))
    joined = mix64(h.copy())
    for k in range(1, words):
        joined[:len(h) - k] = mix64(joined[:len(h) - k] * np.uint64(0x9E3779B97F4A7C15) + h[k:])
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(joined[a:b - words + 1]))
        elif b > a:
            one = mix64(h[a:a + 1])
            for k in range(a + 1, b):
                one = mix64(one * np.uint64(0x9E3779B97F4A7C15) + h[k:k + 1])
            out.append(one ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Hash minima (uint32, one row a set) of not empty sets: the high halves of a * x + b modulo 2^64."""
    flat = np.concatenate(sets) >> np.uint64(32)
    starts = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    out = np.empty((len(sets), HASHES), np.uint32)
    block = 1 << 15  # values at once, so that the work stays in the processor's cache
    lo = 0
    while lo < len(sets):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + block, "right")) - 1)
        end = int(starts[hi]) if hi < len(sets) else len(flat)
        part, at = flat[starts[lo]:end], starts[lo:hi] - starts[lo]
        work = np.empty(len(part), np.uint64)
        for k in range(HASHES):
            np.multiply(part, _A[k], out=work)
            np.add(work, _B[k], out=work)
            out[lo:hi, k] = np.minimum.reduceat(work, at) >> np.uint64(32)
        lo = hi
    return out


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _describe(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, mark (hash of the text), n_shingles, node (digest of the set, null if empty), signature (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in doc_chunks(batch.column(1)):
                sets = shingle_sets(data, offs, words)
                full = [s for s in sets if len(s)]
                signed = iter(signatures(full)) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([next(signed).tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "mark", "n_shingles", "node", "signature"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(
        run, "doc_id long, mark long, n_shingles long, node binary, signature binary")


def _bucket_rows(signed: DataFrame) -> DataFrame:
    """(bucket, node): one row a band of each signature; the bucket hashes the band and its minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                minima = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
                bucket = np.tile(np.arange(BANDS, dtype=np.uint64), (len(minima), 1))
                for k in range(ROWS):
                    bucket = mix64(bucket * np.uint64(0x9E3779B97F4A7C15) + minima[:, :, k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.reshape(-1).view(np.int64)),
                     part.column(0).take(pa.array(np.repeat(np.arange(len(minima)), BANDS)))], names=["bucket", "node"])

    return signed.select("node", "signature").mapInArrow(run, "bucket long, node binary")


def _similar_signatures(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs (u, v) whose signatures agree in at least ``SIGNATURE_LEAST`` of the places."""
    one = signed.select(F.col("node").alias("u"), F.col("signature").alias("s"))
    two = signed.select(F.col("node").alias("v"), F.col("signature").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, t = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, HASHES) for k in (2, 3))
            near = pa.array((s == t).mean(axis=1) >= SIGNATURE_LEAST)
            yield batch.select([0, 1]).filter(near)

    joined = pairs.join(one, "u").join(two, "v").select("u", "v", "s", "t")
    return joined.mapInArrow(run, "u binary, v binary")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0


def _sets_of(nodes: DataFrame, docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(node, items): the full set of each of ``nodes`` (node), from its class's text."""
    chosen = classes.join(nodes.distinct(), "node").select("node", "doc", "mark")
    # by id and text hash: rows without an id, or with one id, meet the class of their own text only
    texts = docs.join(chosen, ["doc", "mark"]).dropDuplicates(["node"]).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in doc_chunks(batch.column(1)):
                nodes = batch.column(0).slice(lo, hi - lo).to_pylist()
                # two texts may share a hash: the digest tells
                kept = [(k, s) for k, s in zip(nodes, shingle_sets(data, offs, words)) if _digest(s) == k]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.binary()),
                                                  pa.array([s.view(np.int64) for _, s in kept], pa.list_(pa.int64()))],
                                                 names=["node", "items"])

    return texts.mapInArrow(run, "node binary, items array<long>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose full sets meet the similarity, in whole numbers: 100 * common >= percent * union.
    Pair by pair in the JVM, so that no batch holds the sets of many pairs."""
    one = sets.select(F.col("node").alias("u"), F.col("items").alias("s"))
    two = sets.select(F.col("node").alias("v"), F.col("items").alias("t"))
    common = F.size(F.array_intersect("s", "t"))
    return pairs.join(two, "v").join(one, "u").withColumn("common", common).where(
        100 * F.col("common") >= percent * (F.size("s") + F.size("t") - F.col("common"))).select("u", "v")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    similar = scratch.write(_similar_signatures(pairs, classes), "similar")
    nodes = similar.select(F.col("u").alias("node")).union(similar.select(F.col("v").alias("node")))
    sets = scratch.write(_sets_of(nodes, docs, classes, words), "sets")
    found = scratch.write(_linked(similar, sets, percent), "links")
    scratch.drop(similar, sets)
    return found


def _family_links(rows: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links between different components in the buckets of ``rows`` (bucket, node, component)."""
    heads = rows.groupBy("bucket").agg(F.min("node").alias("head"))
    star = rows.join(heads, "bucket").select(F.col("node").alias("u"), F.col("head").alias("v"))
    family = connected_components(star, scratch).withColumnRenamed("component", "family")
    nodes = scratch.write(rows.select("node", "component").distinct().join(family, "node"), "families")
    blocks = nodes.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = nodes.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a block meets itself and every other one; a task's group is a pair of blocks
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "component", "family", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    sets = _sets_of(nodes.select("node"), docs, classes, words)
    full = scratch.write(classes.select("node", "signature").join(sets, "node"), "family_sets")
    work = pairs.join(full, "node")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        node, component = (group.column(c).to_pylist() for c in ("node", "component"))
        signed = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
        sets = [x.values.to_numpy().view(np.uint64) for x in group.column("items")]
        block = group.column("block").to_numpy()
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        parent = {c: c for c in component}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        part = np.unique(np.array([hash(c) for c in component]), return_inverse=True)[1]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        near = []
        for a in left:
            agree = (signed[right] == signed[a]).mean(axis=1)
            ok = (agree >= SIGNATURE_LEAST) & (part[right] != part[a])
            ok &= right > a if i == j else True
            b = right[ok]
            near.append(np.c_[np.full(len(b), a), b, np.round(agree[ok] * HASHES)])
        near = np.concatenate(near).astype(np.int64) if near else np.zeros((0, 3), np.int64)
        out = []
        for a, b, _ in near[np.argsort(-near[:, 2], kind="stable")].tolist():
            if root(component[a]) != root(component[b]):
                both = _common(sets[a], sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    parent[root(component[a])] = root(component[b])
                    out.append((node[a], node[b]))
        return pa.table({"u": pa.array([x[0] for x in out], pa.binary()), "v": pa.array([x[1] for x in out], pa.binary())})

    return scratch.write(work.groupBy("family", "i", "j").applyInArrow(run, "u binary, v binary"), "family_links")


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per document: doc_id, mark, n_shingles, node, component (of its group), head (the group's least id)."""
    scratch = Scratch(docs.sparkSession, "neardup")
    described = scratch.write(_describe(docs, words), "described")
    no_id = F.lit(-1 << 62)
    classes = scratch.write(described.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min(F.struct(F.coalesce("doc_id", no_id).alias("doc"), "mark")).alias("one"),
        F.first("signature").alias("signature")).select("node", "least", "one.doc", "one.mark", "signature"), "classes")
    by_id = docs.select(F.coalesce("doc_id", no_id).alias("doc"), F.xxhash64("text").alias("mark"), "text")

    rows = _bucket_rows(classes)
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("head")).where("n > 1")
    rows = scratch.write(rows.join(shared, "bucket"), "buckets")
    pairs = scratch.write(rows.where(F.col("node") != F.col("head")).select(
        F.col("head").alias("u"), F.col("node").alias("v")).distinct(), "pairs")
    links = _confirmed(pairs, classes, by_id, words, percent, scratch)
    labels = scratch.write(connected_components(links, scratch), "labels")

    unsettled = scratch.write(_open(rows, labels), "open")
    small, large = unsettled.where(F.col("n") <= SMALL_BUCKET), unsettled.where(F.col("n") > SMALL_BUCKET)
    found = []
    if not small.isEmpty():
        more = scratch.write(_cross_pairs(small).join(pairs, ["u", "v"], "left_anti"), "pairs")
        found.append(_confirmed(more, classes, by_id, words, percent, scratch))
    if not large.isEmpty():
        found.append(_family_links(large, classes, by_id, words, percent, scratch))
    if found:
        joined = labels.where(F.col("node") != F.col("component")).select(F.col("node").alias("u"), F.col("component").alias("v"))
        for more in found:
            joined = joined.unionByName(more)
        labels = scratch.write(connected_components(joined, scratch), "labels")
    groups = classes.select("node", "least").join(labels, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("component"))
    heads = groups.groupBy("component").agg(F.min("least").alias("head"))
    of_class = groups.join(heads, "component").select("node", "component", "head")
    return described.drop("signature").join(of_class, "node", "left")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least id of its group)."""
    return _grouped(docs, words, percent).select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("head")).alias("component_id"))


def _open(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (bucket, node, n, component) of the buckets that hold several components."""
    named = rows.join(labels, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("component"))
    several = named.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where(
        "a <> b").select("bucket")
    return named.join(several, "bucket")


def _cross_pairs(rows: DataFrame) -> DataFrame:
    other = rows.select("bucket", F.col("node").alias("other"), F.col("component").alias("part"))
    return (rows.join(other, "bucket").where(F.col("component") < F.col("part"))
            .select(F.least("node", "other").alias("u"), F.greatest("node", "other").alias("v")).distinct())


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group, one with the least id (null last). Rows without shingles stay.

    Decided for each id and text; rows equal in both are copies, of which one may stay.
    """
    scratch = Scratch(docs.sparkSession, "deduplicated")
    key = ["none", "id", "mark"]
    ids = [F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id")]
    copies = scratch.write(_grouped(docs, words, percent).where(F.col("component").isNotNull()).select(
        "component", "mark", *ids).groupBy("component", *key).agg(F.count("*").alias("n")), "copies")
    best = copies.groupBy("component").agg(F.min(F.struct(*key)).alias("best"))
    state = F.when(F.struct(*key) != F.col("best"), F.lit("gone")).when(F.col("n") > 1, F.lit("copied"))
    states = scratch.write(copies.join(best, "component").withColumn("state", state).where(
        F.col("state").isNotNull()).select(*key, "state"), "states")
    marked = docs.select(F.struct(*docs.columns).alias("row"), *ids, F.xxhash64("text").alias("mark"))
    kept = marked.join(states, key, "left_anti").select("row.*")
    copied = states.where("state = 'copied'")
    if copied.isEmpty():
        return kept
    one = marked.join(copied, key, "left_semi").groupBy(*key).agg(F.first("row").alias("row"))
    return kept.unionByName(one.select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=2)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
