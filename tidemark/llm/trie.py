"""Prefix trie of conversations with totals of every subtree, rolled up in depth bands (operator 13).

1. Turns are put in order and numbered chunk by chunk. A turn is known by two 64-bit hashes of its role and text, a
   prefix by the xor of what its turns' hashes and places give, so prefixes are running aggregates of chunks and
   a conversation of any length spreads over many tasks. No text moves.
2. A node is a distinct prefix; (its least member, its depth) names it. A path is a conversation's nodes by depth.
3. Depth-band rollup: paths are cut into bands of ``BAND`` depths. Every node adds its values to its ancestors in its
   own band, at most ``BAND`` of them. The top nodes of the bands form a trie ``BAND`` times less deep, whose totals
   are found the same way. A completed total of a band's top then goes to the nodes above it in the band before.
   So a node explodes to at most ``BAND`` rows in each pass, and a depth of D takes log(D) / log(BAND) levels.

Nulls and edge cases: turns are ordered by turn (null first), ties by role and text hash; repeated turns are all kept.
Null roles and texts are empty. Rows without a conversation id belong to no conversation and are left out. Very long
texts are hashed whole in the JVM. Other columns are ignored; an empty table has no conversation and no root, so an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table
from tidemark.llm.ordered import CHUNK_BITS, before_chunks, in_order, numbered

BAND = 16
NODE = ["conv_id", "depth"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def turns_in_order(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, place, one, two, bytes): turns numbered from 1, their two hashes and the bytes of their text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("one"), F.xxhash64(F.lit(2), text, role).alias("two"),
        F.octet_length(text).cast("long").alias("bytes"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("one"), F.col("two")]
    return numbered(in_order(turns, order, [], scratch, "turns"), "conv_id").select("conv_id", "place", "one", "two", "bytes")


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, bytes): the hash of the prefix that ends at each turn (conv_id, place, one, two, bytes)."""
    placed = turns.select(
        "conv_id", F.col("place").alias("depth"), "bytes", F.shiftright(F.col("place") - 1, CHUNK_BITS).alias("chunk"),
        F.xxhash64("place", "one", "two").alias("x1"), F.xxhash64(F.lit(3), "two", "one", "place").alias("x2"))
    totals = placed.groupBy("conv_id", "chunk").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    earlier = before_chunks(totals, "conv_id", "chunk", e1=F.bit_xor("x1"), e2=F.bit_xor("x2"))
    w = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    here = placed.select("conv_id", "chunk", "depth", "bytes", F.bit_xor("x1").over(w).alias("p1"), F.bit_xor("x2").over(w).alias("p2"))

    def whole(p: str, e: str) -> Column:
        return F.col(p).bitwiseXOR(F.coalesce(F.col(e), F.lit(0).cast("long"))).alias(p)

    return here.join(earlier, ["conv_id", "chunk"], "left").select("conv_id", "depth", whole("p1", "e1"), whole("p2", "e2"), "bytes")


def subtree_totals(paths: DataFrame, values: DataFrame, names: list[str], deepest: int, scratch: Scratch, band: int = BAND) -> DataFrame:
    """(conv_id, depth, *names): ``values`` (conv_id, depth, *names) of the nodes, summed over each node's subtree.

    ``paths`` (conv_id, depth, node) names the conversation that stands for the node at each depth of each path.
    """
    def sums(df: DataFrame) -> DataFrame:
        return df.groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in names])

    def at(step: Column) -> Column:
        return F.floor(step / band).cast("long")

    # at most ``band`` entries a row
    banded = scratch.write(paths.groupBy("conv_id", at(F.col("depth")).alias("band")).agg(
        F.collect_list(F.struct(F.col("node").alias("conv_id"), "depth")).alias("path")), "bands")
    inside = values.withColumn("band", at(F.col("depth"))).join(banded, ["conv_id", "band"]).select(
        F.explode(F.filter("path", lambda x: x["depth"] <= F.col("depth"))).alias("up"), *names).select("up.*", *names)
    inside = scratch.write(sums(inside), "inside")
    if deepest < band:
        return inside
    tops = F.col("depth") % band == 0
    less_deep = (F.col("depth") / band).cast("long").alias("depth")
    totals = subtree_totals(paths.where(tops).select("conv_id", less_deep, "node"), inside.where(tops).select("conv_id", less_deep, *names),
                            names, deepest // band, scratch, band)
    above = totals.where("depth > 0").withColumn("band", F.col("depth") - 1).drop("depth").join(banded, ["conv_id", "band"]).select(
        F.explode("path").alias("up"), *names).select("up.*", *names)
    return scratch.write(sums(inside.unionByName(above)), "totals")


def _ends(members: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of rows (conv_id, depth, member): a stream over sorted members, so a node of any
    number of members needs no memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []

        def put_out() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=[*NODE, "ends_sha256"])

        for batch in batches:
            for conv_id, depth, member in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if (conv_id, depth) == node:
                    state.update(f",{member}".encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (conv_id, depth), hashlib.sha256(str(member).encode())
            if done:
                yield put_out()
        if node is not None:
            done.append((*node, state.hexdigest()))
            yield put_out()

    sorted_members = members.select(*NODE, "member").repartition(*NODE).sortWithinPartitions(*NODE, "member")
    return sorted_members.mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame, scratch: Scratch, band: int = BAND) -> DataFrame:
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, of ``turns`` (conv_id, place, one, two, bytes) and ``lengths`` (conv_id, length) of all conversations."""
    lengths = scratch.write(lengths, "lengths")
    whole = lengths.agg(F.min("conv_id").alias("least"), F.count("*").alias("n"), F.max("length").alias("deepest")).head()
    prefixes = scratch.write(_prefixes(turns), "prefixes")
    nodes = scratch.write(prefixes.groupBy("depth", "p1", "p2").agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes")), "nodes")
    root = F.lit(whole.least).cast("long")
    paths = prefixes.join(nodes, ["depth", "p1", "p2"]).select("conv_id", "depth", "node")
    paths = scratch.write(paths.unionByName(lengths.select("conv_id", F.lit(0).cast("long").alias("depth"), root.alias("node"))), "paths")
    top = lengths.limit(1).select(root.alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(whole.n).alias("n_convs"),
                                  F.lit(0).cast("long").alias("bytes"))
    nodes = nodes.select(F.col("node").alias("conv_id"), "depth", "n_convs", "bytes").unionByName(top)
    above = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    nodes = scratch.write(nodes.join(above, NODE, "left"), "parents")
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"))
    saved = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens")
    nodes = nodes.join(children, NODE, "left").select(*NODE, "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), saved)
    nodes = scratch.write(nodes, "valued")
    values = nodes.select(*NODE, (F.col("n_children") == 0).cast("long").alias("n_leaves"), "saved_tokens")
    totals = subtree_totals(paths, values, ["n_leaves", "saved_tokens"], whole.deepest or 0, scratch, band)
    members = paths.join(lengths.withColumnRenamed("length", "depth"), NODE).select(
        F.col("node").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    ended = nodes.drop("saved_tokens").join(totals, NODE).join(_ends(members), NODE, "left")
    return ended.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)))


def trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """``prefix_trie`` of conversations (conv_id, turn, role, text) as they are."""
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = scratch.write(turns_in_order(conversations, scratch), "numbered")
    return prefix_trie(turns, turns.groupBy("conv_id").agg(F.max("place").alias("length")), scratch, band)


def rebuilt(turns: DataFrame, scratch: Scratch, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) of conversations that take their first crc32(id) % ``most`` turns from the first of their family
    (ids that share id / ``family``), and their own turns after as many."""
    conv = F.col("conv_id")
    base = conv - conv % family
    taken = F.crc32(conv.cast("string").cast("binary")) % most
    sizes = scratch.write(turns.groupBy("conv_id").agg(F.max("place").alias("n")), "sizes")
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    shared = F.least(F.col("taken"), F.coalesce("base_n", F.lit(0)))
    plan = sizes.select("conv_id", "n", base.alias("base"), taken.alias("taken")).join(bases, "base", "left").select(
        "conv_id", "base", "taken", shared.alias("shared"), (shared + F.greatest(F.col("n") - F.col("taken"), F.lit(0))).alias("length"))
    plan = scratch.write(plan, "plan")
    # at most most - 1 turns for each conversation
    first = turns.where(F.col("place") < most).withColumnRenamed("conv_id", "base")
    lent = plan.where("shared > 0").join(first, "base").where("place <= shared").select("conv_id", "place", "one", "two", "bytes")
    own = turns.join(plan, "conv_id").where("place > taken").select(
        "conv_id", (F.col("place") - F.col("taken") + F.col("shared")).alias("place"), "one", "two", "bytes")
    return scratch.write(lent.unionByName(own), "rebuilt"), plan.select("conv_id", "length")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "trie")
    turns = scratch.write(turns_in_order(table(spark, sf_dir, "conversations"), scratch), "numbered")
    return prefix_trie(*rebuilt(turns, scratch), scratch)


ORACLE = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY i) AS said FROM turns GROUP BY conv_id),
planned AS (
    SELECT conv_id, said, conv_id - conv_id % 5 AS base,
           xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
               lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 9 AS h
    FROM own),
built AS (
    SELECT p.conv_id, coalesce(b.said[1:h], []) || p.said[h + 1:] AS said
    FROM planned p LEFT JOIN own b ON b.conv_id = p.base),
prefixes AS (
    SELECT conv_id, said[1:d] AS prefix, d, len(said) = d AS is_end
    FROM (SELECT conv_id, said, unnest(range(len(said) + 1)) AS d FROM built)),
nodes AS (
    SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '') AS ends
    FROM prefixes GROUP BY prefix, d),
children AS (
    SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
valued AS (
    SELECT n.prefix, n.d, n.conv_id, n.n_convs, n.ends, coalesce(c.n, 0) AS n_children,
           CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.prefix[n.d].t) END AS saved
    FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix AND c.d = n.d),
totals AS (
    SELECT prefix[1:up] AS prefix, up AS d, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved
    FROM (SELECT prefix, n_children, saved, unnest(range(d + 1)) AS up FROM valued) GROUP BY ALL)
SELECT v.conv_id, v.d::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children::BIGINT AS n_children,
       t.n_leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN totals t ON t.prefix = v.prefix AND t.d = v.d
LEFT JOIN nodes p ON p.prefix = v.prefix[1:v.d - 1] AND p.d = v.d - 1
"""
