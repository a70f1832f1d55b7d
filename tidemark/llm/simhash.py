"""SimHash near-dedup by segment popcounts and a grid range-join (operator 12).

1. Fingerprints: every document's word shingles, repeats included, are hashed (XXH64, seed 42); a bit is set if
   more than half of the hashes set it. Documents of one fingerprint form a class.
2. Embedding: a fingerprint becomes the bit counts of its segments (``width`` bits each, packed into a long).
   The Manhattan distance of two such vectors never exceeds the Hamming distance of the fingerprints.
3. Grid range-join: a point goes to the cells of all vectors within distance 1 of its own. Two points within
   distance 2 of each other share at least one cell. This serves a radius of 1 or 2.
4. Cells of at most ``SMALL_CELL`` points: every two points are verified on their fingerprints inside the task,
   which puts out links that join what is linked (a star a component of the cell), no pairs.
5. Larger cells are not compared: their points are embedded again in finer segments (widths 4, 2, 1) and joined
   on that grid. At width 1 the vector is the fingerprint itself, the bound is the distance, a cell holds the at
   most 65 points one bit around it, and all of these are linked. So no cell size loses a link.
6. Connected components by alternating large-star and small-star over the classes.

Nulls and edge cases: a null text, an empty one or one without words has the fingerprint zero, which is linked
like any other. Fewer words than a shingle make one shingle, all the words. Rows with equal ids each get a
result; a null id gets its group's component, null if no row of the group has an id. Very long texts are taken
whole, a block of shingles at a time. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table
from tidemark.llm.components import connected_components

SEED = 42
WORDS = 3
WIDTHS = (4, 2, 1)
#: cells of at most so many points are compared inside a task; must be at least 65, the most at width 1
SMALL_CELL = 128
STEP = 1 << 16

_SPACES = re.compile(rb"[\x20\x09-\x0D]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The 64-bit fingerprint of a UTF-8 text (0 without words)."""
    joined = _SPACES.sub(b" ", text.translate(_LOWER)).strip(b" ")
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts, ends = np.r_[0, gaps + 1], np.r_[gaps, len(joined)]
    if len(starts) >= words:
        starts, ends = starts[:len(starts) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    set_bits = np.zeros(64, np.int64)
    for lo in range(0, len(starts), STEP):
        spans = zip(starts[lo:lo + STEP].tolist(), ends[lo:lo + STEP].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, point): the fingerprint of every document as a long (its 64 bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            points = np.fromiter((fingerprint((texts[k].as_py() or "").encode(), words) for k in range(len(texts))),
                                 np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(points.view(np.int64))], names=["doc_id", "point"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, point long")


def _repeated(pattern: int, bits: int) -> Column:
    """A 64-bit constant: ``pattern`` in every ``bits`` bits."""
    value = sum(pattern << k for k in range(0, 64, bits))
    return F.lit(value - (1 << 64) if value >> 63 else value)


def embedded(point: Column, width: int) -> Column:
    """The bit counts of the segments of ``width`` (1, 2 or 4) bits, each in as many bits of a long."""
    if width == 1:
        return point
    half = embedded(point, width // 2)
    mask = _repeated((1 << width // 2) - 1, width)
    low, high = half.bitwiseAND(mask), F.shiftrightunsigned(half, width // 2).bitwiseAND(mask)
    if width == 2:  # the sum of two bits without an addition, which would overflow in the highest segment
        return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    return low + high


def _cells(points: DataFrame, width: int) -> DataFrame:
    """(cell, point): every grid vector within distance 1 of the point's vector."""
    places = points.select("point", embedded(F.col("point"), width).alias("vector")).withColumn(
        "place", F.explode(F.sequence(F.lit(0), F.lit(63), F.lit(width))))
    count = f"(shiftrightunsigned(vector, place) & {(1 << width) - 1})"
    # one segment's count goes up or down by one: xor of the counts, as sums would overflow in the highest segment
    up = f"if({count} < {width}, vector ^ shiftleft({count} ^ ({count} + 1), place), null)"
    down = f"if({count} > 0, vector ^ shiftleft({count} ^ ({count} - 1), place), null)"
    near = places.select("point", F.explode(F.expr(f"array({up}, {down})")).alias("cell")).where(F.col("cell").isNotNull())
    return points.select(embedded(F.col("point"), width).alias("cell"), "point").unionByName(near.select("cell", "point"))


def _verified(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links (u, v) inside cells: in each component of a cell's verified graph, all points to its first."""
    for batch in batches:
        column = batch.column(0)
        flat, offs = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
            points = np.sort(flat[a:b])
            near = np.bitwise_count((points[:, None] ^ points[None]).view(np.uint64)) <= radius
            if near.sum() == len(points):
                continue
            label = np.arange(len(points))
            while True:
                least = np.where(near, label[None], len(points)).min(axis=1)
                if (least == label).all():
                    break
                label = least
            moved = label != np.arange(len(points))
            us.append(points[moved])
            vs.append(points[label[moved]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])


def links(points: DataFrame, radius: int, scratch: Scratch, small_cell: int = SMALL_CELL) -> DataFrame:
    """Links (u, v) that join every two of ``points`` (point, distinct) at most ``radius`` bits apart."""
    if not 1 <= radius <= 2:
        raise ValueError("the grid serves a radius of 1 or 2 bits")
    found = []
    for width in WIDTHS:
        cells = scratch.write(_cells(points, width), f"cells{width}")
        sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
        shared = scratch.write(cells.join(sizes, "cell"), f"shared{width}")
        scratch.drop(cells)
        most = small_cell if width > 1 else 65
        # a group here holds at most ``most`` points
        groups = shared.where(F.col("n") <= most).groupBy("cell").agg(F.collect_list("point").alias("points"))
        found.append(scratch.write(groups.select("points").mapInArrow(lambda b: _verified(b, radius), "u long, v long").distinct(), "links"))
        points = scratch.write(shared.where(F.col("n") > most).select("point").distinct(), "crowded")
        scratch.drop(shared)
        if width == 1 or points.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, point (fingerprint as a long), component_id (the least id of its group)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.write(fingerprints(docs, words), "fingerprints")
    classes = scratch.write(marked.groupBy("point").agg(F.min("doc_id").alias("least")), "classes")
    joined = scratch.write(connected_components(links(classes.select("point"), radius, scratch), scratch), "labels")
    groups = classes.join(joined.withColumnRenamed("node", "point"), "point", "left").withColumn(
        "component", F.coalesce("component", "point"))
    heads = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    return marked.join(groups.join(heads, "component").select("point", "component_id"), "point")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("point")), 16, "0").alias("fingerprint"), "component_id")
