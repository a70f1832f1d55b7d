"""Rows in a global order, for groups of any size: written once with their position, numbered chunk by chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

#: a chunk is a run of at most 4,096 rows of the order
CHUNK_BITS = 12


def in_order(rows: DataFrame, ranges: list[Column], within: list[Column], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` written with ``pos``, which grows along ``ranges`` and, among equal ones, ``within``.

    Rows are dealt by ranges, so a large group spreads over many tasks. A written position is final: a retried
    task cannot move rows between ranges under a later step.
    """
    dealt = rows.repartitionByRange(*ranges).sortWithinPartitions(*ranges, *within)
    return scratch.write(dealt.withColumn("pos", F.monotonically_increasing_id()), name)


def chunk_of(pos: Column) -> Column:
    """The chunk of a position: rows that follow each other in one written range, at most 2^CHUNK_BITS of them."""
    return F.shiftright(pos, CHUNK_BITS)


def before_chunks(totals: DataFrame, group: str, chunk: str, **sums: Column) -> DataFrame:
    """(group, chunk, sums over the group's earlier chunks) of the chunks that are not their group's first.

    ``totals`` has a row for each group and chunk, so a group's window is thousands of times shorter than the group.
    """
    w = Window.partitionBy(group).orderBy(chunk)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    numbered = totals.select(group, chunk, F.row_number().over(w).alias("_n"), *[c.over(earlier).alias(k) for k, c in sums.items()])
    return numbered.where("_n > 1").drop("_n")


def numbered(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` (of ``in_order``) with ``place``, the number from 1 of each row in its group."""
    rows = rows.withColumn("_chunk", chunk_of(F.col("pos")))
    counts = rows.groupBy(group, "_chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = before_chunks(counts, group, "_chunk", earlier=F.sum("n"))
    here = rows.withColumn("place", F.row_number().over(Window.partitionBy(group, "_chunk").orderBy("pos")).cast("long"))
    return here.join(earlier, [group, "_chunk"], "left").withColumn(
        "place", F.col("place") + F.coalesce("earlier", F.lit(0))).drop("_chunk", "earlier")
