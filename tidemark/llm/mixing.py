"""Mixing sources to target weights by capped water-filling (operator 8).

Targets: every source gets its weight's share of the budget; a source whose share exceeds ``max_epochs``
times its size is clamped there, and the excess goes to the others by weight, until none is above. Each
round is one aggregate over the source table that brings three numbers to the driver; sums are exact.

Sampling: a source's target is ``whole`` repetitions of all its documents plus a part of one more. For that
part, documents stand in a seeded hash order and the run of first ones whose words come nearest to the rest
of the target is taken whole. Documents larger than 1/64 of their source (at most 64 of them) are decided
first, each in its turn if it still fits, and one that then brings the sum nearest, so that the small ones make up the difference. The order is cut into hash ranges of about
``BUCKET_ROWS`` documents: sums by range find the one range of a source in which the run ends, and only
that range is summed row by row, so a hot source never meets in one task. What results is one row a
source, with the place where its run ends; every document then meets its source's row.

Nulls and edge cases: a null text counts 0 words; null sources form one source; a null or repeated id is
kept, a row each. Rows equal in id, source and size are numbered (by text hash, chunk by chunk, so that any
number of them spreads over tasks) and each number has a place of its own, so they are decided one by one.
Empty sources get target 0. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table
from tidemark.llm.ordered import in_order, numbered

WORDS = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 4096
LARGE_SHARE = 64
SEED = 20


def _key(c: Column) -> Column:
    """A join key under which nulls meet: '-' for null, '=' and the text otherwise."""
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), c.cast("string")))


def weights_in_turn(sources: DataFrame, weights: list[int]) -> DataFrame:
    """``sources`` (one row a source) with column ``weight``: the given weights in turn over the sources in
    code-point order, null last."""
    w = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(w) - 1, F.lit(len(weights)))
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))


def water_fill(sources: DataFrame, budget_share: tuple[int, int], max_epochs: int) -> DataFrame:
    """Adds ``target`` (double) to sources (source, source_size, weight >= 0 as long).

    The budget is ``budget_share`` (numerator, denominator) of all sizes. The level ``p / q`` is the target
    for one unit of weight; a source is clamped once ``weight * p / q`` reaches its cap.
    """
    big = "decimal(38,0)"
    cap = (F.col("source_size") * max_epochs).cast("decimal(19,0)")
    weight = F.col("weight").cast("decimal(10,0)")
    total = sources.agg(F.sum("source_size").alias("s")).head().s or 0
    num, den = budget_share
    p, q, clamped_before = 0, 1, -1
    while True:
        clamped = (weight * F.lit(p).cast("decimal(25,0)")).cast(big) >= (cap * F.lit(q).cast("decimal(15,0)")).cast(big)
        got = sources.agg(F.sum(F.when(clamped, cap).otherwise(0)).alias("fixed"),
                          F.sum(F.when(clamped, 0).otherwise(F.col("weight"))).alias("free"),
                          F.count(F.when(clamped, 1)).alias("n")).head()
        if not got.free or got.n == clamped_before:
            break
        clamped_before = got.n
        p, q = num * int(total) - den * int(got.fixed), den * int(got.free)
    share = F.col("weight").cast("double") * F.lit(float(p)) / F.lit(float(q))
    return sources.withColumn("target", F.when(clamped, cap.cast("double")).otherwise(
        F.least(share, cap.cast("double"))))


def sized_documents(docs: DataFrame, scratch: Scratch, seed: int = SEED, keep: Column | None = None) -> DataFrame:
    """doc_id, source, size (words of the text) and place (seeded, in [0, 1), one for each row); ``keep`` is carried
    along as ``row``."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORDS)), F.lit(0)).cast("long")
    kept = [] if keep is None else [keep.alias("row")]
    rows = docs.select(F.col("doc_id"), F.col("source"), size.alias("size"), F.xxhash64("text").alias("mark"), *kept)
    alike = [_key(F.col("doc_id")).alias("doc_key"), _key(F.col("source")).alias("key"), F.col("size")]
    names = ["doc_key", "key", "size"]
    again = scratch.write(rows.groupBy(*alike).agg(F.count("*").alias("n")).where("n > 1").select(*names), "alike")
    h = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("key"), F.col("size"))
    rows = rows.withColumns({"doc_key": alike[0], "key": alike[1]})
    columns = ["doc_id", "source", "size", "place", *(["row"] if kept else [])]

    def placed(df: DataFrame, hashed: Column) -> DataFrame:
        return df.withColumn("place", F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))).select(*columns)

    if again.isEmpty():
        return placed(rows, h)
    # rows that are alike in everything are spread by the place where they were read
    some = rows.join(again, names, "left_semi").withColumns({"group": F.xxhash64(*names), "read": F.monotonically_increasing_id()})
    some = numbered(in_order(some, [F.col("group"), F.col("mark"), F.col("read")], [], scratch, "numbered"), "group").withColumnRenamed(
        "place", "number")
    one = placed(rows.join(again, names, "left_anti"), h)
    return one.unionByName(placed(some, F.when(F.col("number") == 1, h).otherwise(F.xxhash64(h, F.col("number")))))


def _place(doc_id: Column, size: Column, place: Column) -> Column:
    return F.struct(place.alias("place"), F.coalesce(doc_id, F.lit(-1)).alias("doc"), size.alias("size"))


def _cuts(rows: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """(key, ``name``): the last place of the run of first rows of each source whose sizes come nearest to
    its ``wanted``; null where nothing is wanted.

    ``rows``: key, at (struct), size. ``wanted``: key, wanted, ranges. Only the hash range in which the
    running sum passes ``wanted`` is summed row by row.
    """
    rows = rows.join(wanted, "key").withColumn("range", F.floor(F.col("at.place") * F.col("ranges")).cast("long"))
    sums = rows.groupBy("key", "range").agg(F.sum("size").alias("range_size"), F.first("wanted").alias("wanted"),
                                            F.first("ranges").alias("ranges"))
    by_range = Window.partitionBy("key").orderBy("range")
    start = F.sum("range_size").over(by_range.rowsBetween(Window.unboundedPreceding, 0)) - F.col("range_size")
    sums = sums.withColumn("start", start)
    total = sums.groupBy("key").agg(F.sum("range_size").alias("total"), F.first("wanted").alias("wanted"))
    passing = sums.where((F.col("start") <= F.col("wanted")) & (F.col("wanted") < F.col("start") + F.col("range_size"))
                         & (F.col("wanted") > 0)).select(
        "key", "range", "start", (F.col("range") / F.col("ranges")).alias("low"))
    within = Window.partitionBy("key").orderBy("at")
    run = F.col("start") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    inside = rows.join(passing, ["key", "range"]).withColumn("run", run)
    before = _place(F.lit(None).cast("long"), F.lit(-1).cast("long"), F.col("low"))
    cut = inside.groupBy("key").agg(F.coalesce(
        F.max(F.when(2 * F.col("run") + F.col("size") <= 2 * F.col("wanted"), F.col("at"))),
        F.max(before)).alias(name))
    everything = _place(F.lit(None).cast("long"), F.lit(-1).cast("long"), F.lit(2.0))
    return total.join(cut, "key", "left").select("key", F.when(
        (F.col("wanted") > 0) & (F.col("wanted") >= F.col("total")), everything).otherwise(F.col(name)).alias(name))


def _chosen(large: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, chosen, taken_large): of the large rows of each source (fewer than ``LARGE_SHARE``), in the order of their
    places, every one that still fits into ``wanted``, and the one that then comes nearest; their places and their sum.
    The sum misses ``wanted`` by at most half of the least row left out."""
    held = large.join(wanted, "key").groupBy("key").agg(F.array_sort(F.collect_list("at")).alias("rows"), F.first("wanted").alias("wanted"))
    kind = large.schema["at"].dataType.simpleString()
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast(f"array<{kind}>").alias("chosen"))

    def step(state: Column, row: Column) -> Column:
        fits = state["sum"] + row["size"] <= F.col("wanted")
        return F.struct(F.when(fits, state["sum"] + row["size"]).otherwise(state["sum"]).alias("sum"),
                        F.when(fits, F.concat(state["chosen"], F.array(row))).otherwise(state["chosen"]).alias("chosen"))

    walked = held.select("key", "rows", "wanted", F.aggregate("rows", start, step).alias("state"))
    # what is left of the target is less than any row left out: one more, if it brings the sum nearer
    gap = F.col("wanted") - F.col("state.sum")
    left = F.filter("rows", lambda r: ~F.array_contains(F.col("state.chosen"), r))
    best = F.array_min(F.transform(left, lambda r: F.struct(F.abs(r["size"] - gap).alias("miss"), r.alias("row"))))
    one = F.coalesce(best["miss"] < F.abs(gap), F.lit(False))
    return walked.withColumns({"best": best, "one": one}).select(
        "key", F.when(F.col("one"), F.concat("state.chosen", F.array("best.row"))).otherwise(F.col("state.chosen")).alias("chosen"),
        (F.col("state.sum") + F.when(F.col("one"), F.col("best.row.size")).otherwise(0)).alias("taken_large"))


def mix_plan(sized: DataFrame, weights: list[int], scratch: Scratch, budget_share: tuple[int, int] = (3, 2),
             max_epochs: int = 2) -> DataFrame:
    """One row a source: key, source_size, target, whole, chosen, cut_small (see ``repeats``)."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = scratch.write(weights_in_turn(sources, weights), "sources")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = water_fill(sources, budget_share, max_epochs).withColumn("whole", whole.cast("int")).withColumn(
        "part", F.col("target") - F.col("whole") * F.col("source_size")).select(
        _key(F.col("source")).alias("key"), "source_size", "target", "whole", "part",
        F.greatest(F.lit(1), F.floor(F.col("n") / BUCKET_ROWS)).alias("ranges"))
    targets = scratch.write(targets, "targets")
    rows = sized.withColumn("key", _key(F.col("source"))).join(targets.select("key", "source_size"), "key").select(
        "key", "size", _place(F.col("doc_id"), F.col("size"), F.col("place")).alias("at"),
        (F.col("size") * LARGE_SHARE > F.col("source_size")).alias("is_large"))
    large, small = rows.where("is_large"), rows.where("not is_large")
    large_size = large.groupBy("key").agg(F.sum("size").alias("large_size"))
    wanted = targets.join(large_size, "key").select(
        "key", (F.col("part") * F.col("large_size") / F.col("source_size")).alias("wanted"))
    chosen = scratch.write(_chosen(large, wanted), "chosen")
    taken = chosen.select("key", "taken_large")
    wanted = targets.join(taken, "key", "left").select(
        "key", (F.col("part") - F.coalesce("taken_large", F.lit(0))).alias("wanted"), "ranges")
    cut_small = _cuts(small, wanted, "cut_small")
    plan = targets.join(chosen, "key", "left").join(cut_small, "key", "left")
    return scratch.write(plan.select("key", "source_size", "target", "whole", "chosen", "cut_small"), "plan")


def repeats(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with doc_id, source, size and place, and how often each is taken, by its source's row of ``plan``:
    ``whole`` times, and once more if it is a chosen large row or a small one whose place is not behind the cut."""
    at = _place(F.col("doc_id"), F.col("size"), F.col("place"))
    large = F.col("size") * LARGE_SHARE > F.col("source_size")
    extra = F.coalesce(F.when(large, F.array_contains("chosen", at)).otherwise(at <= F.col("cut_small")).cast("int"), F.lit(0))
    return rows.withColumn("key", _key(F.col("source"))).join(plan, "key").withColumn(
        "repeats", (F.col("whole") + extra).cast("int")).drop("key", "whole", "chosen", "cut_small")


def mix(docs: DataFrame, weights: list[int], budget_share: tuple[int, int] = (3, 2), max_epochs: int = 2,
        seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, place, source_size, target, repeats (int), taken (long).

    ``repeats`` is how often the mix takes the document; ``taken`` is ``repeats * size``.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.write(sized_documents(docs, scratch, seed), "sized")
    plan = mix_plan(sized, weights, scratch, budget_share, max_epochs)
    return repeats(sized, plan).withColumn("taken", (F.col("repeats") * F.col("size")).cast("long"))


def repeated(docs: DataFrame, weights: list[int], budget_share: tuple[int, int] = (3, 2), max_epochs: int = 2,
             seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the columns of ``docs``.

    Texts are not shuffled (but for rows that are alike, see above): the plan has one row a source, and each row of
    ``docs`` meets its own.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    held = sized_documents(docs, scratch, seed, F.struct(*docs.columns))
    sized = scratch.write(held.drop("row"), "sized")
    plan = mix_plan(sized, weights, scratch, budget_share, max_epochs)
    return repeats(held, plan).select("row", F.explode(F.array_repeat(F.lit(1), F.col("repeats")))).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), [3, 1, 2])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
