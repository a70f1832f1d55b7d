"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal updates (operator 3).

Tokens are runs of letters and digits or runs of other visible bytes. Features, hashed to ``2**BITS`` slots:
single tokens, pairs of tokens, and one to three token shapes (upper or lower case, length, the
punctuation itself, same as the token before). A document's vector has the root of each count, scaled to
length one, and a constant.

Training takes at most ``max_train_rows`` labelled documents (those with the smallest hashes of their ids)
in groups of about ``shard_rows``. Each group runs FTRL over its documents in hash order for some epochs; the mean of
the groups' weights is the model: at most ``2**BITS`` numbers, the only thing that reaches the driver.
Scoring is one pass over the documents, a sparse dot product each, on whole texts.

Nulls and edge cases: a null or empty text has the constant alone and so gets the model's base score.
Labels without an id or a value are not used; an id labelled several times gets the majority (a draw is 1).
Without usable labels all weights are 0 and every score is 0.5. A null id is never held out. Repeated rows
get equal scores. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ALNUM, NOT_SPACE, SAME, Scratch, doc_chunks, mix64, span_hashes, table

BITS = 18
SLOTS = 1 << BITS
MAX_TRAIN_ROWS = 32_768
SHARD_ROWS = 8192
EPOCHS = 4
THRESHOLD = 0.7

_KIND = np.where(ALNUM, 1, np.where(NOT_SPACE, 2, 0)).astype(np.uint8)
_UPPER = np.zeros(256, np.int32)
_UPPER[ord("A"):ord("Z") + 1] = 1
_LOWER_CASE = np.zeros(256, np.int32)
_LOWER_CASE[ord("a"):ord("z") + 1] = 1


def _tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of one kind of visible byte; runs never cross rows."""
    kind = _KIND[data]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[offs[:-1][offs[:-1] < len(kind)]] = True
    cuts = np.flatnonzero(new)
    ends = np.r_[cuts[1:], len(kind)]
    seen = kind[cuts] > 0
    starts, ends = cuts[seen], ends[seen]
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, literal: np.ndarray) -> np.ndarray:
    upper = np.r_[0, np.cumsum(_UPPER[data])]
    lower = np.r_[0, np.cumsum(_LOWER_CASE[data])]
    n_up, n_low = upper[ends] - upper[starts], lower[ends] - lower[starts]
    word = _KIND[data[starts]] == 1
    case = np.where(n_up == 0, 0, np.where(n_low == 0, 1, 2))
    code = case * 16 + np.minimum(ends - starts, 12)
    repeat = np.zeros(len(starts), np.int64)
    repeat[1:] = literal[1:] == literal[:-1]
    return np.where(word, (code * 2 + repeat).astype(np.uint64), literal)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row cuts, slots, values) of a run of texts: row ``i`` has entries ``cuts[i]:cuts[i + 1]``, by slot.

    Values have length one by row; a row without tokens has no entries.
    """
    n = len(offs) - 1
    if not len(data):
        return np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
    starts, ends, row = _tokens(data, offs)
    one = span_hashes(data, starts, ends, SAME)
    shape = _shapes(data, starts, ends, one)
    second = np.flatnonzero(row[1:] == row[:-1]) + 1
    third = second[1:][np.diff(second) == 1]
    c1, c2, c3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    hashed = [one ^ c1, mix64(shape * c2), mix64(one[second - 1] * c2 + one[second]), mix64(shape[second - 1] * c3 + shape[second]),
              mix64((shape[third - 2] * c3 + shape[third - 1]) * c1 + shape[third])]
    rows = [row, row, row[second], row[second], row[third]]
    keys = (np.concatenate(rows).astype(np.int64) << BITS) | (np.concatenate(hashed) >> np.uint64(64 - BITS)).astype(
        np.int64)
    keys, counts = np.unique(keys, return_counts=True)
    of, value = keys >> BITS, np.sqrt(counts)
    cuts = np.searchsorted(of, np.arange(n + 1))
    norm = np.sqrt(np.bincount(of, weights=counts, minlength=n))
    return cuts, keys & (SLOTS - 1), value / norm[of]


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int, alpha: float = 0.5, beta: float = 1.0,
         l1: float = 0.05, l2: float = 0.01) -> np.ndarray:
    """Weights (``SLOTS`` and the constant's, last) after per-coordinate FTRL-proximal updates, one example
    at a time."""
    z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    rate = np.full(SLOTS + 1, l1)
    rate[SLOTS] = 0

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= rate[i], 0.0, (np.sign(zi) * rate[i] - zi) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for slots, values, label in examples:
            i, x = np.r_[slots, SLOTS], np.r_[values, 1.0]
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / alpha * w
            n[i] = grown
    return weights(np.arange(SLOTS + 1))


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS, shard_rows: int = SHARD_ROWS,
          epochs: int = EPOCHS) -> np.ndarray:
    """The model of ``labels`` (doc_id, label 0/1) over ``docs`` (doc_id, text)."""
    place = F.xxhash64(F.lit(3), F.col("doc_id"))
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).groupBy("doc_id")
             .agg((F.avg("label") >= 0.5).cast("int").alias("label")).withColumn("place", place)
             .orderBy("place", "doc_id").limit(max_train_rows))
    known = Scratch(docs.sparkSession, "quality").write(known, "labels")
    shards = max(1, round(known.count() / shard_rows))
    # at most max_train_rows rows of three numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("place", "label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in doc_chunks(batch.column(2)):
                cuts, slots, values = features(data, offs)
                slots, values = slots.astype(np.int32), values.astype(np.float32)
                spans = [slice(cuts[k], cuts[k + 1]) for k in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array([slots[s].tobytes() for s in spans], pa.binary()),
                     pa.array([values[s].tobytes() for s in spans], pa.binary())],
                    names=["place", "label", "slots", "values"])

    def learn(group: pa.Table) -> pa.Table:
        listed = sorted(zip(*(group.column(c).to_pylist() for c in ("place", "slots", "values", "label"))))
        w = ftrl([(np.frombuffer(s, np.int32), np.frombuffer(v, np.float32).astype(float), y)
                  for _, s, v, y in listed], epochs)
        at = np.flatnonzero(w)
        return pa.table({"slot": at.astype(np.int32), "weight": w[at]})

    vectors = rows.mapInArrow(extract, "place long, label int, slots binary, values binary")
    parts = vectors.groupBy(F.pmod(F.col("place"), F.lit(shards)).alias("shard")).applyInArrow(
        learn, "slot int, weight double")
    # at most SLOTS + 1 rows; each slot's weights are added in their order, so that reruns agree
    got = parts.groupBy("slot").agg(F.sort_array(F.collect_list("weight")).alias("w")).collect()
    model = np.zeros(SLOTS + 1)
    for r in got:
        model[r.slot] = sum(r.w) / shards
    return model


def score(docs: DataFrame, model: np.ndarray, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``score``: one pass, one sparse dot product a document."""
    schema = docs.select(*keep).schema.add("score", "double")
    at = keep.index("text") if "text" in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at)
            total = np.full(batch.num_rows, model[SLOTS])
            for lo, hi, data, offs in doc_chunks(text):
                cuts, slots, values = features(data, offs)
                sums = np.r_[0.0, np.cumsum(model[slots] * values)]
                total[lo:hi] += sums[cuts[1:]] - sums[cuts[:-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))],
                                             names=[*keep, "score"])

    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that never train: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def quality_model(docs: DataFrame, labels: DataFrame, **options) -> np.ndarray:
    marked = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    return train(docs, marked, **options)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, quality_model(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
