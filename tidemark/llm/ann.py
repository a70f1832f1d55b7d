"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test (operator 7).

Largest inner product becomes smallest distance by one more coordinate, ``sqrt(M^2 - |x|^2)`` with the
largest norm M (0 for a query). A seeded Gaussian projection to ``dims`` coordinates is 2-stable: a point at
distance d has a squared projected distance of d^2 times a chi-square variable with ``dims`` degrees.

Index: a kd-tree over the projected points. Its top (at most ``MAX_CELLS`` cells) is fitted on a sample of at
most ``SAMPLE_ROWS`` rows, those with the smallest hashes of their ids; every row is then put into its cell.
Cells of more than about ``unit_rows`` rows are dealt by hash into units of that size (also a cell of equal
vectors), and each unit has a subtree whose leaves are written, a row each, with their bounding boxes.

Search: each query first visits its own cell, which gives its k-th distance so far. It then visits those
cells, and in them those leaves, nearest box first, whose squared projected distance is at most the
chi-square quantile of ``confidence`` times the squared k-th distance. All points of a visited leaf are
verified by the inner product in double precision. A true neighbour is missed with a probability of at most
``1 - confidence``. Work is dealt by (unit, block of queries); only the cells' boxes are on the driver.

Nulls and edge cases: vectors that are null, empty, zero or hold null or non-finite components take no part,
nor do rows without an id, nor vectors of another length than most (of equally frequent lengths, the
smallest). Rows with the query's own id are no candidates; of several query rows with one id, the vector
that is smallest as bytes is the query. Equal scores rank by id. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, table

DIMS = 8
CONFIDENCE = 0.95
UNIT_ROWS = 4096
LEAF_ROWS = 256
QUERY_BLOCK = 2048
MAX_CELLS = 4096
SAMPLE_ROWS = 16_384
SEED = 7


def chi_square_quantile(p: float, dims: int) -> float:
    """Quantile by the Wilson-Hilferty approximation."""
    a = 2 / (9 * dims)
    return dims * (1 - a + NormalDist().inv_cdf(p) * a ** 0.5) ** 3


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part, ``v`` as array of double."""
    v = F.col(vector_col).cast("array<double>")
    inf = float("inf")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists(v, lambda x: x != 0)
    found = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    return found


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a binary column as a matrix of double."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _projected(x: np.ndarray, matrix: np.ndarray, top: float | None) -> np.ndarray:
    extra = np.zeros(len(x)) if top is None else np.sqrt(np.maximum(top * top - (x * x).sum(1), 0))
    return np.c_[x, extra] @ matrix


def _split(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Splits (axis, value) of a kd-tree of ``depth`` levels in heap order, at the median of the widest axis."""
    splits: list[tuple[int, float]] = []
    level = [points]
    for _ in range(depth):
        below = []
        for part in level:
            if len(part):
                axis = int(np.argmax(np.ptp(part, axis=0)))
                value = float(np.median(part[:, axis]))
            else:
                axis, value = 0, 0.0
            splits.append((axis, value))
            left = part[:, axis] <= value
            below += [part[left], part[~left]]
        level = below
    return splits


def _cells(points: np.ndarray, splits: list[tuple[int, float]], depth: int) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    axes = np.array([a for a, _ in splits] or [0])
    values = np.array([v for _, v in splits] or [0.0])
    for _ in range(depth):
        node = 2 * node + 1 + (points[np.arange(len(points)), axes[node]] > values[node])
    return node - (2 ** depth - 1)


def _leaves(points: np.ndarray, rows: np.ndarray, leaf_rows: int) -> Iterator[np.ndarray]:
    """Row numbers of each leaf of the subtree over ``points[rows]``, by medians of the widest axis."""
    stack = [rows]
    while stack:
        part = stack.pop()
        if len(part) <= leaf_rows:
            yield part
            continue
        axis = int(np.argmax(np.ptp(points[part], axis=0)))
        order = part[np.argsort(points[part, axis], kind="stable")]
        stack += [order[len(order) // 2:], order[:len(order) // 2]]


class Index:
    """What a search needs: the tables of vectors and leaves, the projection and the tree's top."""

    def __init__(self, rows: DataFrame, id_col: str, vector_col: str, dims: int = DIMS, unit_rows: int = UNIT_ROWS,
                 leaf_rows: int = LEAF_ROWS, sample_rows: int = SAMPLE_ROWS):
        self.scratch = scratch = Scratch(rows.sparkSession, "ann")
        found = valid_vectors(rows, id_col, vector_col).withColumn("dim", F.size("v"))
        lengths = found.groupBy("dim").agg(F.count("*").alias("n"), F.max(
            F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("top")).orderBy(F.desc("n"), "dim").limit(1).collect()
        self.dim = int(lengths[0].dim) if lengths else 1
        self.n = int(lengths[0].n) if lengths else 0
        self.top = float(lengths[0].top) ** 0.5 * (1 + 1e-12) if lengths else 1.0
        self.found = found.where(F.col("dim") == self.dim).select("id", "v")
        self.matrix = np.random.default_rng(SEED).standard_normal((self.dim + 1, dims))
        self.depth = max(0, int(np.ceil(np.log2(max(1, min(MAX_CELLS, self.n / unit_rows))))))
        sample = self.found.withColumn("place", F.xxhash64(F.lit(SEED), "id")).orderBy("place", "id", "v").limit(sample_rows)
        drawn = np.array([r.v for r in sample.select("v").collect()], float).reshape(-1, self.dim)  # <= sample_rows rows
        self.splits = _split(_projected(drawn, self.matrix, self.top), self.depth)
        placed = scratch.write(self._placed(self.found, False), "placed")
        counts = {r.cell: r.n for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # <= MAX_CELLS
        self.units = {c: max(1, round(n / unit_rows)) for c, n in counts.items()}
        self.leaves = scratch.write(self._leaves(placed, dims, leaf_rows), "leaves")
        scratch.drop(placed)
        low, high = ([getattr(F, f)(F.col(c)[i]).alias(f"{c}{i}") for i in range(dims)] for f, c in (("min", "low"), ("max", "high")))
        boxes = self.leaves.groupBy("cell").agg(*low, *high).collect()  # at most MAX_CELLS rows
        self.cells = np.array([r.cell for r in boxes], np.int64)
        self.low = np.array([r[1:1 + dims] for r in boxes], float).reshape(-1, dims)
        self.high = np.array([r[1 + dims:] for r in boxes], float).reshape(-1, dims)

    def _placed(self, rows: DataFrame, query: bool) -> DataFrame:
        """(id, vector as bytes, cell) of rows (id, v)."""
        matrix, top, splits, depth, dim = self.matrix, None if query else self.top, self.splits, self.depth, self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                cell = _cells(_projected(x, matrix, top), splits, depth)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(cell)],
                    names=["id", "vector", "cell"])

        return rows.mapInArrow(run, "id long, vector binary, cell long")

    def _unit(self, by: F.Column) -> F.Column:
        """The unit of a row: its cell's rows are dealt over the cell's units by hash."""
        several = {c: n for c, n in self.units.items() if n > 1}
        if not several:
            return F.lit(0).cast("long")
        n = F.coalesce(F.create_map(*[F.lit(x).cast("long") for c in several.items() for x in c])[F.col("cell")], F.lit(1))
        return F.pmod(by, n).cast("long")

    def _leaves(self, placed: DataFrame, dims: int, leaf_rows: int) -> DataFrame:
        matrix, top, dim = self.matrix, self.top, self.dim

        def build(group: pa.Table) -> pa.Table:
            group = group.combine_chunks()
            ids = group.column("id").to_numpy()
            x = _matrix(group.column("vector"), dim)
            points = _projected(x, matrix, top)
            start = np.argsort(ids, kind="stable")
            out = [(ids[p], x[p], points[p].min(0), points[p].max(0)) for p in _leaves(points, start, leaf_rows)]
            n = len(out)
            return pa.table({"cell": [group.column("cell")[0].as_py()] * n, "unit": [group.column("unit")[0].as_py()] * n,
                             "low": [o[2] for o in out], "high": [o[3] for o in out],
                             "ids": [o[0].tobytes() for o in out], "vectors": [o[1].tobytes() for o in out]})

        rows = placed.withColumn("unit", self._unit(F.xxhash64(F.lit(SEED + 1), "id", "vector")))
        return rows.groupBy("cell", "unit").applyInArrow(
            build, "cell long, unit long, low array<double>, high array<double>, ids binary, vectors binary")

    def search(self, queries: DataFrame, k: int, confidence: float = CONFIDENCE) -> DataFrame:
        """(query_id, rank, vec_id, score) of the queries (id, v): at most k neighbours each."""
        scratch = self.scratch
        reach = chi_square_quantile(confidence, len(self.low[0])) if len(self.low) else 0.0
        asked = self._placed(queries.groupBy("id").agg(F.min("v").alias("v")), True)
        asked = scratch.write(asked.withColumn("block", F.pmod(
            F.xxhash64(F.lit(SEED + 2), "id"), F.lit(max(1, round(self.n / 20 / QUERY_BLOCK))))), "queries")
        first = scratch.write(self._visited(asked.withColumn("kth", F.lit(None).cast("double")), k, reach), "first")
        best = _best(first, k).groupBy("query_id").agg(F.max("rank").alias("n"), F.min("score").alias("least"))
        asked = asked.join(best.where(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("least").alias("kth")),
                           "id", "left")
        later = scratch.write(self._visited(self._further(asked, reach), k, reach), "later")
        return _best(first.unionByName(later), k).select("query_id", "rank", "vec_id", "score")

    def _further(self, asked: DataFrame, reach: float) -> DataFrame:
        """A row for each other cell that a query still has to visit."""
        matrix, dim, cells, low, high, top = self.matrix, self.dim, self.cells, self.low, self.high, self.top

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    x = _matrix(part.column(1), dim)
                    near = _box_distances(_projected(x, matrix, None), low, high)
                    bound = _squared_distance(x, part.column(3).to_numpy(zero_copy_only=False).astype(float), top)
                    go = (near <= reach * bound[:, None]) & (cells[None] != part.column(2).to_numpy()[:, None])
                    row, cell = np.nonzero(go)
                    rows = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0), rows.column(1), pa.array(cells[cell]), rows.column(3), rows.column(4)],
                        names=["id", "vector", "cell", "kth", "block"])

        return asked.select("id", "vector", "cell", "kth", "block").mapInArrow(
            run, "id long, vector binary, cell long, kth double, block long")

    def _visited(self, visits: DataFrame, k: int, reach: float) -> DataFrame:
        """(query_id, vec_id, score): what each visit finds that is not behind the query's ``kth``."""
        matrix, dim, top = self.matrix, self.dim, self.top
        n = F.coalesce(F.create_map(*[F.lit(x).cast("long") for c in self.units.items() for x in c])[F.col("cell")],
                       F.lit(1)) if self.units else F.lit(1)
        visits = visits.withColumn("unit", F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)))
        blocks = visits.select(*[F.col(c).alias(c) for c in ("cell", "unit")], (F.col("block") + 0).alias("block")).distinct()
        leaves = self.leaves.join(blocks, ["cell", "unit"]).select(*[F.col(c).alias(c) for c in (*self.leaves.columns, "block")])

        def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
            left, right = left.combine_chunks(), right.combine_chunks()
            if not left.num_rows or not right.num_rows:
                return pa.table({c: pa.array([], t) for c, t in (("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))})
            return _search_unit(left, right, matrix, dim, top, k, reach)

        return leaves.groupBy("cell", "unit", "block").cogroup(visits.groupBy("cell", "unit", "block")).applyInArrow(
            run, "query_id long, vec_id long, score double")


def _squared_distance(x: np.ndarray, score: np.ndarray, top: float) -> np.ndarray:
    """Squared distance of queries to points with these inner products; infinite for no score."""
    d = (x * x).sum(1) + top * top - 2 * score
    return np.where(np.isnan(score), np.inf, np.maximum(d, 0))


def _box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    gap = np.maximum(np.maximum(low[None] - points[:, None], points[:, None] - high[None]), 0)
    return (gap * gap).sum(2)


def _search_unit(leaves: pa.Table, asked: pa.Table, matrix: np.ndarray, dim: int, top: float, k: int, reach: float) -> pa.Table:
    """Incremental search of one unit for a block of queries, in rounds: in round r each query verifies its
    r-th nearest leaf unless the stopping test holds."""
    order = np.argsort(asked.column("id").to_numpy(), kind="stable")
    asked = asked.take(pa.array(order))
    qid = asked.column("id").to_numpy()
    x = _matrix(asked.column("vector"), dim)
    given = asked.column("kth").to_numpy().astype(float)
    kth = np.where(np.isnan(given), -np.inf, given)
    boxes = [np.array(leaves.column(c).to_pylist(), float) for c in ("low", "high")]
    ids = [np.frombuffer(b, np.int64) for b in leaves.column("ids").to_pylist()]
    vectors = [np.frombuffer(b, np.float64).reshape(-1, dim) for b in leaves.column("vectors").to_pylist()]
    points = _projected(x, matrix, None)
    near = np.concatenate([_box_distances(points[a:a + 512], *boxes) for a in range(0, len(points), 512)])
    turn = np.argsort(near, axis=1, kind="stable")
    row, vec, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for r in range(turn.shape[1]):
        leaf = turn[:, r]
        bound = _squared_distance(x, np.where(np.isinf(kth), np.nan, kth), top)
        active = near[np.arange(len(x)), leaf] <= reach * bound
        if not active.any():
            break
        got = []
        for number in np.unique(leaf[active]):
            who = np.flatnonzero(active & (leaf == number))
            v, v_ids = vectors[number], ids[number]
            s = x[who] @ v.T
            s[qid[who][:, None] == v_ids[None]] = -np.inf
            least = kth[who]
            if s.shape[1] > k:
                least = np.maximum(least, np.partition(s, -k, axis=1)[:, -k])
            at, hit = np.nonzero((s >= (least - 1e-9 * (1 + np.abs(least)))[:, None]) & (s > -np.inf))
            for a in range(0, len(at), 1 << 16):  # the scores proper: one sum for each pair, whatever the block
                i, j = who[at[a:a + (1 << 16)]], hit[a:a + (1 << 16)]
                got.append((i, v_ids[j], (x[i] * v[j]).sum(1)))
        row, vec, score = (np.concatenate([old, *(g[c] for g in got)]) for c, old in enumerate((row, vec, score)))
        best = np.lexsort((vec, -score, row))
        row, vec, score = row[best], vec[best], score[best]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < k
        row, vec, score = row[keep], vec[keep], score[keep]
        held = np.bincount(row, minlength=len(x))
        full = np.flatnonzero(held >= k)
        kth[full] = np.maximum(kth[full], score[np.cumsum(held)[full] - 1])
    keep = score >= np.where(np.isnan(given), -np.inf, given)[row]
    return pa.table({"query_id": qid[row[keep]], "vec_id": vec[keep], "score": score[keep]})


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = Index(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return index.search(index.found.where(F.col("id") % 20 == 0), 20)
