"""Shared helpers of the operators: tables, scratch tables in the shared folder, and byte-level word hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder

#: bytes of text handled at once by the numpy helpers (about 80 bytes of working memory for each)
CHUNK_BYTES = 1 << 18
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Tables written once under the shared folder of the session and read again.

    Writing cuts the lineage: a lost executor re-reads files. ``drop`` deletes a table that no later step
    reads, through the file system that Spark itself uses for the folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_folder(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
        self._paths: dict[int, str] = {}
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.base}/{self._n:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def write_marked(self, df: DataFrame, name: str) -> tuple[DataFrame, tuple[int, int]]:
        """``write``, and the count and an order-free checksum of the rows, taken during the same job."""
        seen = Observation()
        total = F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).alias("s")
        out = self.write(df.observe(seen, F.count(F.lit(1)).alias("n"), total), name)
        return out, (seen.get["n"], seen.get["s"])

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            path = self._paths.pop(id(frame), None)
            if path:
                self.delete(path)

    def delete(self, path: str) -> None:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsc.hadoopConfiguration()
        jvm_path.getFileSystem(conf).delete(jvm_path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside the block a job's shuffle files are deleted with its end, not when the driver next collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


# --- byte-level text helpers (inside Python tasks) ------------------------------------------------------

#: word bytes of `[^\x20\x09-\x0D]+`
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: letters, digits and every byte of a character beyond ASCII
ALNUM = np.zeros(256, dtype=bool)
ALNUM[ord("0"):ord("9") + 1] = ALNUM[ord("A"):ord("Z") + 1] = ALNUM[ord("a"):ord("z") + 1] = True
ALNUM[0x80:] = True
#: A-Z to a-z, every other byte as it is
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
SAME = np.arange(256, dtype=np.uint8)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse modulo 2^64."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, CHUNK_BYTES) + 1, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values (xor-shift and multiply rounds)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column without copying its text; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
                              else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offs


def doc_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) over runs of whole rows of about ``max_bytes``."""
    if not len(column):
        return
    data, offs = text_buffers(column)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
        hi = min(hi, n, lo + 50_000)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def word_spans(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each maximal run of word bytes; runs never cross rows."""
    word = is_word[data]
    if not len(word):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    edges = offs[(offs > 0) & (offs < len(data))]
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[edges] = word[edges]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[edges - 1] = word[edges - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, mapping: np.ndarray = LOWER) -> np.ndarray:
    """64-bit hashes of byte spans (sorted, not overlapping), in blocks of about ``CHUNK_BYTES``."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + CHUNK_BYTES, "right")))
        at, end = int(starts[lo]), int(ends[hi - 1])
        power, inverse = _power_tables(end - at)
        total = np.zeros(end - at + 1, np.uint64)
        np.cumsum((mapping[data[at:end]].astype(np.uint64) + np.uint64(1)) * power[:end - at], out=total[1:])
        s, e = starts[lo:hi] - at, ends[lo:hi] - at
        out[lo:hi] = (total[e] - total[s]) * inverse[s]
        lo = hi
    return mix64(out)
