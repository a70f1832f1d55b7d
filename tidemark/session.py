"""Session helpers: building a local session for tests/bench, and locating the shared folder.

Materialised intermediates go under the folder the cluster names in ``spark.checkpoint.dir``. Only a
single-process ``local[...]`` session without that setting gets a scratch folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session tuned like a small cluster: AQE on, UI off, UTC clock."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.autoBroadcastJoinThreshold", str(64 << 20))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20,
               max_shuffle_partitions: int = 50_000) -> dict[str, str]:
    """Session settings for a large cluster run, sized from the input volume and the core count.

    Scans split at ``partition_bytes`` (about input/256 MB tasks); shuffles start with one partition per
    ``partition_bytes`` of input (at least two per core, capped so map statuses stay small) and AQE
    coalesces them to ``partition_bytes`` at run time and splits skewed join partitions. Broadcasts
    stay at 64 MB: every explicit broadcast in the library is checked against this threshold.
    """
    shuffle = int(min(max(2 * total_cores, input_bytes // partition_bytes), max_shuffle_partitions))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.parquet.filterPushdown": "true",
    }


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``, or the context's checkpoint folder if one was set."""
    value = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not value:
        value = spark.sparkContext.getCheckpointDir()
    return value or None


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediates: ``spark.checkpoint.dir`` as the session has it.

    Where it is unset, only a single-process ``local[...]`` master gets a scratch folder of its own (all its
    tasks see the same disk). A cluster without the setting is an error, never a machine-local folder.
    """
    current = checkpoint_dir(spark)
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share (master is {master})")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return checkpoint_dir(spark)


#: text files that are compressed as a whole are read by one task each
_UNSPLITTABLE = (".gz", ".zst", ".snappy", ".deflate", ".lz4")


def scan_splits(df: DataFrame) -> int:
    """About how many tasks read the input of ``df``: its size over ``spark.sql.files.maxPartitionBytes``, or its
    files where these cannot be split. Known from the plan's statistics, without a job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    limit = max(1, _parse_bytes(df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes", "128m")))
    by_size = -(-size // limit)
    files = df.inputFiles() if by_size > 1 else []  # a listing that the scan has made already
    if files and files[0].endswith(_UNSPLITTABLE):
        return min(by_size, len(files))
    return by_size


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``min_partitions`` (default: the cluster's default parallelism) only when fewer
    tasks than that would read it: a small table, or few unsplittable files. Large splittable files pass through
    without a shuffle, however few they are."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if scan_splits(df) < target else df


_run_folders: dict[str, str] = {}


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Intermediates written inside the block go to a folder of their own, which is deleted at its end."""
    key = spark.sparkContext.applicationId
    path = f"{shared_folder(spark).rstrip('/')}/tidemark/run-{uuid.uuid4().hex[:12]}"
    before = _run_folders.get(key)
    _run_folders[key] = path
    try:
        yield path
    finally:
        _run_folders.pop(key)
        if before:
            _run_folders[key] = before
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _intermediate(spark: SparkSession, name: str) -> str:
    base = _run_folders.get(spark.sparkContext.applicationId) or f"{shared_folder(spark).rstrip('/')}/tidemark"
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared folder and return a scan of it.

    This cuts lineage (a lost executor re-reads files instead of recomputing the plan) and lets several
    consumers share one execution. A cluster session without a shared folder is an error.
    """
    path = _intermediate(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize`` plus aggregate metrics (e.g. a row count) computed during the same write job.

    Returns (scan of the written table, metrics).
    """
    observation = Observation(f"tidemark-{uuid.uuid4().hex[:8]}")
    path = _intermediate(df.sparkSession, name)
    wanted = [c.alias(k) for k, c in metrics.items()]
    df.observe(observation, *wanted).write.mode("overwrite").parquet(path)
    written, taken = df.sparkSession.read.parquet(path), observed(observation)
    return written, taken if taken is not None else written.agg(*wanted).first().asDict()


def observed(observation: Observation) -> dict | None:
    """The metrics of an observed write; None where Spark found at run time that there are no rows and took none."""
    try:
        return dict(observation.get)
    except Py4JJavaError as exc:
        if exc.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return None


def estimated_row_bytes(frame: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Rough in-memory size of one row (of ``columns`` only, if given): 48 bytes of row overhead,
    string bytes, 8 bytes per other scalar, 24 bytes plus text per array element. Summed while a frame
    is written, it gives the size a broadcast decision is checked against."""
    size = F.lit(48)
    wanted = set(columns) if columns is not None else None
    for f in frame.schema.fields:
        if wanted is not None and f.name not in wanted:
            continue
        c = F.col(f.name)
        kind = f.dataType.simpleString()
        if kind == "string":
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind.startswith("array"):
            size = size + F.coalesce(F.size(c) * 24 + F.octet_length(F.array_join(c, "")), F.lit(0))
        else:
            size = size + 8
    return size.cast("bigint")


def _parse_bytes(text: str | None) -> int:
    if not text:
        return -1
    t = text.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        number = t[: -len(suffix)].strip()
        if t.endswith(suffix) and number.lstrip("-").isdigit():
            return int(number) * units[suffix]
    return int(t) if t.lstrip("-").isdigit() else -1


def broadcast_byte_limit(spark: SparkSession) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: never broadcast)."""
    return _parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b"))


def fits_broadcast(spark: SparkSession, rows: int, nbytes: int, max_rows: int,
                   max_bytes: int | None = None) -> bool:
    """True when a measured frame is within both the row and the byte bound."""
    limit = broadcast_byte_limit(spark) if max_bytes is None else max_bytes
    return rows <= max_rows and 0 <= nbytes <= limit


T = TypeVar("T")


def run_concurrently(tasks: Sequence[Callable[[], T]], max_workers: int = 8) -> list[T]:
    """Run independent driver-side steps (each submitting its own Spark jobs) from parallel threads.

    Spark schedules jobs from several threads at once; small independent jobs then overlap instead of
    queueing one after another. Results come back in task order; the first failure is raised.
    """
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]
