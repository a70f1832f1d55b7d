"""Table sinks: full refresh, append, and dynamic partition overwrite.

A target is either a path (contains ``/``) or a catalog table name. All writes are single Spark jobs
(tasks write their own files; nothing passes through the driver).
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import delete_path, observed


def is_path(target: str) -> bool:
    """Whether a target is a path; otherwise it is a catalog name."""
    return "/" in target or target.startswith("file:")


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """Scan a layer table by path or catalog name."""
    return spark.read.parquet(target) if is_path(target) else spark.table(target)


def _rebalanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of a partition value gathered into few tasks, with AQE splitting a hot value into
    advisory-sized pieces: few files per partition and no single task holding a hot month."""
    return df.hint("rebalance", *partition_by)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.rename(path(source), path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def write_table(df: DataFrame, target: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Full-refresh (S3) or append (S10) write, optionally partitioned.

    A refresh writes beside the table and then takes its place, so a run that fails leaves the old table whole and
    readers never see half of a new one. (Between the two renames of a folder there is a moment without a table;
    a catalog renames its own entries.)"""
    spark = df.sparkSession
    if partition_by:
        df = _rebalanced(df, partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode != "overwrite" or not exists(spark, target):
        writer.parquet(target) if is_path(target) else writer.format("parquet").saveAsTable(target)
        return
    mark = uuid.uuid4().hex[:12]
    base = target.rstrip("/")
    staged, old = f"{base}__new_{mark}", f"{base}__old_{mark}"
    if is_path(target):
        try:
            writer.parquet(staged)
        except Exception:
            delete_path(spark, staged)
            raise
        _rename(spark, base, old)
        _rename(spark, staged, base)
        delete_path(spark, old)
        return
    try:
        writer.format("parquet").saveAsTable(staged)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
    spark.sql(f"DROP TABLE {old}")


def write_bucketed(df: DataFrame, table: str, columns: list[str], buckets: int, partition_by: list[str] | None = None,
                   path: str | None = None) -> None:
    """A catalog table whose files are split by the hash of ``columns``: joins on them need no shuffle of this side.

    Rows are dealt by the same hash first, so that each task writes the files of one bucket."""
    writer = df.repartition(buckets, *columns).write.mode("overwrite").bucketBy(buckets, *columns).sortBy(*columns)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.format("parquet").saveAsTable(table)


RUN_PARTITION = "_run"


def replace_run(df: DataFrame, target: str, run_id: str) -> None:
    """Rows of one run (Q11, S10): appended to those of other runs, replacing those of an earlier try of this run."""
    overwrite_partitions(df.withColumn(RUN_PARTITION, F.lit(f"run={run_id}")), target, [RUN_PARTITION])


def append_table(df: DataFrame, target: str) -> None:
    """Append rows, e.g. the rule log."""
    write_table(df, target, mode="append")


_CONF_LOCK = threading.Lock()


def exists(spark: SparkSession, target: str) -> bool:
    """Whether a table is there; errors other than its absence are raised."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def partition_values(spark: SparkSession, target: str, column: str) -> list[str | None]:
    """The values of a table's partition column, from its folders or its catalog entries."""
    if not is_path(target):
        listed = [r[0].rpartition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {target}").collect()]
    else:
        base = spark._jvm.org.apache.hadoop.fs.Path(target)
        names = [s.getPath().getName() for s in base.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(base)]
        listed = [n.rpartition("=")[2] for n in names if n.startswith(f"{column}=")]
    return [None if v in ("__HIVE_DEFAULT_PARTITION__", "null") else v for v in listed]


def _partitions(spark: SparkSession, target: str, columns: list[str]) -> list[tuple]:
    """The partitions of a table, a value a column."""
    if not is_path(target):
        shown = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {target}").collect()]
        values = [tuple(part.partition("=")[2] for part in parts) for parts in shown]
        return [tuple(None if v in ("__HIVE_DEFAULT_PARTITION__", "null") else v for v in vs) for vs in values]
    base, found = target.rstrip("/"), [()]
    for column in columns:
        found = [(*above, v) for above in found
                 for v in partition_values(spark, _partition_path(base, columns, above), column)]
    return found


def _partition_path(base: str, columns: list[str], values: tuple) -> str:
    named = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(columns, values)]
    return "/".join([base, *named])


def _drop_partition(spark: SparkSession, target: str, columns: list[str], values: tuple) -> None:
    if is_path(target):
        delete_path(spark, _partition_path(target.rstrip("/"), columns, values))
    else:
        shown = ", ".join(f"{c} = " + ("null" if v is None else "'" + v.replace("'", "''") + "'") for c, v in zip(columns, values))
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({shown})")


def replace_partitions(df: DataFrame, target: str, column: str, touched: Callable[[Column], Column],
                       within: Sequence[str] = ()) -> None:
    """Replace the partitions of ``column`` for which ``touched`` holds by the rows of ``df`` (which are of
    such partitions only); touched partitions that ``df`` has no rows for are removed, also those of the further
    partition columns ``within``.

    The values that ``df`` holds (one a partition) are observed while it is written, so it runs once."""
    spark = df.sparkSession
    if not exists(spark, target):
        write_table(df, target, partition_by=[column, *within])
        return
    columns = [column, *within]
    seen = Observation()
    overwrite_partitions(df.observe(seen, F.collect_set(F.struct(*columns)).alias("values")), target, columns)
    written = observed(seen) or {"values": []}
    present = {tuple(v) for v in written["values"] or []}
    stale = [p for p in _partitions(spark, target, columns) if p not in present]
    schema = ", ".join(f"{c} string" for c in columns)
    for row in spark.createDataFrame(stale, schema).where(touched(F.col(column))).collect():
        _drop_partition(spark, target, columns, tuple(row))


def overwrite_partitions(df: DataFrame, target: str, partition_by: list[str]) -> None:
    """Replace only the partitions present in ``df`` (incremental runs, S11).

    Dynamic partition overwrite is requested per write (writer option), so concurrent writes in the
    same session are not affected; months outside the run window are left untouched.
    """
    spark = df.sparkSession
    df = _rebalanced(df, partition_by)
    if is_path(target):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(target))
        return
    if not spark.catalog.tableExists(target):
        df.write.partitionBy(*partition_by).format("parquet").saveAsTable(target)
        return
    # insertInto matches by position and takes the mode from the session: set it under a lock.
    columns = spark.table(target).columns
    with _CONF_LOCK:
        previous = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            df.select(*columns).write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", previous)
