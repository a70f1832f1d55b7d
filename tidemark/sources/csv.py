"""CSV ingest into the raw layer.

Every file is read with its declared schema; lineage columns record when, from which file and in which
batch each row was loaded. ``load_all`` loads a registry of files with per-file isolation and returns the
outcome as a DataFrame instead of printing it.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tidemark.session import materialize_observed
from tidemark.sources import schemas
from tidemark.sources.sinks import exists, overwrite_partitions, read_table, replace_partitions, write_table

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
CORRUPT_COLUMN = "_corrupt_record"

# Default registry: ``<table>.csv`` -> (``raw_<table>``, schema name). Callers pass their own mapping to
# load differently named files.
FILE_MAPPINGS: dict[str, tuple[str, str]] = {
    f"{name}.csv": (f"raw_{name}", name) for name in schemas.TABLE_SCHEMAS
}


def new_batch_id(now: _dt.datetime | None = None) -> str:
    """Batch id in the ``YYYYmmdd_HHMMSS`` form."""
    return (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType, *,
             timestamp_format: str = TIMESTAMP_FORMAT, enforce_schema: bool = True,
             keep_corrupt: bool = False) -> DataFrame:
    """Read CSV with a header row under a declared schema.

    Default behaviour is positional: header names are skipped, not checked; unparseable cells become
    null, short rows are null-padded, extra cells dropped. ``enforce_schema=False`` makes Spark check the
    header against the schema instead; ``keep_corrupt=True`` adds ``_corrupt_record`` holding the raw line
    of any row that did not parse cleanly.
    """
    read_schema = schema
    reader = (spark.read.option("header", True)
              .option("timestampFormat", timestamp_format)
              .option("enforceSchema", enforce_schema)
              .option("mode", "PERMISSIVE"))
    if keep_corrupt:
        read_schema = StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.schema(read_schema).csv(path)


def with_lineage(df: DataFrame, batch_id: str, source_file: str | Column | None = None) -> DataFrame:
    """Add ``_load_timestamp``, ``_source_file`` and ``_batch_id``.

    Without an explicit name the file of each row is taken from the scan's ``_metadata`` column, so one
    load of a folder of files still records the right file per row.
    """
    if source_file is None:
        source = F.col("_metadata.file_name")
    elif isinstance(source_file, str):
        source = F.lit(source_file)
    else:
        source = source_file
    return df.withColumns({
        "_load_timestamp": F.current_timestamp(),
        "_source_file": source,
        "_batch_id": F.lit(batch_id),
    })


@dataclass(frozen=True)
class LoadOutcome:
    source_file: str
    table: str
    ok: bool
    rows: int | None
    error: str | None


LOAD_STATUS_SCHEMA = StructType([
    StructField("source_file", StringType(), False),
    StructField("table_name", StringType(), False),
    StructField("loaded", BooleanType(), False),
    StructField("row_count", LongType(), True),
    StructField("error", StringType(), True),
])


def load_csv_table(spark: SparkSession, folder: str, file_name: str, target: str, schema: StructType,
                   batch_id: str, **read_options) -> LoadOutcome:
    """Load one CSV file into one raw table; never raises.

    ``_source_file`` is the registry's file name. The row count is taken from the written table, so the
    CSV is parsed once.
    """
    try:
        df = read_csv(spark, f"{folder.rstrip('/')}/{file_name}", schema, **read_options)
        write_table(with_lineage(df, batch_id, file_name), target, mode="overwrite")
        rows = read_table(spark, target).count()
        return LoadOutcome(file_name, target, True, rows, None)
    except Exception as exc:  # one bad file must not stop the others
        return LoadOutcome(file_name, target, False, None, f"{type(exc).__name__}: {exc}")


def load_all(spark: SparkSession, folder: str, target_prefix: str,
             mappings: dict[str, tuple[str, str]] | None = None, batch_id: str | None = None,
             **read_options) -> DataFrame:
    """Load every mapped file (S4); returns (source_file, table_name, loaded, row_count, error).

    ``target_prefix`` is a folder (``.../raw``) or a catalog namespace (``catalog.schema``).
    The loop runs over the file registry (eight entries), not over data.
    """
    batch = batch_id or new_batch_id()
    sep = "/" if "/" in target_prefix else "."
    outcomes = []
    for file_name, (table, schema_name) in (mappings or FILE_MAPPINGS).items():
        target = f"{target_prefix.rstrip(sep)}{sep}{table}"
        outcomes.append(load_csv_table(spark, folder, file_name, target,
                                       schemas.TABLE_SCHEMAS[schema_name], batch, **read_options))
    rows = [(o.source_file, o.table, o.ok, o.rows, o.error) for o in outcomes]
    return spark.createDataFrame(rows, LOAD_STATUS_SCHEMA)


# --- rejects ----------------------------------------------------------------------------------------------


def reject_reason(schema: StructType) -> tuple[Column, Column]:
    """(reason, columns) of a row read with ``keep_corrupt``: reason is null for a clean row, else ``short``, ``long``
    or ``type``; columns lists those whose text did not parse as their type.

    The raw line is parsed once more as plain strings, which fails only by the number of its cells."""
    names = [f.name for f in schema.fields]
    cells = StructType([StructField(f"c{i}", StringType(), True) for i in range(len(names))] + [StructField("_bad", StringType(), True)])
    wide = StructType([StructField(f"c{i}", StringType(), True) for i in range(len(names) + 1)])
    line = F.col(CORRUPT_COLUMN)
    text = F.from_csv(line, cells.simpleString()[len("struct<"):-1].replace(":", " "), {"columnNameOfCorruptRecord": "_bad"})
    wider = F.from_csv(line, wide.simpleString()[len("struct<"):-1].replace(":", " "))
    # an empty cell is null like a missing one: a line that ends in a further comma is long as well
    more = wider[f"c{len(names)}"].isNotNull() | (F.length(F.regexp_replace(line, "[^,]", "")) >= len(names))
    reason = F.when(line.isNull(), None).when(text["_bad"].isNull(), "type").when(more, "long").otherwise("short")
    unparsed = [F.when(text[f"c{i}"].isNotNull() & F.col(n).isNull(), F.lit(n)) for i, n in enumerate(names)]
    return reason, F.when(reason == "type", F.array_compact(F.array(*unparsed)))


REJECT_STATUS_SCHEMA = StructType([
    StructField("source_file", StringType(), False),
    StructField("table_name", StringType(), False),
    StructField("row_count", LongType(), False),
    StructField("rejected_count", LongType(), False),
])


def load_checked(spark: SparkSession, folder: str, file_name: str, target: str, reject_target: str, schema: StructType,
                 batch_id: str, **read_options) -> DataFrame:
    """Load one CSV file: rows that parse cleanly go to ``target``, the others to ``reject_target`` (raw line, reason,
    columns, lineage). Returns (source_file, table_name, row_count, rejected_count).

    The file is parsed once; both counts are observed during that scan."""
    df = read_csv(spark, f"{folder.rstrip('/')}/{file_name}", schema, keep_corrupt=True, **read_options)
    reason, columns = reject_reason(schema)
    parsed = with_lineage(df, batch_id, file_name).withColumns({"_reason": reason, "_columns": columns})
    rows, counts = materialize_observed(parsed, "parsed", good=F.count_if(F.col("_reason").isNull()),
                                        bad=F.count_if(F.col("_reason").isNotNull()))
    lineage = ["_load_timestamp", "_source_file", "_batch_id"]
    write_table(rows.where(F.col("_reason").isNull()).drop(CORRUPT_COLUMN, "_reason", "_columns"), target)
    rejected = rows.where(F.col("_reason").isNotNull()).select(
        F.col(CORRUPT_COLUMN).alias("line"), F.col("_reason").alias("reason"), F.col("_columns").alias("columns"), *lineage)
    write_table(rejected, reject_target)
    return spark.createDataFrame([(file_name, target, counts["good"], counts["bad"])], REJECT_STATUS_SCHEMA)


# --- load ledger ------------------------------------------------------------------------------------------

FILE_KEY = "_file_key"


def _files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, length, modified, file key) of the files of a folder; no content is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"),
                         F.lower(F.hex(F.xxhash64("path"))).alias(FILE_KEY))


def load_new(spark: SparkSession, folder: str, target: str, ledger: str, schema: StructType, batch_id: str,
             pattern: str = "*.csv", **read_options) -> DataFrame:
    """Load the files of a folder that the ledger does not know by path, size and modification time.

    Rows are kept by file, so a changed file replaces its own rows and nothing else; files that are known are not
    read. The ledger is written after the rows: a load that fails in between is repeated, with the same result.
    Returns (path, length, row_count) of the files loaded."""
    listed = _files(spark, folder, pattern)
    known = read_table(spark, ledger) if exists(spark, ledger) else None
    new = listed if known is None else listed.join(known, ["path", "length", "modified"], "left_anti")
    found = new.collect()  # a row for each new file, as the reader needs their paths
    status = StructType([StructField("path", StringType()), StructField("length", LongType()), StructField("row_count", LongType())])
    if not found:
        return spark.createDataFrame([], status)
    keys = [r[FILE_KEY] for r in found]
    rows = read_csv(spark, [r.path for r in found], schema, **read_options)
    key = F.lower(F.hex(F.xxhash64(F.col("_metadata.file_path"))))
    rows = with_lineage(rows.withColumn(FILE_KEY, key), batch_id, F.col("_metadata.file_name"))
    replace_partitions(rows, target, FILE_KEY, lambda c: c.isin(*keys))
    entries = spark.createDataFrame([(r.path, r.length, r.modified, r[FILE_KEY]) for r in found], new.schema).withColumn(
        "_batch_id", F.lit(batch_id))
    overwrite_partitions(entries, ledger, [FILE_KEY])
    counts = read_table(spark, target).where(F.col(FILE_KEY).isin(*keys)).groupBy(FILE_KEY).agg(F.count("*").alias("n"))
    return entries.join(counts, FILE_KEY, "left").select("path", "length", F.coalesce("n", F.lit(0).cast("long")).alias("row_count"))
