"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator family.

Each reads the driver tables under ``sf_dir`` through the fixture views and runs the real pipeline
stages. Stages shared by several queries (annotated and joined tables) are built once per
(session, folder, config) by ``flow`` and reused, as one pipeline run would; ``clear_flows`` forgets them
(the bench does so between timed queries).

Double columns are rounded to 4 decimals on output (``stable``) so that results compare across engines
whose floating-point summation order differs; the library functions themselves do not round.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

from tidemark.operators import engine, mart_state, marts, reporting
from tidemark.operators import transforms as T
from tidemark.operators.engine import ERRORS, WARNINGS
from tidemark.plans import checks
from tidemark.plans.pipeline import Flow, RunConfig, run
from tidemark.session import shared_folder
from tidemark.sources import catalog, csv, fixtures, footers, schemas, sinks

AS_OF = "2025-01-01"
INCREMENTAL_WINDOW = ("1997-01-01", "1997-12-31")
PART_OF_MONTH = ("1997-01-10", "1997-01-20")
SAMPLE_COLUMNS = {
    "customers": ["customer_id", "customer_name", "email", "customer_segment"],
    "delivery": ["order_id", "delivery_partner_id", "delivery_time_minutes", "distance_km", "delivery_status"],
}
BUCKETS = 8
SHORT = {"orders": "orders", "customers": "customers", "delivery": "delivery_performance"}

#: the incremental runs judge freshness at this time
CURRENT_TIME = "1997-01-20 12:00:00"
#: when orders of other months come again
REPEATED_TIME = "1997-01-15 10:30:00"

_FLOWS: dict[tuple, Flow] = {}
_PUBLISHED: dict[tuple, str] = {}


def clear_flows() -> None:
    _FLOWS.clear()
    _PUBLISHED.clear()


def flow(spark: SparkSession, sf_dir: str, **config) -> Flow:
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), tuple(sorted(config.items())))
    if key not in _FLOWS:
        cfg = RunConfig(as_of=AS_OF, **config)
        _FLOWS[key] = Flow(spark, fixtures.raw_tables(spark, sf_dir), cfg)
    return _FLOWS[key]


def stable(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column to ``digits`` (presentation for cross-engine comparison).

    Two steps: first to ``digits + 3`` places, which absorbs last-bit noise from summation order, then to
    ``digits``. One step would split exact half-way values (an average over 8 rows of 2-decimal amounts is
    often exactly ``x.xxxx5``) depending on which side of the tie the noise fell.
    """
    return df.select(*[F.round(F.round(F.col(f.name), digits + 3), digits).alias(f.name)
                       if isinstance(f.dataType, DoubleType) else F.col(f.name) for f in df.schema.fields])


def _joined_names(c: str) -> F.Column:
    return F.array_join(F.array_sort(F.col(c)), ",")


CLEAN_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_date", "promised_delivery_time", "actual_delivery_time",
               "delivery_status", "order_total", "payment_method", "delivery_partner_id", "store_id",
               "delivery_time_minutes", "is_on_time", "order_month", "order_year"],
    "customers": ["customer_id", "customer_name", "email", "phone", "address", "area", "pincode",
                  "registration_date", "customer_segment", "total_orders", "avg_order_value",
                  "customer_age_days", "is_premium", "registration_year"],
    "delivery": ["order_id", "delivery_partner_id", "promised_time", "actual_time", "delivery_time_minutes",
                 "distance_km", "delivery_status", "reasons_if_delayed", "is_delayed", "delay_category",
                 "delivery_efficiency"],
}


def _raw(name: str):
    fn = {"orders": fixtures.raw_orders, "customers": fixtures.raw_customers, "delivery": fixtures.raw_delivery}[name]
    return lambda spark, sf: stable(fn(spark, sf))


def _clean(name: str):
    return lambda spark, sf: stable(flow(spark, sf).processed(SHORT[name]).select(*CLEAN_COLUMNS[name]))


def _profile(name: str):
    return lambda spark, sf: T.completeness_profile(flow(spark, sf).processed(SHORT[name]), SHORT[name])


def _rule_results(name: str):
    def q(spark, sf):
        res = reporting.rule_results(flow(spark, sf).checked(SHORT[name]))
        return res.select("rule_name", "criticality", "failed_records_count", "check_status")
    return q


def _valid(name: str):
    def q(spark, sf):
        v = flow(spark, sf).valid(SHORT[name])
        return stable(v.select(*CLEAN_COLUMNS[name], _joined_names(WARNINGS).alias("warnings")))
    return q


def _quarantine(name: str):
    def q(spark, sf):
        v = flow(spark, sf).quarantine(SHORT[name])
        return stable(v.select(*CLEAN_COLUMNS[name], _joined_names(ERRORS).alias("errors"),
                               _joined_names(WARNINGS).alias("warnings")))
    return q


def quality_summary(spark, sf):
    return stable(flow(spark, sf).quality_summary(), 6)


def overall_quality_score(spark, sf):
    return stable(reporting.overall_score(flow(spark, sf).quality_summary()), 6)


def quarantine_by_rule(spark, sf):
    f = flow(spark, sf)
    parts = [reporting.quarantine_by_rule(f.quarantine(t)).select(F.lit(t).alias("table_name"), "*")
             for t in ("orders", "customers", "delivery_performance")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quarantine_sample_orders(spark, sf):
    cols = ["order_id", "customer_id", "order_total", "delivery_status"]
    sample = reporting.quarantine_sample(flow(spark, sf).quarantine("orders"), cols, cols, 3)
    return stable(sample.select(*cols, _joined_names(ERRORS).alias("errors")))


def analytics_main(spark, sf):
    return stable(flow(spark, sf).joined)


def _mart(fn: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf: stable(fn(flow(spark, sf).joined))


def monthly_growth(spark, sf):
    return stable(marts.monthly_growth(flow(spark, sf).monthly))


def customer_ranking(spark, sf):
    return stable(marts.customer_ranking(flow(spark, sf).joined))


def table_row_counts(spark, sf):
    f = flow(spark, sf)
    tables = {f"raw_{t}": f.raw[t] for t in ("orders", "customers", "delivery_performance")}
    tables.update({f"final_{t}": f.valid(t) for t in ("orders", "customers", "delivery_performance")})
    tables.update({f"quarantine_{t}": f.quarantine(t) for t in ("orders", "customers", "delivery_performance")})
    tables["analytics_main"] = f.joined
    return catalog.table_row_counts(spark, tables)


def preview_final_orders(spark, sf):
    cols = ["order_id", "customer_id", "order_total", "delivery_status", "order_month"]
    return stable(catalog.preview(flow(spark, sf).valid("orders"), cols, cols, 5))


def _freshness(min_records: int):
    def q(spark, sf):
        events = fixtures.freshness_input(spark, sf)
        check = checks.FRESHNESS | {"min_records_per_window": min_records}
        return engine.freshness_report(events, "ts", **check)
    return q


def run_window_orders(spark, sf):
    start, end = INCREMENTAL_WINDOW
    f = flow(spark, sf, run_mode="incremental", start_date=start, end_date=end)
    return stable(f.processed("orders").select(*CLEAN_COLUMNS["orders"]))


def _base(spark, sf, table):
    return spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet")


def lineitem_rule_results(spark, sf):
    """Counts alone: the base table is read in place, with the columns the rules need, and nothing is kept."""
    checked = engine.annotate(_base(spark, sf, "lineitem"), checks.lineitem_rules())
    return reporting.rule_results(checked).select("rule_name", "criticality", "failed_records_count", "check_status")


def lineitem_quality(spark, sf):
    checked = engine.annotate(_base(spark, sf, "lineitem"), checks.lineitem_rules())
    return stable(reporting.quality_score(checked.annotated, "lineitem"), 6)


def fired_rule_results(spark, sf):
    """Every dataset-level kind of rule in a violating state, over the base orders table."""
    checked = engine.annotate(_base(spark, sf, "orders"), checks.firing_rules())
    return reporting.rule_results(checked).select("rule_name", "criticality", "failed_records_count", "check_status")


def _scratch(spark, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def _config(**more) -> RunConfig:
    return RunConfig(as_of=AS_OF, freshness_curr_timestamp=CURRENT_TIME, **more)


def _incremental(spark, sf) -> str:
    """Folder of the tables after a full run and a run for part of a month; published once for several queries."""
    key = (spark.sparkContext.applicationId, id(spark), sf.rstrip("/"))
    if key not in _PUBLISHED:
        out, raw = _scratch(spark, "published"), fixtures.raw_tables(spark, sf)
        run(spark, raw, out, _config(batch_id="full"))
        start, end = PART_OF_MONTH
        run(spark, raw, out, _config(batch_id="part", run_mode="incremental", start_date=start, end_date=end))
        _PUBLISHED[key] = out
    return _PUBLISHED[key]


def _published(spark, sf, name: str) -> DataFrame:
    return spark.read.parquet(f"{_incremental(spark, sf)}/{name}")


def incremental_final_orders(spark, sf):
    final = _published(spark, sf, "final_orders")
    return stable(final.select(*CLEAN_COLUMNS["orders"], _joined_names(WARNINGS).alias("warnings")))


def _stored_split(spark, sf):
    """Valid and quarantined orders of one table, which holds each checked row once."""
    checked = flow(spark, sf).checked("orders").written(_scratch(spark, "checked"), within=["order_month"])
    return checked.valid(), checked.quarantine()


def stored_valid_orders(spark, sf):
    valid, _ = _stored_split(spark, sf)
    return stable(valid.select(*CLEAN_COLUMNS["orders"], _joined_names(WARNINGS).alias("warnings")))


def stored_quarantine_orders(spark, sf):
    _, bad = _stored_split(spark, sf)
    return stable(bad.select(*CLEAN_COLUMNS["orders"], _joined_names(ERRORS).alias("errors"),
                             _joined_names(WARNINGS).alias("warnings")))


def _incremental_mart(name: str):
    """A mart finished from merged state, after a run for part of a month."""
    return lambda spark, sf: stable(_published(spark, sf, name).drop("_created_timestamp"))


def _footer_profile(table: str):
    """T4 of a published table, from its files' footers."""
    def q(spark, sf):
        path = f"{_incremental(spark, sf)}/processed_{table}"
        measures = T.profile_measures(table)
        row = footers.measured(spark, path, measures)
        return spark.createDataFrame([row[:len(measures)]], T.profile_schema(table))
    return q


def column_report(spark, sf):
    """S8 of the published processed tables, with the rows and non-null values of each column."""
    out = _incremental(spark, sf)
    tables = {f"processed_{t}": f"{out}/processed_{t}" for t in SHORT.values()}
    report = catalog.column_report(spark, tables, {"processed_orders": ["order_month"]})
    return report.select("table_name", "column_name", "data_type", "row_count", "non_null_count")


def table_metadata(spark, sf):
    """S9 as published, with the rows of each table it describes."""
    out = _incremental(spark, sf)
    described = spark.read.parquet(f"{out}/table_metadata")
    counts = catalog.table_row_counts(spark, {r[0]: f"{out}/{r[0]}" for r in catalog.TABLE_METADATA})
    return described.join(F.broadcast(counts), "table_name").select("table_name", "description", "category", "row_count")


def stamped_final_orders(spark, sf):
    """P10: the processing time and the share of rules that a row violates."""
    score = F.col("_data_quality_score").alias("data_quality_score")
    return stable(_published(spark, sf, "final_orders").select(
        "order_id", "customer_id", F.col("_processed_timestamp").isNotNull().alias("has_processing_time"), score))


def stamped_analytics_main(spark, sf):
    """D-10: rows of the months that the second run replaced carry its batch, the others that of the first."""
    return _published(spark, sf, "analytics_main").select(
        "order_id", "order_month", F.col("_created_timestamp").isNotNull().alias("has_creation_time"),
        F.col("_batch_id").alias("batch_id"))


def incremental_duplicates(spark, sf):
    """The quarantined orders of a month in which orders of other months come again: found through the state of
    published keys, as the run reads no other row of these months."""
    out, raw = _scratch(spark, "published"), fixtures.raw_tables(spark, sf)
    start, end = PART_OF_MONTH
    run(spark, raw, out, _config(batch_id="full"))
    month = F.date_format("order_date", "yyyy-MM")
    repeated = F.col("order_id").cast("long") % 41 == 3
    again = raw["orders"].where(repeated & (month != start[:7])).withColumn(
        "order_date", F.lit(REPEATED_TIME).cast(raw["orders"].schema["order_date"].dataType))
    more = raw | {"orders": raw["orders"].unionByName(again)}
    run(spark, more, out, _config(batch_id="part", run_mode="incremental", start_date=start, end_date=end))
    bad = spark.read.parquet(f"{out}/quarantine_orders").where(F.col("order_month") == start[:7])
    return bad.select("order_id", "customer_id", "order_date", "order_month", _joined_names(ERRORS).alias("errors"))


def analytics_main_bucketed(spark, sf):
    """J1 over orders and delivery as published in bucketed tables."""
    f = flow(spark, sf)
    mark = uuid.uuid4().hex[:12]
    tables = {}
    for short, table in (("orders", "orders"), ("delivery", "delivery_performance")):
        tables[short] = f"tidemark_{short}_{mark}"
        sinks.write_bucketed(f.valid(table), tables[short], ["order_id"], BUCKETS, path=_scratch(spark, short))
    joined = marts.join_orders(spark.table(tables["orders"]), f.valid("customers"), spark.table(tables["delivery"]))
    return stable(joined)


def mart_cube(spark, sf):
    """The state that marts are merged from: counts and exact sums by month and group."""
    cube = mart_state.cube(flow(spark, sf).joined)
    sums = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in cube.schema.fields]
    return stable(cube.select(*sums))


def _loaded(spark, sf, tables=("orders", "customers", "delivery_performance")):
    """(status of the load, folder of the loaded tables) of the raw tables written as CSV files first."""
    folder, raw = _scratch(spark, "csv"), fixtures.raw_tables(spark, sf)
    for table in tables:
        (raw[table].write.option("header", True).option("timestampNTZFormat", csv.TIMESTAMP_FORMAT)
         .option("dateFormat", "yyyy-MM-dd").csv(f"{folder}/{table}.csv"))
    out = _scratch(spark, "loaded")
    mapping = {f"{t}.csv": (f"raw_{t}", t) for t in tables}
    return csv.load_all(spark, folder, out, mappings=mapping, batch_id="b1"), out


def ingested_orders(spark, sf):
    _, out = _loaded(spark, sf, ("orders",))
    loaded = spark.read.parquet(f"{out}/raw_orders")
    columns = fixtures.raw_orders(spark, sf).columns
    return stable(loaded.select(*columns, "_batch_id", F.col("_source_file").endswith(".csv").alias("from_csv"),
                                F.col("_load_timestamp").isNotNull().alias("has_load_time")))


def ingest_status(spark, sf):
    status, _ = _loaded(spark, sf)
    return status.select("source_file", F.element_at(F.split("table_name", "/"), -1).alias("table_name"), "loaded",
                         "row_count")


def _faulty_csv(spark, sf):
    """(status, rejects, loaded) of the raw orders written as CSV lines of which some are short, long or of a wrong type."""
    folder = _scratch(spark, "csv")
    orders = fixtures.raw_orders(spark, sf)
    number = F.coalesce(F.col("order_id").cast("long"), F.lit(0)) % 13
    cells = [F.coalesce(F.date_format(c, csv.TIMESTAMP_FORMAT) if kind.startswith("timestamp") else F.col(c).cast("string"), F.lit(""))
             for c, kind in orders.dtypes]
    at = orders.columns.index("order_total")
    whole = F.concat_ws(",", *cells)
    faulty = (F.when(number == 1, F.concat_ws(",", *cells[:-2])).when(number == 2, F.concat(whole, F.lit(",more")))
              .when(number == 3, F.concat_ws(",", *cells[:at], F.lit("n/a"), *cells[at + 1:])).otherwise(whole))
    orders.select(faulty.alias(",".join(orders.columns))).write.option("header", True).option("quote", "\u0000").option(
        "sep", "\u0001").csv(f"{folder}/orders.csv")
    loaded, rejects = _scratch(spark, "loaded"), _scratch(spark, "rejects")
    status = csv.load_checked(spark, folder, "orders.csv", loaded, rejects, schemas.TABLE_SCHEMAS["orders"], "b1")
    return status, spark.read.parquet(rejects), spark.read.parquet(loaded)


def ingest_rejects(spark, sf):
    _, rejects, _ = _faulty_csv(spark, sf)
    return rejects.select(F.split("line", ",")[0].alias("order_id"), "reason", F.array_join("columns", ",").alias("columns"))


def ingest_reject_status(spark, sf):
    status, rejects, loaded = _faulty_csv(spark, sf)
    return status.select("source_file", "row_count", "rejected_count").crossJoin(
        loaded.agg(F.count("*").alias("loaded_rows"))).crossJoin(rejects.agg(F.count("*").alias("reject_rows")))


def _csv_file(df: DataFrame, path: str) -> None:
    """A single CSV file of the raw table at a fixed path, in place of an earlier one. One task writes it: ``df`` should
    be a scan of the file's own rows and no more."""
    spark, parts = df.sparkSession, f"{path}__parts"
    (df.coalesce(1).write.mode("overwrite").option("header", True).option("timestampNTZFormat", csv.TIMESTAMP_FORMAT).csv(parts))
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(parts).select("path").collect()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(hadoop(path), True)
    files.rename(hadoop(names[0].path), hadoop(path))


def ledger_loads(spark, sf):
    """Raw orders of three files, loaded three times: all, none (nothing is new), and one changed file, whose rows
    replace its earlier ones."""
    folder, target, ledger = (_scratch(spark, n) for n in ("files", "loaded", "ledger"))
    number = F.coalesce(F.col("order_id").cast("long"), F.lit(0)) % 3
    dealt = _scratch(spark, "dealt")
    fixtures.raw_orders(spark, sf).withColumn("_number", number).write.partitionBy("_number").parquet(dealt)
    orders, number = spark.read.parquet(dealt), F.col("_number")
    for n in range(3):
        _csv_file(orders.where(number == n).drop("_number"), f"{folder}/orders_{n}.csv")
    schema = schemas.TABLE_SCHEMAS["orders"]
    loads = [csv.load_new(spark, folder, target, ledger, schema, "b1", pattern="orders_?.csv").count(),
             csv.load_new(spark, folder, target, ledger, schema, "b2", pattern="orders_?.csv").count()]
    changed = orders.where((number == 1) & (F.col("order_id").cast("long") % 2 == 0))
    _csv_file(changed.drop("_number"), f"{folder}/orders_1.csv")
    loads.append(csv.load_new(spark, folder, target, ledger, schema, "b3", pattern="orders_?.csv").count())
    return stable(spark.read.parquet(target).select(
        "order_id", "customer_id", "order_total", F.element_at(F.split("_source_file", "/"), -1).alias("source_file"), "_batch_id",
        F.lit(",".join(str(n) for n in loads)).alias("files_loaded")))


def logged_rule_results(spark, sf):
    """The rule logs of two runs, the first of them tried twice, read back."""
    target = _scratch(spark, "log")
    checked = flow(spark, sf).checked("orders")
    for run_id in ("first", "second", "first"):
        sinks.replace_run(reporting.rule_log(checked, run_id=run_id), target, run_id)
    return spark.read.parquet(target).select("run_id", "rule_name", "criticality", "failed_records_count", "check_status")


def _sample(name: str):
    def q(spark, sf):
        cols = SAMPLE_COLUMNS[name]
        sample = reporting.quarantine_sample(flow(spark, sf).quarantine(SHORT[name]), cols, cols, 3)
        return stable(sample.select(*cols, _joined_names(ERRORS).alias("errors")))
    return q


def _preview(name: str):
    def q(spark, sf):
        cols = SAMPLE_COLUMNS[name]
        return stable(catalog.preview(flow(spark, sf).valid(SHORT[name]), cols, cols, 5))
    return q


INCREMENTAL_MARTS = {
    "segment_analysis": "customer_segment_analysis", "monthly_performance": "monthly_performance",
    "delivery_analysis": "delivery_analysis", "customer_ranking": "customer_ranking",
    "payment_analysis": "payment_analysis", "kpi_summary": "kpi_summary",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for t in ("orders", "customers", "delivery"):
        q[f"raw_{t}"] = _raw(t)
        q[f"clean_{t}"] = _clean(t)
        q[f"profile_{t}"] = _profile(t)
        q[f"rule_results_{t}"] = _rule_results(t)
        q[f"valid_{t}"] = _valid(t)
        q[f"quarantine_{t}"] = _quarantine(t)
    for t in SAMPLE_COLUMNS:
        q[f"quarantine_sample_{t}"] = _sample(t)
        q[f"preview_final_{t}"] = _preview(t)
    q.update({
        "quality_summary": quality_summary,
        "overall_quality_score": overall_quality_score,
        "quarantine_by_rule": quarantine_by_rule,
        "quarantine_sample_orders": quarantine_sample_orders,
        "analytics_main": analytics_main,
        "segment_analysis": _mart(marts.segment_analysis),
        "monthly_performance": _mart(marts.monthly_performance),
        "monthly_growth": monthly_growth,
        "delivery_analysis": _mart(marts.delivery_analysis),
        "customer_ranking": customer_ranking,
        "payment_analysis": _mart(marts.payment_analysis),
        "kpi_summary": _mart(marts.kpi_summary),
        "table_row_counts": table_row_counts,
        "preview_final_orders": preview_final_orders,
        "fired_rule_results": fired_rule_results,
        "incremental_final_orders": incremental_final_orders,
        **{f"incremental_{short}": _incremental_mart(name) for short, name in INCREMENTAL_MARTS.items()},
        **{f"footer_profile_{short}": _footer_profile(name) for short, name in SHORT.items()},
        "stored_valid_orders": stored_valid_orders,
        "stored_quarantine_orders": stored_quarantine_orders,
        "column_report": column_report,
        "table_metadata": table_metadata,
        "stamped_final_orders": stamped_final_orders,
        "stamped_analytics_main": stamped_analytics_main,
        "incremental_duplicates": incremental_duplicates,
        "analytics_main_bucketed": analytics_main_bucketed,
        "mart_cube": mart_cube,
        "ingest_rejects": ingest_rejects,
        "ingest_reject_status": ingest_reject_status,
        "ledger_loads": ledger_loads,
        "ingested_orders": ingested_orders,
        "ingest_status": ingest_status,
        "logged_rule_results": logged_rule_results,
        "freshness_events": _freshness(checks.FRESHNESS["min_records_per_window"]),
        "freshness_events_min12": _freshness(12),
        "run_window_orders": run_window_orders,
        "lineitem_rule_results": lineitem_rule_results,
        "lineitem_quality": lineitem_quality,
    })
    return q
