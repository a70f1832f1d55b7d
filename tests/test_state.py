"""Mergeable state of rules and marts, tables that are replaced whole, bucketed joins, rejects and the load ledger."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

import tidemark.operators.engine as E
from tests.conftest import SF_SMALL
from tidemark.operators import mart_state, marts, rules as R
from tidemark.plans import checks
from tidemark.plans.pipeline import Flow, RunConfig
from tidemark.session import spread
from tidemark.sources import csv, fixtures, sinks


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _flow(spark):
    return Flow(spark, fixtures.raw_tables(spark, SF_SMALL), RunConfig(as_of="2025-01-01"))


RULES = [
    R.rule("one key", "error", R.is_unique(["k"])),
    R.rule("pair", "warn", R.is_unique(["k", "g"])),
    R.rule("enough", "error", R.is_aggr_not_less_than("*", "count", 25)),
    R.rule("most of a group", "warn", R.is_aggr_not_greater_than("v", "avg", 4.5, group_by=["g"])),
    R.rule("sum of a group", "warn", R.is_aggr_not_greater_than("v", "sum", 60, group_by=["g"])),
    R.rule("largest", "warn", R.is_aggr_not_greater_than("v", "max", 8, group_by=["k"])),
    R.rule("any bad", "warn", R.sql_condition("v = 7", merge_columns=["k"])),
    R.rule("fresh", "warn", R.is_data_fresh_per_time_window("t", 60, 4, 6, curr_timestamp="2024-02-01 06:00:00")),
]


def _rows(seed, month, n):
    rng = random.Random(seed)
    return [(month, rng.choice([None, *range(n)]), rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(10)]),
             f"2024-02-01 0{rng.randrange(6)}:{rng.randrange(60):02d}:00" if rng.random() < 0.9 else None) for _ in range(n)]


@pytest.mark.parametrize("broadcast_rows", [2_000_000, 0])
def test_state_judges_like_the_published_rows(spark, broadcast_rows):
    schema = "part string, k long, g string, v long, t string"
    frame = lambda rows: spark.createDataFrame(rows, schema).withColumn("t", F.col("t").cast("timestamp_ntz"))
    old, new = frame(_rows(1, "2024-01", 30) + _rows(2, None, 10)), frame(_rows(3, "2024-02", 20))
    gate = E.Gate(max_rows=broadcast_rows)
    state = E.annotate(old, RULES, state_part="part").state
    columns = ["k", "g", "v", "t"]

    def result(checked):
        rows = checked.annotated.select(*columns, F.array_sort("_errors"), F.array_sort("_warnings")).collect()
        outcomes = checked.outcomes.collect()
        return sorted(map(str, rows)), sorted(map(str, outcomes))

    by_rows = result(E.annotate(new, RULES, gate, history=old))
    assert result(E.annotate(new, RULES, gate, state=state)) == by_rows
    assert result(E.annotate(new, RULES, gate, state=state, state_part="part")) == by_rows
    assert any("one key" in r for r in by_rows[0]) and any("any bad" in r for r in by_rows[0])
    # a state of no rows at all, and new rows without any
    empty = E.annotate(old.limit(0), RULES, state_part="part").state
    assert result(E.annotate(new, RULES, gate, state=empty)) == result(E.annotate(new, RULES, gate))
    assert E.annotate(new.limit(0), RULES, gate, state=state).annotated.count() == 0


def test_the_lookup_reads_touched_keys_only(spark):
    schema = "part string, k long, g string, v long, t string"
    frame = lambda rows: spark.createDataFrame(rows, schema).withColumn("t", F.col("t").cast("timestamp_ntz"))
    state = E.annotate(frame([("a", k, "x", 1, None) for k in range(1000)]), RULES[:1], state_part="part").state
    partials = E._write_partials(frame([("b", k, "x", 1, None) for k in (500, 510)]), tuple(RULES[:1]), E.Gate(), state, None, "t")
    found = partials._touched(("k",))
    assert sorted(r.k for r in found.collect()) == [500, 510]
    plan = _plan(found)
    assert "GreaterThanOrEqual(k,500)" in plan and "LessThanOrEqual(k,510)" in plan  # row groups outside are skipped
    assert "LeftSemi" in plan and "Exchange hashpartitioning(k" not in plan.split("LeftSemi")[1].split("BroadcastExchange")[0]


def test_a_key_lattice_scans_the_rows_once(spark, monkeypatch):
    f = _flow(spark)
    processed = f.processed("orders")
    scan = re.compile(r"Location: InMemoryFileIndex[^\n]*processed-orders")
    scans = []
    for name in ("materialize_observed", "materialize"):
        original = getattr(E, name)

        def spy(df, label, *args, _original=original, **metrics):
            if label.startswith(("partials-", "violations-", "global-")):
                scans.append((label.split("-")[0], len(scan.findall(_plan(df)))))
            return _original(df, label, *args, **metrics)

        monkeypatch.setattr(E, name, spy)
    E.annotate(processed, checks.orders_rules())
    # three key sets and the table-wide limits: one scan for the partials, none for what is rolled up from them
    assert sorted(scans) == [("global", 0), ("partials", 1), ("violations", 0), ("violations", 0), ("violations", 0)]


def test_marts_from_state_equal_marts_of_the_rows(spark):
    joined = _flow(spark).joined
    months = [r[0] for r in joined.select("order_month").distinct().collect()]
    half = F.col("order_month").isin(sorted(m for m in months if m)[::2])
    parts = [joined.where(half), joined.where(~F.coalesce(half, F.lit(False)))]
    cube, groups = (fn(parts[0]).unionByName(fn(parts[1])) for fn in mart_state.STATES.values())
    rows = {"customer_segment_analysis": marts.segment_analysis, "monthly_performance": marts.monthly_performance,
            "delivery_analysis": marts.delivery_analysis, "customer_ranking": marts.customer_ranking,
            "payment_analysis": marts.payment_analysis, "kpi_summary": marts.kpi_summary}
    for name, df in mart_state.all_marts(cube, groups).items():
        want = rows[name](joined)
        assert df.select(*want.columns).exceptAll(want).count() == 0 and df.count() == want.count(), name
    empty = mart_state.all_marts(*[fn(joined.limit(0)) for fn in mart_state.STATES.values()])
    assert {n: df.count() for n, df in empty.items() if n != "kpi_summary"} == {n: 0 for n in empty if n != "kpi_summary"}
    assert {r.metric: r.value for r in empty["kpi_summary"].collect()}["Total Orders"] == 0


def test_an_incremental_mart_reads_state_alone(spark, tmpdir_path):
    joined = _flow(spark).joined
    for name, fn in mart_state.STATES.items():
        sinks.write_table(fn(joined), f"{tmpdir_path}/{name}", partition_by=["order_month"])
    frames = mart_state.all_marts(*[spark.read.parquet(f"{tmpdir_path}/{n}") for n in mart_state.STATES])
    for name, df in frames.items():
        if name != "customer_ranking":  # ranked over a written copy of its groups
            places = set(re.findall(r"InMemoryFileIndex\(\d+ paths?\)\[file:([^\],]*)", _plan(df)))
            assert places and all(p.startswith(tmpdir_path) for p in places), (name, places)
    only = spark.read.parquet(f"{tmpdir_path}/mart_cube").where("order_month = '1997-01'")
    assert "PartitionFilters: [isnotnull(order_month" in _plan(only)


def test_distinct_counts_do_not_copy_rows(spark):
    joined = _flow(spark).joined
    for df in (marts.segment_analysis(joined), marts.monthly_performance(joined)):
        assert "Expand" not in _plan(df)


def test_large_splittable_files_are_not_dealt_anew(spark, tmpdir_path):
    spark.range(300_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(3).write.parquet(f"{tmpdir_path}/t")
    spark.range(3000).repartition(3).write.option("compression", "gzip").csv(f"{tmpdir_path}/z")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
        assert "RoundRobin" not in _plan(spread(spark.read.parquet(f"{tmpdir_path}/t"), 8))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        assert "RoundRobin" in _plan(spread(spark.read.schema("id long").csv(f"{tmpdir_path}/z"), 8))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert "RoundRobin" in _plan(spread(spark.read.parquet(f"{tmpdir_path}/t"), 8))  # a small table


@pytest.mark.parametrize("kind", ["path", "catalog"])
def test_replaced_partitions(spark, tmpdir_path, kind):
    target = f"{tmpdir_path}/t" if kind == "path" else "replaced_by_test"
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "c")], "x int, m string")
    sinks.write_table(df, target, partition_by=["m"])
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            ran.add(len(batch))
            yield batch

    new = spark.createDataFrame([(9, "a")], "x int, m string").mapInPandas(count, "x int, m string")
    sinks.replace_partitions(new, target, "m", lambda m: F.coalesce(m <= "b", F.lit(True)))
    assert ran.value == 1  # the rows were computed once
    assert sorted(tuple(r) for r in sinks.read_table(spark, target).select("x", "m").collect()) == [(4, "c"), (9, "a")]
    assert sorted(sinks.partition_values(spark, target, "m")) == ["a", "c"]  # no entry is left of a removed one
    if kind == "catalog":
        spark.sql(f"DROP TABLE {target}")


@pytest.mark.parametrize("kind", ["path", "catalog"])
def test_a_failed_refresh_leaves_the_old_table(spark, tmpdir_path, kind):
    target = f"{tmpdir_path}/t" if kind == "path" else "refreshed_by_test"
    sinks.write_table(spark.range(3).toDF("x"), target)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("x"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_table(broken, target)
    assert sinks.read_table(spark, target).count() == 3
    sinks.write_table(sinks.read_table(spark, target).where("x > 0"), target)  # even from itself
    assert sorted(r.x for r in sinks.read_table(spark, target).collect()) == [1, 2]
    left = [t.name for t in spark.catalog.listTables()] if kind == "catalog" else __import__("os").listdir(tmpdir_path)
    assert not [t for t in left if "__new_" in t or "__old_" in t]
    if kind == "catalog":
        spark.sql(f"DROP TABLE {target}")


def test_a_retried_run_replaces_its_log(spark, tmpdir_path):
    target = f"{tmpdir_path}/log"
    for run, n in (("20250101", 3), ("b", 2), ("20250101", 4)):
        sinks.replace_run(spark.range(n).select("id", F.lit(run).alias("run_id")), target, run)
    counts = {r.run_id: r["count"] for r in spark.read.parquet(target).groupBy("run_id").count().collect()}
    assert counts == {"20250101": 4, "b": 2}


def test_bucketed_orders_are_joined_as_they_lie(spark, tmpdir_path):
    f = _flow(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sinks.write_bucketed(f.valid("orders"), "bucketed_orders", ["order_id"], 4, ["order_month"], path=f"{tmpdir_path}/o")
        sinks.write_bucketed(f.valid("delivery_performance"), "bucketed_delivery", ["order_id"], 4, path=f"{tmpdir_path}/d")
        joined = marts.join_orders(spark.table("bucketed_orders"), f.valid("customers"), spark.table("bucketed_delivery"))
        plan = _plan(joined)
        assert not re.search(r"Exchange hashpartitioning\(_?d?_?order_id", plan), plan
        assert plan.count("Exchange hashpartitioning") == 2  # the customer join: both of its sides
        assert joined.exceptAll(f.joined.select(*joined.columns)).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in ("bucketed_orders", "bucketed_delivery"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_publishing_bucketed_tables_to_a_catalog(spark):
    from tidemark.plans.pipeline import run
    raw, name = fixtures.raw_tables(spark, SF_SMALL), "bucketed_by_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    config = dict(as_of="2025-01-01", buckets=4, freshness_curr_timestamp="1997-01-20 12:00:00")
    run(spark, raw, name, RunConfig(batch_id="full", **config))
    tables = ("final_orders", "analytics_main", "kpi_summary")
    columns = {"kpi_summary": ["metric", "value"]}
    rows = lambda t: sorted(map(str, spark.table(f"{name}.{t}").select(*columns.get(t, ["order_id", "order_total"])).collect()))
    full = {t: rows(t) for t in tables}
    run(spark, raw, name, RunConfig(batch_id="part", run_mode="incremental", start_date="1997-01-10", end_date="1997-01-20", **config))
    assert {t: rows(t) for t in tables} == full
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {name}.final_orders").collect()}
    assert described["Num Buckets"] == "4" and described["Bucket Columns"] == "[`order_id`]"
    spark.sql(f"DROP DATABASE {name} CASCADE")


SCHEMA = StructType([StructField("id", LongType()), StructField("name", StringType()), StructField("x", DoubleType())])


def test_rejected_lines(spark, tmpdir_path):
    lines = ["id,name,x", "1,a,1.5", "2,b", "3,c,2,9", "4,d,zz", "q,e,zz", '5,"f,g",2', "6,,", "7", ",,", "8,h,2,"]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(f"{tmpdir_path}/in.csv")
    status = csv.load_checked(spark, tmpdir_path, "in.csv", f"{tmpdir_path}/good", f"{tmpdir_path}/bad", SCHEMA, "b")
    assert [tuple(r)[2:] for r in status.collect()] == [(4, 6)]
    bad = {r.line: (r.reason, r.columns) for r in spark.read.parquet(f"{tmpdir_path}/bad").collect()}
    assert bad == {"2,b": ("short", None), "3,c,2,9": ("long", None), "4,d,zz": ("type", ["x"]), "q,e,zz": ("type", ["id", "x"]),
                   "7": ("short", None), "8,h,2,": ("long", None)}
    good = spark.read.parquet(f"{tmpdir_path}/good")
    assert sorted(str(r.id) for r in good.collect()) == ["1", "5", "6", "None"] and "_corrupt_record" not in good.columns


def test_the_ledger_knows_files(spark, tmpdir_path):
    import os
    folder, target, ledger = f"{tmpdir_path}/in", f"{tmpdir_path}/t", f"{tmpdir_path}/l"
    os.mkdir(folder)

    def put(name, rows):
        with open(f"{folder}/{name}", "w") as out:
            out.write("id,name,x\n" + "".join(f"{r},n,1\n" for r in rows))

    def load(batch):
        got = csv.load_new(spark, folder, target, ledger, SCHEMA, batch)
        return sorted((os.path.basename(r.path), r.row_count) for r in got.collect())

    ids = lambda: sorted(r.id for r in spark.read.parquet(target).collect())
    put("a.csv", [1, 2])
    put("b.csv", [3])
    assert load("one") == [("a.csv", 2), ("b.csv", 1)] and ids() == [1, 2, 3]
    assert load("two") == [] and ids() == [1, 2, 3]
    put("a.csv", [7, 8, 9])
    put("c.csv", [])
    assert load("three") == [("a.csv", 3), ("c.csv", 0)] and ids() == [3, 7, 8, 9]
    put("b.csv", [])
    assert load("four") == [("b.csv", 0)] and ids() == [7, 8, 9]
    assert {r._batch_id for r in spark.read.parquet(ledger).collect()} == {"three", "four"}


@pytest.mark.parametrize("policy", ["error", "any"])
def test_checked_rows_are_written_once(spark, tmpdir_path, policy):
    """Valid and quarantined rows are partition-pruned reads of one table and equal the plain split."""
    schema = "part string, k long, g string, v long, t string"
    rows = spark.createDataFrame(_rows(7, "2024-01", 40) + _rows(8, None, 10), schema).withColumn("t", F.col("t").cast("timestamp_ntz"))
    checked = E.annotate(rows, RULES[:2])
    stored = checked.written(f"{tmpdir_path}/checked", policy, ["part"])
    assert stored.stats["rows"] == 50
    for got, wanted, kind in ((stored.valid(policy), checked.valid(policy), E.VALID),
                              (stored.quarantine(policy), checked.quarantine(policy), E.QUARANTINED)):
        columns = sorted(wanted.columns)
        assert sorted(got.columns) == columns
        assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, wanted.select(columns).collect()))
        assert re.search(rf"PartitionFilters: \[.*_verdict.* = {kind}", _plan(got)) and "DataFilters: []" in _plan(got)
    other = "any" if policy == "error" else "error"  # another policy than the stored one
    assert stored.valid(other).count() == checked.valid(other).count()
    assert E.VERDICT not in stored.quarantine(other).columns
    empty = E.annotate(rows.limit(0), RULES[:2]).written(f"{tmpdir_path}/none", policy, ["part"])
    assert empty.valid(policy).count() == 0 and empty.stats["rows"] == 0


@pytest.mark.parametrize("kind", ["path", "catalog"])
def test_partitions_within_replaced_ones(spark, tmpdir_path, kind):
    """Of touched partitions no old part is left: not of months without rows, nor of a month's verdicts without rows."""
    target = f"{tmpdir_path}/t" if kind == "path" else "replaced_within"
    schema = "v long, m string, w string"
    first = [(1, "a", "x"), (2, "a", "y"), (3, "b", "x"), (4, None, "x"), (5, None, "y"), (6, "c", "y")]
    sinks.write_table(spark.createDataFrame(first, schema), target, partition_by=["m", "w"])
    new = spark.createDataFrame([(7, "a", "y"), (8, None, "x")], schema)
    sinks.replace_partitions(new, target, "m", lambda c: c.isNull() | c.isin("a", "b"), ["w"])
    left = sorted(map(tuple, sinks.read_table(spark, target).select("v", "m", "w").collect()))
    assert left == [(6, "c", "y"), (7, "a", "y"), (8, None, "x")]
    if kind == "catalog":
        spark.sql(f"DROP TABLE {target}")


def test_a_run_that_writes_checked_rows_once(spark, tmpdir_path):
    """Its marts, scores and rows equal those of a run with two tables; a run for part of a month changes none."""
    from tidemark.plans.pipeline import run
    raw = fixtures.raw_tables(spark, SF_SMALL)
    config = {"as_of": "2025-01-01", "freshness_curr_timestamp": "1997-01-20 12:00:00"}
    two, one = f"{tmpdir_path}/two", f"{tmpdir_path}/one"
    run(spark, raw, two, RunConfig(batch_id="full", **config))
    report = run(spark, raw, one, RunConfig(batch_id="full", one_write=True, **config))
    names = {r.table_name for r in report.collect()}
    assert "checked_orders" in names and not any(n.startswith(("final_", "quarantine_")) for n in names)
    columns = ["order_id", "customer_id", "order_total", "order_month", "_data_quality_score"]

    def sets(folder):
        if folder == one:
            valid, bad = E.stored_split(spark.read.parquet(f"{one}/checked_orders"))
        else:
            valid, bad = (spark.read.parquet(f"{two}/{t}_orders") for t in ("final", "quarantine"))
        kept = ["analytics_main", "kpi_summary", "customer_segment_analysis", "data_quality_summary"]
        tables = [spark.read.parquet(f"{folder}/{t}") for t in kept]
        plain = [t.drop("_created_timestamp", "_batch_id") for t in tables]
        return [sorted(map(str, d.select(columns if d is valid or d is bad else sorted(d.columns)).collect())) for d in (valid, bad, *plain)]

    wanted = sets(two)
    assert sets(one) == wanted
    part = {"run_mode": "incremental", "start_date": "1997-01-10", "end_date": "1997-01-20"}
    run(spark, raw, one, RunConfig(batch_id="part", one_write=True, **part, **config))
    assert sets(one) == wanted
    with pytest.raises(ValueError):
        RunConfig(one_write=True, buckets=4)


def test_a_csv_file_is_written_from_its_own_rows(spark, monkeypatch):
    """The one task that writes a file of the ledger reads that file's rows, not the whole table."""
    from tidemark.plans import queries as Q
    scans = []
    monkeypatch.setattr(Q, "_csv_file", lambda df, path: scans.append(df._jdf.queryExecution().executedPlan().toString()))
    monkeypatch.setattr(Q.csv, "load_new", lambda *a, **k: spark.range(0))
    try:
        Q.ledger_loads(spark, "/root/testdata/sf0.001")
    except Exception:  # nothing was loaded
        pass
    assert len(scans) == 4
    assert all("PartitionFilters: [isnotnull(_number" in s and "Union" not in s for s in scans), scans
