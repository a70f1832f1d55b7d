"""Plan shape: the BASELINE targets checked on physical plans, and an incremental publishing run."""

from __future__ import annotations

import re

import tidemark.operators.engine as E
from tests.conftest import SF_SMALL
from tidemark.operators import marts as M
from tidemark.plans import checks
from tidemark.plans.pipeline import Flow, RunConfig, run
from tidemark.sources import fixtures


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))


def test_annotate_is_one_map_only_pass(spark):
    f = Flow(spark, fixtures.raw_tables(spark, SF_SMALL), RunConfig(as_of="2025-01-01"))
    checked = E.annotate(f.processed("orders"), checks.orders_rules())
    plan = _plan(checked.annotated)
    assert _shuffles(plan) == 0, plan                    # side frames are broadcast, rows never move
    assert "BroadcastHashJoin" in plan


def test_rules_sharing_a_key_share_one_aggregation(spark, monkeypatch):
    written: list[str] = []
    original = E.materialize_observed

    def spy(df, name, **metrics):
        written.append(name)
        return original(df, name, **metrics)

    monkeypatch.setattr(E, "materialize_observed", spy)
    f = Flow(spark, fixtures.raw_tables(spark, SF_SMALL), RunConfig(as_of="2025-01-01"))
    E.annotate(f.processed("orders"), checks.orders_rules())
    # 10 rules, three key sets: (order_id), (order_id, customer_id), (customer_id)
    assert len([n for n in written if n.startswith("violations-")]) == 3


def test_kpi_summary_reads_the_joined_table_once(spark):
    f = Flow(spark, fixtures.raw_tables(spark, SF_SMALL), RunConfig(as_of="2025-01-01"))
    plan = _plan(M.kpi_summary(f.joined))
    assert plan.count("FileScan parquet") == 1, plan


def test_incremental_run_overwrites_only_touched_months(spark, tmpdir_path):
    raw = fixtures.raw_tables(spark, SF_SMALL)
    out = f"{tmpdir_path}/out"
    run(spark, raw, out, RunConfig(as_of="2025-01-01", batch_id="full"))
    before = {r.order_month: r.n for r in spark.read.parquet(f"{out}/final_orders")
              .groupBy("order_month").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    run(spark, raw, out, RunConfig(as_of="2025-01-01", batch_id="inc", run_mode="incremental",
                                   start_date="1997-01-01", end_date="1997-12-31"))
    after = {r.order_month: r.n for r in spark.read.parquet(f"{out}/final_orders")
             .groupBy("order_month").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert after == before                               # same rows re-published for 1997, others untouched
    logs = spark.read.parquet(f"{out}/dq_test_logs")
    assert sorted(r.run_id for r in logs.select("run_id").distinct().collect()) == ["full", "inc"]


COLUMNS = ["order_id", "customer_id", "order_date", "order_total", "payment_method", "order_month"]


def _rows(spark, target, columns=COLUMNS):
    from tidemark.sources import sinks
    return sorted((tuple(r) for r in sinks.read_table(spark, target).select(*columns).collect()), key=str)


def test_part_of_a_month_gives_what_a_full_run_gives(spark, tmpdir_path):
    raw = fixtures.raw_tables(spark, SF_SMALL)
    out = f"{tmpdir_path}/out"
    run(spark, raw, out, RunConfig(as_of="2025-01-01", batch_id="full"))
    tables = ["processed_orders", "final_orders", "quarantine_orders"]
    full = {t: _rows(spark, f"{out}/{t}") for t in tables}
    joined = _rows(spark, f"{out}/analytics_main", ["order_id", "customer_segment", "order_total"])
    kpi = _rows(spark, f"{out}/kpi_summary", ["metric", "value"])
    assert any(r[2] is None for r in full["quarantine_orders"])     # undated orders are quarantined
    run(spark, raw, out, RunConfig(as_of="2025-01-01", batch_id="part", run_mode="incremental",
                                   start_date="1997-01-10", end_date="1997-01-20"))
    assert {t: _rows(spark, f"{out}/{t}") for t in tables} == full
    assert _rows(spark, f"{out}/analytics_main", ["order_id", "customer_segment", "order_total"]) == joined
    assert _rows(spark, f"{out}/kpi_summary", ["metric", "value"]) == kpi
    for t in tables:
        assert "_processed_timestamp" in spark.read.parquet(f"{out}/{t}").columns

    # an order without a customer is repaired: it leaves quarantine, though no row of its month stays there
    bad = next(r for r in full["quarantine_orders"] if r[2] is not None and
               sum(q[5] == r[5] for q in full["quarantine_orders"]) == 1)
    month = bad[5]
    fixed = raw | {"orders": raw["orders"].dropDuplicates(["order_id"]).fillna({"customer_id": 1, "order_id": 999_999})}
    run(spark, fixed, out, RunConfig(as_of="2025-01-01", batch_id="repair", run_mode="incremental",
                                     start_date=f"{month}-01", end_date=f"{month}-28"))
    left = [r for r in _rows(spark, f"{out}/quarantine_orders") if r[5] == month and r[2].day <= 28]
    assert len([r for r in left if r == bad]) == 0 or bad[2].day > 28


def test_incremental_run_to_a_catalog(spark):
    raw = fixtures.raw_tables(spark, SF_SMALL)
    name = "published_by_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    run(spark, raw, name, RunConfig(as_of="2025-01-01", batch_id="full"))
    full = {t: _rows(spark, f"{name}.{t}") for t in ("processed_orders", "final_orders", "quarantine_orders")}
    run(spark, raw, name, RunConfig(as_of="2025-01-01", batch_id="part", run_mode="incremental",
                                    start_date="1997-01-10", end_date="1997-01-20"))
    assert {t: _rows(spark, f"{name}.{t}") for t in full} == full
    from tidemark.sources import catalog
    counts = {r.table_name: r.row_count for r in catalog.namespace_row_counts(spark, name).collect()}
    assert counts["kpi_summary"] == 8 and counts["final_orders"] == len(full["final_orders"])
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_a_run_window_needs_a_bound():
    import pytest

    from tidemark.plans.incremental import in_window
    with pytest.raises(ValueError, match="start_date or end_date"):
        in_window(None, None, None)


def test_an_unreadable_table_has_a_row_of_its_own(spark, tmpdir_path):
    from tidemark.sources import catalog
    spark.range(3).write.parquet(f"{tmpdir_path}/good")
    spark.range(3).write.parquet(f"{tmpdir_path}/bad")
    import glob
    for f in glob.glob(f"{tmpdir_path}/bad/part-*"):
        with open(f, "wb") as out:
            out.write(b"broken")
    got = {r.table_name: r for r in catalog.namespace_row_counts(spark, tmpdir_path).collect()}
    assert got["good"].row_count == 3 and got["bad"].row_count is None and got["bad"].error


def test_money_beyond_64_bits(spark):
    df = spark.createDataFrame([(6e16,), (6e16,), (0.01,)], "x double")
    total, mean = df.agg(M.money_sum("x"), M.money_avg("x")).first()
    assert total == 120000000000000000.0 and mean == total / 3
