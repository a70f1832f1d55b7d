"""Rule engine (Q1-Q10) on literal rows: every check, null keys, duplicates, empty input, the gate paths."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import engine as E
from tidemark.operators.rules import (
    is_aggr_not_greater_than,
    is_aggr_not_less_than,
    is_data_fresh_per_time_window,
    is_in_range,
    is_not_null,
    is_unique,
    rule,
    sql_condition,
    sql_query,
)

SCHEMA = "id string, cust string, amount double, status string"
DATA = [
    ("1", "a", 10.0, "ok"),
    ("2", "a", -5.0, "bad"),
    ("2", "b", 20.0, "ok"),     # id 2 duplicated
    (None, "c", 30.0, "ok"),
    (None, "c", None, "bad"),   # two null ids
    ("3", None, 100.0, "ok"),
]


def flags(spark, rules, data=DATA, schema=SCHEMA, gate=None):
    df = spark.createDataFrame(data, schema)
    checked = E.annotate(df, rules, gate)
    out = checked.annotated.select(
        "id", "cust", "amount",
        F.array_join(F.array_sort("_errors"), ",").alias("e"),
        F.array_join(F.array_sort("_warnings"), ",").alias("w")).collect()
    return sorted([(r.id, r.cust, r.amount, r.e, r.w) for r in out], key=str), checked


def test_not_null_and_range(spark):
    got, _ = flags(spark, [rule("id_nn", "error", is_not_null("id")),
                           rule("amt", "warn", is_in_range("amount", 0, 30))])
    by = {(r[0], r[1], r[2]): (r[3], r[4]) for r in got}
    assert by[("1", "a", 10.0)] == ("", "")
    assert by[("2", "a", -5.0)] == ("", "amt")          # below the closed range
    assert by[(None, "c", 30.0)] == ("id_nn", "")        # upper bound is inside
    assert by[(None, "c", None)] == ("id_nn", "")        # null amount is not a range violation
    assert by[("3", None, 100.0)] == ("", "amt")


def test_unique_every_copy_and_null_exempt(spark):
    got, _ = flags(spark, [rule("u", "error", is_unique(["id"])),
                           rule("u2", "warn", is_unique(["id", "cust"]))])
    errs = {(r[0], r[1]): r[3] for r in got}
    assert errs[("2", "a")] == "u" and errs[("2", "b")] == "u"
    assert errs[(None, "c")] == ""                       # null key exempt even though repeated
    assert all(r[4] == "" for r in got)                  # (id, cust) pairs are unique


def test_grouped_aggregate_limit_null_group_is_a_group(spark):
    got, _ = flags(spark, [rule("max2", "warn", is_aggr_not_greater_than("id", "count", 1, group_by=["cust"]))])
    warned = sorted(((r[0], r[1]) for r in got if r[4] == "max2"), key=str)
    # cust a has 2 non-null ids -> both rows; cust c has 0 non-null ids (count ignores nulls) -> none
    assert warned == [("1", "a"), ("2", "a")]
    got, _ = flags(spark, [rule("sum", "warn", is_aggr_not_greater_than("amount", "sum", 25, group_by=["cust"]))])
    # cust c sums to 30 > 25 (both rows), the null-cust group sums to 100 > 25
    assert sorted(str(r[1]) for r in got if r[4] == "sum") == ["None", "c", "c"]


def test_global_aggregate_limit_and_empty_input(spark):
    rules = [rule("min_rows", "error", is_aggr_not_less_than("*", "count", 1)),
             rule("max_avg", "warn", is_aggr_not_greater_than("amount", "avg", 20))]
    got, checked = flags(spark, rules)
    assert all(r[3] == "" for r in got) and all(r[4] == "max_avg" for r in got)   # avg 31 > 20
    outcomes = {r.rule_name: (r.observed, r.dataset_violated) for r in checked.outcomes.collect()}
    assert outcomes["min_rows"] == ("6", False) and outcomes["max_avg"][1] is True
    empty = spark.createDataFrame([], SCHEMA)
    checked = E.annotate(empty, rules)
    assert checked.annotated.count() == 0
    outcomes = {r.rule_name: r.dataset_violated for r in checked.outcomes.collect()}
    assert outcomes["min_rows"] is True                  # no row to flag: the dataset outcome carries it


def test_keyed_condition_propagates_to_key_null_safely(spark):
    r = rule("st", "warn", sql_condition("status = 'bad'", merge_columns=["id"]))
    got, _ = flags(spark, [r])
    warned = sorted(((x[0], x[1]) for x in got if x[4] == "st"), key=str)
    # id 2 has a bad row -> both copies; null ids form one key with a bad row -> both null rows
    assert warned == [("2", "a"), ("2", "b"), (None, "c"), (None, "c")]


def test_conditions_of_counted_keys_keep_single_rows_out_of_the_frame(spark, monkeypatch):
    written = {}
    original = E.materialize_observed

    def spy(df, name, **metrics):
        frame, taken = original(df, name, **metrics)
        written[name.split("-")[0]] = taken["rows"]
        return frame, taken

    monkeypatch.setattr(E, "materialize_observed", spy)
    rows = [(str(i), "c", 1.0, "bad") for i in range(50)] + [("d", "c", 1.0, "ok"), ("d", "c", 1.0, "bad"),
                                                              (None, "c", 1.0, "ok"), (None, "c", 1.0, "bad"), ("e", "c", 1.0, "ok")]
    rules = [rule("u", "error", is_unique(["id"])), rule("st", "warn", sql_condition("status = 'bad'", merge_columns=["id"]))]
    got, _ = flags(spark, rules, rows)
    flagged = {(r[0], r[3], r[4]) for r in got}
    assert flagged == {(str(i), "", "st") for i in range(50)} | {("d", "u", "st"), (None, "", "st"), ("e", "", "")}
    assert written["violations"] == 2  # the keys of several rows: d and null


def test_keyed_condition_where_clause(spark):
    r = rule("neg", "warn", sql_condition("amount < 0", merge_columns=["id"], where="cust = 'b'"))
    got, _ = flags(spark, [r])
    assert all(x[4] == "" for x in got)                  # the negative row is filtered by WHERE


def test_sql_query_matches_sql_condition(spark):
    text = """SELECT id, CASE WHEN status = 'bad' THEN True ELSE False END AS condition
              FROM {{ input_view }} WHERE amount IS NOT NULL"""
    a, _ = flags(spark, [rule("x", "warn", sql_query(text, ["id"]))])
    b, _ = flags(spark, [rule("x", "warn", sql_condition("status = 'bad'", ["id"], where="amount IS NOT NULL"))])
    assert a == b


def test_sql_query_aggregate_shape_and_braces(spark):
    text = """SELECT cust, CASE WHEN COUNT(*) > 1 AND min(status) RLIKE '^b{1,}' THEN True ELSE False END AS condition
              FROM {{input_view}} GROUP BY cust"""
    got, _ = flags(spark, [rule("g", "error", sql_query(text, ["cust"]))])
    assert sorted(r[1] for r in got if r[3] == "g") == ["a", "a", "c", "c"]


def test_many_rules_on_one_key_share_one_frame(spark):
    rules = [rule("u", "error", is_unique(["id"])),
             rule("c", "warn", sql_condition("amount < 0", ["id"])),
             rule("q", "warn", sql_query("SELECT id, status = 'bad' AS condition FROM {{ input_view }}", ["id"]))]
    got, _ = flags(spark, rules)
    by = {(r[0], r[1]): (r[3], r[4]) for r in got}
    assert by[("2", "a")] == ("u", "c,q") and by[("2", "b")] == ("u", "c,q")
    assert by[(None, "c")] == ("", "q")


def test_duplicate_rule_names_rejected(spark):
    with pytest.raises(ValueError, match="duplicate rule name"):
        E.annotate(spark.createDataFrame(DATA, SCHEMA), [rule("x", "warn", is_not_null("id")),
                                                         rule("x", "warn", is_not_null("cust"))])


def test_gate_paths_give_same_flags(spark):
    rules = [rule("u", "error", is_unique(["id"])), rule("c", "warn", sql_condition("status = 'bad'", ["id"]))]
    broadcast, _ = flags(spark, rules, gate=E.Gate(max_rows=1000))
    shuffled, _ = flags(spark, rules, gate=E.Gate(max_rows=0))
    assert broadcast == shuffled


def test_window_start_on_far_dates(spark):
    df = spark.sql("SELECT CAST(x AS TIMESTAMP_NTZ) AS ts FROM VALUES ('0001-01-01 00:59:59'), ('9999-12-31 23:59:59'), "
                   "('1969-12-31 23:30:00'), ('1970-01-01 01:00:00'), (NULL) AS t(x)")
    got = [str(r[0]) for r in df.select(E.window_start(df.ts, 60, "timestamp_ntz").cast("string")).collect()]
    assert got == ["0001-01-01 00:00:00", "9999-12-31 23:00:00", "1969-12-31 23:00:00", "1970-01-01 01:00:00", "None"]


def test_nan_and_infinity_violate_ranges(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 5.0), (4, None)], "id int, x double")
    checked = E.annotate(df, [rule("r", "error", is_in_range("x", 0, None))])
    assert {r.id for r in checked.annotated.where("size(_errors) > 0").collect()} == {1, 2}


def test_split_policies_are_disjoint(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    checked = E.annotate(df, [rule("id_nn", "error", is_not_null("id")),
                              rule("amt", "warn", is_in_range("amount", 0, 30))])
    for policy, expected_bad in (("error", 2), ("any", 4)):
        valid, bad = E.split(checked.annotated, policy)
        assert valid.count() + bad.count() == 6 and bad.count() == expected_bad
    valid, _ = E.split(checked.annotated, "error")
    assert "_errors" not in valid.columns and "_warnings" in valid.columns


def test_score_column(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    checked = E.annotate(df, [rule("id_nn", "error", is_not_null("id")),
                              rule("amt", "warn", is_in_range("amount", 0, 30))])
    scores = sorted(r[0] for r in checked.annotated.select("_data_quality_score").collect())
    assert scores == [0.5, 0.5, 0.5, 0.5, 1.0, 1.0]   # rows 2, 4, 5, 6 break one of two rules


def _events(spark, times):
    return spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")


def test_freshness_windows_rows_and_empty_windows(spark):
    base = dt.datetime(2024, 1, 1, 0, 0)
    times = [base + dt.timedelta(minutes=m) for m in (5, 10, 15, 70, 190, 195)] + [None]
    df = _events(spark, times)
    r = rule("fresh", "warn", is_data_fresh_per_time_window("ts", 60, 2, 4))
    checked = E.annotate(df, [r])
    got = sorted((str(x.ts), x.w) for x in checked.annotated.select(
        "ts", F.array_join("_warnings", ",").alias("w")).collect())
    # windows 00:00 (3 rows), 01:00 (1 row: under), 02:00 (empty), 03:00 (2 rows); null ts is kept, unflagged
    assert ("2024-01-01 01:10:00", "fresh") in got
    assert sum(1 for _, w in got if w) == 1 and len(got) == 7
    outcome = checked.outcomes.first()
    assert outcome.dataset_violated and outcome.observed.startswith("2 of 4 windows")
    report = E.freshness_report(df, "ts", 60, 2, 4).orderBy("window_start").collect()
    assert [(x.records, x.below_min) for x in report] == [(3, False), (1, True), (0, True), (2, False)]


def test_freshness_with_current_time(spark):
    base = dt.datetime(2024, 1, 1, 0, 0)
    df = _events(spark, [base + dt.timedelta(minutes=m) for m in (5, 65)])
    report = E.freshness_report(df, "ts", 60, 1, 3, curr_timestamp="2024-01-01 03:30:00").orderBy("window_start")
    assert [(str(x.window_start), x.records) for x in report.collect()] == [
        ("2024-01-01 00:00:00", 1), ("2024-01-01 01:00:00", 1), ("2024-01-01 02:00:00", 0)]


def test_freshness_with_current_time_pushes_the_window_to_the_scan(spark, tmpdir_path):
    base = dt.datetime(2024, 1, 1, 0, 0)
    path = f"{tmpdir_path}/events"
    _events(spark, [base + dt.timedelta(minutes=m) for m in range(0, 600, 7)]).write.parquet(path)
    df = spark.read.parquet(path)
    report = E.freshness_report(df, "ts", 60, 1, 3, curr_timestamp="2024-01-01 05:30:00")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    # multiples of 7 minutes in 02:00-03:00, 03:00-04:00, 04:00-05:00
    assert [x.records for x in report.orderBy("window_start").collect()] == [8, 9, 8]


def test_history_rows_take_part_in_dataset_checks_only(spark):
    new = spark.createDataFrame([("7", "a", 1.0, "ok"), ("8", "b", 2.0, "ok")], SCHEMA)
    old = spark.createDataFrame([("7", "z", 5.0, "bad"), ("9", "a", 3.0, "ok")], SCHEMA)
    rules = [rule("u", "error", is_unique(["id"])),
             rule("per_cust", "warn", is_aggr_not_greater_than("id", "count", 1, group_by=["cust"])),
             rule("st", "warn", sql_condition("status = 'bad'", ["id"])),
             rule("rows", "error", is_aggr_not_less_than("*", "count", 3))]
    alone, _ = flags(spark, rules, data=[tuple(r) for r in new.collect()])
    assert all(r[3] == "rows" for r in alone)              # only 2 rows without history
    checked = E.annotate(new, rules, history=old)
    got = {r.id: (sorted(r._errors), sorted(r._warnings)) for r in checked.annotated.collect()}
    assert set(got) == {"7", "8"}                          # history rows are not returned
    assert got["7"] == (["u"], ["per_cust", "st"])         # duplicate of a published id; cust a has 2 ids
    assert got["8"] == ([], [])


def test_window_start_ignores_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-07-01 10:59:59",), ("1969-12-31 23:30:00",)],
                                   "x string").select(F.col("x").cast("timestamp_ntz").alias("ts"))
        got = [str(r[0]) for r in df.select(E.window_start(F.col("ts"), 60, "timestamp_ntz")).collect()]
        assert got == ["2024-03-10 02:00:00", "2024-07-01 10:00:00", "1969-12-31 23:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_gate_byte_bound_forces_shuffle_join(spark):
    rules = [rule("u", "error", is_unique(["id"]))]
    small, _ = flags(spark, rules, gate=E.Gate(max_rows=1000, max_bytes=1 << 20))
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no broadcast unless the gate hints one
    try:
        tight, checked = flags(spark, rules, gate=E.Gate(max_rows=1000, max_bytes=1))
        plan = checked.annotated._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    assert small == tight


def test_scale_conf_sizes_partitions():
    from tidemark.session import scale_conf
    big = scale_conf(100 * 10**12, 8000)
    assert big["spark.sql.shuffle.partitions"] == "50000" and big["spark.sql.adaptive.enabled"] == "true"
    small = scale_conf(10**9, 16)
    assert small["spark.sql.shuffle.partitions"] == "32"
