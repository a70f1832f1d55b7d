"""End-to-end plan: raw -> processed -> checked -> valid/quarantine -> joined -> marts.

``Flow`` builds each stage once per run. Stages consumed by several outputs (the annotated tables and the
joined table) are written once to the shared folder and re-read, so no plan is executed once per
consumer, and an executor lost late in the run re-reads files instead of recomputing from raw.
``run`` publishes every table through the sinks; actions happen only there.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import engine, mart_state, marts, reporting
from tidemark.operators import transforms as T
from tidemark.operators.engine import Checked, Gate, RuleState
from tidemark.operators.rules import Freshness
from tidemark.plans import checks
from tidemark.plans.incremental import in_window, touched_months
from tidemark.session import (
    estimated_row_bytes,
    fits_broadcast,
    materialize,
    run_concurrently,
    run_folder,
    spread,
)
from tidemark.sources import catalog, sinks

TABLES = ("orders", "customers", "delivery_performance")


@dataclass(frozen=True)
class RunConfig:
    """Run parameters (all optional).

    ``as_of``: reference date for ages (default: today). ``run_mode``: ``full`` or ``incremental``
    (orders of [start_date, end_date] by order_date and undated ones; the months of the window are rebuilt
    whole). ``freshness_curr_timestamp``: end of the freshness lookback (``run``: its own time).
    ``quality_checks=False`` publishes processed rows as valid without running rules. ``buckets``: catalog tables
    of orders and delivery are bucketed by order id in so many files a partition, and joined as they lie.
    ``one_write``: each checked row is written once, to ``checked_<table>`` partitioned by its verdict, in place of the
    tables ``final_`` and ``quarantine_``, which are then partition-pruned reads of it (``engine.stored_split``).
    """

    as_of: str | None = None
    batch_id: str | None = None
    run_mode: str = "full"
    start_date: str | None = None
    end_date: str | None = None
    quality_checks: bool = True
    quarantine_on: str = "error"
    freshness_curr_timestamp: str | None = None
    customers_broadcast_rows: int = 2_000_000
    buckets: int | None = None
    one_write: bool = False
    gate: Gate = field(default_factory=Gate)

    def __post_init__(self):
        if self.run_mode not in ("full", "incremental"):
            raise ValueError("run_mode must be 'full' or 'incremental'")
        if self.one_write and self.buckets:
            raise ValueError("bucketed tables hold valid rows alone: they need the write of their own")


class Flow:
    """Lazily built stages over three raw tables (orders, customers, delivery_performance)."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], config: RunConfig | None = None,
                 processed_target=None, history: dict[str, DataFrame] | None = None,
                 kept_orders: DataFrame | None = None, stamped: bool = False, state: dict[str, RuleState] | None = None,
                 checked_target=None):
        """``processed_target(table) -> target`` publishes each processed table where the run wants it
        and reuses that copy for the rule passes (one write instead of two). ``history[table]`` holds
        already published rows that dataset-level rules must also see (incremental runs).
        ``kept_orders`` are published processed orders of the run's months outside its window: they are
        checked and published again with the window's rows. ``stamped`` adds the processing time before
        the checks, so that every published table of a row has it, and keeps the orders' rule state by month.
        ``state[table]`` is the rule state of published rows, which takes the place of ``history``.
        ``checked_target(table) -> target`` publishes the checked rows as they are written, by verdict."""
        self.spark = spark
        self.raw = raw
        self.config = config or RunConfig()
        self.processed_target = processed_target
        self.checked_target = checked_target
        self.history = history or {}
        self.state = state or {}
        self.kept_orders = kept_orders
        self.stamped = stamped
        #: a publishing run quarantines undated rows; the plain run window leaves them out
        self.with_undated = stamped
        self._processed: dict[str, DataFrame] = {}
        self._checked: dict[str, Checked] = {}

    # processed ----------------------------------------------------------------------------------
    def processed_plan(self, table: str) -> DataFrame:
        """The cleaning plan of one table (lazy, not materialised)."""
        cfg = self.config
        if table == "orders":
            orders = self.raw["orders"]
            if cfg.run_mode == "incremental":
                inside = in_window(F.col("order_date"), cfg.start_date, cfg.end_date)
                orders = orders.filter(inside | F.col("order_date").isNull() if self.with_undated else inside)
            cleaned = T.clean_orders(orders)
            if self.kept_orders is not None:
                cleaned = cleaned.unionByName(self.kept_orders.select(*cleaned.columns))
            return cleaned
        if table == "customers":
            return T.clean_customers(self.raw["customers"], cfg.as_of)
        return T.clean_delivery(self.raw["delivery_performance"])

    def processed(self, table: str) -> DataFrame:
        """Processed table, written once: every rule pass then reads only the columns it needs."""
        if table not in self._processed:
            plan = self.processed_plan(table)
            if not (self.processed_target and table == "orders"):  # the write by month deals these rows out itself
                plan = spread(plan)
            plan = T.stamp_processed(plan) if self.stamped else plan
            if self.processed_target:
                target = self.processed_target(table)
                sinks.write_table(plan, target, partition_by=["order_month"] if table == "orders" else None)
                self._processed[table] = sinks.read_table(self.spark, target)
            else:
                self._processed[table] = materialize(plan, f"processed-{table}")
        return self._processed[table]

    def rules(self, table: str):
        if table == "orders":
            return checks.orders_rules(curr_timestamp=self.config.freshness_curr_timestamp)
        if table == "customers":
            return checks.customers_rules()
        return checks.delivery_rules()

    # checked ------------------------------------------------------------------------------------
    def _build_checked(self, table: str) -> Checked:
        df = self.processed(table)
        rules = self.rules(table) if self.config.quality_checks else []
        checked = engine.annotate(df, rules, self.config.gate, history=self.history.get(table), state=self.state.get(table),
                                  state_part="order_month" if self.stamped and rules and table == "orders" else None)
        extra = {}
        within = ["order_month"] if table == "orders" else []
        if not rules:
            return checked.written(self.checked_target(table), self.config.quarantine_on, within) if self.checked_target else checked
        if table == "customers":  # size of the join's customer side, measured in the same write
            cols = ["customer_id", *marts.side_columns("c")]
            valid = F.size(F.col(engine.ERRORS)) == 0
            extra["join_bytes"] = F.coalesce(F.sum(F.when(valid, estimated_row_bytes(df, cols))), F.lit(0))
        if self.checked_target:
            return checked.written(self.checked_target(table), self.config.quarantine_on, within, **extra)
        return checked.materialized(f"annotated-{table}", **extra)

    def checked(self, table: str) -> Checked:
        if table not in self._checked:
            self._checked[table] = self._build_checked(table)
        return self._checked[table]

    def check_all(self, tables=TABLES) -> dict[str, Checked]:
        """Annotate several tables with overlapping jobs (they are independent until the join)."""
        missing = [t for t in tables if t not in self._checked]
        for t, c in zip(missing, run_concurrently([lambda t=t: self._build_checked(t) for t in missing])):
            self._checked[t] = c
        return {t: self._checked[t] for t in tables}

    def valid(self, table: str) -> DataFrame:
        return self.checked(table).valid(self.config.quarantine_on)

    def quarantine(self, table: str) -> DataFrame:
        return self.checked(table).quarantine(self.config.quarantine_on)

    # published ----------------------------------------------------------------------------------
    def _broadcast_customers(self) -> bool | None:
        """Broadcast the customer side only when its measured size (rows and estimated bytes of the
        columns the join reads, one aggregation pass) is within the broadcast bounds."""
        stats = self.checked("customers").stats
        if stats and "join_bytes" in stats and self.config.quarantine_on == "error":
            return fits_broadcast(self.spark, stats["rows"] - stats["error_rows"], stats["join_bytes"],
                                  self.config.customers_broadcast_rows)
        side = self.valid("customers").select("customer_id", *marts.side_columns("c"))
        m = side.agg(F.count(F.lit(1)).alias("rows"),
                     F.coalesce(F.sum(estimated_row_bytes(side)), F.lit(0)).alias("bytes")).first()
        return fits_broadcast(self.spark, m["rows"], m["bytes"], self.config.customers_broadcast_rows)

    def joined_plan(self) -> DataFrame:
        self.check_all()
        return marts.join_orders(self.valid("orders"), self.valid("customers"), self.valid("delivery_performance"),
                                 broadcast_customers=self._broadcast_customers())

    @cached_property
    def joined(self) -> DataFrame:
        return materialize(self.joined_plan(), "joined")

    @cached_property
    def monthly(self) -> DataFrame:
        return marts.monthly_performance(self.joined)

    def quality_summary(self) -> DataFrame:
        return reporting.quality_summary({t: self.checked(t).annotated for t in TABLES}, self.config.quarantine_on)


def _published_score(valid: DataFrame, quarantine: DataFrame, table: str) -> DataFrame:
    """Q12 over published tables: rows of ``valid`` are valid, rows of ``quarantine`` are not."""
    none = F.array().cast("array<string>")
    rows = valid.select(none.alias(engine.ERRORS), none.alias(engine.WARNINGS)).unionByName(
        quarantine.select(F.array(F.lit("quarantined")).alias(engine.ERRORS), none.alias(engine.WARNINGS)))
    return reporting.quality_score(rows, table)


def run(spark: SparkSession, raw: dict[str, DataFrame], out_prefix: str,
        config: RunConfig | None = None) -> DataFrame:
    """Publish processed, final (valid), quarantine, log, summary, joined and mart tables.

    Returns the row-count report (S6) of everything written. ``out_prefix`` is a folder or a catalog
    namespace. The three tables are checked with overlapping jobs, published tables that do not depend on
    each other are written concurrently, and marts come last: a run that fails before leaves the earlier
    marts in place. Intermediates go to a folder of this run, deleted at its end.

    Incremental runs read the window's rows and the undated ones, join them with the published rows of the
    window's months outside the window, and replace these months whole in the processed, final, quarantine
    and joined tables and in the state of rules and marts (months left without rows are removed). Rows of other
    months take part in dataset-level rules through their state, and in marts through theirs: neither these
    rows nor the joined table outside the window's months are read again. Scores count whole published tables.
    """
    with run_folder(spark):
        return _run(spark, raw, out_prefix, config or RunConfig())


def _run(spark: SparkSession, raw: dict[str, DataFrame], out_prefix: str, cfg: RunConfig) -> DataFrame:
    now = _dt.datetime.now()
    batch = cfg.batch_id or now.strftime("%Y%m%d_%H%M%S")
    cfg = replace(cfg, freshness_curr_timestamp=cfg.freshness_curr_timestamp or now.isoformat(" ", "seconds"))
    sep = "/" if "/" in out_prefix else "."
    target = lambda name: f"{out_prefix.rstrip(sep)}{sep}{name}"
    months = None
    history, state, kept = {}, {}, None
    rules = checks.orders_rules(curr_timestamp=cfg.freshness_curr_timestamp)
    suffix = engine.state_name(rules)
    windows = {r.name: f"rule_windows_orders_{suffix}_{n}" for n, r in enumerate(r for r in rules if isinstance(r.check, Freshness))}
    keyed = f"rule_state_orders_{suffix}"
    if cfg.run_mode == "incremental":
        inside = F.coalesce(in_window(F.col("order_date"), cfg.start_date, cfg.end_date), F.lit(False))
        months = touched_months(cfg.start_date, cfg.end_date)
        if sinks.exists(spark, target("processed_orders")):
            published = sinks.read_table(spark, target("processed_orders"))
            kept = published.filter(months(F.col("order_month")) & ~inside & F.col("order_date").isNotNull())
            elsewhere = lambda df: df.filter(~months(F.col("order_month")))
            if all(sinks.exists(spark, target(t)) for t in (keyed, *windows.values())):
                state["orders"] = RuleState("order_month", elsewhere(sinks.read_table(spark, target(keyed))),
                                            {r: elsewhere(sinks.read_table(spark, target(t))) for r, t in windows.items()})
            else:  # published under other rules: the rows themselves
                history["orders"] = elsewhere(published)
        else:
            months = None  # nothing published yet: the window's rows are the first tables
    flow = Flow(spark, raw, cfg, processed_target=(lambda t: target(f"processed_{t}")) if months is None else None,
                history=history, kept_orders=kept, stamped=True, state=state,
                checked_target=(lambda t: target(f"checked_{t}")) if cfg.one_write and months is None else None)

    co_located = ("final_orders", "final_delivery_performance") if cfg.buckets and sep == "." else ()

    def publish(name: str, df: DataFrame, by_month: bool = False) -> None:
        if name in co_located and not (by_month and months is not None and sinks.exists(spark, target(name))):
            sinks.write_bucketed(df, target(name), ["order_id"], cfg.buckets, ["order_month"] if by_month else None)
        else:
            verdict = [engine.VERDICT] if name.startswith("checked_") else []
            if by_month and months is not None:
                sinks.replace_partitions(df, target(name), "order_month", months, verdict)
            else:
                sinks.write_table(df, target(name), partition_by=(["order_month"] if by_month else []) + verdict or None)

    flow.check_all()
    outputs: list[tuple] = []
    for table in TABLES:
        by_month = table == "orders"
        if months is not None:
            outputs.append((f"processed_{table}", flow.processed(table), by_month))
        if not cfg.one_write:
            outputs.append((f"final_{table}", flow.valid(table), by_month))
            outputs.append((f"quarantine_{table}", flow.quarantine(table), by_month))
        elif months is not None:
            outputs.append((f"checked_{table}", flow.checked(table).annotated.withColumn(engine.VERDICT, engine.verdict(cfg.quarantine_on)),
                            by_month))
    def joined_plan() -> DataFrame:
        if not co_located:
            return flow.joined_plan()
        sides = [sinks.read_table(spark, target(t)) for t in co_located]
        orders = sides[0] if months is None else sides[0].filter(months(F.col("order_month")))
        return marts.join_orders(orders, flow.valid("customers"), sides[1], broadcast_customers=flow._broadcast_customers())

    if co_located:  # the join reads them as published
        run_concurrently([lambda o=o: publish(*o) for o in outputs if o[0] in co_located])
    analytics = joined_plan().withColumns({"_created_timestamp": F.current_timestamp(),
                                                "_batch_id": F.lit(f"batch_{batch}")})
    outputs.append(("analytics_main", analytics, True))
    outputs.append(("table_metadata", catalog.table_metadata(spark)))
    run_concurrently([lambda o=o: publish(*o) for o in outputs if o[0] not in co_located])

    def own_months(df: DataFrame) -> DataFrame:
        return df if months is None else df.filter(months(F.col("order_month")))

    read = lambda name: sinks.read_table(spark, target(name))
    states = []
    kept_state = flow.checked("orders").state
    if kept_state is not None and not history:
        states.append((keyed, kept_state.keyed, True))
        states += [(name, kept_state.windows[r], True) for r, name in windows.items()]
    for name, fn in mart_state.STATES.items():  # from the months just written, or all where there is no state yet
        fresh = months is not None and sinks.exists(spark, target(name))
        part = own_months(read("analytics_main")) if fresh else read("analytics_main")
        states.append((name, fn(part), fresh))

    def publish_state(name: str, df: DataFrame, by_part: bool) -> None:
        if by_part and months is not None:
            sinks.replace_partitions(df, target(name), "order_month", months)
        else:
            sinks.write_table(df, target(name), partition_by=["order_month"])

    run_concurrently([lambda o=o: publish_state(*o) for o in states])

    logs = None
    for table in TABLES:
        kinds = ("checked", "checked") if cfg.one_write else ("final", "quarantine")
        log = reporting.rule_log(flow.checked(table), run_id=batch, valid_table=target(f"{kinds[0]}_{table}"),
                                 quarantine_table=target(f"{kinds[1]}_{table}"))
        logs = log if logs is None else logs.unionByName(log)
    sinks.replace_run(logs, target("dq_test_logs"), batch)  # a retried run does not double its rows

    if cfg.one_write:
        scores = [reporting.quality_score(read(f"checked_{t}"), t, cfg.quarantine_on) for t in TABLES]
    else:
        scores = [_published_score(read(f"final_{t}"), read(f"quarantine_{t}"), t) for t in TABLES]
    summaries = [("data_quality_summary", scores[0].unionByName(scores[1]).unionByName(scores[2]))]
    marts_now = mart_state.all_marts(*[read(name) for name in mart_state.STATES])
    summaries += [(name, df.withColumn("_created_timestamp", F.current_timestamp())) for name, df in marts_now.items()]
    run_concurrently([lambda o=o: publish(*o) for o in summaries])

    names = [o[0] for o in (*outputs, *summaries)] + ["dq_test_logs"]
    written = ("processed", "checked") if cfg.one_write else ("processed",)
    names += [f"{kind}_{t}" for kind in written for t in TABLES if f"{kind}_{t}" not in names]
    return catalog.table_row_counts(spark, {n: target(n) for n in names})
