"""Rule engine: compile a rule list into few Spark passes, annotate rows, split valid/quarantine (Q10).

Plan shape for one table (``annotate``):

1. One aggregation per distinct key set. Every keyed check on the same key contributes measures to the
   same ``groupBy`` (map-side partial aggregation, so a key holding a third of the table is combined in
   every task before the shuffle). Only violating keys are kept, with the names of the rules they break.
   SQL-query checks with the same merge key are reduced to one row per key and merged into that frame.
2. Each violating-key frame is written to the shared folder; its rows and estimated bytes are observed
   during that write. Empty frames are dropped from the plan; frames within ``Gate`` bounds (rows, and
   bytes up to the broadcast threshold) are broadcast; larger ones are joined by shuffle (AQE splits
   skewed partitions). Conditions of a key that a uniqueness rule counts are judged on the row itself, and by this
   frame only for keys of several rows. Keys match null-safely. The side frames of one table are built concurrently.
3. Global checks become one 1-row aggregate, cross-joined (one row, always broadcast).
4. Freshness checks join rows to the under-filled windows of a spine of at most ``lookback_windows``
   rows.
5. Row checks and the joined flags become two arrays in one projection: ``_errors`` and ``_warnings``
   (rule names). Without a shared folder the frames stay lazy and AQE picks the join strategy at run time.

So the full rows are scanned once, and shuffled only when a violating-key set is large.

Key lattice: where one key set holds all columns of others (order and customer, order, customer), its partial
aggregates are written once and the coarser keys and table-wide limits are rolled up from them, so the rules of
that table scan the rows once.

Rows already published take part in dataset-level rules in one of two ways. ``state`` holds their partial
aggregates (``RuleState``): only those of keys that the new rows touch are read into the aggregation. ``history``
holds the rows themselves, for rules whose measures cannot be merged, or where no state is there yet.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.rules import (
    AggrLimit,
    Condition,
    Freshness,
    KeyedCheck,
    Rule,
    SqlQuery,
    Unique,
)
from tidemark.session import (
    estimated_row_bytes,
    fits_broadcast,
    materialize,
    materialize_observed,
    observed,
    run_concurrently,
)
from tidemark.sources import sinks

ERRORS = "_errors"
WARNINGS = "_warnings"
SCORE = "_data_quality_score"
#: partition column of checked tables that are stored with both kinds of rows
VERDICT = "_verdict"
VALID, QUARANTINED = "valid", "quarantine"
QUARANTINE_POLICIES = ("error", "any")


@dataclass(frozen=True)
class Gate:
    """Decides how a violating-key frame is joined back.

    The frame is written once while its rows and estimated in-memory bytes are
    observed in the same job: 0 rows -> no join at all; at most ``max_rows`` rows and ``max_bytes``
    bytes (default: the session's ``spark.sql.autoBroadcastJoinThreshold``) -> broadcast hash join;
    otherwise a shuffle join (AQE splits skewed partitions).
    """

    max_rows: int = 2_000_000
    max_bytes: int | None = None

    def prepare(self, frame: DataFrame, name: str) -> DataFrame | None:
        frame, metrics = materialize_observed(frame, name, rows=F.count(F.lit(1)),
                                              bytes=F.coalesce(F.sum(estimated_row_bytes(frame)), F.lit(0)))
        if metrics["rows"] == 0:
            return None
        small = fits_broadcast(frame.sparkSession, metrics["rows"], metrics["bytes"], self.max_rows, self.max_bytes)
        return F.broadcast(frame) if small else frame


@dataclass
class RuleState:
    """Partial aggregates of rows, mergeable with those of other rows under the same rules.

    ``keyed``: (part, key columns of the rules, partials), ``windows[rule name]``: (part, wstart, records). ``part``
    is the column by which a table of state is replaced (its month).
    """

    part: str
    keyed: DataFrame | None = None
    windows: dict[str, DataFrame] = field(default_factory=dict)


@dataclass
class Checked:
    """Annotated rows plus dataset-level outcomes of one rule run.

    ``stats`` (rows, error_rows, warning_rows) is filled when the annotated rows are materialised; ``state`` (the
    partial aggregates of the annotated rows) if it was asked for. ``split_on`` is the policy by which the rows are
    stored in partitions of ``VERDICT``, if they are.
    """

    annotated: DataFrame
    rules: tuple[Rule, ...]
    outcomes: DataFrame
    stats: dict | None = None
    state: RuleState | None = None
    split_on: str | None = None

    def materialized(self, name: str = "annotated", **extra: Column) -> "Checked":
        """Write the annotated rows once so split, log and scores share one execution; row counts (and
        any ``extra`` aggregate metrics) are observed during that write."""
        df, stats = materialize_observed(self.annotated, name, rows=F.count(F.lit(1)),
                                         error_rows=F.count_if(F.size(ERRORS) > 0),
                                         warning_rows=F.count_if(F.size(WARNINGS) > 0), **extra)
        return Checked(df, self.rules, self.outcomes, stats, self.state)

    def written(self, target: str, quarantine_on: str = "error", within: Sequence[str] = (), **extra: Column) -> "Checked":
        """Write each checked row once: to a table partitioned by ``within`` and the verdict, of which the valid and
        the quarantined rows are partition-pruned reads. Metrics are observed as in ``materialized``."""
        df = self.annotated.withColumn(VERDICT, verdict(quarantine_on))
        seen = Observation()
        metrics = {"rows": F.count(F.lit(1)), "error_rows": F.count_if(F.size(ERRORS) > 0),
                   "warning_rows": F.count_if(F.size(WARNINGS) > 0), **extra}
        wanted = [c.alias(k) for k, c in metrics.items()]
        sinks.write_table(df.observe(seen, *wanted), target, partition_by=[*within, VERDICT])
        stored = read_checked(df.sparkSession, target, df)
        taken = observed(seen)
        return Checked(stored, self.rules, self.outcomes, taken if taken is not None else stored.agg(*wanted).first().asDict(),
                       self.state, quarantine_on)

    def _split(self, quarantine_on: str) -> tuple[DataFrame, DataFrame]:
        if self.split_on == quarantine_on:
            return stored_split(self.annotated, quarantine_on)
        return split(self.annotated.drop(VERDICT) if self.split_on else self.annotated, quarantine_on)

    def valid(self, quarantine_on: str = "error") -> DataFrame:
        return self._split(quarantine_on)[0]

    def quarantine(self, quarantine_on: str = "error") -> DataFrame:
        return self._split(quarantine_on)[1]


def _check_names(rules: tuple[Rule, ...]) -> None:
    seen: set[str] = set()
    for r in rules:
        if r.name in seen:
            raise ValueError(f"duplicate rule name {r.name!r}: rule names must be unique within a rule set")
        seen.add(r.name)


def _names_array(pairs: list[tuple[Column, str]]) -> Column:
    """array of the names whose condition holds (empty array if none)."""
    if not pairs:
        return F.array().cast("array<string>")
    return F.filter(F.array(*[F.when(cond, F.lit(name)) for cond, name in pairs]), lambda x: x.isNotNull())


def _empty() -> Column:
    return F.array().cast("array<string>")


def _run_sql(df: DataFrame, check: SqlQuery) -> DataFrame:
    """The rule's query over ``df``; the view it reads is gone once the query is analyzed."""
    view = f"tidemark_input_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    pattern = r"\{\{\s*" + re.escape(check.input_placeholder) + r"\s*\}\}"
    try:
        return df.sparkSession.sql(re.sub(pattern, view, check.query))
    finally:
        df.sparkSession.catalog.dropTempView(view)


def _group_key(r: Rule) -> tuple[str, ...] | None:
    c = r.check
    if isinstance(c, (KeyedCheck, Condition)) and not r.is_row_rule:
        return c.keys
    if isinstance(c, SqlQuery):
        return c.merge_columns
    return None


def _tag(r: Rule) -> str:
    """Prefix of a rule's measures: the same in every run, so that stored partials are found again."""
    return "__" + re.sub(r"\W", "_", r.name) + f"_{zlib.crc32(r.name.encode()):08x}"


def _is_mergeable(r: Rule) -> bool:
    return isinstance(r.check, (KeyedCheck, Condition)) and not r.is_row_rule and r.check.mergeable


def state_columns(rules: Iterable[Rule]) -> tuple[str, ...]:
    """The columns that key the partials of all mergeable rules, in order of first use."""
    return tuple(dict.fromkeys(k for r in rules if _is_mergeable(r) for k in r.check.keys))


def state_name(rules: Iterable[Rule]) -> str:
    """A name for the state of these rules: other rules, or other limits of windows, have another state."""
    text = "|".join(sorted(r.definition() for r in rules if _is_mergeable(r)))
    windows = "|".join(f"{r.name}:{r.check.column}:{r.check.window_minutes}" for r in rules if isinstance(r.check, Freshness))
    return f"{zlib.crc32(f'{text}#{windows}'.encode()):08x}"


@dataclass
class _Partials:
    """Written partials of the rows at the finest key, with the bounds of their keys, and those of published rows."""

    frame: DataFrame
    keys: tuple[str, ...]
    metrics: dict
    gate: Gate
    published: DataFrame | None = None

    def of(self, key: tuple[str, ...], rules: list[Rule]) -> DataFrame:
        """The measures of ``rules`` by ``key``, over these rows and the published ones of the same keys."""
        columns = [*key, *[c for r in rules for c in _partial_names(r)]]
        rows = self.frame.select(*columns)
        if self.published is not None:
            rows = rows.unionByName(self._touched(key).select(*columns))
        combine = [c for r in rules for c in r.check.combined(_tag(r))]
        combined = rows.groupBy(*key).agg(*combine) if key else rows.agg(*combine)
        return combined.select(*key, *[c for r in rules for c in r.check.finished(_tag(r))])

    def _touched(self, key: tuple[str, ...]) -> DataFrame:
        """Published partials of the keys that these rows hold. Bounds of the keys are pushed to the scan; the keys
        themselves filter it in a semi-join, broadcast if their measured size allows, before anything is shuffled."""
        published = self.published
        for k in key:
            low, high = self.metrics[f"low_{k}"], self.metrics[f"high_{k}"]
            if low is not None:
                published = published.filter(F.col(k).isNull() | F.col(k).between(F.lit(low), F.lit(high)))
        if not key:
            return published
        touched = self.frame.select(*[F.col(k).alias(f"__touched_{k}") for k in key]).distinct()
        if fits_broadcast(self.frame.sparkSession, self.metrics["rows"], self.metrics["bytes"], self.gate.max_rows, self.gate.max_bytes):
            touched = F.broadcast(touched)
        cond = None
        for k in key:
            c = F.col(k).eqNullSafe(F.col(f"__touched_{k}"))
            cond = c if cond is None else cond & c
        return published.join(touched, cond, "left_semi")


def _partial_names(r: Rule) -> list[str]:
    check = r.check
    if isinstance(check, AggrLimit) and check.aggr_type == "avg":
        return [f"{_tag(r)}_s", f"{_tag(r)}_c"]
    suffix = {"Condition": "any", "Unique": "n"}.get(type(check).__name__, "v")
    return [f"{_tag(r)}_{suffix}"]


def _write_partials(df: DataFrame, rules: tuple[Rule, ...], gate: Gate, state: RuleState | None, part: str | None,
                    name: str) -> _Partials | None:
    """The partials of all mergeable rules at their finest key, written once: where a state is kept or merged, or where
    one rule's key holds those of others."""
    merged = [r for r in rules if _is_mergeable(r)]
    keys = state_columns(rules)
    sets = {r.check.keys for r in merged}
    lattice = len(sets - {()}) > 1 and any(set(keys) == set(k) for k in sets)
    if not merged or not (lattice or part or (state is not None and state.keyed is not None)):
        return None
    by = list(dict.fromkeys([*([part] if part else []), *keys]))
    aggregates = [p for r in merged for p in r.check.partials(_tag(r))]
    frame = df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)
    bounds = {f"{end}_{k}": fn(k) for k in keys for end, fn in (("low", F.min), ("high", F.max))}
    frame, metrics = materialize_observed(frame, f"partials-{name}", rows=F.count(F.lit(1)),
                                          bytes=F.coalesce(F.sum(estimated_row_bytes(frame, keys)), F.lit(0)), **bounds)
    return _Partials(frame, keys, metrics, gate, state.keyed if state is not None else None)


def _counted_by(members: list[Rule]) -> Rule | None:
    """The rule that counts the rows of a key, if there is one."""
    return next((r for r in members if isinstance(r.check, Unique)), None)


def _own_conditions(members: list[Rule]) -> list[Rule]:
    """Conditions of a key whose rows are counted: a row violates them by itself, or by another row of its key, which
    only a key of several rows has. So keys of one row need no place in the violating-key frame."""
    return [r for r in members if isinstance(r.check, Condition)] if _counted_by(members) else []


def _key_frame(df: DataFrame, key: tuple[str, ...], members: list[Rule], tag: str, partials: _Partials | None = None) -> DataFrame:
    """(tag_k0.., tag_e, tag_w): one row per violating key (or exactly one row for ``key == ()``), without the
    ``_own_conditions`` of keys of one row."""
    key_names = [f"{tag}_k{j}" for j in range(len(key))]
    pieces: list[DataFrame] = []

    fused = [r for r in members if not isinstance(r.check, SqlQuery)]
    rolled = [r for r in fused if partials is not None and _is_mergeable(r)]
    direct = [r for r in fused if r not in rolled]
    own, counted = _own_conditions(members), _counted_by(members)
    for rules in (rolled, direct):
        if not rules:
            continue
        if rules is rolled:
            agg = partials.of(key, rules)
        else:
            measures = [m for r in rules for m in r.check.measures(_tag(r))]
            agg = df.groupBy(*key).agg(*measures) if key else df.agg(*measures)
        several = F.col(f"{_tag(counted)}_n") > 1 if own else None
        flags = [(r.check.violated(_tag(r)) & several if r in own else r.check.violated(_tag(r)), r) for r in rules]
        pieces.append(agg.select(
            *[F.col(k).alias(n) for k, n in zip(key, key_names)],
            _names_array([(c, r.name) for c, r in flags if r.criticality == "error"]).alias(f"{tag}_e"),
            _names_array([(c, r.name) for c, r in flags if r.criticality == "warn"]).alias(f"{tag}_w"),
        ))

    for r in members:
        if not isinstance(r.check, SqlQuery):
            continue
        result = _run_sql(df, r.check)
        hit = F.bool_or(F.coalesce(F.col(r.check.condition_column).cast("boolean"), F.lit(False)))
        reduced = (result.groupBy(*key).agg(hit.alias("_hit")) if key else result.agg(hit.alias("_hit")))
        named = F.when(F.coalesce(F.col("_hit"), F.lit(False)), F.array(F.lit(r.name))).otherwise(_empty())
        pieces.append(reduced.select(
            *[F.col(k).cast(df.schema[k].dataType).alias(n) for k, n in zip(key, key_names)],
            (named if r.criticality == "error" else _empty()).alias(f"{tag}_e"),
            (named if r.criticality == "warn" else _empty()).alias(f"{tag}_w"),
        ))

    frame = pieces[0]
    for p in pieces[1:]:
        frame = frame.unionByName(p)
    if len(pieces) > 1:
        merge = [F.array_distinct(F.flatten(F.collect_list(f"{tag}_{s}"))).alias(f"{tag}_{s}") for s in "ew"]
        frame = frame.groupBy(*key_names).agg(*merge) if key else frame.agg(*merge)
    if key:
        frame = frame.filter((F.size(f"{tag}_e") + F.size(f"{tag}_w")) > 0)
    return frame


def _interval(minutes: int) -> Column:
    return F.expr(f"INTERVAL '{int(minutes)}' MINUTE")


def window_start(ts: Column, minutes: int, ts_type: str) -> Column:
    """Start of the tumbling ``minutes`` window holding ``ts``, aligned to the epoch in the column's own
    clock.

    Plain interval arithmetic (``ts - epoch``, then whole minutes), so a ``timestamp_ntz`` column never
    passes through the session time zone, and no row is dropped (``window()`` would also filter out
    rows whose time is null).
    """
    epoch = F.lit("1970-01-01 00:00:00").cast(ts_type)
    since = ts - epoch
    whole_minutes = (F.extract(F.lit("DAY"), since).cast("bigint") * 1440
                     + F.extract(F.lit("HOUR"), since).cast("bigint") * 60
                     + F.extract(F.lit("MINUTE"), since).cast("bigint")
                     # before the epoch the parts are negative: seconds left over belong to the minute below
                     - (F.extract(F.lit("SECOND"), since) < 0).cast("bigint"))
    bucket = whole_minutes - F.pmod(whole_minutes, F.lit(minutes))
    # as an interval of days and minutes: minutes alone leave the int range beyond the year 6000
    start = F.make_dt_interval(days=F.floor(bucket / 1440).cast("int"), mins=F.pmod(bucket, F.lit(1440)).cast("int"))
    return epoch + start


def _floor_to_window(text: str, minutes: int) -> _dt.datetime:
    ts = _dt.datetime.fromisoformat(text)
    seconds = int((ts - _dt.datetime(1970, 1, 1)).total_seconds())
    return _dt.datetime(1970, 1, 1) + _dt.timedelta(seconds=seconds - seconds % (60 * minutes))


def _window_counts(df: DataFrame, check: Freshness, part: str) -> DataFrame:
    """(part, wstart, records) of every window with rows: the state of a freshness rule."""
    wstart = window_start(F.col(check.column), check.window_minutes, df.schema[check.column].dataType.simpleString())
    return df.select(F.col(part), wstart.alias("wstart")).filter(F.col("wstart").isNotNull()).groupBy(part, "wstart").agg(
        F.count(F.lit(1)).alias("records"))


def _freshness(df: DataFrame, check: Freshness, counted: list[DataFrame] | None = None
               ) -> tuple[Column, DataFrame, Callable[[DataFrame], DataFrame]]:
    """(window-start expression, per-window counts, function: counts -> lookback windows).

    ``counted``: window counts that are there already (of these rows, and of published ones) and are summed instead
    of counting rows.

    Counts are one aggregation of the data: with ``curr_timestamp`` the lookback bounds are literals and
    the row filter is pushed to the scan (only the lookback span is read); otherwise every window is
    counted (bounded by the time span, not by the rows) and the lookback ends with the last window
    holding data. The lookback windows (wstart, records) are at most ``lookback_windows`` rows.
    """
    ts_type = df.schema[check.column].dataType.simpleString()
    wstart = window_start(F.col(check.column), check.window_minutes, ts_type)
    width = _interval(check.window_minutes)
    span = _interval(check.window_minutes * check.lookback_windows)

    def spine_from(bounds: DataFrame) -> DataFrame:
        return bounds.select(F.explode(F.sequence(F.col("_end") - span, F.col("_end") - width, width))
                             .alias("wstart"))

    if check.curr_timestamp:
        end = _floor_to_window(check.curr_timestamp, check.window_minutes)
        start = end - _dt.timedelta(minutes=check.window_minutes * check.lookback_windows)
        c = F.col(check.column) if counted is None else F.col("wstart")
        rows = (df if counted is None else _summed(counted)).filter((c >= F.lit(start.isoformat(sep=" ")).cast(ts_type))
                         & (c < F.lit(end.isoformat(sep=" ")).cast(ts_type)))
        fixed_spine = spine_from(df.sparkSession.range(1).select(
            F.lit(end.isoformat(sep=" ")).cast(ts_type).alias("_end")))
        if counted is None:
            rows = rows.select(wstart.alias("wstart"), F.lit(1).alias("records"))
        counts = (rows.select("wstart", "records").join(fixed_spine, "wstart")
                  .groupBy("wstart").agg(F.sum("records").alias("records")))

        def windows_of(counts: DataFrame) -> DataFrame:
            return fixed_spine.join(counts, "wstart", "left").select(
                "wstart", F.coalesce("records", F.lit(0)).alias("records"))
    else:
        if counted is None:
            counts = (df.select(wstart.alias("wstart")).filter(F.col("wstart").isNotNull())
                      .groupBy("wstart").agg(F.count(F.lit(1)).alias("records")))
        else:
            counts = _summed(counted).groupBy("wstart").agg(F.sum("records").alias("records"))

        def windows_of(counts: DataFrame) -> DataFrame:
            spine = spine_from(counts.agg((F.max("wstart") + width).alias("_end")))
            return spine.join(counts, "wstart", "left").select(
                "wstart", F.coalesce("records", F.lit(0)).alias("records"))
    return wstart, counts, windows_of


def _summed(counted: list[DataFrame]) -> DataFrame:
    out = counted[0].select("wstart", "records")
    for more in counted[1:]:
        out = out.unionByName(more.select("wstart", "records"))
    return out


def _window_outcome(windows: DataFrame, check: Freshness) -> tuple[DataFrame, DataFrame]:
    """(under-filled windows, 1-row outcome (observed, dataset_violated))."""
    low = F.col("records") < check.min_records_per_window
    under = windows.filter(low)
    outcome = (windows.agg(F.count(F.lit(1)).alias("n"), F.count_if(low).alias("bad"),
                           F.count_if(F.col("records") == 0).alias("empty"))
               .select(F.format_string("%d of %d windows below %d records (%d empty)", F.col("bad"), F.col("n"),
                                       F.lit(check.min_records_per_window), F.col("empty")).alias("observed"),
                       ((F.col("bad") > 0) | (F.col("n") == 0)).alias("dataset_violated")))
    return under, outcome


def freshness_report(df: DataFrame, column: str, window_minutes: int, min_records_per_window: int,
                     lookback_windows: int, curr_timestamp: str | None = None) -> DataFrame:
    """Q9 as a report: one row per lookback window (window_start, window_end, records, below_min)."""
    check = Freshness(column, window_minutes, min_records_per_window, lookback_windows, curr_timestamp)
    _, counts, windows_of = _freshness(df, check)
    windows = windows_of(counts)
    return windows.select(
        F.col("wstart").alias("window_start"),
        (F.col("wstart") + _interval(window_minutes)).alias("window_end"),
        F.col("records"),
        (F.col("records") < min_records_per_window).alias("below_min"))


def _global_frame(df: DataFrame, members: list[Rule], tag: str, partials: _Partials | None = None) -> DataFrame:
    """Exactly one row: the measures of all table-wide checks plus ``tag_e`` / ``tag_w`` name arrays.

    Every piece is a 1-row aggregate, so the pieces are combined by cross join (1 x 1 rows).
    """
    pieces: list[DataFrame] = []
    errs: list[Column] = []
    warns: list[Column] = []
    fused = [r for r in members if not isinstance(r.check, SqlQuery)]
    rolled = [r for r in fused if partials is not None and _is_mergeable(r)]
    direct = [r for r in fused if r not in rolled]
    for n, rules in enumerate((rolled, direct)):
        if not rules:
            continue
        agg = partials.of((), rules) if rules is rolled else df.agg(*[m for r in rules for m in r.check.measures(_tag(r))])
        flags = [(r.check.violated(_tag(r)), r) for r in rules]
        pieces.append(agg.select(
            "*",
            _names_array([(c, r.name) for c, r in flags if r.criticality == "error"]).alias(f"{tag}_fe{n}"),
            _names_array([(c, r.name) for c, r in flags if r.criticality == "warn"]).alias(f"{tag}_fw{n}")))
        errs.append(F.col(f"{tag}_fe{n}"))
        warns.append(F.col(f"{tag}_fw{n}"))
    for i, r in enumerate(m for m in members if isinstance(m.check, SqlQuery)):
        result = _run_sql(df, r.check)
        hit = F.coalesce(F.bool_or(F.coalesce(F.col(r.check.condition_column).cast("boolean"), F.lit(False))),
                         F.lit(False))
        named = F.when(hit, F.array(F.lit(r.name))).otherwise(_empty())
        pieces.append(result.agg(named.alias(f"{tag}_q{i}")))
        (errs if r.criticality == "error" else warns).append(F.col(f"{tag}_q{i}"))
    frame = pieces[0]
    for p in pieces[1:]:
        frame = frame.crossJoin(p)
    concat = lambda cols: (F.concat(*cols) if len(cols) > 1 else cols[0]) if cols else _empty()
    return frame.select("*", concat(errs).alias(f"{tag}_e"), concat(warns).alias(f"{tag}_w"))


def annotate(df: DataFrame, rules: Iterable[Rule], gate: Gate | None = None, history: DataFrame | None = None,
             state: RuleState | None = None, state_part: str | None = None) -> Checked:
    """Evaluate ``rules`` on ``df``: adds ``_errors``, ``_warnings`` (arrays of rule names) and
    ``_data_quality_score`` (1 - violated rules / rules).

    All side frames (violating keys per key set, the 1-row table-wide frame, freshness windows) are
    built first and materialised concurrently; the annotate pass itself is then one scan of ``df`` joined
    to them.

    ``history``: rows already published (e.g. outside an incremental run's window). They take part in
    every dataset-level check (uniqueness, per-key limits and conditions, table-wide aggregates,
    freshness) but are not annotated or returned, so an incremental run judges new rows against the
    whole dataset.

    ``state``: the partial aggregates of such rows, instead of the rows. ``state_part``: also return the partial
    aggregates of ``df`` by this column, for later runs (``Checked.state``).
    """
    rules = tuple(rules)
    _check_names(rules)
    gate = gate or Gate()
    run = uuid.uuid4().hex[:6]
    source = df
    if history is not None:
        shared = [c for c in df.columns if c in history.columns]
        source = df.unionByName(history.select(*shared), allowMissingColumns=True)

    groups: dict[tuple[str, ...], list[Rule]] = {}
    for r in rules:
        key = _group_key(r)
        if key is not None:
            groups.setdefault(key, []).append(r)
    tags = {key: f"__g{gi}" for gi, key in enumerate(groups)}
    fresh = [r for r in rules if isinstance(r.check, Freshness)]
    partials = _write_partials(source, rules, gate, state, state_part, run)
    part = state_part or (state.part if state is not None else None)
    own = {r.name: materialize(_window_counts(source, r.check, part), f"window-state-{run}") for r in fresh} if part else {}
    fresh_parts = []
    for r in fresh:
        published = [state.windows[r.name]] if state is not None and r.name in state.windows else []
        fresh_parts.append(_freshness(source, r.check, [own[r.name], *published] if part else None))
    kept = RuleState(state_part, partials.frame if partials else None, own) if state_part else None

    # side frames, materialised concurrently (small by construction, or gated by their measured size)
    tasks = []
    for key, members in groups.items():
        if key:
            frame = _key_frame(source, key, members, tags[key], partials)
            tasks.append(lambda frame=frame, key=key: gate.prepare(frame, f"violations-{run}-{tags[key][3:]}"))
        else:  # one row
            frame = _global_frame(source, members, tags[key], partials)
            tasks.append(lambda frame=frame: materialize(frame, f"global-{run}"))
    for i, (_, counts, windows_of) in enumerate(fresh_parts):
        # counts: one row per window of the data's time span, written once; then the lookback windows
        # (at most lookback_windows rows) derived from that small table and written too
        tasks.append(lambda counts=counts, windows_of=windows_of, i=i: materialize(
            windows_of(materialize(counts, f"window-counts-{run}-{i}")), f"windows-{run}-{i}"))
    done = run_concurrently(tasks)
    side = dict(zip(groups, done[:len(groups)]))
    window_frames = done[len(groups):]

    base = df
    helpers: list[str] = []
    err_arrays: list[Column] = []
    warn_arrays: list[Column] = []
    outcome_rows: list[DataFrame] = []

    for key, members in groups.items():
        tag, frame = tags[key], side[key]
        own = _own_conditions(members)
        if frame is None:  # no violating key at all
            for names, level in ((err_arrays, "error"), (warn_arrays, "warn")):
                alone = [(r.check.violation(), r.name) for r in own if r.criticality == level]
                names += [_names_array(alone)] if alone else []
            continue
        if not key:
            base = base.crossJoin(F.broadcast(frame))
            fused = [r for r in members if not isinstance(r.check, SqlQuery)]
            for r in fused:
                if isinstance(r.check, AggrLimit):
                    outcome_rows.append(frame.select(
                        F.lit(r.name).alias("rule_name"),
                        F.col(f"{_tag(r)}_v").cast("string").alias("observed"),
                        r.check.violated(_tag(r)).alias("dataset_violated")))
        else:
            cond = None
            for j, k in enumerate(key):
                c = F.col(k).eqNullSafe(F.col(f"{tag}_k{j}"))
                cond = c if cond is None else cond & c
            base = base.join(frame, cond, "left")
        helpers += list(frame.columns)
        for names, level, of_key in ((err_arrays, "error", f"{tag}_e"), (warn_arrays, "warn", f"{tag}_w")):
            named = F.coalesce(F.col(of_key), _empty())
            alone = [(r.check.violation() & ~F.array_contains(named, r.name), r.name) for r in own if r.criticality == level]
            names += [named, _names_array(alone)] if alone else [named]

    for fi, (r, (wstart, _, _), windows) in enumerate(zip(fresh, fresh_parts, window_frames)):
        col = f"__f{fi}"
        under, outcome = _window_outcome(windows, r.check)
        flagged = under.select(F.col("wstart").alias(f"{col}_w"), F.lit(True).alias(f"{col}_hit"))
        if r.check.lookback_windows <= gate.max_rows:
            flagged = F.broadcast(flagged)
        base = base.withColumn(f"{col}_w", wstart).join(flagged, f"{col}_w", "left")
        helpers += [f"{col}_w", f"{col}_hit"]
        named = F.when(F.coalesce(F.col(f"{col}_hit"), F.lit(False)), F.array(F.lit(r.name))).otherwise(_empty())
        (err_arrays if r.criticality == "error" else warn_arrays).append(named)
        outcome_rows.append(outcome.select(F.lit(r.name).alias("rule_name"), "observed", "dataset_violated"))

    # row rules, and the final two arrays in one projection
    row_rules = [r for r in rules if r.is_row_rule]
    err_arrays.insert(0, _names_array([(r.check.violation(), r.name) for r in row_rules if r.criticality == "error"]))
    warn_arrays.insert(0, _names_array([(r.check.violation(), r.name) for r in row_rules if r.criticality == "warn"]))
    errors = F.concat(*err_arrays) if len(err_arrays) > 1 else err_arrays[0]
    warnings = F.concat(*warn_arrays) if len(warn_arrays) > 1 else warn_arrays[0]
    n_rules = max(len(rules), 1)
    annotated = (base.withColumns({ERRORS: errors, WARNINGS: warnings})
                 .withColumn(SCORE, 1.0 - (F.size(ERRORS) + F.size(WARNINGS)) / F.lit(float(n_rules)))
                 .drop(*helpers))

    outcomes = df.sparkSession.createDataFrame([], "rule_name string, observed string, dataset_violated boolean")
    for o in outcome_rows:
        outcomes = outcomes.unionByName(o)
    return Checked(annotated, rules, outcomes, state=kept)


def _is_bad(quarantine_on: str) -> Column:
    if quarantine_on not in QUARANTINE_POLICIES:
        raise ValueError(f"quarantine_on must be one of {QUARANTINE_POLICIES}")
    bad = F.size(ERRORS) > 0
    return bad | (F.size(WARNINGS) > 0) if quarantine_on == "any" else bad


def verdict(quarantine_on: str = "error") -> Column:
    """Where an annotated row goes: ``valid`` or ``quarantine``."""
    return F.when(_is_bad(quarantine_on), QUARANTINED).otherwise(VALID)


def read_checked(spark: SparkSession, target: str, like: DataFrame | None = None) -> DataFrame:
    """The rows of a table that ``Checked.written`` made; ``like`` has its columns, which files without rows don't show."""
    if like is not None and sinks.is_path(target):
        return spark.read.schema(like.schema).parquet(target)
    return sinks.read_table(spark, target)


def stored_split(stored: DataFrame, quarantine_on: str = "error") -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of rows stored by verdict: each reads the files of its own partitions only."""
    unused = [ERRORS, VERDICT] + ([WARNINGS] if quarantine_on == "any" else [])
    return (stored.filter(F.col(VERDICT) == VALID).drop(*unused),
            stored.filter(F.col(VERDICT) == QUARANTINED).drop(VERDICT))


def split(annotated: DataFrame, quarantine_on: str = "error") -> tuple[DataFrame, DataFrame]:
    """Disjoint (valid, quarantine) filters of an annotated frame.

    ``quarantine_on="error"``: rows with any error-level violation are quarantined, warnings stay valid
    (and keep their ``_warnings``). ``"any"``: warnings are quarantined too.
    """
    bad = _is_bad(quarantine_on)
    valid = annotated.filter(~bad).drop(ERRORS)
    if quarantine_on == "any":
        valid = valid.drop(WARNINGS)
    return valid, annotated.filter(bad)


def apply_checks_and_split(df: DataFrame, rules: Iterable[Rule], quarantine_on: str = "error",
                           gate: Gate | None = None, materialize_as: str | None = "annotated"
                           ) -> tuple[DataFrame, DataFrame]:
    """Annotate once (materialised when a shared folder exists) and return (valid, quarantine)."""
    checked = annotate(df, rules, gate)
    if materialize_as:
        checked = checked.materialized(materialize_as)
    return split(checked.annotated, quarantine_on)
