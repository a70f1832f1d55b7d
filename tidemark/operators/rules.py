"""Declarative data-quality rules (Q1-Q9).

A rule is (name, criticality, check). Checks are plain frozen dataclasses; the engine
(``tidemark.operators.engine``) compiles a list of rules into a few Spark passes:

* row checks        -> one boolean ``Column`` each, all evaluated in one projection
* keyed checks      -> aggregate measures grouped by their key; every check sharing a key shares one
                       ``groupBy`` (partial aggregation map-side, so a hot key never reaches one task whole)
* global checks     -> one 1-row aggregate for all of them
* SQL-query checks  -> the user's query, reduced to one row per merge key
* freshness checks  -> per-window counts against a bounded spine of windows

Semantics where the rule text is open (decisions D3/D4 of the survey):

* a row violates ``is_in_range`` only when the value is present and outside the closed interval;
* ``is_unique``: every copy of a duplicated key violates; a key with any null part is exempt;
* grouped aggregate limits treat a null group as a group like any other;
* merge-key results: a key violates if any of its result rows has a true condition; keys match
  null-safely; input rows whose key is absent from the result do not violate.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.cleaners import NOT_FINITE

CRITICALITIES = ("error", "warn")
AGGR_TYPES = ("count", "sum", "avg", "min", "max", "count_distinct")


def _cols(columns) -> tuple[str, ...]:
    if columns is None:
        return ()
    if isinstance(columns, str):
        return (columns,)
    return tuple(columns)


# ---------------------------------------------------------------------------------------------------
# Checks
# ---------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    """Base class; ``function`` is the check's public name (used in logs)."""

    function = "check"

    def describe(self) -> dict:
        return {"function": self.function, "arguments": asdict(self)}


class RowCheck(Check):
    """A per-row predicate; ``violation`` is true exactly for violating rows (never null)."""

    def violation(self) -> Column:
        raise NotImplementedError


class KeyedCheck(Check):
    """A check evaluated on aggregates of the rows sharing a key (``keys == ()``: the whole table)."""

    @property
    def keys(self) -> tuple[str, ...]:
        raise NotImplementedError

    def measures(self, tag: str) -> list[Column]:
        """Aggregate expressions, each aliased with a name starting with ``tag``."""
        raise NotImplementedError

    def violated(self, tag: str) -> Column:
        """Boolean over the aggregated row (never null)."""
        raise NotImplementedError

    # mergeable form: rows -> partials at any finer key -> combined partials -> the measures
    mergeable = True

    def partials(self, tag: str) -> list[Column]:
        """Aggregates of rows that can be combined further."""
        return self.measures(tag)

    def combined(self, tag: str) -> list[Column]:
        """Aggregates of partials, named as they are."""
        raise NotImplementedError

    def finished(self, tag: str) -> list[Column]:
        """The measures as expressions over one row of combined partials."""
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(RowCheck):
    column: str
    function = "is_not_null"

    def violation(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class InRange(RowCheck):
    column: str
    min_limit: float | int | None = None
    max_limit: float | int | None = None
    function = "is_in_range"

    def violation(self) -> Column:
        c = F.col(self.column)
        inside = F.lit(True)
        if self.min_limit is not None:
            inside = inside & (c >= F.lit(self.min_limit))
        if self.max_limit is not None:
            inside = inside & (c <= F.lit(self.max_limit))
        return c.isNotNull() & (~inside | c.cast("string").isin(*NOT_FINITE))


@dataclass(frozen=True)
class Condition(Check):
    """A SQL boolean expression that marks a violation when true.

    Without ``merge_columns`` it is a row check. With them it has the semantics of a row-shaped
    ``SELECT merge_columns, CASE WHEN condition THEN true ELSE false END FROM input WHERE where`` merged
    back on the key: every row of a key violates when any row of that key (passing ``where``) does.
    """

    condition: str
    merge_columns: tuple[str, ...] = ()
    where: str | None = None
    function = "sql_condition"

    def _hit(self) -> Column:
        hit = F.expr(self.condition)
        if self.where:
            hit = F.expr(self.where) & hit
        return F.coalesce(hit, F.lit(False))

    # row form
    def violation(self) -> Column:
        return self._hit()

    # keyed form
    @property
    def keys(self) -> tuple[str, ...]:
        return self.merge_columns

    def measures(self, tag: str) -> list[Column]:
        return [F.bool_or(self._hit()).alias(f"{tag}_any")]

    def violated(self, tag: str) -> Column:
        return F.coalesce(F.col(f"{tag}_any"), F.lit(False))

    mergeable = True

    def partials(self, tag: str) -> list[Column]:
        return self.measures(tag)

    def combined(self, tag: str) -> list[Column]:
        return [F.bool_or(f"{tag}_any").alias(f"{tag}_any")]

    def finished(self, tag: str) -> list[Column]:
        return [F.col(f"{tag}_any")]

    @property
    def is_row_check(self) -> bool:
        return not self.merge_columns


@dataclass(frozen=True)
class Unique(KeyedCheck):
    columns: tuple[str, ...]
    function = "is_unique"

    @property
    def keys(self) -> tuple[str, ...]:
        return self.columns

    def measures(self, tag: str) -> list[Column]:
        return [F.count(F.lit(1)).alias(f"{tag}_n")]

    def violated(self, tag: str) -> Column:
        complete = F.lit(True)
        for c in self.columns:
            complete = complete & F.col(c).isNotNull()
        return complete & (F.col(f"{tag}_n") > 1)

    def combined(self, tag: str) -> list[Column]:
        return [F.sum(f"{tag}_n").alias(f"{tag}_n")]

    def finished(self, tag: str) -> list[Column]:
        return [F.col(f"{tag}_n")]


@dataclass(frozen=True)
class AggrLimit(KeyedCheck):
    """``aggr_type(column)`` per ``group_by`` group (or over the table) compared with ``limit``.

    ``bound="max"``: violation when the aggregate is greater than the limit (is_aggr_not_greater_than);
    ``bound="min"``: violation when it is less (is_aggr_not_less_than). A null aggregate does not violate.
    """

    column: str
    aggr_type: str
    limit: float | int
    group_by: tuple[str, ...] = ()
    bound: str = "max"

    @property
    def function(self) -> str:  # type: ignore[override]
        return "is_aggr_not_greater_than" if self.bound == "max" else "is_aggr_not_less_than"

    def __post_init__(self):
        if self.aggr_type not in AGGR_TYPES:
            raise ValueError(f"aggr_type must be one of {AGGR_TYPES}, got {self.aggr_type!r}")
        if self.bound not in ("max", "min"):
            raise ValueError("bound must be 'max' or 'min'")

    @property
    def keys(self) -> tuple[str, ...]:
        return self.group_by

    def _aggregate(self) -> Column:
        target = F.lit(1) if self.column == "*" else F.col(self.column)
        if self.aggr_type == "count":
            return F.count(target)
        if self.aggr_type == "count_distinct":
            return F.count_distinct(target)
        return {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[self.aggr_type](target)

    def measures(self, tag: str) -> list[Column]:
        return [self._aggregate().alias(f"{tag}_v")]

    def violated(self, tag: str) -> Column:
        v = F.col(f"{tag}_v")
        breach = v > F.lit(self.limit) if self.bound == "max" else v < F.lit(self.limit)
        return F.coalesce(breach, F.lit(False))

    @property
    def mergeable(self) -> bool:  # type: ignore[override]
        return self.aggr_type != "count_distinct"

    def partials(self, tag: str) -> list[Column]:
        if self.aggr_type == "avg":
            return [F.sum(self.column).alias(f"{tag}_s"), F.count(self.column).alias(f"{tag}_c")]
        return self.measures(tag)

    def combined(self, tag: str) -> list[Column]:
        if self.aggr_type == "avg":
            return [F.sum(f"{tag}_s").alias(f"{tag}_s"), F.sum(f"{tag}_c").alias(f"{tag}_c")]
        if self.aggr_type == "count":  # over no row at all: 0, not null
            return [F.coalesce(F.sum(f"{tag}_v"), F.lit(0).cast("long")).alias(f"{tag}_v")]
        return [{"sum": F.sum, "min": F.min, "max": F.max}[self.aggr_type](f"{tag}_v").alias(f"{tag}_v")]

    def finished(self, tag: str) -> list[Column]:
        if self.aggr_type == "avg":
            return [F.try_divide(F.col(f"{tag}_s"), F.col(f"{tag}_c")).alias(f"{tag}_v")]
        return [F.col(f"{tag}_v")]

    def describe(self) -> dict:
        return {"function": self.function, "arguments": asdict(self)}


@dataclass(frozen=True)
class SqlQuery(Check):
    """A user SQL query over the input, referenced as ``{{ input_placeholder }}``.

    The result must hold ``merge_columns`` and a boolean ``condition_column`` (true = violation).
    """

    query: str
    merge_columns: tuple[str, ...]
    condition_column: str = "condition"
    input_placeholder: str = "input_view"
    function = "sql_query"


@dataclass(frozen=True)
class Freshness(Check):
    """At least ``min_records_per_window`` rows in each of the last ``lookback_windows`` tumbling windows.

    Windows are ``window_minutes`` long, aligned like Spark's ``window()``. The lookback ends at the
    window boundary at or before ``curr_timestamp`` if given, else at the end of the last window holding
    data. Rows of an under-filled window violate; windows with no row at all are reported in the
    dataset-level outcome.
    """

    column: str
    window_minutes: int
    min_records_per_window: int
    lookback_windows: int
    curr_timestamp: str | None = None
    function = "is_data_fresh_per_time_window"


# ---------------------------------------------------------------------------------------------------
# Rules
# ---------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    name: str
    criticality: str
    check: Check
    metadata: dict = field(default_factory=dict, compare=False, hash=False)

    def __post_init__(self):
        if self.criticality not in CRITICALITIES:
            raise ValueError(f"criticality must be one of {CRITICALITIES}, got {self.criticality!r}")

    @property
    def is_row_rule(self) -> bool:
        return isinstance(self.check, RowCheck) or (isinstance(self.check, Condition) and self.check.is_row_check)

    def definition(self) -> str:
        """Stable JSON text of the rule, for logs."""
        body = {"name": self.name, "criticality": self.criticality, "check": self.check.describe()}
        return json.dumps(body, sort_keys=True, default=str)


def rule(name: str, criticality: str, check: Check, **metadata) -> Rule:
    return Rule(name, criticality, check, metadata)


# ---------------------------------------------------------------------------------------------------
# Check constructors under their public names
# ---------------------------------------------------------------------------------------------------

def is_not_null(column: str) -> NotNull:
    return NotNull(column)


def is_in_range(column: str, min_limit=None, max_limit=None) -> InRange:
    return InRange(column, min_limit, max_limit)


def is_unique(columns) -> Unique:
    return Unique(_cols(columns))


def is_aggr_not_greater_than(column: str, aggr_type: str = "count", limit=0, group_by=None) -> AggrLimit:
    return AggrLimit(column, aggr_type, limit, _cols(group_by), "max")


def is_aggr_not_less_than(column: str, aggr_type: str = "count", limit=0, group_by=None) -> AggrLimit:
    return AggrLimit(column, aggr_type, limit, _cols(group_by), "min")


def sql_query(query: str, merge_columns, condition_column: str = "condition",
              input_placeholder: str = "input_view") -> SqlQuery:
    return SqlQuery(query, _cols(merge_columns), condition_column, input_placeholder)


def sql_condition(condition: str, merge_columns=None, where: str | None = None) -> Condition:
    return Condition(condition, _cols(merge_columns), where)


def is_data_fresh_per_time_window(column: str, window_minutes: int, min_records_per_window: int,
                                  lookback_windows: int, curr_timestamp: str | None = None) -> Freshness:
    return Freshness(column, window_minutes, min_records_per_window, lookback_windows, curr_timestamp)
