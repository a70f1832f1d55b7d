"""Column-level cleaners (P1-P10). Each maps ``Column -> Column`` with built-in expressions only, so a
whole table's cleaning collapses into one projection inside whole-stage codegen.

Null handling follows Spark's: every function here is null-in, null-out unless it names a default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: ColumnOrName) -> Column:
    """Strip leading/trailing spaces; null stays null, '' stays ''."""
    return F.trim(_c(c))


def standard_email(c: ColumnOrName) -> Column:
    """Trim + lower-case."""
    return F.lower(F.trim(_c(c)))


def phone_digits(c: ColumnOrName) -> Column:
    """Keep only digits and '+'."""
    return F.regexp_replace(_c(c), r"[^\d+]", "")


#: how Spark writes the floating-point values that are no numbers
NOT_FINITE = ("NaN", "Infinity", "-Infinity")


def in_range_or_null(c: ColumnOrName, min_val=None, max_val=None, dtype: DataType | None = None) -> Column:
    """The value if inside the closed interval [min_val, max_val] (either bound optional), else null.

    On a string column (``dtype`` a StringType) the comparison is made on ``try_cast(c AS bigint)`` and the
    original string is returned; a non-numeric string is out of range (null), never an error. NaN and
    infinities are out of every range.
    """
    col = _c(c)
    probe = col.try_cast("bigint") if isinstance(dtype, StringType) else col
    cond = probe.isNotNull() & ~probe.cast("string").isin(*NOT_FINITE)
    if min_val is not None:
        cond = cond & (probe >= F.lit(min_val))
    if max_val is not None:
        cond = cond & (probe <= F.lit(max_val))
    return F.when(cond, col)


def title_or_default(c: ColumnOrName, default: str = "Unknown") -> Column:
    """P5: null -> ``default``, else title case (first letter of each word upper, rest lower; no trim)."""
    return F.coalesce(F.initcap(_c(c)), F.lit(default))


def default_if_null(c: ColumnOrName, value) -> Column:
    """Replace null by a literal."""
    return F.coalesce(_c(c), F.lit(value))


def trimmed_or_default(c: ColumnOrName, default: str = "None") -> Column:
    """Null -> ``default`` (the literal text), else trimmed."""
    return F.coalesce(F.trim(_c(c)), F.lit(default))


def as_timestamp(c: ColumnOrName, dtype: DataType | None = None) -> Column:
    """A timestamp; identity on timestamp columns (either flavour), parsed otherwise."""
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return _c(c)
    return F.to_timestamp(_c(c))


def as_date(c: ColumnOrName, dtype: DataType | None = None) -> Column:
    """A date; identity on date columns, parsed otherwise."""
    if isinstance(dtype, DateType):
        return _c(c)
    return F.to_date(_c(c))


def round2(c: ColumnOrName) -> Column:
    """Round half-up to 2 decimals; null passes through."""
    return F.round(_c(c), 2)
