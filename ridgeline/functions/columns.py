"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Width of one time bucket where the caller names none, by type of the time
# column: days for dates, seconds for timestamps, units for numbers.
DATE_WIDTH = 128
TIMESTAMP_WIDTH = 86_400
NUMBER_WIDTH = 1_024
MICROS = 1_000_000


def names(cols: str | Iterable[str]) -> list[str]:
    """One name or several, as a list."""
    return [cols] if isinstance(cols, str) else list(cols)


def missing(df: DataFrame, name: str) -> Column:
    """True where the value is NULL, or NaN in a floating-point column."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def time_place(df: DataFrame, t: str) -> Column:
    """Position of ``t``: days of a date, microseconds of a timestamp, the value of a number."""
    kind = df.schema[t].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(t).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(t)
    if isinstance(kind, T.TimestampNTZType):
        # Wall-clock time; a cast to an instant would jump where the session's zone does.
        day = F.unix_date(F.to_date(t)).cast("long") * 86_400
        second = F.date_part(F.lit("SECOND"), F.col(t)) * MICROS
        return (day + F.hour(t) * 3_600 + F.minute(t) * 60) * MICROS + second.cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(t).cast("long")
    if isinstance(kind, T.NumericType):
        return F.col(t).cast("double")
    raise TypeError(f"{t}: a series needs a date, timestamp or number to order by, not {kind}")


def time_width(df: DataFrame, t: str, width: float | None) -> float:
    """A width in days, seconds or units, or the type's default, in units of ``time_place``."""
    kind = df.schema[t].dataType
    if isinstance(kind, T.DateType):
        return width or DATE_WIDTH
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return (width or TIMESTAMP_WIDTH) * MICROS
    return width or NUMBER_WIDTH


def cell_start(place: Column, width: Column, whole: bool) -> Column:
    """Where the fixed-width cell that holds ``place`` begins."""
    if whole:
        return place - F.pmod(place, width.cast("long"))
    return F.floor(place / width) * width


def value_bucket(x: Column, per_octave: int = 65_536) -> Column:
    """Monotone whole number of a double: ``a <= b`` gives ``bucket(a) <= bucket(b)``.

    Buckets are of equal relative width, so a narrow range of large values is
    split as finely as a wide one, and outliers do not crowd the rest together.
    """
    size = F.floor((F.log2(F.abs(x)) + 1_075) * per_octave)
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0)).cast("long")


# Distinct values that one task looks at one by one.
CELL_VALUES = 32_768


def cell_bounds(x: str) -> list[Column]:
    """Aggregates of a bucket for ``cell_in``: its range, and into how many cells it is cut."""
    return [F.min(x).alias("_low"), F.max(x).alias("_high"), F.ceil(F.count(x) / CELL_VALUES).alias("_cells")]


def cell_in(x: Column) -> Column:
    """Number of the equal slice of its bucket's range that holds a value; rises with the value."""
    share = F.try_divide(x - F.col("_low"), F.col("_high") - F.col("_low"))
    return F.coalesce(F.least(F.floor(share * F.col("_cells")), F.col("_cells") - 1), F.lit(0).cast("long"))


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both are present (neither NULL nor NaN); NULL where undefined."""
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    left, right = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(left, right), F.stddev_samp(left) * F.stddev_samp(right))
