"""Guarded scalar expressions and causal windows over (series_id, observation_date).

All frames end at the current row or before it. Divisions and logarithms are guarded first, so that ANSI mode never
raises and no engine's treatment of zero or negative operands shows.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ordered(*more: Column | str) -> WindowSpec:
    """Rows of a series by date; with ``more``, only those that agree in it too, which makes windows over valid rows alone."""
    return Window.partitionBy("series_id", *more).orderBy("observation_date")


def trailing(n: int, *more: Column | str) -> WindowSpec:
    """The last ``n`` rows, this one included."""
    return ordered(*more).rowsBetween(-(n - 1), 0)


def finite(x: Column | str) -> Column:
    x = col(x)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def positive(*xs: Column | str) -> Column:
    out = F.lit(True)
    for x in xs:
        out = out & (col(x) > 0)
    return out


def ratio(x: Column | str, y: Column | str) -> Column:
    """x / y, null where y is 0 or null."""
    return F.try_divide(col(x), col(y))


def log_ratio(x: Column | str, y: Column | str) -> Column:
    """ln(x / y) where both are positive and the quotient doesn't underflow."""
    quotient = F.when(positive(x, y), ratio(x, y))
    return F.when(quotient > 0, F.ln(quotient))


def when_complete(x: Column | str, n: int, value: Column, *more: Column | str) -> Column:
    """``value`` where all of the last ``n`` rows have ``x``."""
    return F.when(F.count(col(x)).over(trailing(n, *more)) == n, value)


def correlation(x: Column | str, y: Column | str, window: WindowSpec) -> Column:
    """Pearson's correlation, null instead of an error where a deviation is 0."""
    return F.try_divide(F.covar_pop(col(x), col(y)).over(window), F.stddev_pop(col(x)).over(window) * F.stddev_pop(col(y)).over(window))


def sample_zscore(x: Column | str, n: int, *more: Column | str) -> Column:
    """(x - mean) / sample deviation over the last ``n`` rows with ``x``, null where the deviation is 0."""
    window = trailing(n, *more)
    return when_complete(x, n, F.try_divide(col(x) - F.avg(col(x)).over(window), F.stddev_samp(col(x)).over(window)), *more)


def nan_to_null(x: Column | str) -> Column:
    return F.when(~F.isnan(col(x)), col(x))


def utc_midnight(day: Column | str) -> Column:
    """The first moment of ``day`` in UTC, whatever the session's time zone is."""
    return F.timestamp_micros(F.unix_date(col(day)).cast("long") * 86_400_000_000)


def utc_date(seconds: Column | str) -> Column:
    """The day in UTC of ``seconds`` since the epoch, whatever the session's time zone is."""
    return F.date_from_unix_date(F.floor(col(seconds) / 86_400).cast("int"))


def next_weekday(day: Column | str) -> Column:
    """The next Monday to Friday after ``day``, at midnight UTC: when a day's observation is first available."""
    iso = F.weekday(col(day)) + 1
    step = F.when(iso == 5, 3).when(iso == 6, 2).otherwise(1)
    return utc_midnight(F.date_add(col(day), step))


def canonical_number(x: Column | str) -> Column:
    """A double as text for digests: null apart, -0.0 as 0.0; NaN and infinities are errors."""
    x = col(x)
    good = F.assert_true(x.isNull() | finite(x), F.lit("non-finite value in a digest"))
    text = F.when(x.isNull(), "N").otherwise(F.concat(F.lit("F"), F.when(x == 0, F.lit("0.0")).otherwise(x.cast("string"))))
    return F.coalesce(good.cast("string"), text)
