"""Diffs, merges, wide and long forms, and quality counts of keyed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import finite, utc_date, utc_midnight


class DuplicateKeys(ValueError):
    """A table has several rows of one key."""


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def require_unique(df: DataFrame, key: list[str]) -> DataFrame:
    if not duplicate_keys(df, key).isEmpty():
        raise DuplicateKeys(f"several rows of one ({', '.join(key)})")
    return df


def _same(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in columns], F.lit(True))


def frame_diff(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``new`` with change_type: insert, unchanged or revision, by null-safe equality of payloads.

    Rows of ``old`` alone are ignored: an omission is no deletion. Null keys are equal to each other. Several rows of one
    key, in either table, raise DuplicateKeys.
    """
    if old.dtypes != new.dtypes:
        raise ValueError("the tables differ in columns or types")
    payload = [c for c in new.columns if c not in key]
    there = require_unique(old, key).withColumn("_there", F.lit(True)).alias("old")
    joined = require_unique(new, key).alias("new").join(there, [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in key], "left")
    kind = F.when(F.col("old._there").isNull(), "insert").when(_same(payload), "unchanged").otherwise("revision")
    return joined.select(*[F.col(f"new.{c}") for c in new.columns], kind.alias("change_type"))


def merge_upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of their keys, and added. Null keys are equal; several rows of one key raise DuplicateKeys."""
    same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in key]
    return require_unique(old, key).alias("old").join(require_unique(new, key).select(*key).alias("new"), same, "left_anti").unionByName(new)


def stable_audit(old: DataFrame, new: DataFrame, key: list[str], audit: str) -> DataFrame:
    """``new``, with the old ``audit`` value where all else is equal, so that fetching again changes nothing.

    Null keys are equal to each other; several rows of one key, in either table, raise DuplicateKeys.
    """
    payload = [c for c in new.columns if c not in key and c != audit]
    there = require_unique(old, key).withColumn("_there", F.lit(True)).alias("old")
    joined = require_unique(new, key).alias("new").join(there, [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in key], "left")
    value = F.when(F.col("old._there") & _same(payload), F.col(f"old.{audit}")).otherwise(F.col(f"new.{audit}"))
    return joined.select(*[value.alias(c) if c == audit else F.col(f"new.{c}") for c in new.columns])


def changed_months(diff: DataFrame, day: str = "observation_date", by: tuple[str, ...] = ("series_id",)) -> DataFrame:
    """The months that a diff makes it necessary to write again."""
    return diff.where("change_type <> 'unchanged'").select(*by, F.year(day).alias("year"), F.month(day).alias("month")).distinct()


def serving_upsert(target: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """``target`` after ``changes``: a row all of whose other columns are null deletes its key."""
    payload = [c for c in changes.columns if c not in key]
    keep = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in payload])
    return merge_upsert(target, changes, key).where(keep)


def gold_wide(bars: DataFrame, ids: list[str], ohlc_ids: list[str]) -> DataFrame:
    """One row a date: a level for each of ``ids`` and the bar of each of ``ohlc_ids``; absent cells are null.

    The pivot is one aggregation with a fixed list of values, instead of a chain of outer joins.
    """
    cells = [F.max(F.when(F.col("series_id") == s, F.col("level"))).alias(f"{s}_level") for s in ids]
    cells += [F.max(F.when(F.col("series_id") == s, F.col(x))).alias(f"{s}_{x}") for s in ohlc_ids for x in ("open", "high", "low", "close")]
    return bars.groupBy("observation_date").agg(*cells)


def gold_outer_chain(bars: DataFrame, ids: list[str], ohlc_ids: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """The cells of gold_wide by full outer joins with coalesced keys. A date that only other series have is absent."""
    cells = {s: ["level", *(("open", "high", "low", "close") if s in ohlc_ids else ())] for s in ids}
    parts = [bars.where(F.col("series_id") == s).select("observation_date", *[F.col(x).alias(f"{s}_{x}") for x in xs]) for s, xs in cells.items()]
    order = [f"{s}_level" for s in ids] + [f"{s}_{x}" for s in ids if s in ohlc_ids for x in ("open", "high", "low", "close")]
    return reduce(lambda a, b: a.join(b, "observation_date", "full_outer"), parts).select("observation_date", *order)


def long_form(wide: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, feature, value) of every finite value; booleans as 1.0 and 0.0."""
    # one array a row, exploded: an unpivot of ninety columns would be ninety projections of the whole row
    row = wide.select(*keys, F.posexplode(F.array(*[F.col(v).cast("double") for v in values])).alias("_at", "value"))
    names = F.array(*[F.lit(v) for v in values])
    return row.where(finite("value")).select(*keys, F.element_at(names, F.col("_at") + 1).alias("feature"), "value")


def silver_canonical(bronze: DataFrame, units: DataFrame) -> DataFrame:
    """The fixed long form of observations: value is a bar's close; scalar series have null bars; the unit is the registry's."""
    rows = bronze.join(F.broadcast(units), "series_id")  # one row for each registered series
    value = F.when(F.col("native_shape") == "ohlc", F.col("close")).otherwise(F.col("value"))
    bar = [F.when(F.col("native_shape") == "ohlc", F.col(c)).alias(c) for c in ("open", "high", "low", "close")]
    return rows.select("observation_date", "series_id", value.alias("value"), *bar, "unit", "provider", "source_id", "fetched_at_utc")


def quality_counts(df: DataFrame, key: list[str], numbers: list[str]) -> DataFrame:
    """One row: rows, distinct keys, null keys, and nulls and non-finite values of each number."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    out = [F.count("*").alias("n_rows"), F.count_distinct(F.struct(*key)).alias("n_keys"), F.count_if(null_key).alias("n_null_keys")]
    for c in numbers:
        out += [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"), F.count_if(F.col(c).isNotNull() & ~finite(c)).alias(f"{c}_not_finite")]
    return df.agg(*out)


def inventory(bars: DataFrame, by: str = "series_id", day: str = "observation_date") -> DataFrame:
    """First and last day, rows, and rows of duplicated keys (each row of such a key counts) for each series."""
    keyed = bars.groupBy(by, day).agg(F.count("*").alias("n"))
    return keyed.groupBy(by).agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"), F.sum("n").alias("n_rows"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("n_duplicates"))


def feature_profile(long: DataFrame, total: DataFrame) -> DataFrame:
    """Coverage, as a share of the one row of ``total``, mean, least and most of each feature."""
    found = long.groupBy("feature").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("least"), F.max("value").alias("most"))
    return found.crossJoin(F.broadcast(total)).select("feature", (F.col("n") / F.col("total")).alias("coverage"), "mean", "least", "most")


def feature_histogram(long: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """(``feature``, bin, n_bins, from_value, to_value, n): how the finite values of each feature are spread.

    min(30, max(5, floor(sqrt(n)))) bins of equal width reach from a feature's least value to its highest, which is in the last
    bin; where all are equal, they reach half a unit to either side. Two passes: the bounds, a row for each feature, are
    broadcast, so values are only summed up by feature and bin. Empty bins have no row.
    """
    rows = long.where(finite(value)).select(feature, F.col(value).cast("double").alias("_v"))
    bounds = rows.groupBy(feature).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_n"))
    same = F.col("_lo") == F.col("_hi")
    bins = F.least(F.lit(30), F.greatest(F.lit(5), F.floor(F.sqrt("_n")).cast("int")))
    bounds = bounds.select(feature, F.when(same, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"), F.when(same, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"), bins.alias("n_bins"))
    at = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.col("n_bins")).cast("int"), F.col("n_bins") - 1)
    counted = rows.join(F.broadcast(bounds), feature).groupBy(feature, at.alias("bin"), "n_bins", "_lo", "_hi").agg(F.count("*").alias("n"))  # a row of bounds for each feature
    edge = lambda i: F.col("_lo") + (F.col("_hi") - F.col("_lo")) * i / F.col("n_bins")
    return counted.select(feature, "bin", "n_bins", edge(F.col("bin")).alias("from_value"), edge(F.col("bin") + 1).alias("to_value"), "n")


def conformance_report(long: DataFrame, known: list[str]) -> DataFrame:
    """(check, violations) over a long table (series_id, observation_date, available_at_utc, feature, value)."""
    checks = {
        "null_key": F.col("series_id").isNull() | F.col("observation_date").isNull() | F.col("feature").isNull(),
        "not_finite": ~F.coalesce(finite("value"), F.lit(False)),
        "unknown_feature": ~F.col("feature").isin(known),
        "available_too_early": F.col("available_at_utc") <= utc_midnight("observation_date"),
        "available_on_weekend": F.weekday(utc_date(F.unix_seconds("available_at_utc"))) >= 5,
    }
    counted = long.agg(*[F.count_if(bad).alias(name) for name, bad in checks.items()])
    doubled = long.groupBy("series_id", "observation_date", "feature").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("violations"))
    return counted.unpivot([], list(checks), "check", "violations").unionByName(doubled.select(F.lit("duplicate_key").alias("check"), "violations"))
