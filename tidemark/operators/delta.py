"""Row digests and complete-state reconciliation of a serving copy with its source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, IntegralType, TimestampType

from tidemark.functions.columns import canonical_number


def _cell(df: DataFrame, name: str) -> Column:
    """A cell as text that no other cell has: name, type, length and value; null is N, and so has neither length nor value."""
    kind, value = df.schema[name].dataType, F.col(name).cast("string")
    if isinstance(kind, TimestampType):
        tag, value = "T", F.unix_micros(name).cast("string")  # the same in every session's time zone
    elif isinstance(kind, DoubleType | FloatType):
        tag, value = "F", F.nullif(canonical_number(F.col(name).cast("double")), F.lit("N"))
    else:
        tag = "I" if isinstance(kind, IntegralType) else "D" if isinstance(kind, DateType) else "S"
    framed = F.concat(F.lit(tag), F.length(value).cast("string"), F.lit(":"), value)
    return F.concat(F.lit(f"{len(name)}:{name}"), F.coalesce(framed, F.lit("N")))


def row_digest(df: DataFrame, key: list[str], numbers: list[str]) -> DataFrame:
    """``key`` and row_sha256 of the named, typed and framed cells; negative zero is zero, non-finite values raise."""
    return df.select(*key, F.sha2(F.concat(*[_cell(df, c) for c in [*key, *numbers]]), 256).alias("row_sha256"))


class StateMissing(ValueError):
    """A serving copy has digests, but no state that says of which build they are."""


def _same_key(a: str, b: str, key: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in key])


def delta_plan(source: DataFrame, target: DataFrame, key: list[str], state: DataFrame | None = None) -> DataFrame:
    """``key`` and change_type (insert, update, delete, unchanged) between two digest tables; an omission is a deletion.

    ``state``, if given, is the copy's table of states: where it is empty and ``target`` isn't, that raises StateMissing.
    """
    if state is not None and state.isEmpty() and not target.isEmpty():
        raise StateMissing("digests without a state")
    old = target.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("row_sha256").alias("_old"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    joined = source.select(*key, F.col("row_sha256").alias("_new")).join(old, same, "full_outer")
    kind = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").when(F.col("_new") == F.col("_old"), "unchanged").otherwise("update")
    return joined.select(*[F.when(F.col("_new").isNull(), F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in key], kind.alias("change_type"))


def apply_delta(target: DataFrame, source: DataFrame, plan: DataFrame, key: list[str]) -> DataFrame:
    """``target`` after the plan. Null keys are equal to each other, as in the plan."""
    touched = plan.where("change_type <> 'unchanged'").select(*key).alias("plan")
    added = plan.where("change_type in ('insert', 'update')").select(*key).alias("plan")
    kept = target.alias("rows").join(touched, _same_key("rows", "plan", key), "left_anti")
    return kept.unionByName(source.alias("rows").join(added, _same_key("rows", "plan", key), "left_semi"))


def digest_mismatches(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose digests differ or that one side lacks; empty when both are the same."""
    return delta_plan(a, b, key).where("change_type <> 'unchanged'")


def target_summary(df: DataFrame, key: str, numbers: list[str]) -> DataFrame:
    """Rows, and first and last key, of rows with any payload."""
    return df.where(F.coalesce(*numbers).isNotNull()).agg(F.count("*").alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def input_signature(df: DataFrame, by: str, day: str, numbers: list[str]) -> DataFrame:
    """Rows, first and last day and a SHA-256 of the sorted row digests, for each series. Rows of a series are a history of days."""
    digests = row_digest(df, [by, day], numbers)
    ordered = F.array_sort(F.collect_list(F.concat_ws(":", F.col(day).cast("string"), "row_sha256")))
    return digests.groupBy(by).agg(F.count("*").alias("n_rows"), F.min(day).alias("first_date"), F.max(day).alias("last_date"), F.sha2(F.array_join(ordered, ","), 256).alias("signature"))


def feature_count_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Features whose row counts differ between two long tables."""
    a = expected.groupBy("feature").agg(F.count("*").alias("expected"))
    b = actual.groupBy("feature").agg(F.count("*").alias("actual"))
    return a.join(b, "feature", "full_outer").where(~F.col("expected").eqNullSafe(F.col("actual")))


def population_report(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: rows, features and non-finite values of both long tables, and how many features differ in count."""

    def side(df: DataFrame, name: str) -> DataFrame:
        bad = F.isnan("value") | (F.abs("value") == float("inf"))
        return df.agg(F.count("*").alias(f"{name}_rows"), F.count_distinct("feature").alias(f"{name}_features"), F.count_if(bad).alias(f"{name}_not_finite"))

    # three relations of one row each
    different = feature_count_diff(expected, actual).agg(F.count("*").alias("n_different"))
    return side(expected, "expected").crossJoin(side(actual, "actual")).crossJoin(different)
