"""Verification of published tables: values within a tolerance, schemas, availability, and agreement of a serving copy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import finite, next_weekday

# How far a published value may be from a recomputed one.
ABSOLUTE, RELATIVE = 1e-12, 1e-10


def compared_values(expected: DataFrame, actual: DataFrame, key: list[str], value: str = "value") -> DataFrame:
    """``key``, expected, actual (of a value each side has), n_expected, n_actual: a row for each key of either long table.

    This is a null-safe full outer join by one aggregation: both tables are dealt out by key once, summed up beforehand, and
    a key that is repeated on a side is counted there instead of multiplying rows. Of a repeated key the values farthest
    apart are compared.
    """
    mine = expected.select(*key, F.col(value).cast("double").alias("_e"), F.lit(None).cast("double").alias("_a"), F.lit(1).alias("_side"))
    theirs = actual.select(*key, F.lit(None).cast("double").alias("_e"), F.col(value).cast("double").alias("_a"), F.lit(0).alias("_side"))
    found = mine.unionByName(theirs).groupBy(*key).agg(
        F.min("_e").alias("_e0"), F.max("_e").alias("_e1"), F.min("_a").alias("_a0"), F.max("_a").alias("_a1"), F.sum("_side").alias("n_expected"), F.count_if(F.col("_side") == 0).alias("n_actual")
    )
    high = F.abs(F.col("_e1") - F.col("_a0")) >= F.abs(F.col("_a1") - F.col("_e0"))
    pick = lambda a, b: F.when(F.coalesce(high, F.lit(True)), F.col(a)).otherwise(F.col(b))
    return found.select(*key, pick("_e1", "_e0").alias("expected"), pick("_a0", "_a1").alias("actual"), "n_expected", "n_actual")


def reconcile_values(expected: DataFrame, actual: DataFrame, groups: DataFrame, key: list[str], feature: str = "feature_name", absolute: float = ABSOLUTE, relative: float = RELATIVE) -> DataFrame:
    """A row for each group of features: how the published long table ``actual`` differs from the recomputed ``expected``.

    ``groups`` (feature, family) names the group of each feature and is of a catalog's size; features that it lacks are of the
    group null. Counted are rows of both tables, keys missing in ``actual``, surplus in it, repeated on either side, and those
    whose values differ by more than absolute + relative * |actual|; null, NaN and infinite values agree with themselves only. Also the
    largest difference of finite values, and the features whose number of rows differs.
    """
    e, a = F.col("expected"), F.col("actual")
    both = (F.col("n_expected") > 0) & (F.col("n_actual") > 0)
    gap = F.when(finite(e) & finite(a), F.abs(e - a))
    near = F.coalesce(gap <= absolute + relative * F.abs(a), e.eqNullSafe(a))
    rows = compared_values(expected, actual, key).withColumn("_gap", F.when(both, gap))
    flags = {
        "n_missing": (F.col("n_expected") > 0) & (F.col("n_actual") == 0),
        "n_surplus": (F.col("n_expected") == 0) & (F.col("n_actual") > 0),
        "n_repeated": (F.col("n_expected") > 1) | (F.col("n_actual") > 1),
        "n_different": both & ~near,
    }
    by_feature = rows.groupBy(feature).agg(F.sum("n_expected").alias("expected_rows"), F.sum("n_actual").alias("actual_rows"), *[F.count_if(x).alias(n) for n, x in flags.items()], F.max("_gap").alias("largest_error"))
    named = by_feature.join(F.broadcast(groups.select(feature, "family")), feature, "left")  # a row for each feature on both sides
    sums = [F.sum(c).alias(c) for c in ("expected_rows", "actual_rows", *flags)]
    return named.groupBy("family").agg(*sums, F.count_if(F.col("expected_rows") != F.col("actual_rows")).alias("n_features_off"), F.max("largest_error").alias("largest_error"))


def schema_table(spark, schema: StructType, table: str) -> DataFrame:
    """(table, position, column, type): a schema as rows."""
    return spark.createDataFrame([(table, i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)], "table string, position int, column string, type string")


def schema_differences(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """(table, column, difference, declared, actual) for every column of two tables of schemas that isn't the same in both.

    A column may be missing or surplus, or differ in type and in position.
    """
    d = declared.select("table", "column", F.struct("position", "type").alias("d"))
    a = actual.select("table", "column", F.struct("position", "type").alias("a"))
    both = d.join(a, ["table", "column"], "full_outer")
    kinds = {
        "missing": (F.col("a").isNull(), F.col("d.type"), F.lit(None).cast("string")),
        "surplus": (F.col("d").isNull(), F.lit(None).cast("string"), F.col("a.type")),
        "type": (F.col("d.type") != F.col("a.type"), F.col("d.type"), F.col("a.type")),
        "position": (F.col("d.position") != F.col("a.position"), F.col("d.position").cast("string"), F.col("a.position").cast("string")),
    }
    found = F.array(*[F.when(x, F.struct(F.lit(k).alias("difference"), w.alias("declared"), v.alias("actual"))) for k, (x, w, v) in kinds.items()])
    return both.select("table", "column", F.explode(F.array_compact(found)).alias("f")).select("table", "column", "f.*")


def availability_differences(rows: DataFrame, day: str = "observation_date", available: str = "available_at_utc") -> DataFrame:
    """(``day``, difference, n_rows, least, most): days with rows that aren't available when they should be, at midnight UTC of the next weekday.

    A row may be without availability, too early, too late, or on the right day at another time.
    """
    due, when = next_weekday(day), F.col(available)
    late = F.unix_micros(when) - F.unix_micros(due)
    kind = F.when(when.isNull() | F.col(day).isNull(), "absent").when(late < 0, "early").when(late >= 86_400_000_000, "late").when(late > 0, "time")
    return rows.withColumn("difference", kind).where("difference is not null").groupBy(day, "difference").agg(F.count("*").alias("n_rows"), F.min(available).alias("least"), F.max(available).alias("most"))


def agreement_report(source: DataFrame, index: DataFrame, consumer: DataFrame, state: DataFrame, key: str, build: dict[str, object]) -> DataFrame:
    """(check, violations) of a serving copy: its digest index and re-hashed rows against the source's digests, its summary and state against the build's.

    ``source``, ``index`` and ``consumer`` are digest tables (``key``, row_sha256), ``state`` has one row with the names of
    ``build`` as columns; n_rows, first_key and last_key of ``build`` are what the consumer's summary is held against.
    """

    def differing(side: DataFrame) -> DataFrame:
        joined = source.select(F.col(key).alias("_k"), F.col("row_sha256").alias("_s")).join(side.select(F.col(key).alias("_l"), F.col("row_sha256").alias("_t")), F.expr("_k <=> _l"), "full_outer")
        return joined.agg(F.count_if(~F.col("_s").eqNullSafe(F.col("_t"))).alias("violations"))

    summary = consumer.agg(F.count("*").alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
    wrong = reduce(lambda a, b: a + b, [(~F.col(c).eqNullSafe(F.lit(build[c]))).cast("int") for c in ("n_rows", "first_key", "last_key")])
    unlike: Column = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lit(v)) for c, v in build.items()])
    states = state.agg(F.count("*").alias("n"), F.count_if(unlike).alias("bad"))
    parts = {
        "digest_index": differing(index),
        "consumer": differing(consumer),
        "summary": summary.select(wrong.cast("long").alias("violations")),
        "state": states.select((F.col("bad") + F.abs(F.col("n") - 1)).alias("violations")),  # there must be one
    }
    return reduce(lambda a, b: a.unionByName(b), [df.select(F.lit(name).alias("check"), "violations") for name, df in parts.items()])


def verdicts(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations, verdict): one row for each of ``checks``, a table of violations or of (check, violations), and one for all.

    The last row, ``all``, is PASS only if every other one is.
    """
    counted = []
    for name, df in checks.items():
        if df.columns == ["check", "violations"]:
            counted.append(df.select(F.concat(F.lit(f"{name}."), "check").alias("check"), F.col("violations").cast("long").alias("violations")))
        else:
            counted.append(df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations"))
    rows = reduce(lambda a, b: a.unionByName(b), counted)
    every = rows.agg(F.sum("violations").alias("violations")).select(F.lit("all").alias("check"), "violations")
    return rows.unionByName(every).withColumn("verdict", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
