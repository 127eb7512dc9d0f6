"""Provider payloads to typed rows: delimited files and JSON documents, parsed by Spark.

Bar sources return observation_date, open, high, low, close; scalar sources observation_date, value. A payload with
nothing in it gives an empty table of that schema. Malformed cells, duplicate dates and, where the provider promises
whole bars, invalid bars raise PayloadError.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import finite, utc_date

BAR = "observation_date date, open double, high double, low double, close double"
SCALAR = "observation_date date, value double"


class PayloadError(ValueError):
    """A payload that doesn't hold what its provider promises."""


def valid_bar() -> Column:
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return finite(o) & finite(h) & finite(low) & finite(c) & (low > 0) & (h >= F.greatest(o, c, low)) & (low <= F.least(o, c, h))


def dates(text: Column, *formats: str) -> Column:
    """The date by the first format that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(f)).cast("date") for f in formats])


def _checked(df: DataFrame, kept: Column | None = None, some: bool = False, **bad: Column) -> DataFrame:
    """``df`` after one pass that looks for rows in which one of ``bad`` holds (name: the message, with _ for spaces) and for dates twice.

    Dates are looked at among the rows of ``kept`` alone, which are what is returned; with ``some``, there must be one.
    """
    kept = F.lit(True) if kept is None else kept
    by_day = df.groupBy("observation_date").agg(*[F.count_if(x).alias(name) for name, x in bad.items()], F.count_if(kept).alias("_n"))
    found = by_day.agg(*[F.sum(name).alias(name) for name in bad], F.sum("_n").alias("_rows"), F.max("_n").alias("_most")).first()
    for name in bad:
        if found[name]:
            raise PayloadError(name.replace("_", " "))
    if (found["_most"] or 0) > 1:
        raise PayloadError("a date occurs twice")
    if some and not found["_rows"]:
        raise PayloadError("no valid bar")
    return df.where(kept)


def _check(df: DataFrame, bad: Column, what: str) -> DataFrame:
    if not df.where(bad).limit(1).isEmpty():
        raise PayloadError(what)
    return df


# What pages say that stand in for a payload without data.
NO_DATA = ("no record", "no result", "no data", "security concerns", "access has been blocked")


def _delimited(spark: SparkSession, path: str, sep: str) -> DataFrame:
    raw = spark.read.option("header", True).option("sep", sep).option("mode", "FAILFAST").csv(path)
    return raw.toDF(*[c.strip().lower() for c in raw.columns])


def read_bars_csv(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated daily bars, dates as month/day/year or ISO. Invalid bars are dropped; if none is left, that raises."""
    raw = _delimited(spark, path, ",")
    names = ("open", "high", "low", "close")
    cells = [F.expr(f"try_cast(trim({n}) as double)").alias(n) for n in names]
    rows = raw.select(dates(F.col("date"), "MM/dd/yyyy", "yyyy-MM-dd").alias("observation_date"), *cells)
    bad = F.col("observation_date").isNull()
    for n in names:
        bad = bad | F.col(n).isNull()
    return _checked(rows, valid_bar(), some=True, a_cell_is_empty_or_malformed=bad)


def read_scalar_delimited(spark: SparkSession, path: str, symbol: str, value_names: tuple[str, ...] = ("indexvalue", "value", "close")) -> DataFrame:
    """Daily values of ``symbol`` from a file separated by semicolons, tabs or commas. A blank value is an absent one."""
    head = spark.read.text(path).first()
    if head is None:
        return spark.createDataFrame([], SCALAR)
    sep = max((";", "\t", ","), key=lambda s: head[0].count(s))
    raw = _delimited(spark, path, sep)
    day = next((c for c in ("date", "time_period") if c in raw.columns), None)
    value = next((c for c in value_names if c in raw.columns), None)
    if day is None or value is None:
        raise PayloadError("no date or value column")
    rows = raw.where(F.upper(F.trim("symbol")) == symbol.upper()) if "symbol" in raw.columns else raw
    rows = rows.where(F.coalesce(F.trim(F.col(value)), F.lit("")) != "")
    rows = rows.select(dates(F.col(day), "dd.MM.yyyy", "yyyy-MM-dd").alias("observation_date"), F.expr(f"try_cast(trim(`{value}`) as double)").alias("value"))
    return _checked(rows, a_date_or_value_is_malformed=F.col("observation_date").isNull() | F.col("value").isNull())


def read_sdmx_csv(spark: SparkSession, path: str) -> DataFrame:
    """TIME_PERIOD and OBS_VALUE; empty and "." values are absent.

    An empty payload, or a page that isn't a table and says so, is one without data. A table without these columns raises
    PayloadError, whatever is written in it, and so does any other page.
    """
    raw = _delimited(spark, path, ",")
    if not {"time_period", "obs_value"} <= set(raw.columns):
        page = spark.read.text(path, wholetext=True)
        said = reduce(lambda a, b: a | b, [F.lower("value").contains(x) for x in NO_DATA], F.trim("value") == "")
        if len(raw.columns) < 2 and page.where(~said).isEmpty():
            return spark.createDataFrame([], SCALAR)
        raise PayloadError(f"{path} has no columns TIME_PERIOD and OBS_VALUE")
    rows = raw.where(~F.coalesce(F.trim("obs_value"), F.lit("")).isin("", "."))
    rows = rows.select(dates(F.col("time_period"), "yyyy-MM-dd").alias("observation_date"), F.expr("try_cast(trim(obs_value) as double)").alias("value"))
    return _checked(rows, a_date_or_value_is_malformed=F.col("observation_date").isNull() | ~F.coalesce(finite("value"), F.lit(False)))


def read_observations_json(spark: SparkSession, path: str) -> DataFrame:
    """{"observations": [{"date", "value"}]}; a value of "." is absent."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "observations array<struct<date:string,value:string>>").alias("x"))
    rows = _check(raw, F.col("x.observations").isNull(), "no observations").select(F.explode("x.observations").alias("o")).where("o.value <> '.'")
    rows = rows.select(dates(F.col("o.date"), "yyyy-MM-dd").alias("observation_date"), F.expr("try_cast(trim(o.value) as double)").alias("value"))
    return _checked(rows, a_date_or_value_is_malformed=F.col("observation_date").isNull() | ~F.coalesce(finite("value"), F.lit(False)))


def read_chart_json(spark: SparkSession, path: str) -> DataFrame:
    """A chart document with parallel vectors of epoch seconds and bars. Wholly null bars are skipped, others must be valid."""
    quote = "struct<open:array<double>,high:array<double>,low:array<double>,close:array<double>>"
    schema = f"chart struct<result:array<struct<timestamp:array<bigint>,indicators:struct<quote:array<{quote}>>>>>"
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("x")).select(F.expr("x.chart.result[0] as r"))
    raw = raw.select(F.col("r.timestamp").alias("t"), *[F.expr(f"r.indicators.quote[0].{c} as {c}") for c in ("open", "high", "low", "close")])
    uneven = F.lit(False)
    for c in ("open", "high", "low", "close"):
        uneven = uneven | F.coalesce(F.size(c) != F.size("t"), F.lit(True))
    raw = _check(raw.where("t is not null"), uneven, "vectors differ in length")
    rows = raw.select(F.explode(F.arrays_zip("t", "open", "high", "low", "close")).alias("b"))
    rows = rows.select(utc_date("b.t").alias("observation_date"), "b.open", "b.high", "b.low", "b.close")
    rows = rows.where(F.coalesce("open", "high", "low", "close").isNotNull())
    return _checked(rows, a_bar_is_partial_or_invalid=~F.coalesce(valid_bar(), F.lit(False)))


def within(df: DataFrame, first: str, last: str) -> DataFrame:
    """``df``, all of whose dates must be within the window that was asked for."""
    return _check(df, ~F.col("observation_date").between(first, last), "a date is outside the window")
