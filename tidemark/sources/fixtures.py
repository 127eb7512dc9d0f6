"""Daily bars from the order tables, the input of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.registry import IDS


def _bars(orders: DataFrame, series: str) -> DataFrame:
    price = F.col("o_totalprice")
    cells = [F.min_by(price, "o_orderkey").alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, "o_orderkey").alias("close")]
    bars = orders.groupBy(F.col(series).alias("series_id"), F.to_date("o_orderdate").alias("observation_date")).agg(*cells)
    return bars.withColumn("level", F.col("close"))


def bars_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series for each order priority."""
    return _bars(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderpriority")


def bars_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered series for each nation of the ordering customer, by position in the registry."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    name = F.element_at(F.array(*[F.lit(s) for s in IDS]), F.col("c_nationkey") + 1)
    return _bars(orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).withColumn("series", name), "series")


def with_gaps(bars: DataFrame) -> DataFrame:
    """``bars`` with some levels null, zero or negative, by the hash-free rule that the oracle knows: days of the month."""
    day = F.dayofmonth("observation_date")
    return bars.withColumn("level", F.when(day == 7, None).when(day == 19, 0.0).when((day == 28) & (F.month("observation_date") % 3 == 0), -F.col("level")).otherwise(F.col("level")))
