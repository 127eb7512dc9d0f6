"""The closed catalog of long-form features: which feature of which series is published, under which name."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import finite, log_ratio, next_weekday, ratio
from tidemark.operators import features as X
from tidemark.operators.frames import conformance_report, gold_wide, long_form
from tidemark.operators.verify import availability_differences, verdicts
from tidemark.plans.registry import IDS, OHLC
from tidemark.sources.lake import BuildCatalog

# Series groups and their lags.
VOLATILITY_SERIES = ("vix", "vix9d", "vix3m", "vix6m", "vix1y", "vstoxx", "move")
DELTAS = {**dict.fromkeys(VOLATILITY_SERIES, (1, 5, 20)), "ciss": (1, 5, 20), "euro_hy_oas": (1, 5, 20), "us_2y": (1, 20), "us_10y": (1, 20), "estr": (1, 20), "usd_broad": (1, 20)}
SIGNED = ("estr",)

CROSS = ("vix9d_vix_ratio", "vix_vix3m_ratio", "vix9d_vix3m_log_ratio", "vix3m_minus_vix", "vix6m_minus_vix", "vix1y_minus_vix", "us_10y_minus_us_2y")


@dataclass(frozen=True)
class Spec:
    name: str
    series_id: str
    feature: str


LEVEL_NAMES = (
    "log_level", *(f"delta_{k}obs" for k in X.DELTA_LAGS), "zscore_60obs", *(f"momentum_autocorr_{k}_{n}obs" for k, n in X.CHANGE_CORRELATIONS),
    *(f"log_return_{k}obs" for k in X.LAGS), *(f"return_geom_{n}obs_pct" for n in X.GEOMETRIC_WINDOWS), *(f"return_mean_{n}obs" for n in X.MEAN_WINDOWS),
    *(f"volatility_{n}obs" for n in X.VOLATILITY_WINDOWS), *(f"sma_ratio_{a}_{b}" for a, b in X.SMA_PAIRS), *(f"roc_{k}obs" for k in X.LAGS), "roc_acceleration_4_8",
    *(f"drawdown_{n}obs" for n in X.DRAWDOWN_WINDOWS),
)


def _of(series: str) -> list[str]:
    out = [f"delta_{k}obs" for k in DELTAS.get(series, ())]
    if series in VOLATILITY_SERIES:
        out.append("zscore_60obs")
    if series in SIGNED:
        return out + [n for n in LEVEL_NAMES if n.startswith("momentum_autocorr")]
    out += [n for n in LEVEL_NAMES if not n.startswith(("delta_", "zscore_"))]
    out += [*X.VALID_ONLY, *X.RSI, *X.TREND]
    return out + list(X.BAR if series in OHLC else ())


CATALOG: tuple[Spec, ...] = (*(Spec(f"{s}_{f}", s, f) for s in IDS for f in _of(s)), *(Spec(n, "", n) for n in CROSS))
if len({s.name for s in CATALOG}) != len(CATALOG):
    raise ValueError("a feature is catalogued twice")


def fingerprint() -> str:
    """Changes with any name, series or feature of the catalog, and with their order."""
    return hashlib.sha256("\n".join(f"{s.name}|{s.series_id}|{s.feature}" for s in CATALOG).encode()).hexdigest()


def catalog_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s.name, s.series_id, s.feature) for s in CATALOG], "feature_name string, series_id string, feature string")


def cross_features(bars: DataFrame) -> DataFrame:
    """Ratios and spreads of levels of one day."""
    wide = gold_wide(bars, ["vix", "vix9d", "vix3m", "vix6m", "vix1y", "us_2y", "us_10y"], [])
    level = {s: F.col(f"{s}_level") for s in ("vix", "vix9d", "vix3m", "vix6m", "vix1y", "us_2y", "us_10y")}

    def over(a: str, b: str):
        return F.when(level[b] > 0, ratio(level[a], level[b]))

    values = [over("vix9d", "vix"), over("vix", "vix3m"), log_ratio(level["vix9d"], level["vix3m"]), *[level[s] - level["vix"] for s in ("vix3m", "vix6m", "vix1y")], level["us_10y"] - level["us_2y"]]
    return wide.select("observation_date", *[v.alias(n) for v, n in zip(values, CROSS, strict=True)])


def macro_features_long(bars: DataFrame) -> DataFrame:
    """(observation_date, available_at_utc, feature_name, value) of the whole catalog; only finite values, one row for each."""
    wide = X.all_features(bars)
    singles = long_form(wide, ["series_id", "observation_date"], [c for c in wide.columns if c not in X.KEYS])
    named = F.broadcast(catalog_table(bars.sparkSession))  # CATALOG, 1,720 rows
    singles = singles.join(named, ["series_id", "feature"]).select("observation_date", "feature_name", "value")
    cross = long_form(cross_features(bars), ["observation_date"], list(CROSS)).withColumnRenamed("feature", "feature_name")
    out = singles.unionByName(cross).where(finite("value"))
    return out.select("observation_date", next_weekday("observation_date").alias("available_at_utc"), "feature_name", "value")


def catalog_drift(long: DataFrame) -> DataFrame:
    """Feature names of ``long`` that aren't catalogued, with their rows."""
    return long.join(F.broadcast(catalog_table(long.sparkSession)), "feature_name", "left_anti").groupBy("feature_name").agg(F.count("*").alias("n_rows"))


def catalog_parity(long: DataFrame) -> DataFrame:
    """(feature_name, difference, n_rows): features of ``long`` that aren't catalogued (unknown), and catalogued ones without rows (absent)."""
    found = long.groupBy("feature_name").agg(F.count("*").alias("n_rows"))
    named = F.broadcast(catalog_table(long.sparkSession).select("feature_name", F.lit(True).alias("known")))  # CATALOG, 1,720 rows
    joined = found.join(named, "feature_name", "full_outer")
    kind = F.when(F.col("known").isNull(), "unknown").when(F.col("n_rows").isNull(), "absent")
    return joined.select("feature_name", kind.alias("difference"), F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows")).where("difference is not null")


class NotConformant(RuntimeError):
    """A recomputed catalog that mustn't be published."""


def refresh_features(builds: BuildCatalog, build_id: str, bars: DataFrame, fault: Callable[[str], None] = lambda step: None) -> str:
    """Recomputes the whole catalog from ``bars`` and publishes it as the current build; returns its path.

    What was written is verified before it is promoted, so it is computed once: keys, values, names and availability. If
    anything is wrong, NotConformant; the build is then failed and the current one stays.
    """
    long = macro_features_long(bars)

    def check(step: str) -> None:
        if step == "written":
            written = bars.sparkSession.read.schema(long.schema).parquet(f"{builds.root}/versions/build_id={build_id}")
            rows = written.withColumnRenamed("feature_name", "feature").withColumn("series_id", F.lit(""))
            report = verdicts({"rows": conformance_report(rows, [s.name for s in CATALOG]), "temporal": availability_differences(written), "catalog": catalog_parity(written).where("difference = 'unknown'")})
            wrong = [r["check"] for r in report.where("verdict = 'FAIL' and check <> 'all'").collect()]
            if wrong:
                raise NotConformant(", ".join(sorted(wrong)))
        fault(step)

    return builds.publish(build_id, long, fault=check)
