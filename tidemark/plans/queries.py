"""The registered queries on daily series, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import nan_to_null, next_weekday
from tidemark.operators import delta, features, frames, verify
from tidemark.operators.recurrences import with_states
from tidemark.plans import catalog
from tidemark.plans import oracle as O
from tidemark.plans.registry import IDS, OHLC, REGISTRY
from tidemark.sources import ingestion, lake, versions
from tidemark.sources.fixtures import bars_by_nation, bars_by_priority, with_gaps

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ["series_id", "observation_date"]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            ORACLE_SQL[name] = sql
        return query

    return keep


def _rounded(df: DataFrame, values: dict[str, Column] | list[str]) -> DataFrame:
    columns = values if isinstance(values, dict) else {v: F.col(v) for v in values}
    return df.select(*KEYS, *[F.round(x, 6).alias(n) for n, x in columns.items()])


# windows over rows with a level -------------------------------------------------------------------------------------


def _level_family(names: list[str], gaps: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = bars_by_priority(spark, sf_dir)
        made = features.level_features()
        return _rounded(features.with_lags(with_gaps(bars) if gaps else bars), {n: made[n] for n in names})

    return query


for _family, _columns in O.LEVEL.items():
    register(_family, O.level_sql(_family))(_level_family(list(_columns)))
for _family in ("log_return", "roc", "drawdown", "sma_ratio", "delta_obs"):
    register(f"{_family}_gaps", O.level_sql(_family, source="g"))(_level_family(list(O.LEVEL[_family]), gaps=True))


def _valid_only(name: str) -> Query:
    return lambda spark, sf_dir: _rounded(features.with_valid_only(features.with_lags(bars_by_priority(spark, sf_dir))), [name])


register("volatility_zscore", O.valid_sql("volatility_zscore_96", O._z("vol8", 96), "vol8 IS NOT NULL", 96))(_valid_only("volatility_zscore_96"))
register("level_zscore", O.valid_sql("level_zscore_96", O._z("level", 96), "level > 0", 96))(_valid_only("level_zscore_96"))
for _k, _n in features.RETURN_CORRELATIONS:
    _name = f"momentum_autocorr_lag{_k}_window{_n}"
    _sql = O.valid_sql(_name, O._corr("lr_1", f"lr1_lag_{_k}", _n), f"lr_1 IS NOT NULL AND lr1_lag_{_k} IS NOT NULL", _n)
    register(f"return_autocorr_lag{_k}", _sql)(_valid_only(_name))


# recurrences --------------------------------------------------------------------------------------------------------


def _trend(names: list[str], gaps: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = bars_by_nation(spark, sf_dir)
        return _rounded(features.with_trend(with_states((with_gaps(bars) if gaps else bars).select(*KEYS, "level"))), names)

    return query


for _family, _columns in O.TREND.items():
    register(_family, O.trend_sql(_family))(_trend(list(_columns)))
register("ema_null_reset", O.trend_sql("ema_distance", "g"))(_trend(list(O.TREND["ema_distance"]), gaps=True))
register("macd_hist", f"WITH RECURSIVE {O.BARS2}, {O.ema_ctes('b', (12, 26))}, {O.signal_ctes()} SELECT {O.KEYS}, round(hist, 6) AS macd_hist_relative FROM h")(_trend(["macd_hist_relative"]))
register("macd_hist_delta", f"WITH RECURSIVE {O.BARS2}, {O.ema_ctes('b', (12, 26))}, {O.signal_ctes()} SELECT {O.KEYS}, round(hist - lag(hist, 3) {O.P}, 6) AS macd_hist_delta_3 FROM h")(_trend(["macd_hist_delta_3"]))


@register("ema_state", f"WITH RECURSIVE {O.BARS2}, {O.ema_ctes('b')} SELECT {O.KEYS}, {', '.join(f'round(e{n}, 6) AS ema_{n}' for n in (5, 9, 12, 21, 26))} FROM e")
def ema_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(with_states(bars_by_nation(spark, sf_dir).select(*KEYS, "level")), [f"ema_{n}" for n in (5, 9, 12, 21, 26)])


def _rsi(values: Callable[[], dict[str, Column]], gaps: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = bars_by_nation(spark, sf_dir)
        return _rounded(features.with_rsi(with_states((with_gaps(bars) if gaps else bars).select(*KEYS, "level"))), values())

    return query


def _of_rsi(names: list[str]) -> Callable[[], dict[str, Column]]:
    return lambda: {n: features.rsi_features()[n] for n in names}


_ALL = (3, 5, 7, 14)
register("wilder_state", O.rsi_sql({f"avg_{s}_{n}": f"{s[0]}{n}" for n in _ALL for s in ("gain", "loss")}, _ALL))(_rsi(lambda: {f"avg_{s}_{n}": F.col(f"avg_{s}_{n}") for n in _ALL for s in ("gain", "loss")}))
register("wilder_rsi", O.rsi_sql({f"rsi_{n}obs": f"rsi_{n}" for n in _ALL}, _ALL))(_rsi(_of_rsi([f"rsi_{n}obs" for n in _ALL])))
register("wilder_rsi_gaps", O.rsi_sql({f"rsi_{n}obs": f"rsi_{n}" for n in _ALL}, _ALL, "g"))(_rsi(_of_rsi([f"rsi_{n}obs" for n in _ALL]), gaps=True))
register("rsi_ratio", O.rsi_sql({"rsi_ratio_5_15": "rsi_5 / nullif(rsi_15, 0)"}, (5, 15)))(_rsi(_of_rsi(["rsi_ratio_5_15"])))
register("rsi_slope", O.rsi_sql({"rsi5_slope_3": f"(rsi_5 - lag(rsi_5, 3) {O.P}) / 3", "rsi5_delta_1": f"rsi_5 - lag(rsi_5, 1) {O.P}"}, (5,)))(_rsi(_of_rsi(["rsi5_slope_3", "rsi5_delta_1"])))


# bars ---------------------------------------------------------------------------------------------------------------


def _bar(names: list[str]) -> Query:
    return lambda spark, sf_dir: _rounded(features.bar_features(bars_by_priority(spark, sf_dir)), names)


register("high_low_range", O.bar_metric_sql("high_low_range", "(high - low) / close", "close > 0"))(_bar(["high_low_range_1obs", "high_low_range_5obs"]))
register("intraday_return", O.bar_metric_sql("intraday_return", "(close - open) / open", "open > 0"))(_bar(["intraday_return_1obs", "intraday_return_5obs"]))
register("overnight_gap", O.bar_metric_sql("overnight_gap", "(open - pc) / pc", "pc > 0"))(_bar(["overnight_gap_1obs", "overnight_gap_5obs"]))
register("stochastic_k", O.stochastic_sql({"stoch_k_5": "k5", "stoch_k_14": "k14"}))(_bar(["stoch_k_5", "stoch_k_14"]))
register("stochastic_d", O.stochastic_sql({"stoch_d_5_3": "d5", "stoch_d_14_3": "d14"}))(_bar(["stoch_d_5_3", "stoch_d_14_3"]))
register("stochastic_spread", O.stochastic_sql({"stoch_kd_spread_5": "k5 - d5", "stoch_k_slope_3": "(k5 - k5_3) / 3"}))(_bar(["stoch_kd_spread_5", "stoch_k_slope_3"]))
@register("donchian", O.DONCHIAN)
def donchian(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = features.bar_features(bars_by_priority(spark, sf_dir))
    return made.select(*KEYS, *[F.col(c).cast("double").alias(c) for c in ("donchian_breakout_up", "donchian_breakout_down")])


@register("asof_prev_close", f"""WITH {O.BARS1} SELECT x.series_id, x.observation_date, y.close AS previous_close FROM b x
ASOF LEFT JOIN b y ON x.series_id = y.series_id AND x.observation_date > y.observation_date""")
def asof_prev_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_by_priority(spark, sf_dir).select(*KEYS, features.previous_close().alias("previous_close"))


@register("bar_validity_filter", f"WITH {O.BARS1} SELECT {O.KEYS}, open, high, low, close FROM b WHERE low > 0 AND high >= greatest(open, close, low) AND low <= least(open, close, high) AND high > low")
def bar_validity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.sources.parsers import valid_bar

    return bars_by_priority(spark, sf_dir).where(valid_bar() & (F.col("high") > F.col("low"))).select(*KEYS, "open", "high", "low", "close")


# wide and long ------------------------------------------------------------------------------------------------------

_WIDE = ", ".join([f"max(level) FILTER (series_id = '{s}') AS {s}_level" for s in IDS] + [f"max({c}) FILTER (series_id = '{s}') AS {s}_{c}" for s in OHLC for c in ("open", "high", "low", "close")])


@register("gold_wide_pivot", f"WITH {O.BARS2} SELECT observation_date, {_WIDE} FROM b GROUP BY observation_date")
def gold_wide_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.gold_wide(bars_by_nation(spark, sf_dir), list(IDS), list(OHLC))


@register("gold_full_outer_chain", f"WITH {O.BARS2} SELECT observation_date, {_WIDE} FROM b GROUP BY observation_date")
@register("gold_full_outer_chain_all", f"WITH {O.BARS2} SELECT observation_date, {_WIDE} FROM b GROUP BY observation_date")
def gold_full_outer_chain_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = bars_by_nation(spark, sf_dir).repartition("observation_date").persist()  # read by each of the joins; it goes with clearCache
    return frames.gold_outer_chain(bars, list(IDS), list(OHLC))


_X = {s: f"max(level) FILTER (series_id = '{s}')" for s in IDS}
_CROSS = f"WITH {O.BARS2}, x AS (SELECT observation_date, {', '.join(f'{v} AS {s}' for s, v in _X.items())} FROM b GROUP BY observation_date)"


@register("term_structure", f"""{_CROSS} SELECT observation_date, round(CASE WHEN vix > 0 THEN vix9d / vix END, 6) AS vix9d_vix_ratio, round(CASE WHEN vix3m > 0 THEN vix / vix3m END, 6) AS vix_vix3m_ratio,
round(CASE WHEN vix9d > 0 AND vix3m > 0 THEN ln(vix9d / vix3m) END, 6) AS vix9d_vix3m_log_ratio FROM x""")
def term_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.cross_features(bars_by_nation(spark, sf_dir)).select("observation_date", *[F.round(c, 6).alias(c) for c in catalog.CROSS[:3]])


@register("yield_spread", f"""{_CROSS} SELECT observation_date, round(vix3m - vix, 6) AS vix3m_minus_vix, round(vix6m - vix, 6) AS vix6m_minus_vix, round(vix1y - vix, 6) AS vix1y_minus_vix,
round(us_10y - us_2y, 6) AS us_10y_minus_us_2y FROM x""")
def yield_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.cross_features(bars_by_nation(spark, sf_dir)).select("observation_date", *[F.round(c, 6).alias(c) for c in catalog.CROSS[3:]])


_LONG = ["zscore_60obs", "log_return_5obs", "volatility_20obs", "roc_8obs"]
_LONG_CTE = f"""{O.BARS1}, {O.lagged('b')}, w AS (SELECT {O.KEYS}, {O.LEVEL['zscore_60']['zscore_60obs']} AS zscore_60obs, lr_5 AS log_return_5obs,
{O.LEVEL['volatility']['volatility_20obs']} AS volatility_20obs, {O.LEVEL['roc']['roc_8obs']} AS roc_8obs FROM l),
n AS (SELECT series_id, observation_date, feature, value FROM w UNPIVOT (value FOR feature IN (zscore_60obs, log_return_5obs, volatility_20obs, roc_8obs)))"""


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = features.level_features()
    wide = features.with_lags(bars_by_priority(spark, sf_dir)).select(*KEYS, *[made[n].alias(n) for n in _LONG])
    return frames.long_form(wide, KEYS, _LONG)


@register("long_unpivot", f"""WITH {_LONG_CTE} SELECT {O.KEYS}, CAST(observation_date + CASE isodow(observation_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS TIMESTAMP) AS available_at_utc,
feature, round(value, 6) AS value FROM n""")
def long_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(spark, sf_dir).select(*KEYS, next_weekday("observation_date").alias("available_at_utc"), "feature", F.round("value", 6).alias("value"))


@register("union_long", f"WITH {_LONG_CTE} SELECT {O.KEYS}, feature, round(value, 6) AS value FROM n UNION ALL SELECT {O.KEYS}, 'log_level', round(ln(level), 6) FROM l WHERE level > 0")
def union_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = bars_by_priority(spark, sf_dir).where("level > 0").select(*KEYS, F.lit("log_level").alias("feature"), F.ln("level").alias("value"))
    return _long(spark, sf_dir).unionByName(more).select(*KEYS, "feature", F.round("value", 6).alias("value"))


@register("feature_counts", f"WITH {_LONG_CTE} SELECT feature, count(*) AS n_rows FROM n GROUP BY feature")
def feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(spark, sf_dir).groupBy("feature").agg(F.count("*").alias("n_rows"))


_ACTUAL = "k AS (SELECT * FROM n WHERE feature <> 'roc_8obs' OR day(observation_date) <> 13)"


@register("feature_count_diff", f"""WITH {_LONG_CTE}, {_ACTUAL}, x AS (SELECT feature, count(*) AS expected FROM n GROUP BY feature), y AS (SELECT feature, count(*) AS actual FROM k GROUP BY feature)
SELECT feature, expected, actual FROM x FULL OUTER JOIN y USING (feature) WHERE expected IS DISTINCT FROM actual""")
def feature_count_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _long(spark, sf_dir)
    return delta.feature_count_diff(long, long.where("feature <> 'roc_8obs' or day(observation_date) <> 13"))


@register("population_verify", f"""WITH {_LONG_CTE}, {_ACTUAL}, x AS (SELECT feature, count(*) AS c FROM n GROUP BY feature), y AS (SELECT feature, count(*) AS c FROM k GROUP BY feature)
SELECT (SELECT count(*) FROM n) AS expected_rows, (SELECT count(DISTINCT feature) FROM n) AS expected_features, (SELECT count(*) FILTER (isnan(value) OR isinf(value)) FROM n) AS expected_not_finite,
(SELECT count(*) FROM k) AS actual_rows, (SELECT count(DISTINCT feature) FROM k) AS actual_features, (SELECT count(*) FILTER (isnan(value) OR isinf(value)) FROM k) AS actual_not_finite,
(SELECT count(*) FROM x FULL OUTER JOIN y USING (feature) WHERE x.c IS DISTINCT FROM y.c) AS n_different""")
def population_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _long(spark, sf_dir)
    return delta.population_report(long, long.where("feature <> 'roc_8obs' or day(observation_date) <> 13"))


@register("catalog_drift", f"WITH {O.BARS1} SELECT series_id || '_log_level' AS feature_name, count(*) AS n_rows FROM b GROUP BY series_id")
def catalog_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_priority = bars_by_priority(spark, sf_dir).select(F.concat("series_id", F.lit("_log_level")).alias("feature_name"))
    known = bars_by_nation(spark, sf_dir).where("series_id <> 'estr'").select(F.concat("series_id", F.lit("_log_level")).alias("feature_name"))
    return catalog.catalog_drift(by_priority.unionByName(known))


@register("feature_profile", f"""WITH {_LONG_CTE} SELECT feature, round(count(value) / (SELECT count(*) FROM b), 6) AS coverage, round(avg(value), 6) AS mean, round(min(value), 6) AS least, round(max(value), 6) AS most
FROM n GROUP BY feature""")
def feature_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = frames.feature_profile(_long(spark, sf_dir), bars_by_priority(spark, sf_dir).agg(F.count("*").alias("total")))
    return out.select("feature", *[F.round(c, 6).alias(c) for c in ("coverage", "mean", "least", "most")])


_CATALOG_CTE = O.catalog_ctes(
    [(x.name, x.series_id, x.feature) for x in catalog.CATALOG],
    f"""{_CROSS} SELECT observation_date, round(CASE WHEN vix > 0 THEN vix9d / vix END, 4) AS vix9d_vix_ratio, round(CASE WHEN vix3m > 0 THEN vix / vix3m END, 4) AS vix_vix3m_ratio,
round(CASE WHEN vix9d > 0 AND vix3m > 0 THEN ln(vix9d / vix3m) END, 4) AS vix9d_vix3m_log_ratio, round(vix3m - vix, 4) AS vix3m_minus_vix, round(vix6m - vix, 4) AS vix6m_minus_vix,
round(vix1y - vix, 4) AS vix1y_minus_vix, round(us_10y - us_2y, 4) AS us_10y_minus_us_2y FROM x""",
    4,
)


@register("macro_features_long", f"""WITH {_CATALOG_CTE} SELECT observation_date, CAST(observation_date + CASE isodow(observation_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS TIMESTAMP) AS available_at_utc,
feature_name, value FROM c""")
def macro_features_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.macro_features_long(bars_by_nation(spark, sf_dir)).withColumn("value", F.round("value", 4))


@register("macro_feature_counts", f"WITH {_CATALOG_CTE} SELECT feature_name, count(*) AS n_rows FROM c GROUP BY feature_name")
def macro_feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return macro_features_long(spark, sf_dir).groupBy("feature_name").agg(F.count("*").alias("n_rows"))


@register("macro_feature_counts_all", f"WITH {_CATALOG_CTE} SELECT feature_name, count(*) AS n_rows FROM c GROUP BY feature_name")
def macro_feature_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return macro_features_long(spark, sf_dir).groupBy("feature_name").agg(F.count("*").alias("n_rows"))


def _whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All published features, under the column names that the verifying operators take. Series are in the names."""
    return macro_features_long(spark, sf_dir).withColumnRenamed("feature_name", "feature")


#: Rows missing on purpose: one family on one day of the month, of all series.
_SOME = "feature not like '%\\_roc\\_8obs' or day(observation_date) <> 13"


_KEPT_CTE = f"{_CATALOG_CTE}, n AS (SELECT observation_date, feature_name AS feature, value FROM c), k2 AS (SELECT * FROM n WHERE NOT ends_with(feature, '_roc_8obs') OR day(observation_date) <> 13)"


@register("feature_count_diff_all", f"""WITH {_KEPT_CTE}, x AS (SELECT feature, count(*) AS expected FROM n GROUP BY feature), y AS (SELECT feature, count(*) AS actual FROM k2 GROUP BY feature)
SELECT feature, expected, actual FROM x FULL OUTER JOIN y USING (feature) WHERE expected IS DISTINCT FROM actual""")
def feature_count_diff_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _whole(spark, sf_dir)
    return delta.feature_count_diff(long, long.where(_SOME))


@register("population_verify_all", f"""WITH {_KEPT_CTE}, x AS (SELECT feature, count(*) AS c FROM n GROUP BY feature), y AS (SELECT feature, count(*) AS c FROM k2 GROUP BY feature)
SELECT (SELECT count(*) FROM n) AS expected_rows, (SELECT count(DISTINCT feature) FROM n) AS expected_features, (SELECT count(*) FILTER (isnan(value) OR isinf(value)) FROM n) AS expected_not_finite,
(SELECT count(*) FROM k2) AS actual_rows, (SELECT count(DISTINCT feature) FROM k2) AS actual_features, (SELECT count(*) FILTER (isnan(value) OR isinf(value)) FROM k2) AS actual_not_finite,
(SELECT count(*) FROM x FULL OUTER JOIN y USING (feature) WHERE x.c IS DISTINCT FROM y.c) AS n_different""")
def population_verify_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _whole(spark, sf_dir)
    return delta.population_report(long, long.where(_SOME))


@register("feature_profile_all", f"""WITH {_CATALOG_CTE}, {O.BARS2}, t AS (SELECT count(DISTINCT observation_date) AS total FROM b)
SELECT feature_name AS feature, round(count(value) / any_value(total), 6) AS coverage, round(avg(value), 7) AS mean, round(min(value), 6) AS least, round(max(value), 6) AS most FROM c, t GROUP BY feature_name""")
def feature_profile_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage is of the dates that have a bar of any series."""
    out = frames.feature_profile(_whole(spark, sf_dir), bars_by_nation(spark, sf_dir).agg(F.count_distinct("observation_date").alias("total")))
    return out.select("feature", *[F.round(c, 7 if c == "mean" else 6).alias(c) for c in ("coverage", "mean", "least", "most")])


@register("conformance_report_all", f"""WITH {_CATALOG_CTE}, x AS (SELECT *, observation_date + CASE isodow(observation_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS available FROM c),
known AS (SELECT feature_name FROM k UNION ALL SELECT unnest([{', '.join(f"'{n}'" for n in catalog.CROSS)}]))
SELECT 'null_key' AS check, count(*) FILTER (observation_date IS NULL OR feature_name IS NULL) AS violations FROM x
UNION ALL SELECT 'not_finite', count(*) FILTER (value IS NULL OR isnan(value) OR isinf(value)) FROM x UNION ALL SELECT 'unknown_feature', count(*) FROM x ANTI JOIN known USING (feature_name)
UNION ALL SELECT 'available_too_early', count(*) FILTER (available <= observation_date) FROM x UNION ALL SELECT 'available_on_weekend', count(*) FILTER (isodow(available) > 5) FROM x
UNION ALL SELECT 'duplicate_key', count(*) FROM (SELECT 1 FROM x GROUP BY observation_date, feature_name HAVING count(*) > 1)""")
def conformance_report_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _whole(spark, sf_dir).withColumn("series_id", F.lit(""))
    return frames.conformance_report(long, [s.name for s in catalog.CATALOG])


@register("available_at", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS observation_date, CAST(CAST(o_orderdate AS DATE) + CASE isodow(o_orderdate) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS TIMESTAMP) AS available_at_utc FROM orders")
def available_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("observation_date")).distinct()
    return days.withColumn("available_at_utc", next_weekday("observation_date"))


@register("nan_to_null", "SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS level FROM orders")
def nan_to_null_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.when(F.col("o_orderkey") % 97 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", nan_to_null(x).alias("level"))


# scans and counts ---------------------------------------------------------------------------------------------------


@register("scan_bars", f"WITH {O.BARS1} SELECT {O.KEYS}, open, high, low, close, level FROM b")
def scan_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_by_priority(spark, sf_dir).select(*KEYS, "open", "high", "low", "close", "level")


@register("observation_bounds", "SELECT min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date FROM orders")
def observation_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.observation_bounds(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderdate")


@register("bounded_window", f"WITH {O.BARS1} SELECT {O.KEYS}, level FROM b WHERE observation_date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'")
def bounded_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_by_priority(spark, sf_dir).where(F.col("observation_date").between("1996-01-01", "1996-03-31")).select(*KEYS, "level")


@register("inventory", """WITH k AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY ALL)
SELECT series_id, min(d) AS first_date, max(d) AS last_date, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS n_duplicates FROM k GROUP BY series_id""")
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("observation_date"))
    return frames.inventory(rows)


@register("duplicate_keys", "SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS observation_date, count(*) AS n_rows FROM orders GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("observation_date"))
    return frames.duplicate_keys(rows, KEYS)


_SILVER_SQL = f"""WITH {O.BARS2}, {O.UNITS} SELECT observation_date, series_id, close AS value, CASE WHEN native_shape = 'ohlc' THEN open END AS open, CASE WHEN native_shape = 'ohlc' THEN high END AS high,
CASE WHEN native_shape = 'ohlc' THEN low END AS low, CASE WHEN native_shape = 'ohlc' THEN close END AS close, unit, u.provider, 'src:' || series_id AS source_id, TIMESTAMP '2026-01-02 03:04:05' AS fetched_at_utc FROM b JOIN u USING (series_id)"""


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = spark.createDataFrame([(s.series_id, s.native_shape, s.unit, s.provider) for s in REGISTRY], "series_id string, native_shape string, unit string, provider string")
    bronze = bars_by_nation(spark, sf_dir).withColumnRenamed("level", "value").withColumn("source_id", F.concat(F.lit("src:"), "series_id")).withColumn("fetched_at_utc", F.lit("2026-01-02 03:04:05").cast("timestamp"))
    return frames.silver_canonical(bronze, units)


@register("silver_canonical", _SILVER_SQL)
def silver_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@register("silver_quality", f"""SELECT count(*) AS n_rows, count(DISTINCT (series_id, observation_date)) AS n_keys, count(*) FILTER (series_id IS NULL OR observation_date IS NULL) AS n_null_keys,
count(*) FILTER (value IS NULL) AS value_nulls, count(*) FILTER (isnan(value) OR isinf(value)) AS value_not_finite, count(*) FILTER (open IS NULL) AS open_nulls,
count(*) FILTER (isnan(open) OR isinf(open)) AS open_not_finite FROM ({_SILVER_SQL})""")
def silver_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.quality_counts(_silver(spark, sf_dir), KEYS, ["value", "open"])


# diffs, merges, deltas ----------------------------------------------------------------------------------------------

_SIDES = f"""{O.BARS1}, old AS (SELECT {O.KEYS}, CASE WHEN day(observation_date) % 7 = 0 THEN level + 1 WHEN day(observation_date) = 3 THEN NULL ELSE level END AS level, TIMESTAMP '2026-01-01 00:00:00' AS fetched_at_utc
FROM b WHERE day(observation_date) % 5 <> 0), new AS (SELECT {O.KEYS}, level, TIMESTAMP '2026-01-02 00:00:00' AS fetched_at_utc FROM b WHERE day(observation_date) % 11 <> 0)"""


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    bars = bars_by_priority(spark, sf_dir).select(*KEYS, "level")
    day = F.dayofmonth("observation_date")
    level = F.when(day % 7 == 0, F.col("level") + 1).when(day == 3, None).otherwise(F.col("level"))
    old = bars.where(day % 5 != 0).withColumn("level", level).withColumn("fetched_at_utc", F.lit("2026-01-01").cast("timestamp"))
    return old, bars.where(day % 11 != 0).withColumn("fetched_at_utc", F.lit("2026-01-02").cast("timestamp"))


@register("frame_diff", f"""WITH {_SIDES} SELECT n.series_id, n.observation_date, n.level, CASE WHEN o.series_id IS NULL THEN 'insert' WHEN n.level IS NOT DISTINCT FROM o.level THEN 'unchanged' ELSE 'revision' END AS change_type
FROM new n LEFT JOIN old o USING (series_id, observation_date)""")
def frame_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (x.drop("fetched_at_utc") for x in _sides(spark, sf_dir))
    return frames.frame_diff(old, new, KEYS)


@register("merge_upsert", f"WITH {_SIDES} SELECT {O.KEYS}, level, fetched_at_utc FROM new UNION ALL SELECT {O.KEYS}, level, fetched_at_utc FROM old ANTI JOIN new USING (series_id, observation_date)")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.merge_upsert(*_sides(spark, sf_dir), KEYS)


@register("stable_fetched_at", f"""WITH {_SIDES} SELECT n.series_id, n.observation_date, n.level, CASE WHEN o.series_id IS NOT NULL AND n.level IS NOT DISTINCT FROM o.level THEN o.fetched_at_utc ELSE n.fetched_at_utc END AS fetched_at_utc
FROM new n LEFT JOIN old o USING (series_id, observation_date)""")
def stable_fetched_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.stable_audit(*_sides(spark, sf_dir), KEYS, "fetched_at_utc")


@register("changed_months", f"""WITH {_SIDES} SELECT DISTINCT n.series_id, CAST(year(n.observation_date) AS INTEGER) AS year, CAST(month(n.observation_date) AS INTEGER) AS month FROM new n LEFT JOIN old o USING (series_id, observation_date)
WHERE o.series_id IS NULL OR n.level IS DISTINCT FROM o.level""")
def changed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (x.drop("fetched_at_utc") for x in _sides(spark, sf_dir))
    return frames.changed_months(frames.frame_diff(old, new, KEYS))


@register("serving_upsert", f"""WITH {_SIDES}, c AS (SELECT {O.KEYS}, CASE WHEN day(observation_date) % 2 = 0 THEN level END AS level FROM new)
SELECT * FROM (SELECT {O.KEYS}, level FROM c UNION ALL SELECT {O.KEYS}, level FROM old ANTI JOIN c USING (series_id, observation_date)) WHERE level IS NOT NULL""")
def serving_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (x.drop("fetched_at_utc") for x in _sides(spark, sf_dir))
    return frames.serving_upsert(old, new.withColumn("level", F.when(F.dayofmonth("observation_date") % 2 == 0, F.col("level"))), KEYS)


def _cents(df: DataFrame) -> DataFrame:
    """Prices as whole cents, whose text is the same in any engine."""
    return df.select(*KEYS, F.round(F.col("level") * 100).cast("long").alias("cents"))


def _framed(tag: str, cell: str) -> str:
    return f"CASE WHEN {cell} IS NULL THEN 'N' ELSE '{tag}' || length(CAST({cell} AS VARCHAR)) || ':' || CAST({cell} AS VARCHAR) END"


def _digest_sql(day: str = "observation_date") -> str:
    cents = "CAST(round(level * 100) AS BIGINT)"
    return f"sha256('9:series_id' || {_framed('S', 'series_id')} || '16:observation_date' || {_framed('D', day)} || '5:cents' || {_framed('I', cents)})"


_DIGEST = _digest_sql()


def _digests(df: DataFrame) -> DataFrame:
    return delta.row_digest(_cents(df), KEYS, ["cents"])


@register("row_digest", f"WITH {_SIDES} SELECT {O.KEYS}, {_DIGEST} AS row_sha256 FROM old")
def row_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(_sides(spark, sf_dir)[0])


def _framed_number(cell: str) -> str:
    text = f"CASE WHEN {cell} = 0 THEN '0.0' ELSE CAST({cell} AS VARCHAR) END"
    return f"'{len(cell)}:{cell}' || CASE WHEN {cell} IS NULL THEN 'N' ELSE 'F' || (1 + length({text})) || ':F' || {text} END"


#: Numbers below 10^7, as prices are, have the same shortest text in both engines.
_EXACT = f"sha256('9:series_id' || {_framed('S', 'series_id')} || '16:observation_date' || {_framed('D', 'observation_date')} || {' || '.join(map(_framed_number, ('open', 'high', 'low', 'close', 'level')))})"


@register("row_digest_exact", f"WITH {O.BARS1} SELECT {O.KEYS}, {_EXACT} AS row_sha256 FROM b")
def row_digest_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.row_digest(bars_by_priority(spark, sf_dir), KEYS, ["open", "high", "low", "close", "level"])


@register("delta_plan", f"""WITH {_SIDES}, s AS (SELECT {O.KEYS}, {_DIGEST} AS x FROM new), t AS (SELECT {O.KEYS}, {_DIGEST} AS y FROM old)
SELECT {O.KEYS}, CASE WHEN y IS NULL THEN 'insert' WHEN x IS NULL THEN 'delete' WHEN x = y THEN 'unchanged' ELSE 'update' END AS change_type FROM s FULL OUTER JOIN t USING (series_id, observation_date)""")
def delta_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _sides(spark, sf_dir)
    return delta.delta_plan(_digests(new), _digests(old), KEYS)


@register("delta_verify", f"WITH {_SIDES} SELECT count(*) AS n_rows, 0 AS n_mismatches FROM new")
def delta_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (x.drop("fetched_at_utc") for x in _sides(spark, sf_dir))
    after = delta.apply_delta(old, new, delta.delta_plan(_digests(new), _digests(old), KEYS), KEYS)
    wrong = delta.digest_mismatches(_digests(new), _digests(after), KEYS).agg(F.count("*").cast("int").alias("n_mismatches"))
    return after.agg(F.count("*").alias("n_rows")).crossJoin(wrong)  # two relations of one row


@register("target_summary", f"WITH {_SIDES} SELECT count(*) AS n_rows, min(observation_date) AS first_key, max(observation_date) AS last_key FROM old WHERE level IS NOT NULL")
def target_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.target_summary(_sides(spark, sf_dir)[0], "observation_date", ["level"])


@register("input_signature", f"""WITH {O.BARS1}, d AS (SELECT {O.KEYS}, {_DIGEST} AS x FROM b) SELECT series_id, count(*) AS n_rows, min(observation_date) AS first_date, max(observation_date) AS last_date,
sha256(string_agg(CAST(observation_date AS VARCHAR) || ':' || x, ',' ORDER BY observation_date)) AS signature FROM d GROUP BY series_id""")
def input_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.input_signature(_cents(bars_by_priority(spark, sf_dir)), "series_id", "observation_date", ["cents"])


# catalog of builds --------------------------------------------------------------------------------------------------

_BUILDS = "k AS (SELECT o_orderkey AS build_id, CAST(o_custkey % 3 + 9 AS INTEGER) AS schema_version, CAST(o_custkey % 2 + 5 AS INTEGER) AS feature_version, CASE WHEN o_orderkey % 4 = 0 THEN 'failed' ELSE 'complete' END AS status, CAST(o_orderdate AS TIMESTAMP) AS completed_at_utc FROM orders)"


def _builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    status = F.when(F.col("o_orderkey") % 4 == 0, "failed").otherwise("complete").alias("status")
    return orders.select(F.col("o_orderkey").alias("build_id"), (F.col("o_custkey") % 3 + 9).cast("int").alias("schema_version"), (F.col("o_custkey") % 2 + 5).cast("int").alias("feature_version"), status, F.col("o_orderdate").cast("timestamp").alias("completed_at_utc"))


@register("retention_select", f"""WITH {_BUILDS}, r AS (SELECT *, row_number() OVER (PARTITION BY schema_version, feature_version ORDER BY completed_at_utc DESC, build_id DESC) AS place FROM k WHERE status = 'complete')
SELECT build_id, schema_version, feature_version FROM r WHERE place > 5""")
def retention_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.superseded_builds(_builds(spark, sf_dir), keep=5).select("build_id", "schema_version", "feature_version")


@register("latest_compatible", f"WITH {_BUILDS} SELECT build_id, schema_version, feature_version FROM k WHERE status = 'complete' AND schema_version >= 10 AND feature_version = 6 ORDER BY completed_at_utc DESC, build_id DESC LIMIT 1")
def latest_compatible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.latest_compatible(_builds(spark, sf_dir), least_schema=10, feature_version=6).select("build_id", "schema_version", "feature_version")


@register("fetch_windows", f"""WITH {O.BARS2}, {O.UNITS}, m AS (SELECT series_id, max(observation_date) AS d FROM b WHERE series_id <> 'move' GROUP BY series_id)
SELECT u.series_id, CASE WHEN d IS NULL THEN 'bootstrap' ELSE 'update' END AS mode, coalesce(CASE WHEN u.provider IN ('Yahoo', 'ECB', 'FRED') THEN CAST(d - 7 AS VARCHAR) END, 'all') AS request_from, coalesce(CAST(d - 7 AS VARCHAR), 'all') AS first_date, DATE '2026-01-01' AS last_date
FROM u LEFT JOIN m USING (series_id)""")
def fetch_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = spark.createDataFrame([(s.series_id, s.fetch) for s in REGISTRY], "series_id string, fetch string")
    out = lake.fetch_windows(registry, bars_by_nation(spark, sf_dir).where("series_id <> 'move'"), "2026-01-01")
    return out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("all")) for c in ("request_from", "first_date")})


@register("conformance_report", f"""WITH {_LONG_CTE}, x AS (SELECT *, observation_date + CASE isodow(observation_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS available FROM n)
SELECT 'null_key' AS check, count(*) FILTER (series_id IS NULL OR observation_date IS NULL OR feature IS NULL) AS violations FROM x
UNION ALL SELECT 'not_finite', count(*) FILTER (value IS NULL OR isnan(value) OR isinf(value)) FROM x UNION ALL SELECT 'unknown_feature', count(*) FILTER (feature = 'roc_8obs') FROM x
UNION ALL SELECT 'available_too_early', count(*) FILTER (available <= observation_date) FROM x UNION ALL SELECT 'available_on_weekend', count(*) FILTER (isodow(available) > 5) FROM x
UNION ALL SELECT 'duplicate_key', count(*) FROM (SELECT 1 FROM x GROUP BY series_id, observation_date, feature HAVING count(*) > 1)""")
def conformance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _long(spark, sf_dir).withColumn("available_at_utc", next_weekday("observation_date"))
    return frames.conformance_report(long, [n for n in catalog.LEVEL_NAMES if n != "roc_8obs"])


# verification -------------------------------------------------------------------------------------------------------

#: What a published copy has differently, so that there is something to find: values off by 1, values off within the
#: tolerance, rows that are missing, and rows of days that don't exist.
_PUBLISHED = """a AS (SELECT observation_date, feature_name, CASE WHEN day(observation_date) = 5 AND (ends_with(feature_name, '_log_return_5obs') OR ends_with(feature_name, '_ratio')) THEN value + 1
    WHEN day(observation_date) = 6 THEN value * CAST(1.000000000001 AS DOUBLE) ELSE value END AS value FROM c WHERE NOT ends_with(feature_name, '_roc_8obs') OR day(observation_date) <> 13
    UNION ALL SELECT observation_date + 20000, feature_name, value FROM c WHERE ends_with(feature_name, '_log_level') AND day(observation_date) = 17)"""


def _published(long: DataFrame) -> DataFrame:
    day, name, value = F.dayofmonth("observation_date"), F.col("feature_name"), F.col("value")
    off = F.when((day == 5) & (name.endswith("_log_return_5obs") | name.endswith("_ratio")), value + 1).when(day == 6, value * 1.000000000001).otherwise(value)
    kept = F.when(~name.endswith("_roc_8obs") | (day != 13), F.struct(F.col("observation_date").alias("d"), off.alias("v")))
    more = F.when(name.endswith("_log_level") & (day == 17), F.struct(F.date_add("observation_date", 20000).alias("d"), value.alias("v")))
    return long.select("feature_name", F.explode(F.array_compact(F.array(kept, more))).alias("r")).select(F.col("r.d").alias("observation_date"), "feature_name", F.col("r.v").alias("value"))


@register("value_reconciliation", f"""WITH {_CATALOG_CTE}, {_PUBLISHED}, e AS (SELECT observation_date, feature_name, value FROM c),
j AS (SELECT feature_name, e.value AS e, a.value AS a, e.feature_name IS NOT NULL AS in_e, a.feature_name IS NOT NULL AS in_a FROM e FULL OUTER JOIN a USING (observation_date, feature_name)),
v AS (SELECT coalesce(series_id, 'cross_series') AS family, feature_name, count(*) FILTER (in_e) AS ne, count(*) FILTER (in_a) AS na, count(*) FILTER (NOT in_a) AS missing, count(*) FILTER (NOT in_e) AS surplus,
    count(*) FILTER (in_e AND in_a AND NOT abs(e - a) <= 1e-12 + 1e-10 * abs(a)) AS different, max(abs(e - a)) AS error FROM j LEFT JOIN k USING (feature_name) GROUP BY ALL)
SELECT family, CAST(sum(ne) AS BIGINT) AS expected_rows, CAST(sum(na) AS BIGINT) AS actual_rows, CAST(sum(missing) AS BIGINT) AS n_missing, CAST(sum(surplus) AS BIGINT) AS n_surplus, CAST(0 AS BIGINT) AS n_repeated,
    CAST(sum(different) AS BIGINT) AS n_different, count(*) FILTER (ne <> na) AS n_features_off, round(max(error), 4) AS largest_error FROM v GROUP BY family""")
def value_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole published catalog against a recomputation, by group."""
    long = macro_features_long(spark, sf_dir).select("observation_date", "feature_name", "value")
    groups = catalog.catalog_table(spark).select("feature_name", F.when(F.col("series_id") == "", "cross_series").otherwise(F.col("series_id")).alias("family"))
    out = verify.reconcile_values(long, _published(long), groups, ["observation_date", "feature_name"])
    return out.withColumn("largest_error", F.round("largest_error", 4))


@register("catalog_parity", f"""WITH {_CATALOG_CTE}, x AS (SELECT CASE WHEN ends_with(feature_name, '_sma_ratio_5_15') THEN feature_name || '_old' ELSE feature_name END AS feature_name FROM c),
known AS (SELECT feature_name FROM k UNION ALL SELECT unnest([{', '.join(f"'{n}'" for n in catalog.CROSS)}])), n AS (SELECT feature_name, count(*) AS n_rows FROM x GROUP BY feature_name)
SELECT coalesce(n.feature_name, known.feature_name) AS feature_name, CASE WHEN known.feature_name IS NULL THEN 'unknown' ELSE 'absent' END AS difference, coalesce(n_rows, 0) AS n_rows
FROM n FULL OUTER JOIN known ON n.feature_name = known.feature_name WHERE n.feature_name IS NULL OR known.feature_name IS NULL""")
def catalog_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table in which one family has another name."""
    name = F.col("feature_name")
    return catalog.catalog_parity(macro_features_long(spark, sf_dir).select(F.when(name.endswith("_sma_ratio_5_15"), F.concat(name, F.lit("_old"))).otherwise(name).alias("feature_name")))


@register("feature_histogram", f"""WITH {_CATALOG_CTE}, s AS (SELECT feature_name, min(value) AS lo, max(value) AS hi, count(*) AS n FROM c GROUP BY feature_name),
w AS (SELECT feature_name, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi, CAST(least(30, greatest(5, floor(sqrt(n)))) AS INTEGER) AS n_bins FROM s),
p AS (SELECT feature_name, least(CAST(floor((value - lo) / (hi - lo) * n_bins) AS INTEGER), n_bins - 1) AS bin, n_bins, lo, hi FROM c JOIN w USING (feature_name))
SELECT feature_name, bin, n_bins, round(lo + (hi - lo) * bin / n_bins, 9) AS from_value, round(lo + (hi - lo) * (bin + 1) / n_bins, 9) AS to_value, count(*) AS n FROM p GROUP BY ALL""")
def feature_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = frames.feature_histogram(macro_features_long(spark, sf_dir), "feature_name")
    return out.withColumns({c: F.round(c, 9) for c in ("from_value", "to_value")})


_DUE = "CAST(observation_date + CASE isodow(observation_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS TIMESTAMP)"


@register("availability_report", f"""WITH {O.BARS2}, x AS (SELECT observation_date, {_DUE} AS due, CASE day(observation_date) WHEN 9 THEN {_DUE} + INTERVAL 1 DAY WHEN 10 THEN {_DUE} - INTERVAL 3 DAY WHEN 11 THEN NULL
    WHEN 12 THEN {_DUE} + INTERVAL 6 HOUR ELSE {_DUE} END AS given FROM b),
y AS (SELECT observation_date, given, CASE WHEN given IS NULL THEN 'absent' WHEN given < due THEN 'early' WHEN given >= due + INTERVAL 1 DAY THEN 'late' WHEN given > due THEN 'time' END AS difference FROM x)
SELECT observation_date, difference, count(*) AS n_rows, min(given) AS least, max(given) AS most FROM y WHERE difference IS NOT NULL GROUP BY ALL""")
def availability_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    due, day = next_weekday("observation_date"), F.dayofmonth("observation_date")
    at = F.when(day == 9, due + F.expr("interval 1 day")).when(day == 10, due - F.expr("interval 3 days")).when(day == 12, due + F.expr("interval 6 hours")).when(day != 11, due)
    return verify.availability_differences(bars_by_nation(spark, sf_dir).select("observation_date", at.alias("available_at_utc")))


#: The columns that the registered queries read, in the order in which they are declared.
_DECLARED = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_orderdate timestamp, o_totalprice double, o_channel string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_linenumber bigint, l_linestatus string",
}
_SPARK_TYPES = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'SMALLINT' THEN 'smallint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE lower(column_type) END"


@register("schema_report", f"""WITH d("table", position, "column", type) AS (VALUES {', '.join(f"('{t}', {i + 1}, '{c.split(' ')[0]}', '{c.split(' ')[1]}')" for t, columns in _DECLARED.items() for i, c in enumerate(columns.split(', ')))}),
a AS ({' UNION ALL '.join(f"""SELECT '{t}' AS "table", CAST(row_number() OVER () AS INTEGER) AS position, column_name AS "column", {_SPARK_TYPES} AS type FROM (DESCRIBE SELECT * FROM {t})""" for t in _DECLARED)}),
j AS (SELECT "table", "column", d.position AS dp, a.position AS ap, d.type AS dt, a.type AS ty FROM d FULL OUTER JOIN a USING ("table", "column"))
SELECT "table", "column", 'missing' AS difference, dt AS declared, NULL AS actual FROM j WHERE ty IS NULL UNION ALL SELECT "table", "column", 'surplus', NULL, ty FROM j WHERE dt IS NULL
UNION ALL SELECT "table", "column", 'type', dt, ty FROM j WHERE dt <> ty UNION ALL SELECT "table", "column", 'position', CAST(dp AS VARCHAR), CAST(ap AS VARCHAR) FROM j WHERE dp <> ap""")
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = [verify.schema_table(spark, spark.createDataFrame([], columns).schema, t) for t, columns in _DECLARED.items()]
    actual = [verify.schema_table(spark, spark.read.parquet(f"{sf_dir}/{t}.parquet").schema, t) for t in _DECLARED]
    union = lambda x: x[0].unionByName(x[1]).unionByName(x[2])
    return verify.schema_differences(union(declared), union(actual))


@register("agreement_report", f"""WITH {_SIDES}, s AS (SELECT {O.KEYS}, {_DIGEST} AS x FROM new WHERE series_id = '1-URGENT'), t AS (SELECT {O.KEYS}, {_DIGEST} AS y FROM old WHERE series_id = '1-URGENT'),
i AS (SELECT observation_date, CASE WHEN day(observation_date) = 2 THEN 'x' ELSE x END AS z FROM s)
SELECT 'digest_index' AS check, count(*) AS violations FROM s FULL OUTER JOIN i USING (observation_date) WHERE x IS DISTINCT FROM z
UNION ALL SELECT 'consumer', count(*) FROM s FULL OUTER JOIN t USING (observation_date) WHERE x IS DISTINCT FROM y
UNION ALL SELECT 'summary', CAST((SELECT count(*) FROM t) IS DISTINCT FROM (SELECT count(*) FROM s) AS BIGINT) + CAST((SELECT min(observation_date) FROM t) IS DISTINCT FROM (SELECT min(observation_date) FROM s) AS BIGINT)
    + CAST((SELECT max(observation_date) FROM t) IS DISTINCT FROM (SELECT max(observation_date) FROM s) AS BIGINT)
UNION ALL SELECT 'state', 0""")
def agreement_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of one dataset (the urgent orders' series) that is some days behind, with an index that is wrong on some days."""
    old, new = (_digests(x.where("series_id = '1-URGENT'")).drop("series_id") for x in _sides(spark, sf_dir))
    index = new.withColumn("row_sha256", F.when(F.dayofmonth("observation_date") == 2, "x").otherwise(F.col("row_sha256")))
    summary = new.agg(F.count("*").alias("n_rows"), F.min("observation_date").alias("first_key"), F.max("observation_date").alias("last_key"))
    return verify.agreement_report(new, index, old, summary, "observation_date", summary.first().asDict())


# versions, states and builds ----------------------------------------------------------------------------------------

_STATES = """st AS (SELECT o_orderkey, CAST(nullif(o_custkey % 12, 0) AS INTEGER) AS ps, CAST(1 + o_custkey % 6 AS INTEGER) AS pf, CAST(1 + o_orderkey % 11 AS INTEGER) AS s, CAST(1 + (o_orderkey // 11 + o_custkey) % 6 AS INTEGER) AS f FROM orders)"""
_ALLOWED = ", ".join(f"({', '.join(map(str, t))}, {str(t in versions.COALESCING).lower()})" for t in (*versions.KEEPING, *versions.STEPS, *versions.COALESCING))


@register("version_gate", f"""WITH RECURSIVE t(a, b, c, d, free) AS (VALUES {_ALLOWED}),
r AS (SELECT a, b, c, d, 1 AS n, true AS once, free FROM t UNION ALL SELECT r.a, r.b, t.c, t.d, n + 1, r.free AND t.free, r.free AND t.free FROM r JOIN t ON r.c = t.a AND r.d = t.b),
m AS (SELECT a, b, c, d, min(n) AS n, bool_or(once) AS once FROM r GROUP BY a, b, c, d), {_STATES}
SELECT o_orderkey, CASE WHEN ps IS NULL THEN 'new' WHEN ps = s AND pf = f THEN 'same' WHEN once THEN 'upgrade' WHEN n > 0 THEN 'stepwise' ELSE 'refused' END AS verdict,
    CASE WHEN ps IS NULL OR (ps = s AND pf = f) THEN 0 ELSE n END AS n_steps FROM st LEFT JOIN m ON ps = a AND pf = b AND s = c AND f = d""")
def version_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of each order's versions, and whether those of the build may follow them."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    states = orders.selectExpr(
        "o_orderkey", "cast(nullif(o_custkey % 12, 0) as int) as prior_schema", "cast(1 + o_custkey % 6 as int) as prior_feature",
        "cast(1 + o_orderkey % 11 as int) as schema_version", "cast(1 + (o_orderkey div 11 + o_custkey) % 6 as int) as feature_version",
    )
    return versions.version_gate(states, versions.transitions(spark)).select("o_orderkey", "verdict", "n_steps")


_RUNS = """runs AS (SELECT o_orderpriority AS series_id, o_orderkey AS run_id, CAST(o_orderdate AS TIMESTAMP) AS committed_at_utc, CASE o_custkey % 5 WHEN 0 THEN 'reconcile' WHEN 1 THEN 'bootstrap' ELSE 'update' END AS mode,
    CAST(o_orderdate AS DATE) - 1 AS last_observed_date, CASE WHEN o_custkey % 2 = 0 THEN CAST(o_orderdate AS DATE) - 7 END AS filter_start, CASE WHEN o_custkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) - 30 END AS request_start,
    CAST(o_orderdate AS DATE) AS request_end, o_custkey % 100 AS fetched_rows, o_custkey % 50 AS accepted_rows, o_custkey % 7 AS changed_rows FROM orders),
durable AS (SELECT * FROM runs SEMI JOIN (SELECT l_orderkey AS run_id FROM lineitem WHERE l_linestatus = 'F') USING (run_id))"""
_STATE_SQL = "committed_at_utc AS last_success_utc, last_observed_date, coalesce(filter_start, request_start) AS last_requested_start, request_end AS last_requested_end, mode, fetched_rows, accepted_rows, changed_rows"
_SO_FAR = "OVER (PARTITION BY series_id ORDER BY committed_at_utc, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_HISTORY_SQL = f"SELECT series_id, run_id, {_STATE_SQL}, last_value(CASE WHEN mode = 'reconcile' THEN committed_at_utc END IGNORE NULLS) {_SO_FAR} AS last_reconcile_utc FROM durable"


def _runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A run for each order; the manifest of one is durable if a line of it is shipped."""
    day = F.to_date("o_orderdate")
    mode = F.when(F.col("o_custkey") % 5 == 0, "reconcile").when(F.col("o_custkey") % 5 == 1, "bootstrap").otherwise("update")
    runs = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").cast("timestamp").alias("committed_at_utc"), mode.alias("mode"), F.date_sub(day, 1).alias("last_observed_date"),
        F.when(F.col("o_custkey") % 2 == 0, F.date_sub(day, 7)).alias("filter_start"), F.when(F.col("o_custkey") % 3 != 0, F.date_sub(day, 30)).alias("request_start"), day.alias("request_end"),
        (F.col("o_custkey") % 100).alias("fetched_rows"), (F.col("o_custkey") % 50).alias("accepted_rows"), (F.col("o_custkey") % 7).alias("changed_rows"),
    )
    return runs, spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("run_id"))


@register("ingestion_state_history", f"WITH {_RUNS} {_HISTORY_SQL}")
def ingestion_state_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingestion.state_history(*_runs(spark, sf_dir))


@register("ingestion_state", f"WITH {_RUNS}, h AS ({_HISTORY_SQL}) SELECT * EXCLUDE (run_id) FROM h QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY last_success_utc DESC, run_id DESC) = 1")
def ingestion_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states after the runs up to 1994, advanced by all others."""
    runs, manifests = _runs(spark, sf_dir)
    prior = spark.createDataFrame([], ingestion.STATES)
    for part in ("committed_at_utc < '1995-01-01'", "committed_at_utc >= '1995-01-01'"):
        prior = ingestion.advance_states(prior, runs.where(part), manifests)
    return prior


_DATASETS = _BUILDS.replace("k AS (SELECT ", "k AS (SELECT o_custkey AS dataset_id, coalesce(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 + o_custkey % 3 OR (o_custkey % 10 = 0 AND o_orderkey % 2 = 0), false) AS is_current, ")


@register("build_resolution", f"""WITH {_DATASETS}, x AS (SELECT *, status = 'complete' AS done, schema_version >= 10 AND feature_version = 6 AS ok FROM k),
g AS (SELECT dataset_id, count(*) FILTER (is_current) AS n, max(build_id) FILTER (is_current) AS cur, bool_or(is_current AND done) AS done, bool_or(is_current AND done AND ok) AS good,
    arg_max(build_id, (completed_at_utc, build_id)) FILTER (done AND ok) AS newest FROM x GROUP BY dataset_id)
SELECT dataset_id, CASE WHEN n = 1 AND good THEN cur END AS strict_build, CASE WHEN n = 0 THEN 'no current' WHEN n > 1 THEN 'several current' WHEN NOT done THEN 'not complete' WHEN NOT good THEN 'not compatible' ELSE 'current' END AS strict_reason,
    CASE WHEN n > 1 THEN NULL WHEN n = 1 AND good THEN cur ELSE newest END AS latest_build, CASE WHEN n > 1 THEN 'several current' WHEN n = 1 AND good THEN 'current' WHEN newest IS NOT NULL THEN 'newest' ELSE 'none' END AS latest_reason FROM g""")
def build_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset for each customer, with a build for each order."""
    place = F.row_number().over(Window.partitionBy("dataset_id").orderBy("build_id"))
    rows = _builds(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("build_id"), F.col("o_custkey").alias("dataset_id")), "build_id")
    current = (place == 1 + F.col("dataset_id") % 3) | ((F.col("dataset_id") % 10 == 0) & (F.col("build_id") % 2 == 0))
    return lake.resolutions(rows.withColumn("is_current", current), 10, 6, ["dataset_id"])


@register("silver_upsert", f"""{_SILVER_SQL.replace(' SELECT observation_date, series_id, close AS value', ', v AS (SELECT observation_date, series_id, close AS value', 1).replace(' AS fetched_at_utc FROM b', ' AS fetched_at_utc, native_shape FROM b')}),
o AS (SELECT * EXCLUDE (native_shape) FROM v WHERE day(observation_date) % 5 <> 0), n AS (SELECT * EXCLUDE (native_shape)
    REPLACE (CASE WHEN day(observation_date) % 7 = 0 AND native_shape <> 'ohlc' THEN value + 1 ELSE value END AS value, TIMESTAMP '2026-02-02 00:00:00' AS fetched_at_utc) FROM v WHERE day(observation_date) % 11 <> 0)
SELECT n.* REPLACE (CASE WHEN o.series_id IS NOT NULL AND o.value IS NOT DISTINCT FROM n.value THEN o.fetched_at_utc ELSE n.fetched_at_utc END AS fetched_at_utc) FROM n LEFT JOIN o USING (series_id, observation_date)
UNION ALL BY NAME SELECT * FROM o ANTI JOIN n USING (series_id, observation_date)""")
def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical table after observations were fetched again, some of them revised; bars take their value from the close."""
    day = F.dayofmonth("observation_date")
    silver = _silver(spark, sf_dir).where(day % 5 != 0)
    units = spark.createDataFrame([(s.series_id, s.native_shape, s.unit, s.provider) for s in REGISTRY], "series_id string, native_shape string, unit string, provider string")
    value = F.when(day % 7 == 0, F.col("level") + 1).otherwise(F.col("level"))
    bronze = bars_by_nation(spark, sf_dir).where(day % 11 != 0).withColumn("value", value).withColumn("source_id", F.concat(F.lit("src:"), "series_id")).withColumn("fetched_at_utc", F.lit("2026-02-02").cast("timestamp"))
    return ingestion.silver_upsert(silver, bronze, units)[0]
