"""Feature families over daily series, as columns of one plan partitioned by series_id.

Three notions of the previous row are kept apart: rows with a level (lags and most windows), all rows including those of
null level (EMA and MACD), and the rows valid for a family (bar means, z-scores, return pairs, stochastics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import correlation, finite, log_ratio, ordered, positive, ratio, sample_zscore, trailing, when_complete
from tidemark.operators.recurrences import RSI_PERIODS, with_states

# Lags, windows and names of the published features.
LAGS = (1, 2, 3, 4, 5, 8, 10, 20)
DELTA_LAGS = (1, 5, 20)
MEAN_WINDOWS = (5, 10, 20)
GEOMETRIC_WINDOWS = (4, 5, 8, 10, 16, 20)
VOLATILITY_WINDOWS = (5, 8, 10, 20, 32, 40, 96)
SMA_PAIRS = ((5, 15), (5, 20), (10, 20), (10, 40))
DRAWDOWN_WINDOWS = (20, 32, 60, 96)
CHANGE_CORRELATIONS = ((1, 60), (5, 60), (20, 120))
RETURN_CORRELATIONS = ((1, 96), (4, 96), (8, 192))
KEYS = ("series_id", "observation_date")


def with_lags(bars: DataFrame) -> DataFrame:
    """Rows with a level, with lag_k, change, its lags, and log returns lr_k."""
    rows = bars.where("level is not null")
    rows = rows.withColumns({f"lag_{k}": F.lag("level", k).over(ordered()) for k in LAGS})
    rows = rows.withColumn("change", F.col("level") - F.col("lag_1")).withColumns({f"lr_{k}": log_ratio("level", f"lag_{k}") for k in LAGS})
    return rows.withColumns({f"change_lag_{k}": F.lag("change", k).over(ordered()) for k in DELTA_LAGS} | {f"lr1_lag_{k}": F.lag("lr_1", k).over(ordered()) for k, _ in RETURN_CORRELATIONS})


def level_features() -> dict[str, Column]:
    """Features over with_lags that need no state: by name without the series."""
    level = F.col("level")
    out = {"log_level": F.when(positive("level"), F.ln("level"))}
    out |= {f"delta_{k}obs": level - F.col(f"lag_{k}") for k in DELTA_LAGS}
    deviation = F.stddev_pop("level").over(trailing(60))
    out["zscore_60obs"] = when_complete("level", 60, ratio(level - F.avg("level").over(trailing(60)), deviation))
    for k, n in CHANGE_CORRELATIONS:
        there = (F.count("change").over(trailing(n)) == n) & (F.count(f"change_lag_{k}").over(trailing(n)) == n)
        both = correlation("change", f"change_lag_{k}", trailing(n))
        out[f"momentum_autocorr_{k}_{n}obs"] = F.when(there & both.isNotNull(), F.greatest(both, F.lit(0.0)))
    out |= {f"log_return_{k}obs": F.col(f"lr_{k}") for k in LAGS}
    out |= {f"return_geom_{n}obs_pct": when_complete("lr_1", n, F.exp(F.sum("lr_1").over(trailing(n))) - 1) for n in GEOMETRIC_WINDOWS}
    out |= {f"return_mean_{n}obs": when_complete("lr_1", n, F.avg("lr_1").over(trailing(n))) for n in MEAN_WINDOWS}
    out |= {f"volatility_{n}obs": when_complete("lr_1", n, F.stddev_samp("lr_1").over(trailing(n))) for n in VOLATILITY_WINDOWS}
    out |= {f"sma_ratio_{a}_{b}": when_complete("level", b, ratio(F.avg("level").over(trailing(a)), F.avg("level").over(trailing(b)))) for a, b in SMA_PAIRS}
    roc = {k: F.when(positive("level", f"lag_{k}"), ratio("level", f"lag_{k}") - 1) for k in LAGS}
    out |= {f"roc_{k}obs": x for k, x in roc.items()}
    out["roc_acceleration_4_8"] = roc[4] - roc[8]
    out |= {f"drawdown_{n}obs": when_complete("level", n, ratio("level", F.max("level").over(trailing(n))) - 1) for n in DRAWDOWN_WINDOWS}
    return out


def with_valid_only(rows: DataFrame) -> DataFrame:
    """``rows`` (of with_lags) with the features whose windows hold valid rows alone.

    A window partitioned by validity, too, is the window over the filtered rows, without a join back.
    """
    volatility = when_complete("lr_1", 8, F.stddev_samp("lr_1").over(trailing(8)))
    rows = rows.withColumn("_vol8", volatility).withColumns({"_v": F.col("_vol8").isNotNull(), "_p": F.coalesce(positive("level"), F.lit(False))})
    rows = rows.withColumn("volatility_zscore_96", F.when(F.col("_v"), sample_zscore("_vol8", 96, "_v")))
    rows = rows.withColumn("level_zscore_96", F.when(F.col("_p"), sample_zscore("level", 96, "_p")))
    for k, n in RETURN_CORRELATIONS:
        rows = rows.withColumn("_b", F.col("lr_1").isNotNull() & F.col(f"lr1_lag_{k}").isNotNull())
        value = F.when(F.col("_b"), when_complete("lr_1", n, correlation("lr_1", f"lr1_lag_{k}", trailing(n, "_b")), "_b"))
        rows = rows.withColumn(f"momentum_autocorr_lag{k}_window{n}", value)
    return rows.drop("_vol8", "_v", "_p", "_b")


VALID_ONLY = ("volatility_zscore_96", "level_zscore_96", *(f"momentum_autocorr_lag{k}_window{n}" for k, n in RETURN_CORRELATIONS))


def with_rsi(rows: DataFrame) -> DataFrame:
    """Rows with a level of with_states, with rsi_n; lags over them count such rows."""
    number = F.row_number().over(ordered())
    rows = rows.where("level is not null").withColumn("_number", number)
    for n in RSI_PERIODS:
        gain, loss = F.col(f"avg_gain_{n}"), F.col(f"avg_loss_{n}")
        value = F.when((gain == 0) & (loss == 0), None).when(loss == 0, 100.0).otherwise(100 - 100 / (1 + ratio(gain, loss)))
        rows = rows.withColumn(f"rsi_{n}obs", F.when((F.col("_number") >= n + 1) & gain.isNotNull() & loss.isNotNull(), value))
    return rows.drop("_number")


def rsi_features() -> dict[str, Column]:
    rsi = F.col("rsi_5obs")
    return {f"rsi_{n}obs": F.col(f"rsi_{n}obs") for n in RSI_PERIODS if n != 15} | {
        "rsi_ratio_5_15": ratio(rsi, "rsi_15obs"),
        "rsi5_slope_3": (rsi - F.lag(rsi, 3).over(ordered())) / 3,
        "rsi5_delta_1": rsi - F.lag(rsi, 1).over(ordered()),
    }


def trend_features() -> dict[str, Column]:
    """EMA and MACD features over all rows of with_states."""
    level, fast, slow = F.col("level"), F.col("ema_5"), F.col("ema_9")
    above = F.when(positive("level"), level)
    was_fast, was_slow = F.lag(fast, 1).over(ordered()), F.lag(slow, 1).over(ordered())
    known = fast.isNotNull() & slow.isNotNull() & was_fast.isNotNull() & was_slow.isNotNull()
    line = F.col("ema_12") - F.col("ema_26")
    histogram = ratio(line - F.col("macd_signal"), above)
    return {f"ema{n}_distance": ratio(above, f"ema_{n}") - 1 for n in (5, 9, 21)} | {
        "ema5_ema21_spread": ratio(fast - F.col("ema_21"), above),
        "ema9_slope_3": ratio(slow - F.lag(slow, 3).over(ordered()), 3 * above),
        "ema5_ema9_cross": F.when(known, F.when((fast > slow) & (was_fast <= was_slow), 1.0).when((fast < slow) & (was_fast >= was_slow), -1.0).otherwise(0.0)),
        "macd_line_relative": ratio(line, above),
        "macd_hist_relative": histogram,
    }


def with_trend(rows: DataFrame) -> DataFrame:
    rows = rows.withColumns(trend_features())
    return rows.withColumn("macd_hist_delta_3", F.col("macd_hist_relative") - F.lag("macd_hist_relative", 3).over(ordered()))


# Names of the published features.
TREND = ("ema5_distance", "ema9_distance", "ema21_distance", "ema5_ema21_spread", "ema9_slope_3", "ema5_ema9_cross", "macd_line_relative", "macd_hist_relative", "macd_hist_delta_3")
RSI = ("rsi_3obs", "rsi_5obs", "rsi_7obs", "rsi_14obs", "rsi_ratio_5_15", "rsi5_slope_3", "rsi5_delta_1")
BAR = (
    "high_low_range_1obs", "high_low_range_5obs", "intraday_return_1obs", "intraday_return_5obs", "overnight_gap_1obs", "overnight_gap_5obs",
    "stoch_k_5", "stoch_k_14", "stoch_d_5_3", "stoch_d_14_3", "stoch_kd_spread_5", "stoch_k_slope_3", "donchian_breakout_up", "donchian_breakout_down",
)


def previous_close() -> Column:
    """The latest finite close strictly before the row: an as-of join as a window."""
    return F.last(F.when(finite("close"), F.col("close")), ignorenulls=True).over(ordered().rowsBetween(Window.unboundedPreceding, -1))


def with_bars(rows: DataFrame) -> DataFrame:
    """``rows`` (with open, high, low and close) with BAR; all rows count, also those without a level."""
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    rows = rows.withColumn("_pc", previous_close())
    metrics = {
        "high_low_range": F.when(finite(h) & finite(low) & finite(c) & (c > 0), (h - low) / c),
        "intraday_return": F.when(finite(c) & finite(o) & (o > 0), (c - o) / o),
        "overnight_gap": F.when(finite(o) & (F.col("_pc") > 0), (o - F.col("_pc")) / F.col("_pc")),
    }
    for name, metric in metrics.items():
        rows = rows.withColumn(f"{name}_1obs", F.when(finite(metric), metric)).withColumn("_v", F.col(f"{name}_1obs").isNotNull())
        mean = when_complete(f"{name}_1obs", 5, F.avg(f"{name}_1obs").over(trailing(5, "_v")), "_v")
        rows = rows.withColumn(f"{name}_5obs", F.when(F.col("_v"), mean))
    rows = rows.withColumn("_v", finite(o) & finite(h) & finite(low) & finite(c))
    for n in (5, 14):
        least, most = F.min(low).over(trailing(n, "_v")), F.max(h).over(trailing(n, "_v"))
        full = F.col("_v") & (F.count(c).over(trailing(n, "_v")) == n)
        rows = rows.withColumn(f"stoch_k_{n}", F.when(full, 100 * F.try_divide(c - least, most - least)))
    for n in (5, 14):
        rows = rows.withColumn(f"stoch_d_{n}_3", F.when(F.col("_v"), when_complete(f"stoch_k_{n}", 3, F.avg(f"stoch_k_{n}").over(trailing(3, "_v")), "_v")))
    rows = rows.withColumn("stoch_kd_spread_5", F.col("stoch_k_5") - F.col("stoch_d_5_3"))
    rows = rows.withColumn("stoch_k_slope_3", F.when(F.col("_v"), (F.col("stoch_k_5") - F.lag("stoch_k_5", 3).over(ordered("_v"))) / 3))
    before = ordered("_v").rowsBetween(-20, -1)
    full = F.col("_v") & (F.count(c).over(before) == 20)
    rows = rows.withColumn("donchian_breakout_up", F.when(full, h > F.max(h).over(before))).withColumn("donchian_breakout_down", F.when(full, low < F.min(low).over(before)))
    return rows.drop("_pc", "_v")


def bar_features(bars: DataFrame) -> DataFrame:
    """series_id, observation_date and BAR of every row."""
    return with_bars(bars.select(*KEYS, "open", "high", "low", "close")).select(*KEYS, *BAR)


def all_features(bars: DataFrame) -> DataFrame:
    """series_id, observation_date and every feature of a single series, in one plan over one partitioning.

    The recurrences come first, so their rows stay dealt out by series for all windows after them.
    """
    cells = bars.select(*KEYS, F.when(finite("level"), F.col("level")).alias("level"), "open", "high", "low", "close")
    rows = with_bars(with_trend(with_states(cells))).drop("open", "high", "low", "close")
    rows = with_valid_only(with_lags(with_rsi(rows)))
    singles = level_features() | rsi_features()
    return rows.select(*KEYS, *[x.alias(name) for name, x in singles.items()], *VALID_ONLY, *TREND, *BAR)
