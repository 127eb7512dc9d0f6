import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features
from tidemark.operators.recurrences import EMA_PERIODS, STATE_COLUMNS, scan, with_states, with_states_arrow


def bars(spark, levels, series="x"):
    day = date(2024, 1, 1)
    return spark.createDataFrame([(series, day + timedelta(days=i), v) for i, v in enumerate(levels)], "series_id string, observation_date date, level double")


def ema(xs, n, signed=False):
    """Directly by the definition: over the valid run up to each row."""
    out = []
    for t in range(len(xs)):
        run = []
        for x in reversed(xs[: t + 1]):
            if x is None or (x <= 0 and not signed):
                break
            run.insert(0, x)
        value = sum(run[:n]) / n if len(run) >= n else None
        for x in run[n:]:
            value += (x - value) * 2 / (n + 1)
        out.append(value)
    return out


RESET = [10.0] * 9 + [20.0] * 4 + [10.0] * 3 + [None] + [30.0] * 22 + [0.0] + [40.0] * 2 + [-1.0] + [50.0] * 24 + [1000.0, 2.0]


def collected(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("observation_date").collect()]


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=2e-10, abs_tol=2e-12))


@pytest.mark.parametrize("n", EMA_PERIODS)
def test_ema_seed_and_reset(spark, n):
    found = collected(with_states(bars(spark, RESET)), f"ema_{n}")
    assert all(close(a[0], b) for a, b in zip(found, ema(RESET, n), strict=True))


def test_macd_signal_allows_negative_lines_and_warms_up(spark):
    rnd = random.Random(3)
    xs = [100 * math.exp(rnd.gauss(0, 0.2)) for _ in range(80)]
    out = collected(features.with_trend(with_states(bars(spark, xs))), "macd_line_relative", "macd_hist_relative", "macd_hist_delta_3")
    line = [None if a is None or b is None else a - b for a, b in zip(ema(xs, 12), ema(xs, 26), strict=True)]
    assert any(v is not None and v < 0 for v in line)
    signal = ema(line, 9, signed=True)
    for i, (relative, histogram, delta) in enumerate(out):
        assert (relative is None) == (i < 25) and (histogram is None) == (i < 33) and (delta is None) == (i < 36)
        if histogram is not None:
            assert close(histogram, (line[i] - signal[i]) / xs[i])


def test_wilder_flat_rising_and_falling(spark):
    def rsi(xs):
        rows = features.with_rsi(with_states(bars(spark, xs)))
        return [v for (v,) in collected(rows, "rsi_3obs")]

    assert rsi([5.0] * 8) == [None] * 8
    assert rsi([float(i) for i in range(1, 9)]) == [None] * 3 + [100.0] * 5
    assert rsi([float(9 - i) for i in range(8)]) == [None] * 3 + [0.0] * 5


def test_series_do_not_touch_each_other_and_the_past_is_final(spark):
    xs = [float(10 + i % 7) for i in range(60)]
    both = bars(spark, xs).unionByName(bars(spark, [None, 5.0] * 40, "y"))
    alone = collected(with_states(bars(spark, xs)), *STATE_COLUMNS)
    assert collected(with_states(both).where("series_id = 'x'"), *STATE_COLUMNS) == alone
    longer = collected(with_states(bars(spark, [*xs, 1e9, 1e-9])), *STATE_COLUMNS)
    assert longer[:60] == alone


def test_single_stage_families_are_causal_and_guarded(spark):
    xs = [100.0 + (i * 37) % 11 for i in range(130)]
    xs[40], xs[41], xs[50] = 0.0, -3.0, None
    names = [n for n in features.level_features()]
    rows = lambda x: features.with_lags(bars(spark, x)).select("observation_date", *[v.alias(n) for n, v in features.level_features().items()])
    a, b = collected(rows(xs), *names), collected(rows([*xs, 1e12, 1e-12]), *names)
    assert a == b[: len(a)] and len(a) == len(xs) - 1


def test_constant_levels_have_no_zscore_or_correlation(spark):
    made = features.with_valid_only(features.with_lags(bars(spark, [7.0] * 220)))
    made = made.select("observation_date", *features.VALID_ONLY, features.level_features()["zscore_60obs"].alias("z"), features.level_features()["momentum_autocorr_1_60obs"].alias("m"))
    assert made.select([F.count(c) for c in made.columns[1:]]).first()[0:] == (0,) * (len(made.columns) - 1)


def bar_rows(spark, rows):
    day = date(2024, 1, 1)
    return spark.createDataFrame([("x", day + timedelta(days=i), *r) for i, r in enumerate(rows)], "series_id string, observation_date date, open double, high double, low double, close double")


def test_bars_skip_invalid_cells(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(10.0, 12.0, 9.0, 11.0), (11.0, None, 10.0, 12.0), (12.0, 13.0, 11.0, nan), (0.0, 14.0, 12.0, 13.0), (13.0, inf, 12.0, 0.0), (14.0, 15.0, 13.0, 14.0), (15.0, 15.0, 15.0, 15.0)]
    out = collected(features.bar_features(bar_rows(spark, rows)), "high_low_range_1obs", "intraday_return_1obs", "overnight_gap_1obs")
    assert [a[0] for a in out] == [pytest.approx(3 / 11), None, None, pytest.approx(2 / 13), None, pytest.approx(2 / 14), 0.0]
    assert [a[1] for a in out] == [pytest.approx(0.1), pytest.approx(1 / 11), None, None, -1.0, 0.0, 0.0]
    # the close before the sixth bar is 0: no gap, and none further back is looked for
    assert [a[2] for a in out] == [None, 0.0, 0.0, -1.0, 0.0, None, pytest.approx(1 / 14)]


def test_stochastic_and_donchian(spark):
    flat = collected(features.bar_features(bar_rows(spark, [(5.0, 5.0, 5.0, 5.0)] * 25)), "stoch_k_5", "donchian_breakout_up")
    assert flat == [(None, None)] * 20 + [(None, False)] * 5
    rising = [(i + 1.0, i + 2.0, i + 0.5, i + 1.5) for i in range(25)]
    up = collected(features.bar_features(bar_rows(spark, rising)), "donchian_breakout_up", "donchian_breakout_down")
    assert up == [(None, None)] * 20 + [(True, False)] * 5


def test_column_form_is_the_object_form(spark):
    """Bit by bit, over resets, gaps, values that aren't numbers, lengths around a chunk, and columns that only pass through."""
    rnd = random.Random(8)
    rows = []
    for series, n in (("a", 1), ("b", 127), ("c", 128), ("d", 129), ("e", 600)):
        for i in range(n):
            level = rnd.choice([None, 0.0, -1.5, float("nan")]) if rnd.random() < 0.03 else math.exp(rnd.gauss(0, 0.5))
            rows.append((series, date(2020, 1, 1) + timedelta(days=i), level, f"x{i}", i))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "series_id string, observation_date date, level double, note string, n int")
    plain = with_states(df)
    assert plain.columns == with_states_arrow(df).columns and "Arrow" not in plain._jdf.queryExecution().toString()
    key = lambda r: (r["series_id"], r["observation_date"])
    a, b = (sorted(map(repr, sorted(x.collect(), key=key))) for x in (plain, with_states_arrow(df)))
    assert a == b and len(a) == len(rows)


def test_scan_of_nothing(spark):
    empty = F.array().cast("array<int>")
    found = spark.range(1).select(scan(empty, F.lit(0), lambda s, x: s + x).alias("none"), scan(F.sequence(F.lit(1), F.lit(300)), F.lit(0), lambda s, x: s + x).alias("sums")).first()
    assert found["none"] == [] and found["sums"] == [i * (i + 1) // 2 for i in range(1, 301)]
