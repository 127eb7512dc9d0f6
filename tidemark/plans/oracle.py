"""DuckDB SQL for the registered queries, written apart from the Spark plans that it checks."""

from __future__ import annotations

from tidemark.plans.registry import IDS, REGISTRY

#: Lags and windows of the correlations of returns.
RETURN_CORRELATIONS = ((1, 96), (4, 96), (8, 192))

KEYS = "series_id, observation_date"
_BAR = """arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
    arg_max(o_totalprice, o_orderkey) AS close, arg_max(o_totalprice, o_orderkey) AS level"""
BARS1 = f"b AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS observation_date, {_BAR} FROM orders GROUP BY ALL)"
_NAMES = "[" + ", ".join(f"'{s}'" for s in IDS) + "]"
BARS2 = f"b AS (SELECT {_NAMES}[c_nationkey + 1] AS series_id, CAST(o_orderdate AS DATE) AS observation_date, {_BAR} FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"
GAPS = """g AS (SELECT series_id, observation_date, CASE WHEN day(observation_date) = 7 THEN NULL WHEN day(observation_date) = 19 THEN 0.0
    WHEN day(observation_date) = 28 AND month(observation_date) % 3 = 0 THEN -level ELSE level END AS level FROM b)"""
P = "OVER (PARTITION BY series_id ORDER BY observation_date)"


def w(n: int) -> str:
    return f"OVER (PARTITION BY series_id ORDER BY observation_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_LAGS = ", ".join(f"lag(level, {k}) {P} AS lag_{k}" for k in (1, 2, 3, 4, 5, 8, 10, 20))
_LRS = ", ".join(f"CASE WHEN level > 0 AND lag_{k} > 0 THEN ln(level / lag_{k}) END AS lr_{k}" for k in (1, 2, 3, 4, 5, 8, 10, 20))


def lagged(source: str) -> str:
    """CTEs l0 and l: rows with a level, lags, the change and log returns; then lags of these."""
    return f"""l0 AS (SELECT *, {_LAGS} FROM {source} WHERE level IS NOT NULL), l1 AS (SELECT *, level - lag_1 AS change, {_LRS} FROM l0),
l AS (SELECT *, {", ".join(f"lag(change, {k}) {P} AS change_lag_{k}" for k in (1, 5, 20))}, {", ".join(f"lag(lr_1, {k}) {P} AS lr1_lag_{k}" for k in (1, 4, 8))} FROM l1)"""


def _full(x: str, n: int, value: str) -> str:
    return f"CASE WHEN count({x}) {w(n)} = {n} THEN {value} END"


def _corr(x: str, y: str, n: int) -> str:
    return f"covar_pop({x}, {y}) {w(n)} / nullif(stddev_pop({x}) {w(n)} * stddev_pop({y}) {w(n)}, 0)"


LEVEL: dict[str, dict[str, str]] = {
    "log_level": {"log_level": "CASE WHEN level > 0 THEN ln(level) END"},
    "delta_obs": {f"delta_{k}obs": f"level - lag_{k}" for k in (1, 5, 20)},
    "zscore_60": {"zscore_60obs": _full("level", 60, f"(level - avg(level) {w(60)}) / nullif(stddev_pop(level) {w(60)}, 0)")},
    "momentum_autocorr": {
        f"momentum_autocorr_{k}_{n}obs": f"CASE WHEN count(change) {w(n)} = {n} AND count(change_lag_{k}) {w(n)} = {n} THEN CASE WHEN {_corr('change', f'change_lag_{k}', n)} < 0 THEN 0.0 ELSE {_corr('change', f'change_lag_{k}', n)} END END"
        for k, n in ((1, 60), (5, 60), (20, 120))
    },
    "log_return": {f"log_return_{k}obs": f"lr_{k}" for k in (1, 2, 3, 4, 5, 8, 10, 20)},
    "return_geom": {f"return_geom_{n}obs_pct": _full("lr_1", n, f"exp(sum(lr_1) {w(n)}) - 1") for n in (4, 5, 8, 10, 16, 20)},
    "return_mean": {f"return_mean_{n}obs": _full("lr_1", n, f"avg(lr_1) {w(n)}") for n in (5, 10, 20)},
    "volatility": {f"volatility_{n}obs": _full("lr_1", n, f"stddev_samp(lr_1) {w(n)}") for n in (5, 8, 10, 20, 32, 40, 96)},
    "sma_ratio": {f"sma_ratio_{a}_{b}": _full("level", b, f"avg(level) {w(a)} / nullif(avg(level) {w(b)}, 0)") for a, b in ((5, 15), (5, 20), (10, 20), (10, 40))},
    "roc": {f"roc_{k}obs": f"CASE WHEN level > 0 AND lag_{k} > 0 THEN level / lag_{k} - 1 END" for k in (1, 2, 3, 4, 5, 8, 10, 20)},
    "roc_acceleration": {"roc_acceleration_4_8": "CASE WHEN level > 0 AND lag_4 > 0 AND lag_8 > 0 THEN level / lag_4 - level / lag_8 END"},
    "drawdown": {f"drawdown_{n}obs": _full("level", n, f"level / nullif(max(level) {w(n)}, 0) - 1") for n in (20, 32, 60, 96)},
}


def rounded(columns: dict[str, str], digits: int = 6) -> str:
    return ", ".join(f"round({x}, {digits}) AS {n}" for n, x in columns.items())


def level_sql(family: str | None, bars: str = BARS1, source: str = "b", digits: int = 6) -> str:
    more = f", {GAPS}" if source == "g" else ""
    columns = LEVEL[family] if family else {n: x for made in LEVEL.values() for n, x in made.items()}
    return f"WITH {bars}{more}, {lagged(source)} SELECT {KEYS}, {rounded(columns, digits)} FROM l"


def valid_sql(name: str, value: str, valid: str, n: int, bars: str = BARS1, digits: int = 6) -> str:
    """``value`` over the last n rows that meet ``valid`` alone, left-joined to all rows with a level."""
    return f"""WITH {bars}, {lagged('b')}, m AS (SELECT *, {_full('lr_1', 8, f'stddev_samp(lr_1) {w(8)}')} AS vol8 FROM l),
v AS (SELECT *, count(*) {w(n)} AS k FROM m WHERE {valid}), f AS (SELECT {KEYS}, CASE WHEN k = {n} THEN {value} END AS x FROM v)
SELECT l.series_id, l.observation_date, round(f.x, {digits}) AS {name} FROM l LEFT JOIN f USING (series_id, observation_date)"""


def _z(x: str, n: int) -> str:
    return f"({x} - avg({x}) {w(n)}) / nullif(stddev_samp({x}) {w(n)}, 0)"


def bar_metric_sql(name: str, value: str, valid: str, bars: str = BARS1, digits: int = 6) -> str:
    return f"""WITH {bars}, p AS (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY observation_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pc FROM b),
v AS (SELECT {KEYS}, {value} AS x FROM p WHERE {valid}), f AS (SELECT *, CASE WHEN count(*) {w(5)} = 5 THEN avg(x) {w(5)} END AS y FROM v)
SELECT b.series_id, b.observation_date, round(f.x, {digits}) AS {name}_1obs, round(f.y, {digits}) AS {name}_5obs FROM b LEFT JOIN f USING (series_id, observation_date)"""


_STOCH = f"""k AS (SELECT *, CASE WHEN count(*) {w(5)} = 5 THEN 100 * (close - min(low) {w(5)}) / nullif(max(high) {w(5)} - min(low) {w(5)}, 0) END AS k5,
CASE WHEN count(*) {w(14)} = 14 THEN 100 * (close - min(low) {w(14)}) / nullif(max(high) {w(14)} - min(low) {w(14)}, 0) END AS k14 FROM b),
d AS (SELECT *, CASE WHEN count(k5) {w(3)} = 3 THEN avg(k5) {w(3)} END AS d5, CASE WHEN count(k14) {w(3)} = 3 THEN avg(k14) {w(3)} END AS d14, lag(k5, 3) {P} AS k5_3 FROM k)"""


def stochastic_sql(columns: dict[str, str], bars: str = BARS1, digits: int = 6) -> str:
    return f"WITH {bars}, {_STOCH} SELECT {KEYS}, {rounded(columns, digits)} FROM d"


_PRIOR = "OVER (PARTITION BY series_id ORDER BY observation_date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
_DONCHIAN = f"SELECT {KEYS}, CASE WHEN count(*) {_PRIOR} = 20 THEN CAST(high > max(high) {_PRIOR} AS DOUBLE) END AS donchian_breakout_up, CASE WHEN count(*) {_PRIOR} = 20 THEN CAST(low < min(low) {_PRIOR} AS DOUBLE) END AS donchian_breakout_down FROM b"
DONCHIAN = f"WITH {BARS1} {_DONCHIAN}"


def _ema_step(n: int, x: str) -> str:
    """New (count, total, value) of an EMA whose state columns end in n, for the valid value ``x``, null to reset."""
    a = f"CAST(2.0 AS DOUBLE) / {n + 1}"
    return f"""CASE WHEN {x} IS NULL THEN 0 WHEN s.e{n} IS NOT NULL THEN s.c{n} ELSE s.c{n} + 1 END AS c{n},
CASE WHEN {x} IS NULL THEN 0.0 WHEN s.e{n} IS NOT NULL THEN s.t{n} ELSE s.t{n} + {x} END AS t{n},
CASE WHEN {x} IS NULL THEN NULL WHEN s.e{n} IS NOT NULL THEN {a} * {x} + (1 - {a}) * s.e{n} WHEN s.c{n} + 1 = {n} THEN (s.t{n} + {x}) / {n} END AS e{n}"""


def ema_ctes(source: str, periods: tuple[int, ...] = (5, 9, 12, 21, 26)) -> str:
    """Recursive CTE ``s`` (series_id, observation_date, i, level, e5, ...) over all rows of ``source``."""
    start = ", ".join(f"0 AS c{n}, CAST(0.0 AS DOUBLE) AS t{n}, CAST(NULL AS DOUBLE) AS e{n}" for n in periods)
    x = "CASE WHEN r.level > 0 THEN r.level END"
    return f"""r AS MATERIALIZED (SELECT {KEYS}, level, row_number() {P} AS i FROM {source}),
s AS (SELECT DISTINCT series_id, CAST(NULL AS DATE) AS observation_date, CAST(0 AS BIGINT) AS i, CAST(NULL AS DOUBLE) AS level, {start} FROM r
UNION ALL SELECT r.series_id, r.observation_date, r.i, r.level, {", ".join(_ema_step(n, x) for n in periods)} FROM s JOIN r ON r.series_id = s.series_id AND r.i = s.i + 1),
e AS MATERIALIZED (SELECT * FROM s WHERE i > 0)"""


def signal_ctes() -> str:
    """Recursive CTE: the signal over the MACD line of ``e``, as column e9 of m."""
    return f"""q AS MATERIALIZED (SELECT series_id, observation_date, i, level, e12 - e26 AS line FROM e),
z AS (SELECT DISTINCT series_id, CAST(NULL AS DATE) AS observation_date, CAST(0 AS BIGINT) AS i, CAST(NULL AS DOUBLE) AS level, CAST(NULL AS DOUBLE) AS line, 0 AS c9, CAST(0.0 AS DOUBLE) AS t9, CAST(NULL AS DOUBLE) AS e9 FROM q
UNION ALL SELECT q.series_id, q.observation_date, q.i, q.level, q.line, {_ema_step(9, 'q.line')} FROM z AS s JOIN q ON q.series_id = s.series_id AND q.i = s.i + 1),
h AS (SELECT *, CASE WHEN level > 0 THEN (line - e9) / level END AS hist FROM z WHERE i > 0)"""


def _wilder_step(n: int, x: str, v: str) -> str:
    return f"""CASE WHEN r.gain IS NULL THEN 0.0 WHEN s.{v}{n} IS NOT NULL THEN 0.0 ELSE s.{v}t{n} + r.{x} END AS {v}t{n},
CASE WHEN r.gain IS NULL THEN NULL WHEN s.{v}{n} IS NOT NULL THEN ({n - 1} * s.{v}{n} + r.{x}) / {n} WHEN s.n{n} + 1 >= {n} THEN (s.{v}t{n} + r.{x}) / {n} END AS {v}{n}"""


def wilder_ctes(source: str, periods: tuple[int, ...]) -> str:
    start = ", ".join(f"0 AS n{n}, CAST(0.0 AS DOUBLE) AS gt{n}, CAST(NULL AS DOUBLE) AS g{n}, CAST(0.0 AS DOUBLE) AS lt{n}, CAST(NULL AS DOUBLE) AS l{n}" for n in periods)
    steps = ", ".join(f"CASE WHEN r.gain IS NULL THEN 0 ELSE s.n{n} + 1 END AS n{n}, {_wilder_step(n, 'gain', 'g')}, {_wilder_step(n, 'loss', 'l')}" for n in periods)
    rsi = ", ".join(f"CASE WHEN i >= {n + 1} THEN CASE WHEN g{n} = 0 AND l{n} = 0 THEN NULL WHEN l{n} = 0 THEN 100.0 ELSE 100 - 100 / (1 + g{n} / l{n}) END END AS rsi_{n}" for n in periods)
    return f"""y AS (SELECT {KEYS}, level, lag(level) {P} AS before, row_number() {P} AS i FROM {source} WHERE level IS NOT NULL),
r AS MATERIALIZED (SELECT *, CASE WHEN level > 0 AND before > 0 THEN greatest(level - before, 0.0) END AS gain, CASE WHEN level > 0 AND before > 0 THEN greatest(before - level, 0.0) END AS loss FROM y),
s AS (SELECT DISTINCT series_id, CAST(NULL AS DATE) AS observation_date, CAST(0 AS BIGINT) AS i, {start} FROM r
UNION ALL SELECT r.series_id, r.observation_date, r.i, {steps} FROM s JOIN r ON r.series_id = s.series_id AND r.i = s.i + 1),
a AS MATERIALIZED (SELECT *, {rsi} FROM s WHERE i > 0)"""


_ABOVE = "CASE WHEN level > 0 THEN level END"
TREND: dict[str, dict[str, str]] = {
    "ema_distance": {f"ema{n}_distance": f"{_ABOVE} / nullif(e{n}, 0) - 1" for n in (5, 9, 21)},
    "ema_spread": {"ema5_ema21_spread": f"(e5 - e21) / ({_ABOVE})"},
    "ema_slope": {"ema9_slope_3": f"(e9 - lag(e9, 3) {P}) / (3 * {_ABOVE})"},
    "ema_cross": {
        "ema5_ema9_cross": f"""CASE WHEN e5 IS NULL OR e9 IS NULL OR lag(e5) {P} IS NULL OR lag(e9) {P} IS NULL THEN NULL WHEN e5 > e9 AND lag(e5) {P} <= lag(e9) {P} THEN 1.0
WHEN e5 < e9 AND lag(e5) {P} >= lag(e9) {P} THEN -1.0 ELSE 0.0 END"""
    },
    "macd_line": {"macd_line_relative": f"(e12 - e26) / ({_ABOVE})"},
}


def trend_sql(family: str | None, source: str = "b", digits: int = 6) -> str:
    more = f", {GAPS}" if source == "g" else ""
    columns = TREND[family] if family else {n: x for made in TREND.values() for n, x in made.items()}
    return f"WITH RECURSIVE {BARS2}{more}, {ema_ctes(source)} SELECT {KEYS}, {rounded(columns, digits)} FROM e"


def rsi_sql(columns: dict[str, str], periods: tuple[int, ...], source: str = "b", digits: int = 6) -> str:
    more = f", {GAPS}" if source == "g" else ""
    return f"WITH RECURSIVE {BARS2}{more}, {wilder_ctes(source, periods)} SELECT {KEYS}, {rounded(columns, digits)} FROM a"


UNITS = "u AS (SELECT * FROM (VALUES " + ", ".join(f"('{s.series_id}', '{s.native_shape}', '{s.unit}', '{s.provider}')" for s in REGISTRY) + ") AS t(series_id, native_shape, unit, provider))"

VALID_ONLY: dict[str, tuple[str, str, int]] = {
    "volatility_zscore_96": (_z("vol8", 96), "vol8 IS NOT NULL", 96),
    "level_zscore_96": (_z("level", 96), "level > 0", 96),
    **{f"momentum_autocorr_lag{k}_window{n}": (_corr("lr_1", f"lr1_lag_{k}", n), f"lr_1 IS NOT NULL AND lr1_lag_{k} IS NOT NULL", n) for k, n in RETURN_CORRELATIONS},
}
BAR_METRICS = {"high_low_range": ("(high - low) / close", "close > 0"), "intraday_return": ("(close - open) / open", "open > 0"), "overnight_gap": ("(open - pc) / pc", "pc > 0")}
STOCHASTIC = {"stoch_k_5": "k5", "stoch_k_14": "k14", "stoch_d_5_3": "d5", "stoch_d_14_3": "d14", "stoch_kd_spread_5": "k5 - d5", "stoch_k_slope_3": "(k5 - k5_3) / 3"}
RSI = {**{f"rsi_{n}obs": f"rsi_{n}" for n in (3, 5, 7, 14)}, "rsi_ratio_5_15": "rsi_5 / nullif(rsi_15, 0)", "rsi5_slope_3": f"(rsi_5 - lag(rsi_5, 3) {P}) / 3", "rsi5_delta_1": f"rsi_5 - lag(rsi_5, 1) {P}"}
MACD = {"macd_hist_relative": "hist", "macd_hist_delta_3": f"hist - lag(hist, 3) {P}"}


def catalog_ctes(specs: list[tuple[str, str, str]], cross: str, digits: int) -> str:
    """CTE ``c`` (observation_date, feature_name, value): every feature of ``specs`` (name, series, feature) by its family's SQL, and those of ``cross``."""
    families = [level_sql(None, BARS2, digits=digits), trend_sql(None, digits=digits), rsi_sql(RSI, (3, 5, 7, 14, 15), digits=digits)]
    families += [valid_sql(name, *how, BARS2, digits) for name, how in VALID_ONLY.items()]
    families += [bar_metric_sql(name, *how, BARS2, digits) for name, how in BAR_METRICS.items()]
    families += [stochastic_sql(STOCHASTIC, BARS2, digits), f"WITH {BARS2} {_DONCHIAN}"]
    families.append(f"WITH RECURSIVE {BARS2}, {ema_ctes('b', (12, 26))}, {signal_ctes()} SELECT {KEYS}, {rounded(MACD, digits)} FROM h")
    long = " UNION ALL ".join(f"(SELECT {KEYS}, feature, CAST(value AS DOUBLE) AS value FROM (UNPIVOT ({sql}) ON COLUMNS(* EXCLUDE ({KEYS})) INTO NAME feature VALUE value))" for sql in families)
    names = ", ".join(f"('{name}', '{series}', '{feature}')" for name, series, feature in specs if series)
    return f"""k(feature_name, series_id, feature) AS (VALUES {names}), f AS ({long}),
c AS (SELECT observation_date, feature_name, value + 0.0 AS value FROM f JOIN k USING (series_id, feature) WHERE isfinite(value)
UNION ALL SELECT observation_date, feature_name, value + 0.0 FROM (UNPIVOT ({cross}) ON COLUMNS(* EXCLUDE (observation_date)) INTO NAME feature_name VALUE value) WHERE isfinite(value))"""
