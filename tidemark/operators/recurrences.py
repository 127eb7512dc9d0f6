"""Recurrences along a series that no window expresses: seeded EMA, Wilder averages and the MACD signal.

Whatever doesn't depend on the state before is made by windows first: runs of valid rows, places in them, and the means that
seed an average. What is left is a step of a few operations, and all states of a series advance in one pass over its sorted
rows, as a column: a higher-order ``aggregate`` that keeps what it passes, so no Python worker is needed. Series are spread
over tasks by the one shuffle on series_id that the windows need anyway. The same recurrences as Python objects advance a stream (``SeriesState``), and over an Arrow batch of a series they
are what tests hold the column form against.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ordered

# Periods of the recurrences.
EMA_PERIODS = (5, 9, 12, 21, 26)
RSI_PERIODS = (3, 5, 7, 14, 15)
SIGNAL_PERIOD = 9

#: Rows whose states are gathered before they go to the others, so that a long series isn't copied row by row.
CHUNK = 128


class Ema:
    """An EMA seeded with the mean of its first ``n`` valid values in a row; an invalid value resets it."""

    def __init__(self, n: int, signed: bool = False) -> None:
        self.n, self.signed, self.alpha = n, signed, 2.0 / (n + 1)
        self.count, self.total, self.value = 0, 0.0, None

    def step(self, x: float | None) -> float | None:
        if x is None or not (self.signed or x > 0):
            self.count, self.total, self.value = 0, 0.0, None
        elif self.value is not None:
            self.value = self.alpha * x + (1 - self.alpha) * self.value
        else:
            self.count += 1
            self.total += x
            if self.count == self.n:
                self.value = self.total / self.n
        return self.value


class Wilder:
    """Wilder's average: the mean of the first ``n`` values in a row, then ((n - 1) average + x) / n; null resets it."""

    def __init__(self, n: int) -> None:
        self.n, self.count, self.total, self.value = n, 0, 0.0, None

    def step(self, x: float | None) -> float | None:
        if x is None:
            self.count, self.total, self.value = 0, 0.0, None
        elif self.value is not None:
            self.value = ((self.n - 1) * self.value + x) / self.n
        else:
            self.count += 1
            self.total += x
            if self.count >= self.n:
                self.value = self.total / self.n
        return self.value


STATE_COLUMNS = (*(f"ema_{n}" for n in EMA_PERIODS), "macd_signal", *(f"avg_{side}_{n}" for n in RSI_PERIODS for side in ("gain", "loss")))


class SeriesState:
    """All recurrences of one series."""

    def __init__(self) -> None:
        self.emas = {n: Ema(n) for n in EMA_PERIODS}
        self.signal = Ema(SIGNAL_PERIOD, signed=True)
        self.averages = [Wilder(n) for n in RSI_PERIODS for _ in range(2)]
        self.previous: float | None = None

    def step(self, level: float | None) -> list[float | None]:
        """STATE_COLUMNS after the next row. A null level resets EMAs and is no observation for Wilder's averages."""
        emas = [self.emas[n].step(level) for n in EMA_PERIODS]
        fast, slow = self.emas[12].value, self.emas[26].value
        out = [*emas, self.signal.step(None if fast is None or slow is None else fast - slow)]
        if level is None:
            return [*out, *[None] * len(self.averages)]
        valid = self.previous is not None and level > 0 and self.previous > 0
        gain, loss = (max(level - self.previous, 0.0), max(self.previous - level, 0.0)) if valid else (None, None)
        self.previous = level
        return [*out, *[a.step(gain if i % 2 == 0 else loss) for i, a in enumerate(self.averages)]]


def _states(table: pa.Table) -> pa.Table:
    table = table.take(pc.sort_indices(table, [("observation_date", "ascending")]))
    state = SeriesState()
    rows = [state.step(x) for x in table.column("level").to_pylist()]
    for i, name in enumerate(STATE_COLUMNS):
        table = table.append_column(name, pa.array([r[i] for r in rows], pa.float64()))
    return table


def with_states_arrow(bars: DataFrame) -> DataFrame:
    """with_states in one Arrow pass over each series."""
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in bars.schema.fields), *(f"{c} double" for c in STATE_COLUMNS)])
    return bars.groupBy("series_id").applyInArrow(_states, fields)


def scan(rows: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The states after each of the array ``rows``, the first of which follows ``zero``: an array as long as ``rows``."""

    def one(held: Column, row: Column) -> Column:
        state = step(held["state"], row)
        # the state stands twice, which a struct in an array of one row makes a single evaluation
        return F.transform(F.array(state), lambda s: F.struct(s.alias("state"), F.concat(held["passed"], F.array(s)).alias("passed")))[0]

    def chunk(held: Column, at: Column) -> Column:
        done = F.aggregate(F.slice(rows, at, F.lit(CHUNK)), F.struct(held["state"].alias("state"), F.slice(F.array(held["state"]), 1, 0).alias("passed")), one)
        return F.transform(F.array(done), lambda d: F.struct(d["state"].alias("state"), F.concat(held["passed"], F.array(d["passed"])).alias("passed")))[0]

    nothing = F.slice(F.array(F.array(zero)), 1, 0)
    starts = F.when(F.size(rows) > 0, F.sequence(F.lit(1), F.size(rows), F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(starts, F.struct(zero.alias("state"), nothing.alias("passed")), chunk, lambda held: F.flatten(held["passed"]))


#: The rows of a run at which the MACD line begins, and at which the signal over it does.
_LINE, _SIGNAL = max(12, 26), max(12, 26) + SIGNAL_PERIOD - 1


def _run(valid: Column, *more: str) -> Column:
    """A number for each run of valid rows, with the invalid row before it."""
    return F.count_if(~valid).over(ordered(*more).rowsBetween(Window.unboundedPreceding, 0))


def _seeds(xs: dict[str, str], periods: tuple[int, ...], at: str, *by: str) -> dict[str, Column]:
    """The mean of the first n rows of a run, at the n-th, for each of ``periods``: summed up in order, with one frame for all."""
    upto = ordered(*by).rowsBetween(Window.unboundedPreceding, 0)
    return {f"{name}{n}": F.when(F.col(at) == n, F.sum(F.when(F.col(at) <= n, F.col(x))).over(upto) / n) for name, x in xs.items() for n in periods}


def _prepared(bars: DataFrame) -> tuple[DataFrame, list[str]]:
    """``bars`` with what the steps take, and the names of that."""
    level = F.col("level")
    up = level.isNotNull() & ~F.isnan(level) & (level > 0)
    before = F.last("level", ignorenulls=True).over(ordered().rowsBetween(Window.unboundedPreceding, -1))
    rows = bars.withColumns({"_there": level.isNotNull(), "_up": F.coalesce(up, F.lit(False)), "_x": F.when(up, level), "_before": before})
    both = F.col("_up") & F.coalesce(~F.isnan("_before") & (F.col("_before") > 0), F.lit(False))
    rows = rows.withColumns({"_gain": F.when(both, F.greatest(level - F.col("_before"), F.lit(0.0))), "_loss": F.when(both, F.greatest(F.col("_before") - level, F.lit(0.0)))})
    rows = rows.withColumns({"_e_run": _run(F.col("_up")), "_w_run": _run(F.col("_gain").isNotNull(), "_there")})
    upto = lambda *by: ordered(*by).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_e_at": F.count("_x").over(upto("_e_run")), "_w_at": F.count("_gain").over(upto("_there", "_w_run"))})
    seeds = _seeds({"_seed_ema_": "_x"}, EMA_PERIODS, "_e_at", "_e_run")
    rows = rows.withColumns(seeds)
    averages = _seeds({"_seed_gain_": "_gain", "_seed_loss_": "_loss"}, RSI_PERIODS, "_w_at", "_there", "_w_run")
    rows = rows.withColumns(averages)
    made = ["_there", "_x", "_gain", "_loss", "_e_at", *seeds, *averages]
    return rows.select(*bars.columns, *made), made


def _step(state: Column, row: Column) -> Column:
    """All recurrences after the next row. A value that is null before it is seeded, or in an invalid row, makes the next one null."""
    alpha = lambda n: 2.0 / (n + 1)
    ema = {n: F.coalesce(row[f"_seed_ema_{n}"], alpha(n) * row["_x"] + (1 - alpha(n)) * state[f"ema_{n}"]) for n in EMA_PERIODS}
    line, at = ema[12] - ema[26], row["_e_at"]
    total = F.when(at == _LINE, line).when(at <= _SIGNAL, state["total"] + line)
    signal = F.when(at > _SIGNAL, alpha(SIGNAL_PERIOD) * line + (1 - alpha(SIGNAL_PERIOD)) * state["macd_signal"]).when(at == _SIGNAL, total / SIGNAL_PERIOD)
    # a null level is no observation for Wilder's averages: they stay as they are
    averages = [
        F.when(row["_there"], F.coalesce(row[f"_seed_{side}_{n}"], ((n - 1) * state[f"avg_{side}_{n}"] + row[f"_{side}"]) / n)).otherwise(state[f"avg_{side}_{n}"]).alias(f"avg_{side}_{n}")
        for n in RSI_PERIODS
        for side in ("gain", "loss")
    ]
    return F.struct(*[x.alias(f"ema_{n}") for n, x in ema.items()], signal.alias("macd_signal"), *averages, total.alias("total"))


def with_states(bars: DataFrame) -> DataFrame:
    """``bars`` (series_id, observation_date, level, ...) with STATE_COLUMNS.

    Rows of null level stay in: they reset EMAs. Dates that a series lacks, and other series' rows, change nothing.
    """
    # a series is a few rows that take long, so their number of tasks isn't one to be chosen by their bytes
    tasks = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, made = _prepared(bars.repartition(tasks, "series_id"))
    others = [c for c in bars.columns if c not in ("series_id", "observation_date")]
    series = rows.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("observation_date", *others, *made))).alias("rows"))
    zero = F.struct(*[F.lit(None).cast("double").alias(c) for c in (*STATE_COLUMNS, "total")])
    states = series.withColumn("states", scan(F.col("rows"), zero, _step)).select("series_id", F.explode(F.arrays_zip("rows", "states")).alias("r"))
    cells = [F.col("series_id") if c == "series_id" else F.col(f"r.rows.`{c}`").alias(c) for c in bars.columns]
    state = [F.when(F.col("r.rows._there") | F.lit(not c.startswith("avg_")), F.col(f"r.states.{c}")).alias(c) for c in STATE_COLUMNS]
    return states.select(*cells, *state)
