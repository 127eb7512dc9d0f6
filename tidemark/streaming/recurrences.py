"""The recurrences of a series over a stream of daily rows, with the state kept between micro-batches."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.recurrences import STATE_COLUMNS, SeriesState


def _advance(key: tuple[str], batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
    last, state = (kept.get[0], pickle.loads(kept.get[1])) if kept.exists else ("", SeriesState())
    rows = pd.concat(list(batches)).sort_values("observation_date", kind="stable")
    rows = rows[rows["observation_date"].astype(str) > last]
    values = [state.step(None if pd.isna(x) else float(x)) for x in rows["level"]]
    if len(rows):
        kept.update((str(rows["observation_date"].iloc[-1]), pickle.dumps(state)))
    out = pd.DataFrame(values, columns=list(STATE_COLUMNS), dtype=float)
    yield pd.concat([rows[["series_id", "observation_date", "level"]].reset_index(drop=True), out], axis=1)


def stream_states(bars: DataFrame) -> DataFrame:
    """A streaming ``bars`` (series_id, observation_date, level) with STATE_COLUMNS, the same as over the whole history.

    A series' rows must come in order of date from batch to batch; within a batch they are sorted, and rows of dates
    already passed are dropped. The state of a series is a few dozen numbers.
    """
    output = "series_id string, observation_date date, level double, " + ", ".join(f"{c} double" for c in STATE_COLUMNS)
    rows = bars.select("series_id", "observation_date", "level")
    return rows.groupBy("series_id").applyInPandasWithState(_advance, output, "last string, state binary", "append", GroupStateTimeout.NoTimeout)
