"""Ingestion of fetched observations: what a run changes, and the state of each series, a fold of its durable runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import frames
from tidemark.sources.commits import Commits

#: What a run reports, besides series_id and run_id.
RUN = ("committed_at_utc", "mode", "last_observed_date", "filter_start", "request_start", "request_end", "fetched_rows", "accepted_rows", "changed_rows")
STATE = ("last_success_utc", "last_observed_date", "last_requested_start", "last_requested_end", "mode", "fetched_rows", "accepted_rows", "changed_rows", "last_reconcile_utc")


def durable_runs(runs: DataFrame, manifests: DataFrame) -> DataFrame:
    """The runs whose data and success manifest are durable (``manifests``: run_id); only these advance a state. Negative counts end the job with an error."""
    kept = runs.join(manifests.select("run_id").distinct(), "run_id", "left_semi")
    counts = [F.when(F.col(c) < 0, F.raise_error(F.lit(f"{c} must not be negative"))).otherwise(F.col(c)).alias(c) for c in ("fetched_rows", "accepted_rows", "changed_rows")]
    return kept.select(*[c for c in runs.columns if c not in ("fetched_rows", "accepted_rows", "changed_rows")], *counts)


def _start() -> Column:
    return F.coalesce("filter_start", "request_start")


def _reconciled() -> Column:
    return F.when(F.col("mode") == "reconcile", F.col("committed_at_utc"))


def state_history(runs: DataFrame, manifests: DataFrame) -> DataFrame:
    """series_id, run_id and STATE after each durable run, in order of committed_at_utc and run_id.

    All but the time of the last reconciliation is the run's own; that time is carried on from the last run that was one.
    """
    so_far = Window.partitionBy("series_id").orderBy("committed_at_utc", "run_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = durable_runs(runs, manifests).withColumn("last_reconcile_utc", F.last(_reconciled(), ignorenulls=True).over(so_far))
    return rows.select("series_id", "run_id", F.col("committed_at_utc").alias("last_success_utc"), "last_observed_date", _start().alias("last_requested_start"), F.col("request_end").alias("last_requested_end"), *STATE[4:])


def advance_states(prior: DataFrame, runs: DataFrame, manifests: DataFrame) -> DataFrame:
    """series_id and STATE of all series of ``prior`` (series_id, STATE) and of the durable ``runs``: each the state after its last run.

    A fold needs no order here: the last run is a maximum, and so is the last reconciliation. So a series may have any
    number of runs, which are summed up before they are shuffled. A series without durable runs keeps its state; runs that
    aren't newer than the prior state are passed over.
    """
    fresh = durable_runs(runs, manifests).join(prior.select("series_id", F.col("last_success_utc").alias("_known")), "series_id", "left")
    fresh = fresh.where(F.col("_known").isNull() | (F.col("committed_at_utc") > F.col("_known")))
    order = F.struct("committed_at_utc", "run_id")
    last = F.struct(F.col("committed_at_utc").alias("last_success_utc"), "last_observed_date", _start().alias("last_requested_start"), F.col("request_end").alias("last_requested_end"), *STATE[4:8])
    folded = fresh.groupBy("series_id").agg(F.max_by(last, order).alias("s"), F.max(_reconciled()).alias("r"))
    old = prior.select("series_id", F.struct(*STATE).alias("p"))
    joined = folded.join(old, "series_id", "full_outer")
    cells = [F.when(F.col("s").isNotNull(), F.col(f"s.{c}")).otherwise(F.col(f"p.{c}")).alias(c) for c in STATE[:8]]
    return joined.select("series_id", *cells, F.coalesce("r", "p.last_reconcile_utc").alias("last_reconcile_utc"))


#: The tables that a run changes.
OBSERVATIONS = "series_id string, observation_date date, open double, high double, low double, close double, value double, source_id string, fetched_at_utc timestamp, year int, month int"
RUNS = "series_id string, run_id string, committed_at_utc timestamp, mode string, last_observed_date date, filter_start date, request_start date, request_end date, fetched_rows long, accepted_rows long, changed_rows long"
STATES = "series_id string, last_success_utc timestamp, last_observed_date date, last_requested_start date, last_requested_end date, mode string, fetched_rows long, accepted_rows long, changed_rows long, last_reconcile_utc timestamp"
_KEY = ["series_id", "observation_date"]


def commit_runs(commits: Commits, fetched: DataFrame, runs: DataFrame, fault: Callable[[str], None] = lambda step: None) -> str:
    """Commits what ``runs`` (RUNS, without last_observed_date and changed_rows) fetched: observations, runs and states together.

    ``fetched`` has the columns of OBSERVATIONS but year and month, one row a key. An observation that is as before keeps its
    time of fetching; only months with an insert or a revision are written again; each series' bounds are those of the merged
    table. Until the manifest has the commit, readers see all three tables as they were.
    """
    series = [r["series_id"] for r in runs.select("series_id").distinct().collect()]  # of the runs at hand
    within = F.col("part").rlike("^series_id=(" + "|".join(series) + ")(/|$)")
    old = commits.read("observations", OBSERVATIONS, within).drop("year", "month")
    new = frames.stable_audit(old, fetched, _KEY, "fetched_at_utc")
    payload = [c for c in new.columns if c != "fetched_at_utc"]
    diff = frames.frame_diff(old.select(*payload), new.select(*payload), _KEY)
    months = frames.changed_months(diff)
    merged = frames.merge_upsert(old, new, _KEY)
    rows = merged.withColumns({"year": F.year("observation_date"), "month": F.month("observation_date")}).join(months, ["series_id", "year", "month"], "left_semi")
    bounds = merged.groupBy("series_id").agg(F.max("observation_date").alias("last_observed_date"))
    changed = diff.where("change_type <> 'unchanged'").groupBy("series_id").agg(F.count("*").alias("changed_rows"))
    zero = F.lit(0).cast("long")
    done = runs.join(bounds, "series_id", "left").join(changed, "series_id", "left").withColumn("changed_rows", F.coalesce("changed_rows", zero))
    prior = commits.read("states", STATES, within)
    states = advance_states(prior, done, done.select("run_id"))
    columns = lambda schema: [c.split(" ")[0] for c in schema.split(", ")]
    tables = {
        "observations": (rows.select(*columns(OBSERVATIONS)), ["series_id", "year", "month"]),
        "runs": (done.select(*columns(RUNS)), ["series_id", "run_id"]),
        "states": (states.select(*columns(STATES)), ["series_id"]),
    }
    return commits.commit(tables, fault=fault)


def silver_upsert(silver: DataFrame, bronze: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged, changed months) of the canonical table after all of ``bronze`` was made canonical and merged by series and date.

    The unit and the shape of a series come from ``units``; an observation that is as before keeps its time of fetching.
    """
    fresh = frames.silver_canonical(bronze, units).select(*silver.columns)
    fresh = frames.stable_audit(silver, fresh, _KEY, "fetched_at_utc")
    payload = [c for c in silver.columns if c != "fetched_at_utc"]
    diff = frames.frame_diff(silver.select(*payload), fresh.select(*payload), _KEY)
    return frames.merge_upsert(silver, fresh, _KEY), frames.changed_months(diff)
