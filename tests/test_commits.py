from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans.registry import REGISTRY
from tidemark.sources import commits, ingestion

BARS = "series_id string, observation_date date, open double, high double, low double, close double, value double, source_id string, fetched_at_utc timestamp"
RUN = "series_id string, run_id string, committed_at_utc timestamp, mode string, filter_start date, request_start date, request_end date, fetched_rows long, accepted_rows long"


def observations(spark, rows, at):
    return spark.createDataFrame([(s, d, None, None, None, None, v, "src", at) for s, d, v in rows], BARS)


def run(spark, name, at, mode="update", series=("a",), n=2):
    return spark.createDataFrame([(s, name, at, mode, None, date(2024, 1, 1), date(2024, 2, 28), n, n) for s in series], RUN)


def seen(store):
    rows = store.read("observations", ingestion.OBSERVATIONS)
    return sorted((r["series_id"], r["observation_date"], r["value"], r["fetched_at_utc"]) for r in rows.collect()), sorted(r["run_id"] for r in store.read("runs", ingestion.RUNS).collect()), sorted(tuple(r) for r in store.read("states", ingestion.STATES).collect())


ONE, TWO, THREE = datetime(2024, 3, 1), datetime(2024, 3, 2), datetime(2024, 3, 3)
JAN, FEB = date(2024, 1, 5), date(2024, 2, 5)


def test_runs_are_committed_whole_or_not_at_all(spark, tmp_path):
    store = commits.Commits(spark, str(tmp_path))
    assert seen(store) == ([], [], [])
    ingestion.commit_runs(store, observations(spark, [("a", JAN, 1.0), ("a", FEB, 2.0), ("b", FEB, 3.0)], ONE), run(spark, "r1", ONE, "bootstrap", ("a", "b"), 3))
    first = seen(store)
    assert first[0] == [("a", JAN, 1.0, ONE), ("a", FEB, 2.0, ONE), ("b", FEB, 3.0, ONE)] and first[1] == ["r1", "r1"]
    assert [(s[0], s[2], s[5], s[8], s[9]) for s in first[2]] == [("a", FEB, "bootstrap", 2, None), ("b", FEB, "bootstrap", 1, None)]

    fetched = observations(spark, [("a", JAN, 1.0), ("a", FEB, 9.0)], TWO)
    steps = []
    ingestion.commit_runs(commits.Commits(spark, f"{tmp_path}/other"), fetched, run(spark, "r2", TWO), steps.append)
    assert steps == ["observations written", "observations", "runs written", "runs", "states written", "states", "manifest"]
    for step in steps[:-1]:

        def stop(at, step=step):
            if at == step:
                raise RuntimeError(at)

        with pytest.raises(RuntimeError, match=step):
            ingestion.commit_runs(store, fetched, run(spark, "r2", TWO), stop)
        assert seen(store) == first

    ingestion.commit_runs(store, fetched, run(spark, "r2", TWO, "reconcile"))
    second = seen(store)
    assert second[0] == [("a", JAN, 1.0, ONE), ("a", FEB, 9.0, TWO), ("b", FEB, 3.0, ONE)]
    assert [(s[0], s[1], s[8], s[9]) for s in second[2]] == [("a", TWO, 1, TWO), ("b", ONE, 1, None)]
    january = store.files("observations", "part = 'series_id=a/year=2024/month=1'").first()["commit_id"]
    assert january != store.files("observations", "part = 'series_id=a/year=2024/month=2'").first()["commit_id"]  # not written again

    # nothing new: no month is written, the state goes on all the same
    ingestion.commit_runs(store, observations(spark, [("a", FEB, 9.0)], THREE), run(spark, "r3", THREE))
    third = seen(store)
    assert third[0] == second[0] and [(s[0], s[1], s[8], s[9]) for s in third[2]] == [("a", THREE, 0, TWO), ("b", ONE, 1, None)]


def test_only_listed_files_are_read(spark, tmp_path):
    store = commits.Commits(spark, str(tmp_path))
    rows = spark.createDataFrame([(i, i % 3, "x y+z%") for i in range(30)], "id long, k int, s string")
    store.commit({"t": (rows, ["k", "s"])})
    schema = "id long, k int, s string"
    assert sorted(map(tuple, store.read("t", schema).collect())) == sorted(map(tuple, rows.collect()))
    folder = next((tmp_path / "t").rglob("k=1")).parent
    rows.select("id").write.parquet(f"{folder}/k=1/s=q")
    rows.select("id", "s").write.parquet(f"{folder}/k=7")
    assert store.read("t", schema).count() == 30  # strays aren't
    held = store.inventory().first()
    assert (held["table"], held["n_parts"], held["n_rows"]) == ("t", 3, 30) and held["n_files"] == len(store.files("t").collect())
    assert store.read("t", schema, F.col("part").startswith("k=1/")).count() == 10
    store.commit({"t": (rows.where("k = 1").limit(1), ["k", "s"])}, emptied={"t": [store.files("t", "part like 'k=2/%'").first()["part"]]})
    assert sorted(r["k"] for r in store.read("t", schema).collect()) == [0] * 10 + [1]
    found = next(p for p in (tmp_path / "t").rglob("*.parquet") if "k=0" in str(p))
    found.unlink()
    with pytest.raises(Exception, match=r"(?i)not.exist|no such file"):
        store.read("t", schema).collect()


@pytest.mark.parametrize("path", ["../x.parquet", "/etc/x.parquet", "t/../../x.parquet", "file:/x.parquet", "t//x.parquet", "t/%2e%2e/%2e%2e/x", ""])
def test_paths_stay_under_the_root(spark, tmp_path, path):
    with pytest.raises(commits.PathEscape):
        commits.confined("/root", path)
    store = commits.Commits(spark, str(tmp_path))
    store.commit({"t": (spark.range(3), [])})
    store.manifest().withColumn("file", F.lit(path)).write.mode("append").parquet(f"{tmp_path}/_manifest")
    with pytest.raises(commits.PathEscape):
        store.read("t", "id long")


def test_spoiled_files_are_not_committed(spark, tmp_path):
    store = commits.Commits(spark, str(tmp_path))
    store.commit({"t": (spark.range(5), [])})

    def spoil(step):
        if step == "t written":  # as many rows, but others
            spark.range(7, 14).coalesce(1).write.mode("overwrite").parquet(str(next(p for p in (tmp_path / "t").iterdir() if len(list(p.glob("*.parquet"))) > 0 and p.name not in known)))

    known = {p.name for p in (tmp_path / "t").iterdir()}
    with pytest.raises(commits.DigestMismatch):
        store.commit({"t": (spark.range(7), [])}, fault=spoil)
    assert store.read("t", "id long").count() == 5


def test_multiset_digest(spark):
    def digest(rows, schema="a int, b int"):
        df = spark.createDataFrame(rows, schema)
        return tuple(df.repartition(3).agg(*commits.multiset_digest(df)).first())

    assert digest([(1, 2), (3, 4)]) == digest([(3, 4), (1, 2)])
    assert len({digest(x) for x in ([(1, None)], [(None, 1)], [(1, 1)], [(1, 1), (1, 1)], [], [(None, None)], [(2, 1)], [(1, 2)])}) == 8
    assert digest([(1, 2)], "a int, b int") == digest([(2, 1)], "b int, a int")


def test_states_advance_by_durable_runs_alone(spark):
    schema = "series_id string, run_id string, committed_at_utc timestamp, mode string, last_observed_date date, filter_start date, request_start date, request_end date, fetched_rows long, accepted_rows long, changed_rows long"
    rows = [
        ("a", "1", ONE, "reconcile", JAN, None, JAN, FEB, 1, 1, 1), ("a", "2", TWO, "update", FEB, JAN, None, FEB, 2, 2, 0), ("a", "3", THREE, "update", FEB, None, None, FEB, 9, 9, 9),
        ("b", "4", ONE, "bootstrap", JAN, None, None, FEB, 5, 5, 5), ("c", "5", ONE, "update", JAN, None, None, FEB, 5, 5, 5),
    ]
    runs, durable = spark.createDataFrame(rows, schema), spark.createDataFrame([("1",), ("2",), ("2",), ("4",)], "run_id string")
    prior = spark.createDataFrame([("b", TWO, FEB, None, FEB, "update", 7, 7, 7, ONE), ("d", ONE, JAN, None, FEB, "update", 1, 1, 1, None)], ingestion.STATES)
    found = {r["series_id"]: r for r in ingestion.advance_states(prior, runs, durable).collect()}
    assert set(found) == {"a", "b", "d"}  # the only run of c isn't durable
    assert (found["a"]["last_success_utc"], found["a"]["mode"], found["a"]["fetched_rows"], found["a"]["last_reconcile_utc"], found["a"]["last_requested_start"]) == (TWO, "update", 2, ONE, JAN)
    assert found["b"]["fetched_rows"] == 7 and found["b"]["last_success_utc"] == TWO and found["d"]["last_reconcile_utc"] is None
    history = {r["run_id"]: r for r in ingestion.state_history(runs, durable).collect()}
    assert set(history) == {"1", "2", "4"} and history["2"]["last_reconcile_utc"] == ONE
    # step by step is the same as at once
    again = ingestion.advance_states(ingestion.advance_states(prior, runs.where("run_id < '2'"), durable), runs.where("run_id >= '2'"), durable)
    assert {r["series_id"]: tuple(r) for r in again.collect()} == {k: tuple(r) for k, r in found.items()}
    with pytest.raises(Exception, match="negative"):
        ingestion.advance_states(prior, runs.withColumn("changed_rows", F.lit(-1).cast("long")), durable).collect()


def test_silver_upsert(spark):
    units = spark.createDataFrame([(s.series_id, s.native_shape, s.unit, s.provider) for s in REGISTRY], "series_id string, native_shape string, unit string, provider string")
    bronze = spark.createDataFrame([("ciss", JAN, None, None, None, None, 1.0, "src", ONE), ("vix", JAN, 1.0, 2.0, 0.5, 1.5, 9.0, "src", ONE)], BARS)
    empty = spark.createDataFrame([], "observation_date date, series_id string, value double, open double, high double, low double, close double, unit string, provider string, source_id string, fetched_at_utc timestamp")
    silver, months = ingestion.silver_upsert(empty, bronze, units)
    assert {(r["series_id"], r["value"], r["close"], r["unit"]) for r in silver.collect()} == {("ciss", 1.0, None, "index"), ("vix", 1.5, 1.5, "index_points")} and months.count() == 2
    later = bronze.withColumn("fetched_at_utc", F.lit(TWO).cast("timestamp")).withColumn("value", F.col("value") + 1)
    again, months = ingestion.silver_upsert(silver, later, units)
    assert {(r["series_id"], r["value"], r["fetched_at_utc"]) for r in again.collect()} == {("ciss", 2.0, TWO), ("vix", 1.5, ONE)}
    assert [r["series_id"] for r in months.collect()] == ["ciss"]
