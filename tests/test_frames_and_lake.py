import hashlib
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import next_weekday
from tidemark.operators import delta, features, frames
from tidemark.plans import catalog
from tidemark.plans.registry import IDS, OHLC
from tidemark.sources import commits, lake, parsers

SCHEMA = "series_id string, observation_date date, level double, fetched_at_utc timestamp"
DAY, OLD, NEW = date(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 2, 2)


def test_diff_and_merge(spark):
    key = ["series_id", "observation_date"]
    old = spark.createDataFrame([("a", DAY, 1.0, OLD), ("a", date(2024, 1, 2), None, OLD), ("b", DAY, 3.0, OLD)], SCHEMA)
    new = spark.createDataFrame([("a", DAY, 1.0, NEW), ("a", date(2024, 1, 2), None, NEW), ("a", date(2024, 2, 3), 9.0, NEW)], SCHEMA)
    stable = frames.stable_audit(old, new, key, "fetched_at_utc")
    diff = frames.frame_diff(old, stable, key)
    assert {r["observation_date"]: r["change_type"] for r in diff.collect()} == {DAY: "unchanged", date(2024, 1, 2): "unchanged", date(2024, 2, 3): "insert"}
    assert frames.merge_upsert(old, stable, key).count() == 4
    assert [tuple(r) for r in frames.changed_months(diff).collect()] == [("a", 2024, 2)]
    with pytest.raises(ValueError):
        frames.frame_diff(old.drop("level"), new, key)
    with pytest.raises(frames.DuplicateKeys):
        frames.require_unique(old.unionByName(old), key)


def test_only_changed_months_are_written(spark, tmp_path):
    rows = [("a", date(2024, 1, 5), 1.0), ("a", date(2024, 2, 5), 2.0), ("b", date(2024, 2, 6), 3.0)]
    schema = "series_id string, observation_date date, level double"
    path, key = f"{tmp_path}/t", ["series_id", "observation_date"]
    first = spark.createDataFrame(rows, schema)
    assert lake.write_changed_months(first, frames.frame_diff(first.limit(0), first, key), path) == 3
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    new = spark.createDataFrame([*rows[:1], ("a", date(2024, 2, 5), 7.0), *rows[2:]], schema)
    assert lake.write_changed_months(new, frames.frame_diff(first, new, key), path) == 1
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    assert sum(p not in after for p in stamps) == 1
    assert sorted(r["level"] for r in spark.read.parquet(path).collect()) == [1.0, 3.0, 7.0]
    assert lake.write_changed_months(new, frames.frame_diff(new, new, key), path) == 0


def test_delta(spark):
    schema = "k string, x double"
    source = spark.createDataFrame([("a", 1.0), ("b", -0.0), ("c", None)], schema)
    target = spark.createDataFrame([("b", 0.0), ("c", 5.0), ("d", 6.0)], schema)
    a, b = (delta.row_digest(t, ["k"], ["x"]) for t in (source, target))
    plan = delta.delta_plan(a, b, ["k"])
    assert {r["k"]: r["change_type"] for r in plan.collect()} == {"a": "insert", "b": "unchanged", "c": "update", "d": "delete"}
    after = delta.apply_delta(target, source, plan, ["k"])
    assert delta.digest_mismatches(delta.row_digest(after, ["k"], ["x"]), a, ["k"]).isEmpty()
    with pytest.raises(Exception, match="non-finite"):
        delta.row_digest(spark.createDataFrame([("a", float("nan"))], schema), ["k"], ["x"]).collect()


def test_digests_tell_cells_apart(spark):
    schema = "a string, b string, n long, x double"
    rows = [("x|b=y", "z", 1, 1.0), ("x", "y|b=z", 1, 1.0), (None, "z", 1, 1.0), ("", "z", 1, 1.0), ("N", "z", 1, 1.0), ("", "z", None, 1.0), ("", "z", 1, None), ("", None, 1, 1.0)]
    found = delta.row_digest(spark.createDataFrame(rows, schema), ["a", "b"], ["n", "x"]).collect()
    assert len({r["row_sha256"] for r in found}) == len(rows)
    plan = delta.delta_plan(*[delta.row_digest(spark.createDataFrame(rows, schema), ["a", "b", "n", "x"], [])] * 2, ["a", "b", "n", "x"])
    assert [tuple(r) for r in plan.groupBy("change_type").count().collect()] == [("unchanged", len(rows))]


def test_diffs_and_merges_take_one_row_a_key(spark):
    once = spark.createDataFrame([("a", 1.0), (None, 2.0)], "k string, x double")
    twice = once.union(once)
    for call in (frames.frame_diff, frames.merge_upsert):
        for sides in ((once, twice), (twice, once)):
            with pytest.raises(frames.DuplicateKeys):
                call(*sides, ["k"])
    assert {(r["k"], r["change_type"]) for r in frames.frame_diff(once, once, ["k"]).collect()} == {("a", "unchanged"), (None, "unchanged")}
    assert frames.merge_upsert(once, once, ["k"]).count() == 2


def test_audit_takes_one_row_a_key_and_null_keys(spark):
    once = spark.createDataFrame([("a", 1.0, OLD), (None, 2.0, OLD)], "k string, x double, at timestamp")
    new = once.withColumn("at", F.lit(NEW).cast("timestamp"))
    assert {r["at"] for r in frames.stable_audit(once, new, ["k"], "at").collect()} == {OLD}
    for sides in ((once.union(once), new), (once, new.union(new))):
        with pytest.raises(frames.DuplicateKeys):
            frames.stable_audit(*sides, ["k"], "at")


def test_delta_of_null_keys_and_without_state(spark):
    source, target = (spark.createDataFrame([(None, x), ("a", 1.0)], "k string, x double") for x in (1.0, 2.0))
    a, b = (delta.row_digest(t, ["k"], ["x"]) for t in (source, target))
    after = delta.apply_delta(target, source, delta.delta_plan(a, b, ["k"]), ["k"])
    assert after.count() == 2 and delta.digest_mismatches(a, delta.row_digest(after, ["k"], ["x"]), ["k"]).isEmpty()
    state = spark.createDataFrame([], "build_id string")
    with pytest.raises(delta.StateMissing):
        delta.delta_plan(a, b, ["k"], state)
    assert delta.delta_plan(a, b.limit(0), ["k"], state).count() == 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Pacific/Apia"])
def test_days_and_digests_are_of_no_time_zone(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        chart = '{"chart": {"result": [{"timestamp": [1704153600, 1704326399, -1], "indicators": {"quote": [{"open": [1, 1, 1], "high": [2, 2, 2], "low": [0.5, 0.5, 0.5], "close": [1, 1, 1]}]}}]}}'
        found = parsers.read_chart_json(spark, written(tmp_path, "z.json", chart)).collect()
        assert sorted(r["observation_date"] for r in found) == [date(1969, 12, 31), date(2024, 1, 2), date(2024, 1, 3)]
        at = spark.range(1).select(F.unix_seconds(next_weekday(F.lit("2024-03-08").cast("date"))).alias("s")).first()["s"]
        assert at == 1710115200  # Monday, 00:00 UTC
        # two moments that are one local time in New York
        times = spark.range(2).select("id", F.timestamp_seconds(F.lit(1604208600) + 3600 * F.col("id")).alias("t"))
        digests = [r["row_sha256"] for r in delta.row_digest(times.select(F.lit(1).alias("id"), "t"), ["id"], ["t"]).collect()]
        assert len(set(digests)) == 2 and sorted(digests) == sorted(hashlib.sha256(f"2:idI1:11:tT16:{(1604208600 + 3600 * i) * 10**6}".encode()).hexdigest() for i in range(2))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_serving_upsert_deletes_empty_rows(spark):
    target = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0)], "k int, a double, b double")
    changes = spark.createDataFrame([(1, None, None), (3, None, 1.0)], "k int, a double, b double")
    assert sorted(tuple(r) for r in frames.serving_upsert(target, changes, ["k"]).collect()) == [(2, 3.0, 4.0), (3, None, 1.0)]


def test_next_weekday(spark):
    days = [date(2024, 3, d) for d in range(4, 11)]  # Monday to Sunday
    rows = spark.createDataFrame([(d,) for d in days], "d date").select("d", next_weekday("d").cast("date").alias("n")).collect()
    assert [r["n"].day for r in sorted(rows)] == [5, 6, 7, 8, 11, 11, 11]


def test_catalog_is_closed_and_complete(spark):
    assert len(IDS) == 25 and len(OHLC) == 6 and len(catalog.CATALOG) == 1720
    assert set(features.level_features()) == set(catalog.LEVEL_NAMES)
    assert len(catalog.fingerprint()) == 64
    made = set(catalog.LEVEL_NAMES) | set(features.VALID_ONLY) | set(features.RSI) | set(features.TREND) | set(features.BAR) | set(catalog.CROSS)
    assert {s.feature for s in catalog.CATALOG} <= made
    assert not any("rsi_15" in s.name for s in catalog.CATALOG if "ratio" not in s.name)


def test_long_view_is_unique_and_catalogued(spark):
    from tidemark.sources.fixtures import bars_by_nation

    long = catalog.macro_features_long(bars_by_nation(spark, "/root/testdata/sf0.001")).cache()
    assert long.count() > 0 and catalog.catalog_drift(long).isEmpty()
    assert frames.duplicate_keys(long, ["observation_date", "feature_name"]).isEmpty()
    assert long.where(F.isnan("value") | F.col("value").isNull()).isEmpty()


def test_build_catalog(spark, tmp_path):
    builds = lake.BuildCatalog(spark, str(tmp_path))
    data = spark.createDataFrame([(1,)], "x int")
    builds.publish("20240101T000000Z", data, 11, 6)
    builds.publish("20240102T000000Z", data.unionByName(data), 11, 6)
    assert builds.read(10, 6).count() == 2 and builds.table().where("is_current").count() == 1
    with pytest.raises(ValueError, match="already"):
        builds.publish("20240102T000000Z", data, 11, 6)
    assert {r["build_id"]: r["status"] for r in builds.table().collect()}["20240102T000000Z"] == "complete"
    assert builds.read(10, 6).count() == 2  # the refused one has changed nothing
    with pytest.raises(LookupError):
        builds.read(12, 6)
    for day in range(3, 9):
        builds.publish(f"2024010{day}T000000Z", data, 11, 6)
    assert builds.prune(keep=5) == [f"2024010{day}T000000Z" for day in (1, 2, 3)]
    gone = tmp_path / "versions/build_id=20240103T000000Z"
    assert spark.read.parquet(str(gone)).columns == ["pruned"] and spark.read.parquet(str(gone)).isEmpty() and builds.read(10, 6).count() == 1
    stamp = (gone / "_SUCCESS").stat().st_mtime_ns
    assert builds.prune(keep=5) == [] and stamp == (gone / "_SUCCESS").stat().st_mtime_ns
    with pytest.raises(ValueError, match="already"):
        builds.publish("20240103T000000Z", data, 11, 6)
    before = builds.table().where("build_id = '20240108T000000Z'").first()["created_at_utc"]
    stale = builds.table().limit(1).withColumns({"build_id": F.lit("x"), "status": F.lit("building"), "is_current": F.lit(False)})
    builds._put(stale)
    builds.recover(before=datetime(2000, 1, 1))
    assert not builds.table().where("status = 'building'").isEmpty()  # begun since then
    builds.recover()
    assert builds.table().where("status = 'building'").isEmpty()
    assert builds.table().where("build_id = '20240108T000000Z'").first()["created_at_utc"] == before


def test_what_is_current(spark, tmp_path):
    """The current build is preferred to newer ones, a failed one never takes over, and two current ones are an error."""
    builds = lake.BuildCatalog(spark, str(tmp_path))
    data = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(LookupError):
        builds.read(11, 6)
    builds.publish("a", data, 11, 6)
    builds.publish("b", data.unionByName(data), 10, 6)
    assert builds.read(10, 6, strict=True).count() == 2 and builds.read(11, 6).count() == 1
    with pytest.raises(LookupError, match="not compatible"):
        builds.read(11, 6, strict=True)

    def stop(step):
        raise RuntimeError(step)

    with pytest.raises(RuntimeError):
        builds.publish("c", data, 11, 6, fault=stop)
    assert {r["build_id"]: (r["status"], r["is_current"]) for r in builds.table().collect()} == {"a": ("complete", False), "b": ("complete", True), "c": ("failed", False)}

    def spoil(step):
        if step == "written":
            data.unionByName(data).unionByName(data).write.mode("append").parquet(f"{tmp_path}/versions/build_id=d")

    with pytest.raises(commits.DigestMismatch):
        builds.publish("d", data, 11, 6, fault=spoil)
    assert builds.read(10, 6).count() == 2
    builds._put(builds.table().where("build_id = 'a'").withColumn("is_current", F.lit(True)))
    for strict in (True, False):
        with pytest.raises(ValueError, match="several"):
            builds.read(10, 6, strict=strict)


def written(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_bar_files(spark, tmp_path):
    path = written(tmp_path, "a.csv", "DATE,OPEN,HIGH,LOW,CLOSE\n01/02/2024,1,2,0.5,1.5\n2024-01-03,1,0.5,2,1\n")
    assert values(parsers.read_bars_csv(spark, path)) == [(date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5)]
    for bad in ("01/02/2024,1,,0.5,1.5", "soon,1,2,0.5,1.5", "2024-01-02,1,2,0.5,1.5\n01/02/2024,1,2,0.5,1.5", "2024-01-02,1,0,0.5,1.5"):
        with pytest.raises(parsers.PayloadError):
            parsers.read_bars_csv(spark, written(tmp_path, "b.csv", f"DATE,OPEN,HIGH,LOW,CLOSE\n{bad}\n"))


def test_scalar_files(spark, tmp_path):
    path = written(tmp_path, "a.txt", "Date;Symbol;Indexvalue\n02.01.2024;V2TX;13.5\n03.01.2024;V2TX; \n02.01.2024;OTHER;9\n")
    assert values(parsers.read_scalar_delimited(spark, path, "v2tx")) == [(date(2024, 1, 2), 13.5)]
    with pytest.raises(parsers.PayloadError):
        parsers.read_scalar_delimited(spark, written(tmp_path, "b.txt", "Date;Symbol;Indexvalue\n02.01.2024;V2TX;x\n"), "V2TX")
    sdmx = written(tmp_path, "c.csv", "KEY,TIME_PERIOD,OBS_VALUE\nk,2024-01-02,0.5\nk,2024-01-03,.\nk,2024-01-04,\n")
    assert values(parsers.read_sdmx_csv(spark, sdmx)) == [(date(2024, 1, 2), 0.5)]
    assert parsers.read_sdmx_csv(spark, written(tmp_path, "d.csv", "No data\n")).count() == 0
    assert parsers.read_sdmx_csv(spark, written(tmp_path, "g.csv", "")).count() == 0
    for name, note in (("h", "k"), ("i", "no data")):
        with pytest.raises(parsers.PayloadError, match="OBS_VALUE"):
            parsers.read_sdmx_csv(spark, written(tmp_path, f"{name}.csv", f"KEY,PERIOD,VALUE\n{note},2024-01-02,0.5\n"))


def test_json_documents(spark, tmp_path):
    path = written(tmp_path, "a.json", '{"observations": [{"date": "2024-01-02", "value": "4.1"}, {"date": "2024-01-03", "value": "."}]}')
    assert values(parsers.read_observations_json(spark, path)) == [(date(2024, 1, 2), 4.1)]
    chart = '{"chart": {"result": [{"timestamp": [1704153600, 1704240000], "indicators": {"quote": [{"open": [1, null], "high": [2, null], "low": [0.5, null], "close": [%s, null]}]}}]}}'
    assert values(parsers.read_chart_json(spark, written(tmp_path, "b.json", chart % "1.5"))) == [(date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5)]
    with pytest.raises(parsers.PayloadError):
        parsers.read_chart_json(spark, written(tmp_path, "c.json", chart % "null"))
    with pytest.raises(parsers.PayloadError):
        parsers.within(parsers.read_observations_json(spark, path), "2024-02-01", "2024-02-28")


def test_outer_chain_joins_all_series(spark, tmp_path):
    from tidemark.plans.queries import QUERIES
    from tidemark.sources.fixtures import bars_by_nation

    # nation n has the days n and 40 + n // 5, so days of one series alone and shared ones
    orders = [(10 * n + k, n, datetime(1995, 1, 1) + timedelta(days=d), 100.0 * n + k) for n in range(25) for k, d in enumerate((n, n, 40 + n // 5))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(n, n) for n in range(25)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    out = QUERIES["gold_full_outer_chain_all"](spark, str(tmp_path))
    wide = frames.gold_wide(bars_by_nation(spark, str(tmp_path)), list(IDS), list(OHLC))
    assert out.columns == wide.columns and len(out.columns) == 1 + 25 + 4 * len(OHLC)
    rows = sorted(map(tuple, out.collect()))
    assert len(rows) == 30 and rows == sorted(map(tuple, wide.collect()))


def test_whole_catalog_is_counted_and_verified(spark, tmp_path):
    from tidemark.plans.queries import QUERIES

    n = 70  # rising days of all 25 series
    orders = [(n * s + d, s, datetime(1995, 1, 1) + timedelta(days=d), 1000.0 + 10 * s + d + (d % 7) ** 2) for s in range(25) for d in range(n)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(s, s) for s in range(25)], "c_custkey long, c_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    long = QUERIES["macro_features_long"](spark, str(tmp_path)).toPandas()
    published = long["feature_name"].value_counts().to_dict()
    counts = {r["feature_name"]: r["n_rows"] for r in QUERIES["macro_feature_counts_all"](spark, str(tmp_path)).collect()}
    assert counts == published and set(counts) <= {s.name for s in catalog.CATALOG} and len(counts) > 1000
    for s in IDS:
        if s != "estr":
            assert counts[f"{s}_log_level"] == n and all(counts[f"{s}_{f}_{k}obs"] == n - k for f in ("log_return", "roc") for k in (5, 8))
    assert counts["vix_delta_20obs"] == n - 20 and counts["estr_delta_1obs"] == n - 1 and all(counts[c] == n for c in catalog.CROSS)
    gone = long[long["feature_name"].str.endswith("_roc_8obs") & (long["observation_date"].map(lambda d: d.day) == 13)]["feature_name"].value_counts().to_dict()
    found = {r["feature"]: (r["expected"], r["actual"]) for r in QUERIES["feature_count_diff_all"](spark, str(tmp_path)).collect()}
    assert len(gone) == 24 and found == {f: (counts[f], counts[f] - k) for f, k in gone.items()}
    profile = {r["feature"]: r["coverage"] for r in QUERIES["feature_profile_all"](spark, str(tmp_path)).collect()}
    assert profile == {f: round(k / n, 6) for f, k in counts.items()}
    assert {r["violations"] for r in QUERIES["conformance_report_all"](spark, str(tmp_path)).collect()} == {0}
    report = QUERIES["population_verify_all"](spark, str(tmp_path)).first()
    assert (report["expected_rows"], report["expected_features"], report["n_different"]) == (len(long), len(counts), 24)
    assert report["actual_rows"] == len(long) - sum(gone.values())
