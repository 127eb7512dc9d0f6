import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import delta, frames, verify
from tidemark.plans import catalog
from tidemark.plans.registry import IDS
from tidemark.sources import lake, versions

LONG = "observation_date date, feature_name string, value double"
D = [date(2024, 1, d) for d in range(1, 8)]


def reconciled(spark, expected, actual, **more):
    groups = spark.createDataFrame([("a", "one"), ("b", "one"), ("c", "two")], "feature_name string, family string")
    out = verify.reconcile_values(spark.createDataFrame(expected, LONG), spark.createDataFrame(actual, LONG), groups, ["observation_date", "feature_name"], **more)
    return {r["family"]: r for r in out.collect()}


def test_values_within_the_tolerance(spark):
    base = [(D[0], "a", 1000.0), (D[0], "b", 0.0), (D[1], "c", -5.0)]
    same = reconciled(spark, base, [(D[0], "a", 1000.0 + 9e-8), (D[0], "b", 9e-13), (D[1], "c", -5.0)])
    assert all(r["n_different"] == r["n_missing"] == r["n_surplus"] == r["n_features_off"] == 0 for r in same.values())
    off = reconciled(spark, base, [(D[0], "a", 1000.0 + 2e-7), (D[0], "b", 2e-12), (D[1], "c", -5.0)])
    assert off["one"]["n_different"] == 2 and off["two"]["n_different"] == 0
    assert math.isclose(off["one"]["largest_error"], 2e-7, rel_tol=1e-4)


def test_keys_that_one_side_lacks_or_repeats(spark):
    expected = [(D[0], "a", 1.0), (D[1], "a", 2.0), (None, "a", 3.0), (D[0], "b", 1.0), (D[0], "new", 1.0)]
    actual = [(D[0], "a", 1.0), (D[0], "a", 7.0), (None, "a", 3.0), (D[2], "b", 1.0), (D[3], "b", 1.0), (D[0], "new", 1.0)]
    found = reconciled(spark, expected, actual)
    one = found["one"]
    assert (one["expected_rows"], one["actual_rows"], one["n_missing"], one["n_surplus"], one["n_repeated"], one["n_different"], one["n_features_off"]) == (4, 5, 2, 2, 1, 1, 1)
    assert one["largest_error"] == 6.0 and found[None]["n_different"] == 0  # of no group that is known


def test_values_that_are_no_numbers(spark):
    nan, inf = float("nan"), float("inf")
    cells = [None, nan, inf, -inf, 1.0]
    rows = [(D[i % 7], f"{i}", x) for i, x in enumerate(c for c in cells for _ in cells)]
    other = [(D[i % 7], f"{i}", x) for i, x in enumerate(c for _ in cells for c in cells)]
    groups = spark.createDataFrame([(f"{i}", "g") for i in range(25)], "feature_name string, family string")
    found = verify.reconcile_values(spark.createDataFrame(rows, LONG), spark.createDataFrame(other, LONG), groups, ["observation_date", "feature_name"]).first()
    assert found["n_different"] == 20 and found["largest_error"] == 0.0


def test_empty_tables_agree(spark):
    assert reconciled(spark, [], []) == {}


def test_schemas(spark):
    declared = verify.schema_table(spark, spark.createDataFrame([], "a int, b string, c double, d date").schema, "t")
    actual = verify.schema_table(spark, spark.createDataFrame([], "a int, c double, b int, e date").schema, "t")
    found = {(r["column"], r["difference"], r["declared"], r["actual"]) for r in verify.schema_differences(declared, actual).collect()}
    assert found == {("b", "type", "string", "int"), ("b", "position", "2", "3"), ("c", "position", "3", "2"), ("d", "missing", "date", None), ("e", "surplus", None, "date")}
    assert verify.schema_differences(declared, declared).isEmpty()


def test_availability(spark):
    friday = date(2024, 3, 8)
    good = [(friday, datetime(2024, 3, 11)), (D[0], datetime(2024, 1, 2))]
    bad = [(friday, datetime(2024, 3, 9)), (friday, datetime(2024, 3, 9)), (friday, datetime(2024, 3, 12)), (friday, datetime(2024, 3, 11, 0, 0, 1)), (friday, None), (None, datetime(2024, 3, 11))]
    df = spark.createDataFrame(good + bad, "observation_date date, available_at_utc timestamp")
    found = {(r["observation_date"], r["difference"]): r["n_rows"] for r in verify.availability_differences(df).collect()}
    assert found == {(friday, "early"): 2, (friday, "late"): 1, (friday, "time"): 1, (friday, "absent"): 1, (None, "absent"): 1}


def test_agreement(spark):
    df = spark.createDataFrame([(d, float(i)) for i, d in enumerate(D)], "day date, x double")
    source = delta.row_digest(df, ["day"], ["x"])
    build = {"n_rows": 7, "first_key": D[0], "last_key": D[6], "build_id": "b"}
    state = spark.createDataFrame([(7, D[0], D[6], "b")], "n_rows long, first_key date, last_key date, build_id string")
    report = lambda *a: {r["check"]: r["violations"] for r in verify.agreement_report(*a, "day", build).collect()}
    assert set(report(source, source, source, state).values()) == {0}
    less = source.where("day < '2024-01-07'")
    assert report(source, less, source, state) == {"digest_index": 1, "consumer": 0, "summary": 0, "state": 0}
    assert report(source, source, less, state) == {"digest_index": 0, "consumer": 1, "summary": 2, "state": 0}
    assert report(source, source, source, state.withColumn("build_id", F.lit("a")))["state"] == 1
    assert report(source, source, source, state.limit(0))["state"] == 1 and report(source, source, source, state.union(state))["state"] == 1


def test_histogram(spark):
    rows = [("few", float(i)) for i in range(4)] + [("many", i / 10) for i in range(2000)] + [("one", 3.0)] * 50 + [("bad", None), ("bad", float("nan")), ("bad", float("inf"))]
    found = frames.feature_histogram(spark.createDataFrame(rows, "feature string, value double")).collect()
    by = {f: {r["bin"]: r["n"] for r in found if r["feature"] == f} for f in ("few", "many", "one", "bad")}
    assert by["few"] == {0: 1, 1: 1, 3: 1, 4: 1} and len(by["many"]) == 30 and sum(by["many"].values()) == 2000 and by["bad"] == {}
    assert by["one"] == {3: 50} and {r["n_bins"] for r in found if r["feature"] == "one"} == {7}
    edges = [(r["from_value"], r["to_value"]) for r in found if r["feature"] == "many" and r["bin"] in (0, 29)]
    assert math.isclose(min(e[0] for e in edges), 0.0) and math.isclose(max(e[1] for e in edges), 199.9)


def test_version_gate(spark):
    cases = {
        (None, None, 11, 6): ("new", 0), (11, 6, 11, 6): ("same", 0), (1, 4, 2, 4): ("upgrade", 1), (1, 4, 2, 5): ("refused", None), (2, 1, 3, 2): ("upgrade", 1), (2, 2, 3, 3): ("refused", None),
        (6, 5, 7, 6): ("upgrade", 1), (7, 6, 11, 6): ("upgrade", 4), (8, 6, 10, 6): ("upgrade", 2), (6, 5, 8, 6): ("stepwise", 2), (1, 1, 11, 6): ("stepwise", 10), (11, 6, 7, 6): ("refused", None), (9, 5, 10, 5): ("refused", None),
    }
    schema = "prior_schema int, prior_feature int, schema_version int, feature_version int"
    states = spark.createDataFrame(list(cases), schema)
    found = {tuple(r)[:4]: tuple(r)[4:] for r in versions.version_gate(states, versions.transitions(spark)).collect()}
    assert found == cases
    assert versions.require_compatible(states.where("schema_version = 7 and prior_feature = 5")).count() == 1
    with pytest.raises(versions.IncompatibleVersions, match="9/5 to 10/5: refused"):
        versions.require_compatible(states.where("prior_schema = 9"))


def test_verdicts(spark):
    counts = spark.createDataFrame([("a", 0), ("b", 2)], "check string, violations long")
    found = {r["check"]: (r["violations"], r["verdict"]) for r in verify.verdicts({"rows": counts, "none": spark.range(0), "some": spark.range(3)}).collect()}
    assert found == {"rows.a": (0, "PASS"), "rows.b": (2, "FAIL"), "none": (0, "PASS"), "some": (3, "FAIL"), "all": (5, "FAIL")}


def test_parity(spark):
    names = [s.name for s in catalog.CATALOG]
    long = spark.createDataFrame([(n,) for n in names[1:] + ["new", "new", None]], "feature_name string")
    assert {tuple(r) for r in catalog.catalog_parity(long).collect()} == {(names[0], "absent", 0), ("new", "unknown", 2), (None, "unknown", 1)}


def test_refresh_publishes_only_what_conforms(spark, tmp_path):
    builds = lake.BuildCatalog(spark, str(tmp_path))
    rows = [(IDS[s], date(1995, 1, 1 + d), *[10.0 * (s + 1) + d + x for x in (0, 2, -2, 1, 1)]) for s in range(3) for d in range(25)]
    bars = spark.createDataFrame(rows, "series_id string, observation_date date, open double, high double, low double, close double, level double")
    catalog.refresh_features(builds, "a", bars)
    first = builds.read(strict=True)
    assert first.count() == catalog.macro_features_long(bars).count() > 100
    with pytest.raises(catalog.NotConformant, match=r"rows\.duplicate_key"):
        catalog.refresh_features(builds, "b", bars.unionByName(bars))
    assert {r["build_id"]: (r["status"], r["is_current"]) for r in builds.table().collect()} == {"a": ("complete", True), "b": ("failed", False)}
