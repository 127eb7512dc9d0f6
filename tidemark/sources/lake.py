"""The lake: partitioned tables, immutable builds and their catalog."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.commits import confined, write_checked
from tidemark.sources.versions import FEATURE, SCHEMA

CATALOG_SCHEMA = (
    "build_id string, path string, status string, is_current boolean, schema_version int, feature_version int, row_count long, digest decimal(38,0), "
    "created_at_utc timestamp, completed_at_utc timestamp"
)


def observation_bounds(df: DataFrame, day: str) -> DataFrame:
    """First and last day of a column of dates or times; Parquet statistics may answer it, as it is cast only afterwards."""
    return df.agg(F.min(day).alias("first_date"), F.max(day).alias("last_date")).select(F.to_date("first_date").alias("first_date"), F.to_date("last_date").alias("last_date"))


def write_changed_months(table: DataFrame, diff: DataFrame, path: str, day: str = "observation_date", by: str = "series_id") -> int:
    """Writes again only the months of ``table`` in which ``diff`` has a change; returns how many there are.

    ``table`` is the state after the merge and mustn't be read from ``path`` itself. Nothing changed: nothing is written.
    """
    months = diff.where("change_type <> 'unchanged'").select(by, F.year(day).alias("year"), F.month(day).alias("month")).distinct().cache()
    if n := months.count():
        rows = table.withColumns({"year": F.year(day), "month": F.month(day)}).join(months, [by, "year", "month"], "left_semi")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by, "year", "month").parquet(path)
    months.unpersist()
    return n


def fetch_windows(registry: DataFrame, history: DataFrame, today: str, overlap_days: int = 7, reconcile: bool = False) -> DataFrame:
    """What to fetch for each series of ``registry`` (series_id, fetch), from the last stored day of ``history``.

    Without history: everything (bootstrap). Else the last ``overlap_days`` days before the last stored one and what
    follows (update), for revisions; or everything again (reconcile). Sources that only have whole files are filtered by
    the same window. first_date is null where there is no lower bound; only request_from is what a source is asked for.
    """
    last = history.groupBy("series_id").agg(F.max("observation_date").alias("last_date"))
    rows = registry.join(last, "series_id", "left")
    mode = F.when(F.col("last_date").isNull(), "bootstrap").otherwise("reconcile" if reconcile else "update")
    first = F.when((mode == "update"), F.date_sub("last_date", overlap_days))
    request = F.when(F.col("fetch") == "date_range", first)
    return rows.select("series_id", mode.alias("mode"), request.alias("request_from"), first.alias("first_date"), F.lit(today).cast("date").alias("last_date"))


def _compatible(least_schema: int, feature_version: int) -> Column:
    return (F.col("schema_version") >= least_schema) & (F.col("feature_version") == feature_version)


def _current(catalog: DataFrame) -> Column:
    return F.coalesce("is_current", F.lit(False)) if "is_current" in catalog.columns else F.lit(False)


def superseded_builds(catalog: DataFrame, keep: int) -> DataFrame:
    """Complete builds beyond the newest ``keep`` of their pair of versions; never the current one."""
    newest = Window.partitionBy("schema_version", "feature_version").orderBy(F.desc("completed_at_utc"), F.desc("build_id"))
    placed = catalog.where("status = 'complete'").withColumn("place", F.row_number().over(newest))
    return placed.where((F.col("place") > keep) & ~_current(catalog)).drop("place")


def latest_compatible(catalog: DataFrame, least_schema: int, feature_version: int) -> DataFrame:
    """The complete build that a reader of these versions can use: the current one if it is such, else the newest, or none."""
    fits = catalog.where((F.col("status") == "complete") & _compatible(least_schema, feature_version))
    return fits.orderBy(_current(catalog).desc(), F.desc("completed_at_utc"), F.desc("build_id")).limit(1)


def resolutions(catalog: DataFrame, least_schema: int, feature_version: int, by: list[str]) -> DataFrame:
    """``by``, strict_build, strict_reason, latest_build, latest_reason: which build of each dataset a reader gets.

    Strictly, only the current build: where there is none, several, or one that isn't complete or doesn't fit, there is no
    build and the reason says so. By the other policy the current build if it will do, else the newest complete one that
    fits; several current ones are an error by either. One aggregation: a dataset may have any number of builds.
    """
    fits = (F.col("status") == "complete") & _compatible(least_schema, feature_version)
    row = F.struct("build_id", (F.col("status") == "complete").alias("complete"), _compatible(least_schema, feature_version).alias("fits"))
    found = catalog.groupBy(*by).agg(
        F.count_if(_current(catalog)).alias("n"), F.max(F.when(_current(catalog), row)).alias("current"), F.max_by("build_id", F.when(fits, F.struct("completed_at_utc", "build_id"))).alias("newest"), F.count_if(fits).alias("n_fit")
    )
    strict = F.when(F.col("n") == 0, "no current").when(F.col("n") > 1, "several current").when(~F.col("current.complete"), "not complete").when(~F.col("current.fits"), "not compatible").otherwise("current")
    latest = F.when(F.col("n") > 1, "several current").when(strict == "current", "current").when(F.col("n_fit") > 0, "newest").otherwise("none")
    of = F.when(latest == "current", F.col("current.build_id")).when(latest == "newest", F.col("newest"))
    return found.select(*by, F.when(strict == "current", F.col("current.build_id")).alias("strict_build"), strict.alias("strict_reason"), of.alias("latest_build"), latest.alias("latest_reason"))


class BuildCatalog:
    """The builds under ``root``, each a directory of its own that is written once.

    A build is registered as building, becomes complete and current, or failed, and only a complete one is ever read. What
    happens to builds is appended to a Parquet table of events, each append as one file; a build's last event is its state.
    One process publishes at a time.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def events(self) -> DataFrame:
        schema = f"{CATALOG_SCHEMA}, recorded_at_utc timestamp"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/catalog")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)  # no build so far

    def table(self) -> DataFrame:
        """One row for each build."""
        # should two events be of one moment, what ends a build comes after its beginning
        last = Window.partitionBy("build_id").orderBy(F.desc("recorded_at_utc"), F.col("status") == "building", F.col("is_current"))
        return self.events().withColumn("place", F.row_number().over(last)).where("place = 1").drop("place", "recorded_at_utc")

    def _put(self, rows: DataFrame) -> None:
        at = F.lit(datetime.now(timezone.utc))
        rows.withColumn("recorded_at_utc", at).coalesce(1).write.mode("append").parquet(f"{self.root}/catalog")  # a row or two for each build

    def publish(self, build_id: str, data: DataFrame, schema_version: int = SCHEMA, feature_version: int = FEATURE, fault: Callable[[str], None] = lambda step: None) -> str:
        """Writes ``data`` as an immutable build, reads it back, and makes it the one current build; returns its path.

        An id that was used before is refused and changes nothing, whatever became of that build. What is read back must have
        the rows and the digest of what was written (DigestMismatch). On any failure before the promotion the build is marked
        failed, the current one stays, and the error is raised.
        """
        path = confined(self.root, f"versions/build_id={build_id}")
        builds = self.table()
        if not builds.where(F.col("build_id") == build_id).isEmpty():
            raise ValueError(f"there is a build {build_id} already")
        begun = datetime.now(timezone.utc)

        def row(status: str, n: int | None = None, digest: Decimal | None = None) -> DataFrame:
            done = datetime.now(timezone.utc) if status != "building" else None
            return self.spark.createDataFrame([(build_id, f"versions/build_id={build_id}", status, status == "complete", schema_version, feature_version, n, digest, begun, done)], CATALOG_SCHEMA)

        self._put(row("building"))
        try:
            fault("building")
            files = write_checked(data, path, fault=fault)
            total = files.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"), F.coalesce(F.sum("digest"), F.lit(0)).alias("digest")).first()
            files.unpersist()
            before = builds.where("is_current").withColumn("is_current", F.lit(False))
            self._put(row("complete", int(total["n"]), total["digest"]).unionByName(before))
        except BaseException:
            self._put(row("failed"))
            raise
        return path

    def recover(self, before: datetime | None = None) -> None:
        """Marks builds left building by a lost run as failed: those begun before ``before``, or all, if nothing is publishing."""
        stale = self.table().where("status = 'building'")
        if before is not None:
            stale = stale.where(F.col("created_at_utc") < F.lit(before))
        if not stale.isEmpty():
            self._put(stale.withColumns({"status": F.lit("failed"), "is_current": F.lit(False), "completed_at_utc": F.lit(datetime.now(timezone.utc))}))

    def prune(self, keep: int = 5) -> list[str]:
        """Gives up complete builds beyond the newest ``keep`` of their versions: first in the catalog, then on disk, where an empty table takes their place."""
        old = superseded_builds(self.table(), keep).withColumn("status", F.lit("pruned"))
        rows = old.collect()  # a row for each build
        if rows:
            self._put(old)
        given_up = self.table().where("status = 'pruned'")
        for row in given_up.collect():
            path = confined(self.root, row["path"])
            self.spark.createDataFrame([], "pruned boolean").write.mode("overwrite").parquet(path)
        if not given_up.isEmpty():
            self._put(given_up.withColumn("status", F.lit("swept")))
        return sorted(r["build_id"] for r in rows)

    def read(self, least_schema: int = SCHEMA, feature_version: int = FEATURE, strict: bool = False) -> DataFrame:
        """The current build, or, unless ``strict``, the newest one that fits where it doesn't; never what merely lies on disk.

        LookupError if there is none to be had, ValueError if several builds are current.
        """
        builds = self.table()
        found = resolutions(builds, least_schema, feature_version, []).first()
        build, reason = (found["strict_build"], found["strict_reason"]) if strict else (found["latest_build"], found["latest_reason"])
        if reason == "several current":
            raise ValueError("several builds are current")
        if build is None:
            raise LookupError(f"no compatible complete build ({reason})")
        return self.spark.read.parquet(confined(self.root, builds.where(F.col("build_id") == build).first()["path"]))
