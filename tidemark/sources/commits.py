"""Tables that change together: files are written beside what is there, and one row set in a manifest makes them visible.

A commit writes the data of any number of tables under names of its own, reads them back, and then appends what it wrote to
the manifest, as one file. Readers go by the manifest alone: of each part of a table (say a month of a series) the files of
its last commit. What a commit that failed has left is in no manifest and so in no table; a reader never lists a folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: A row of the manifest: a file, or, without one, a part that the commit left empty.
MANIFEST = "commit_id string, committed_at_utc timestamp, table string, part string, file string, n_rows long, digest decimal(38,0)"


class DigestMismatch(RuntimeError):
    """What was read back isn't what was written."""


class PathEscape(ValueError):
    """A catalog names a file outside its root."""


def confined(root: str, path: str) -> str:
    """``path``, which is relative, under ``root``; PathEscape if it leads out of it."""
    if path.startswith("/") or ":" in path.split("/")[0] or any(p in ("", ".", "..") for p in unquote(path).split("/")):
        raise PathEscape(f"not under the root: {path!r}")
    return f"{root.rstrip('/')}/{path}"


def row_hash(columns: list[str]) -> Column:
    """A hash of a row that tells nulls from values and cells from each other."""
    return F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])


def multiset_digest(df: DataFrame) -> list[Column]:
    """(n_rows, digest) as aggregates: how many rows there are and the sum of their hashes, whatever their order and partitions."""
    return [F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(row_hash(sorted(df.columns)).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("digest")]


def write_checked(df: DataFrame, path: str, by: list[str] | None = None, fault: Callable[[str], None] = lambda step: None) -> DataFrame:
    """Writes ``df`` at ``path``, where there must be nothing, and returns a row for each file: file, n_rows, digest, and the part that ``by`` makes.

    Rows are counted and hashed while they are written, and again as they are read back; if these differ, DigestMismatch.
    """
    seen = Observation()
    rows = df.observe(seen, *multiset_digest(df))
    writer = rows.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    fault("written")
    spark = df.sparkSession
    back = spark.read.schema(df.schema).parquet(path)
    part = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in by or []])
    name = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))  # it is that of a URI
    files = back.groupBy(name.alias("file"), part.alias("part")).agg(*multiset_digest(back)).cache()
    total = files.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("digest"), F.lit(0)).alias("digest")).first()
    if (total["n_rows"], int(total["digest"])) != (seen.get["n_rows"], int(seen.get["digest"])):
        files.unpersist()
        raise DigestMismatch(f"{path}: {seen.get['n_rows']} rows written, {total['n_rows']} read back, or their digests differ")
    return files


class Commits:
    """The tables under ``root``, as its manifest says. One process commits at a time; any number reads."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/_manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)  # nothing was committed so far

    def files(self, table: str, where: Column | str = "true") -> DataFrame:
        """The manifest's rows of what ``table`` holds now, or of the parts that meet ``where``, a condition over ``part``."""
        last = Window.partitionBy("part").orderBy(F.desc("committed_at_utc"), F.desc("commit_id"))
        rows = self.manifest().where(F.col("table") == table).where(where)
        return rows.withColumn("_place", F.dense_rank().over(last)).where("_place = 1 and file is not null").drop("_place")

    def read(self, table: str, schema: str, where: Column | str = "true") -> DataFrame:
        """The rows of ``table`` (or of some of its parts): exactly the files that the manifest lists.

        A file that isn't listed isn't read, wherever it lies; one that is listed and gone is an error; one listed outside the
        root raises PathEscape. ``schema`` is that of the table, with the columns of its parts.
        """
        found = [confined(self.root, r["file"]) for r in self.files(table, where).select("file").distinct().collect()]  # names of files
        if not found:
            return self.spark.createDataFrame([], schema)
        columns = self.spark.createDataFrame([], schema).columns
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*sorted(found)).select(*columns)

    def commit(self, tables: dict[str, tuple[DataFrame, list[str]]], emptied: dict[str, list[str]] | None = None, fault: Callable[[str], None] = lambda step: None) -> str:
        """Writes ``tables`` (name to rows and the columns that make its parts) and makes them visible together; returns the commit's id.

        The rows of a part replace what the table had of it; other parts stay as they are. ``emptied`` names parts that are
        left without rows. ``fault`` is called with the name of each step that is done; whatever it or a step raises leaves
        every table as it was.
        """
        commit_id = uuid.uuid4().hex
        listed: list[DataFrame] = []
        written: list[DataFrame] = []
        try:
            for name, (df, by) in tables.items():
                files = write_checked(df, f"{self.root}/{name}/commit={commit_id}", by, lambda step, name=name: fault(f"{name} {step}"))
                written.append(files)
                listed.append(files.select(F.lit(name).alias("table"), "part", F.element_at(F.split("file", f"/(?={name}/commit={commit_id}/)"), -1).alias("file"), "n_rows", "digest"))
                fault(name)
            gone = [(name, part) for name, parts in (emptied or {}).items() for part in parts]
            if gone:
                listed.append(self.spark.createDataFrame(gone, "table string, part string").select("table", "part", F.lit(None).cast("string").alias("file"), F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("decimal(38,0)").alias("digest")))
            if listed:
                rows = reduce(lambda a, b: a.unionByName(b), listed).select(F.lit(commit_id).alias("commit_id"), F.lit(datetime.now(timezone.utc)).alias("committed_at_utc"), "*")
                rows.coalesce(1).write.mode("append").parquet(f"{self.root}/_manifest")  # a row for each file, as one file
        finally:
            for files in written:
                files.unpersist()
        fault("manifest")
        return commit_id

    def inventory(self) -> DataFrame:
        """(table, n_parts, n_files, n_rows, last_commit_utc): what every table holds now, by the manifest alone."""
        last = Window.partitionBy("table", "part").orderBy(F.desc("committed_at_utc"), F.desc("commit_id"))
        now = self.manifest().withColumn("_place", F.dense_rank().over(last)).where("_place = 1 and file is not null")
        return now.groupBy("table").agg(F.count_distinct("part").alias("n_parts"), F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"), F.max("committed_at_utc").alias("last_commit_utc"))
