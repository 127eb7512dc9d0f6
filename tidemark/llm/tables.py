"""Tables between steps, and joins whose small side is broadcast only after its size was checked."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

#: Rows up to which the narrow side of a join may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000
#: The same for tables of large values, in bytes.
BROADCAST_BYTES = 48 << 20
#: Rows in a hash bucket where rows are numbered by buckets.
BUCKET_ROWS = 200_000
#: Rows in an Arrow batch of texts.
ARROW_ROWS = 1200


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: spark.checkpoint.dir, or, only where that is unset and all runs in one process, a new local one."""
    if not (folder := spark.conf.get("spark.checkpoint.dir", None)):
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table of long texts at ``path``.

    Texts are hundreds of times longer than the rows that Spark's default Arrow batch of 10,000 is meant for, so the
    session's batches are made smaller, for the memory of executors and of their Python workers.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(path)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back, which cuts its lineage and outlives lost executors."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/tidemark/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def masked(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named by place, "_0", "_1" and so on, and the new name of each old one.

    So columns that an operator adds meanwhile clash with none, whatever the table's are called.
    """
    names = [f"_{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names, strict=True))


def unmasked(names: dict[str, str], added: dict[str, Column] | None = None) -> list[Column]:
    """The old columns under their names, then ``added``, which stand in for old columns of their names."""
    added = added or {}
    return [F.col(m).alias(c) for c, m in names.items() if c not in added] + [x.alias(c) for c, x in added.items()]


def _wide(name: str, kind: DataType) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, StringType | BinaryType):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 16
    if isinstance(kind, ArrayType | MapType):
        return F.coalesce(F.size(name), F.lit(0)) * 32 + 16
    return F.lit(64 if isinstance(kind, StructType) else 8)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether the saved table ``df`` has ``rows`` rows and ``size`` bytes at most, as counted."""
    wide = sum((_wide(f"`{f.name}`", f.dataType) for f in df.schema.fields), F.lit(0))
    found = df.agg(F.count("*"), F.coalesce(F.sum(wide), F.lit(0))).first()
    return found[0] <= rows and found[1] <= size


def join_checked(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``left`` joined with the narrow, saved table ``right``, broadcast if it is_small."""
    return left.join(F.broadcast(right) if is_small(right, rows) else right, on, how)


def buckets_for(rows: int, spark: SparkSession) -> int:
    """Hash buckets for ``rows`` rows, so that a bucket has about BUCKET_ROWS however many there are."""
    return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))
