"""Vector compression by product quantisation with integer codebooks.

A vector's components become whole numbers and are cut into equal parts; a part is coded by the nearest of its codebook's
entries. The codebooks are fitted in rounds, each one pass over the vectors: the books are broadcast (their size is fixed
by the parameters and the vectors' length), a task finds the nearest entries of a batch of parts by expanding the norm,
|x - c|^2 = |x|^2 - 2 x.c + |c|^2, with one exact product of long matrices for all parts and entries, and adds up what it
gives to each entry. A task so returns a row for each component of the books, however many vectors it has read, and these
are summed in one grouped shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import is_small, saved
from tidemark.llm.words import tidy

#: Parts of a vector, entries of a codebook, rounds of fitting, and what components are multiplied by.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Bytes of distances that a task holds at a time.
HELD_BYTES = 8 << 20
#: Parts that a label's vectors are dealt into where there are too many labels to broadcast.
SALTS = 32


def largest_component(dim: int) -> int:
    """What no component's magnitude may reach, so that every distance of vectors of ``dim`` components is a long."""
    return int((2**60 / dim) ** 0.5)


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, distance), rows by parts: the first nearest of ``books`` (part, entry, position) to each part of ``x`` (row, part, position)."""
    product = np.matmul(x.transpose(1, 0, 2), books.transpose(0, 2, 1))  # long by long, (part, row, entry)
    away = np.square(books).sum(axis=2)[:, None, :] - 2 * product
    index = away.argmin(axis=2)
    distance = np.take_along_axis(away, index[:, :, None], axis=2)[:, :, 0].T + np.square(x).sum(axis=2)
    return index.T, distance


def _parts(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of ``batches`` in steps, each with its components as (row, part, position)."""
    parts, entries, width = books.shape
    rows = max(1, HELD_BYTES // (parts * entries * 8))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            piece = batch.slice(at, rows)
            yield piece, piece.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, parts, width)
    tidy()


def _summed(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        parts, entries, width = books.shape
        counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for _, x in _parts(batches, books):
            slots = (nearest(x, books)[0] + np.arange(parts) * entries).ravel()
            counts += np.bincount(slots, minlength=len(counts))
            np.add.at(sums, slots, x.reshape(-1, width))
        slots = np.flatnonzero(counts)
        places = np.tile(np.arange(width), len(slots))
        columns = [pa.array(np.repeat(slots, width).astype(np.int32)), pa.array(places.astype(np.int32)), pa.array(np.repeat(counts[slots], width)), pa.array(sums[slots].ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "place", "n", "total"])

    return run


def _coded(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        for piece, x in _parts(batches, books):
            index, distance = nearest(x, books)
            codes = ["".join(f"{i:02x}" for i in row) for row in index.tolist()]
            yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("label"), pa.array(codes), pa.array(distance.sum(axis=1))], ["id", "label", "code", "error"])

    return run


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, int]:
    """(id, label, x) of all vectors that take part, as whole numbers, and their length (0: none takes part)."""
    v = F.col(vector_col)
    good = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.when(good, v).alias("v")).where("v is not null")
    rows = rows.select("id", "label", F.transform("v", lambda c: F.floor(c.cast("double") * float(SCALE))).alias("x"), F.size("v").alias("dim"))
    first = rows.orderBy(F.asc_nulls_last("id"), "x").first()
    if first is None or first["dim"] == 0:
        return rows.drop("dim").limit(0), 0
    dim = first["dim"]
    most = F.array_max(F.transform("x", lambda c: F.abs(c)))
    fits = F.assert_true(most < largest_component(dim), F.lit(f"a component of {largest_component(dim)} or more, whose distances a long can't hold"))
    rows = rows.where(F.col("dim") == dim).select("id", "label", F.when(fits.isNull(), F.col("x")).cast("array<int>").alias("x"))
    return saved(rows), dim


def fit_books(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (part, entry, position) after ``rounds`` rounds over ``rows`` (id, label, x)."""
    start = rows.orderBy(F.asc_nulls_last("id"), "x").limit(entries).select("x").collect()  # ``entries`` rows
    books = np.array([r["x"] for r in start], np.int64).reshape(len(start), parts, dim // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        held = rows.sparkSession.sparkContext.broadcast(books)
        sums = rows.select("x").mapInArrow(_summed(held), "slot int, place int, n long, total long")
        found = sums.groupBy("slot", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect()  # a row for each component of the books
        books = books.copy()
        for r in found:
            part, entry = divmod(r["slot"], books.shape[1])
            books[part, entry, r["place"]] = int(r["total"]) // r["n"]
        held.destroy()
    return books


def _with_totals(coded: DataFrame, of: str, by: str, into: str) -> DataFrame:
    """``coded`` with the sum of ``of`` over all rows of equal ``by``, nulls being equal."""
    totals = saved(coded.groupBy(F.col(by).alias("_by")).agg(F.sum(of).alias(into)))
    same = F.col(by).eqNullSafe(F.col("_by"))
    if is_small(totals):
        return coded.join(F.broadcast(totals), same).drop("_by")
    # a label's rows are dealt out to parts, so that none is one task's
    dealt = coded.withColumn("_salt", F.pmod(F.xxhash64("id", "code", "error"), F.lit(SALTS)).cast("int"))
    totals = totals.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(totals, same & (F.col("_salt") == F.col("_part"))).drop("_by", "_salt", "_part")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``id_col``, code, error, label_error, codebooks_sha256 of every vector that takes part.

    Components x become floor(256 x). A part's codebook starts as that part of the ``entries`` vectors of the smallest ids;
    each round assigns all parts to their nearest entries (ties to the lower index) and moves each entry to the floor of its
    parts' mean; entries without parts stay. ``error`` is the final squared distance, ``label_error`` its sum over the label.

    - Vectors that are null, empty or hold a null or a non-finite component take no part, nor do those of another length than
      that of the smallest id. A length that isn't a multiple of ``parts`` raises ValueError; a component so large that a
      distance might not be a long ends the job with an error (for 64 components: 2^27 and more, after scaling).
    - Null ids come after all others; vectors of one id are ordered by their components. Repeated rows are rows of their own,
      and fewer rows than ``entries`` make as many entries. Null labels are equal. An empty table gives an empty result.
    - Other columns of ``vectors``, whatever their names, are not looked at.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits")
    rows, dim = whole_numbers(vectors, id_col, vector_col, label_col)
    id_type = vectors.schema[id_col].dataType.simpleString()
    if not dim:
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` {id_type}, code string, error long, label_error long, codebooks_sha256 string")
    if dim % parts:
        raise ValueError(f"{dim} components can't be cut into {parts} equal parts")
    books = fit_books(rows, dim, parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    held = rows.sparkSession.sparkContext.broadcast(books)
    label_type = vectors.schema[label_col].dataType.simpleString()
    coded = saved(rows.mapInArrow(_coded(held), f"id {id_type}, label {label_type}, code string, error long"))
    out = _with_totals(coded, "error", "label", "label_error")
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
