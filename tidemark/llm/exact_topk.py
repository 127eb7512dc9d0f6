"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are cut into segments; the means and deviations of segments bound an inner product from above (Cauchy-Schwarz
within each segment), as they bound a distance from below. Vectors go into blocks with others of the same signs of coarse
means, queries into blocks of their own, and the search goes from coarse to fine:

1. The box of a block's statistics bounds all inner products of two blocks. Each query block is first searched in the
   vector block of the highest bound, which gives every query a score to reach; pairs of blocks that can't reach it are
   dropped before any vector is joined.
2. In a pair of blocks, pairs of vectors are bounded on few, long segments, then those left on more, shorter ones.
3. Only what is left is scored: pair by pair if little is, else by one matrix product of the rows and columns left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import BROADCAST_BYTES, is_small, join_checked, saved

#: Vectors in a block, queries in a block, and the segment counts from coarse to fine.
BLOCK, QUERY_BLOCK, LEVELS = 2048, 256, (4, 16)
#: Bytes of vectors that a task holds at most before its fullest block is closed.
HELD_BYTES = 48 << 20
#: Share of the pairs of two blocks up to which they are scored one by one.
FEW = 0.05
#: Parts that a key of a join is dealt into where the queries are too many to broadcast.
SALTS = 32
#: Beyond this, squares of components may leave a double's range, and bounds are not looked at.
_LARGE = 1e75
#: Up to this size of a sum of products, doubles hold it exactly.
_EXACT = 2.0**52
_LEAST, _MOST = -(2**63), 2**63 - 1
_DOUBLE = np.finfo(float).max

_BLOCK_SCHEMA = "block long, dim int, ids binary, cells binary, box binary"


def quantised(lists: pa.Array, scale: int) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """floor(scale * x) of whole vectors, as doubles: by length, the rows' places and their matrix.

    Vectors that are null, or hold a null or a non-finite component, are left out. A product beyond a double's range is
    that range's limit.
    """
    out = {}
    lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths[lengths >= 0]).tolist():
        rows = np.flatnonzero(lengths == dim)
        cells = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), dim)
        good = np.isfinite(cells).all(axis=1)  # a null is a NaN here
        with np.errstate(over="ignore"):
            cells = np.clip(np.floor(scale * cells[good]), -_DOUBLE, _DOUBLE)
        out[dim] = (rows[good], cells)
    return lengths, out


def _packed(cells: np.ndarray) -> bytes:
    """Whole numbers as floats if these hold them, else as doubles."""
    return (cells.astype(np.float32) if np.abs(cells).max(initial=0) <= 2**24 else cells).tobytes()


def _unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = np.float32 if len(data) == 4 * rows * dim else np.float64
    return np.frombuffer(data, kind).reshape(rows, dim).astype(float)


def _cells(cells: np.ndarray) -> np.ndarray:
    """A number for the signs of a vector's coarse means."""
    with np.errstate(over="ignore", invalid="ignore"):
        signs = _statistics(cells, LEVELS[0])[:, ::2] > 0
    return signs @ (1 << np.arange(signs.shape[1]))


def _blocks(size: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        kept: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        rows: dict[tuple[int, int], int] = {}

        def closed(key: tuple[int, int]) -> pa.RecordBatch:
            nonlocal block
            block += 1
            rows.pop(key)
            ids, cells = (np.concatenate(x) for x in zip(*kept.pop(key), strict=True))
            columns = [pa.array([block], pa.int64()), pa.array([key[0]], pa.int32()), *[pa.array([x], pa.binary()) for x in (ids.tobytes(), _packed(cells), box(cells).tobytes())]]
            return pa.RecordBatch.from_arrays(columns, ["block", "dim", "ids", "cells", "box"])

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                for dim, (places, cells) in quantised(part.column("v"), scale)[1].items():
                    ids, group = part.column("id").to_numpy()[places], _cells(cells)
                    for g in np.unique(group).tolist():
                        key, mine = (dim, g), group == g
                        kept.setdefault(key, []).append((ids[mine], cells[mine]))
                        rows[key] = rows.get(key, 0) + int(mine.sum())
                        if rows[key] >= size:
                            yield closed(key)
                while sum(n * (k[0] + 1) * 8 for k, n in rows.items()) > HELD_BYTES:
                    yield closed(max(rows, key=lambda k: rows[k] * (k[0] + 1)))
        for key in list(kept):
            yield closed(key)

    return run


def _statistics(cells: np.ndarray, segments: int) -> np.ndarray:
    """Mean and deviation of each segment, so scaled that the inner product of two rows bounds that of the vectors."""
    dim = cells.shape[1]
    out = []
    for part in np.array_split(np.arange(dim), min(segments, dim)) if dim else []:
        weight = np.sqrt(len(part))
        out += [cells[:, part].mean(axis=1) * weight, cells[:, part].std(axis=1) * weight]
    return np.stack(out, axis=1) if out else np.zeros((len(cells), 1))


def box(cells: np.ndarray) -> np.ndarray:
    """Least and highest value of each of the finest statistics in a block; infinite if components are too large."""
    if np.abs(cells).max(initial=0) > _LARGE:
        return np.full((2, 2 * max(1, min(LEVELS[-1], cells.shape[1]))), np.inf)
    found = _statistics(cells, LEVELS[-1])
    return np.stack([found.min(axis=0), found.max(axis=0)])


def box_bound(a: np.ndarray, b: np.ndarray) -> float:
    """What no inner product of vectors of two blocks exceeds."""
    if not (np.isfinite(a).all() and np.isfinite(b).all()):
        return np.inf
    bound = float(np.max([a[i] * b[j] for i in (0, 1) for j in (0, 1)], axis=0).sum())
    return bound + 1e-9 * abs(bound) + 1e-6


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products as longs; beyond a long's range, its limit."""
    if not len(a) or np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < _EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    return np.array([min(_MOST, max(_LEAST, sum(int(p) * int(q) for p, q in zip(x, y, strict=True)))) for x, y in zip(a, b, strict=True)], np.int64)


def best_in_block(queries: np.ndarray, query_ids: np.ndarray, cells: np.ndarray, ids: np.ndarray, k: int, reached: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of pairs that hold each query's best k of this block, own rows left out.

    ``reached`` is a score that each query's k-th best is known to reach; it is raised here.
    """
    alive = query_ids[:, None] != ids[None, :]
    columns = np.arange(len(cells))
    bounded = max(np.abs(queries).max(initial=0), np.abs(cells).max(initial=0)) <= _LARGE
    for level in LEVELS if bounded else ():  # the vectors that no query needs any more are left out of the finer levels
        bound = _statistics(queries, level) @ _statistics(cells[columns], level).T
        bound += 1e-9 * np.abs(bound) + 1e-6  # beyond what rounding may take away
        if level == LEVELS[0] and len(columns) > k and np.isneginf(reached).any():
            # those with the highest bounds give a first score to reach
            bound[~alive] = -np.inf
            top = np.argpartition(-bound, k, axis=1)[:, : k + 1]
            q = np.repeat(np.arange(len(queries)), k + 1)
            tried = np.where(alive[q, top.ravel()], _exact(queries[q], cells[top.ravel()]).astype(float), -np.inf)
            np.maximum(reached, np.sort(tried.reshape(len(queries), -1), axis=1)[:, 1], out=reached)
        alive &= bound >= (reached - 1e-9 * np.abs(np.where(np.isneginf(reached), 0, reached)))[:, None]
        wanted = alive.any(axis=0)
        alive, columns = alive[:, wanted], columns[wanted]
    chosen = cells[columns]
    small = np.abs(queries).max(initial=0) * np.abs(chosen).max(initial=0) * max(1, queries.shape[1]) < _EXACT
    if small and alive.size and alive.mean() > FEW:
        product = queries @ chosen.T
        q, x = np.nonzero(alive & (product >= reached[:, None]))
        score = product[q, x].astype(np.int64)
    else:
        q, x = np.nonzero(alive)
        parts = [_exact(queries[q[i : i + 65536]], chosen[x[i : i + 65536]]) for i in range(0, len(q), 65536)]
        score = np.concatenate([*parts, np.zeros(0, np.int64)])
    order = np.lexsort((ids[columns[x]], ~score, q))  # ~ turns the order of longs around without overflow
    q, x, score = q[order], columns[x[order]], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    full = place == k - 1
    np.maximum.at(reached, q[full], score[full].astype(float))
    return q[place < k], x[place < k], score[place < k]


def _block_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bounds = [box_bound(*(np.frombuffer(v).reshape(2, -1) for v in pair)) for pair in zip(batch.column("box").to_pylist(), batch.column("query_box").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("query_block"), pa.array(bounds, pa.float64())], ["block", "query_block", "bound"])


def _searched(k: int, seeds: bool):
    """The best of each pair of blocks, or, with ``seeds``, only what each query of it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, ids = np.frombuffer(row["query_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                queries, cells = _unpacked(row["query_cells"], len(query_ids), row["dim"]), _unpacked(row["cells"], len(ids), row["dim"])
                if len(known) > 4096:
                    known.clear()
                if row["query_block"] not in known:
                    known[row["query_block"]] = np.frombuffer(row["reached"]).copy() if row["reached"] else np.full(len(query_ids), -np.inf)
                reached = known[row["query_block"]]
                q, x, score = best_in_block(queries, query_ids, cells, ids, k, reached)
                if seeds:
                    columns = [pa.array([row["query_block"]]), pa.array([reached.tobytes()], pa.binary()), pa.array([float(reached.min())])]
                    yield pa.RecordBatch.from_arrays(columns, ["query_block", "reached", "least"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(query_ids[q]), pa.array(ids[x]), pa.array(score)], ["query_id", "vec_id", "score"])

    return run


def _met(left: DataFrame, queries: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """``left`` joined with the blocks of queries, which are broadcast or dealt out to parts of each key."""
    if small:
        return left.join(F.broadcast(queries), keys)
    left = left.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(SALTS)))
    return left.join(queries.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), [*keys, "salt"]).drop("salt")


def _blocks_of(vectors: DataFrame, is_query: str, id_col: str, vector_col: str, scale: int) -> tuple[DataFrame, DataFrame]:
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    queries = rows.where(f"({is_query}) and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))").groupBy("id").agg(F.min("v").alias("v"))
    named = {"ids": "query_ids", "cells": "query_cells", "box": "query_box", "block": "query_block"}
    return saved(rows.mapInArrow(_blocks(BLOCK, scale), _BLOCK_SCHEMA)), saved(queries.mapInArrow(_blocks(QUERY_BLOCK, scale), _BLOCK_SCHEMA).withColumnsRenamed(named))


def block_pairs(blocks: DataFrame, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, reached): the pairs (block, query_block) that can hold a query's best, and for each query block what its queries reach."""
    boxes, query_boxes = blocks.select("block", "dim", "box"), saved(queries.select("query_block", "dim", "query_box"))
    bounds = saved(_met(boxes, query_boxes, ["dim"], is_small(query_boxes)).select("block", "query_block", "box", "query_box").mapInArrow(_block_bounds, "block long, query_block long, bound double"))
    best = saved(bounds.groupBy("query_block").agg(F.max_by("block", F.struct("bound", "block")).alias("block")))
    first = join_checked(blocks, best, "block", "inner").join(queries.drop("dim"), "query_block").withColumn("reached", F.lit(None).cast("binary"))
    reached = saved(first.mapInArrow(_searched(k, True), "query_block long, reached binary, least double"))
    pairs = join_checked(bounds, reached.select("query_block", "least"), "query_block", "inner").where("bound >= least - 1e-9 * abs(least) or isnan(bound)")
    return saved(pairs.select("block", "query_block")), reached


def top_k(vectors: DataFrame, is_query: str, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` highest integer inner products, ties to the smaller id.

    Components x become floor(scale * x). Queries are the rows for which the SQL condition ``is_query``, over a column
    ``id``, holds; candidates are all rows with another id.

    - Vectors that are null or hold a null or a non-finite component, and rows without an id, take no part.
    - Only vectors of equal length are compared. Fewer than k candidates: all of them. No query: an empty result.
    - A candidate on several rows is several candidates; of a query on several rows, the least vector is searched.
    - A scaled component beyond a double's range is that range's limit, and a score beyond a long's range is that one's.
      Other columns of ``vectors`` are not looked at.
    """
    blocks, queries = _blocks_of(vectors, is_query, id_col, vector_col, scale)
    pairs, reached = block_pairs(blocks, queries, k)
    queries = saved(queries.join(reached.select("query_block", "reached"), "query_block").select("query_block", "query_ids", "query_cells", "reached"))
    size = queries.agg(F.sum(F.octet_length("query_cells") + F.octet_length("query_ids") + F.octet_length("reached"))).first()[0] or 0
    pairs = join_checked(blocks.drop("box"), pairs, "block", "inner")
    found = _met(pairs, queries, ["query_block"], size <= BROADCAST_BYTES).drop("block").mapInArrow(_searched(k, False), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
