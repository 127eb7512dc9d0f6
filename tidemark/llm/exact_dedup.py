"""Exact dedup against a minimal perfect hash of the digests already known.

Texts are equal when they agree without white space; a text's digest is the SHA-256 of what is left. The index is a table
with a row for each range of digests. A row holds a minimal perfect hash of the range's distinct digests, which gives each
of them a slot of its own, and the slots: the whole digest, and a locator of the row that stays (its size, id and number)
with the count of rows. A lookup computes the slot and compares all 32 bytes, so a digest that the index lacks is never
taken for one that it has.

Texts that arrive are looked up in the index. Those found are repeats: they only add to their slot, and may take its
locator over. The others are grouped by themselves and get an index of their own. At last every row looks up what became
of its text. Rows of one range are dealt out to as many tasks as they need, each with a copy of that range's row of the
index, so a text may be on any share of the rows.

The perfect hash is that of levels: a level is a bit array into which all digests left are hashed; those alone on their bit
are done, and their slot is the number of bits set before; the others go on to the next level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import join_checked, saved
from tidemark.llm.words import scramble

#: Digests in a range of the index, and rows that one task looks up in it, about.
RANGE_DIGESTS, LOOKUP_ROWS = 50_000, 200_000
#: Bits of a level for each digest that is left, and levels after which the rest is kept as a sorted list.
SPREAD, LEVELS = 2.0, 40

INDEX = "range int, sizes binary, bits binary, rest binary, digests binary, chars binary, ids binary, uids binary, counts binary"
#: What Unicode's ASCII white space is here: space and U+0009 to U+000D.
SPACES = " \t\n\v\f\r"


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit of each digest (a row of four 64-bit words) on a level of ``size`` bits."""
    mixed = words[:, level % 4] ^ (words[:, (level + 1) % 4] >> np.uint64(level // 4 % 32))
    return (scramble(mixed + np.uint64((level * 0x9E3779B97F4A7C15) % 2**64)) % np.uint64(size)).astype(np.int64)


def perfect_hash(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, bits, rest, slots) for distinct ``digests`` (rows of 32 bytes): each level's bits, those left over, and each digest's slot."""
    words = np.ascontiguousarray(digests).view(np.uint64).reshape(-1, 4)
    slots, left = np.zeros(len(words), np.int64), np.arange(len(words))
    sizes, arrays, before = [], [], 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(8, int(SPREAD * len(left)))
        at = _places(words[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        done = alone[at]
        slots[left[done]] = before + np.cumsum(alone)[at[done]] - 1
        before += int(alone.sum())
        sizes.append(size)
        arrays.append(alone)
        left = left[~done]
    rest = digests[left]
    order = np.lexsort(rest.T[::-1])
    slots[left[order]] = before + np.arange(len(left))
    return np.array(sizes, np.int64), np.packbits(np.concatenate([*arrays, np.zeros(0, bool)])), rest[order], slots


def slots_of(digests: np.ndarray, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The slot of each digest, -1 where ``known`` (the digest of each slot) lacks it."""
    words = np.ascontiguousarray(digests).view(np.uint64).reshape(-1, 4)
    flat = np.unpackbits(bits, count=int(sizes.sum())).astype(bool)
    rank = np.cumsum(flat) - 1
    slots, left, start = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for level, size in enumerate(sizes.tolist()):
        at = start + _places(words[left], level, size)
        hit = flat[at]
        slots[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + size
    if len(rest) and len(left):
        listed = {r.tobytes(): len(known) - len(rest) + i for i, r in enumerate(rest)}
        slots[left] = [listed.get(d.tobytes(), -1) for d in digests[left]]
    found = slots >= 0
    found[found] = (known[slots[found]] == digests[found]).all(axis=1)  # byte by byte
    return np.where(found, slots, -1)


def _digests(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


_VALUES = ("chars", "ids", "uids", "counts")


def _row(at: int, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray, known: np.ndarray, values: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame([[at, *(x.tobytes() for x in (sizes, bits, rest, known, *values))]], columns=["range", "sizes", "bits", "rest", "digests", *_VALUES])


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    digests = _digests(rows["digest"])
    sizes, bits, rest, slots = perfect_hash(digests)
    order = np.argsort(slots)
    values = [rows[c].to_numpy(np.int64)[order] for c in ("chars", "id", "uid", "n")]
    return _row(int(rows["range"].iloc[0]), sizes, bits, rest, digests[order], values)


def _opened(row) -> tuple[list[np.ndarray], list[np.ndarray]]:
    sizes, bits = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["bits"], np.uint8)
    rest, known = (np.frombuffer(row[c], np.uint8).reshape(-1, 32) for c in ("rest", "digests"))
    return [sizes, bits, rest, known], [np.frombuffer(row[c], np.int64) for c in _VALUES]


def _updated(index: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """A range's row of the index after one row for each digest that was found in it again."""
    if index.empty:
        return index
    table, values = _opened(index.iloc[0])
    if rows.empty:
        return index
    chars, ids, uids, counts = (v.copy() for v in values)
    at = slots_of(_digests(rows["digest"]), *table)
    new = [rows[c].to_numpy(np.int64) for c in ("chars", "id", "uid", "n")]
    counts[at] += new[3]
    better = np.array([(-c, i, u) < (-chars[s], ids[s], uids[s]) for s, c, i, u in zip(at, *new[:3], strict=True)], bool)
    for old, x in zip((chars, ids, uids), new[:3], strict=True):
        old[at[better]] = x[better]
    return _row(int(index["range"].iloc[0]), *table, [chars, ids, uids, counts])


#: Stands for the id null in the index, and is behind every other id.
_NO_ID = 2**63 - 1
_FOUND = "uid long, known boolean, keep_uid long, keep_id long, group_size long"


def _looked_up(rows: pa.Table, index: pa.Table) -> pa.Table:
    uids = rows.column("uid").combine_chunks()
    columns = [np.zeros(len(uids), bool), *(np.zeros(len(uids), np.int64) for _ in range(3))]
    if index.num_rows and len(uids):
        table, (_, ids, keepers, counts) = _opened(index.to_pylist()[0])
        slots = slots_of(_digests(rows.column("digest").to_pylist()), *table)
        found = slots >= 0
        columns[0] = found
        for out, values in zip(columns[1:], (keepers, ids, counts), strict=True):
            out[found] = values[slots[found]]
    return pa.table([uids, *map(pa.array, columns)], names=["uid", "known", "keep_uid", "keep_id", "group_size"])


def _range(ranges: int):
    return F.pmod(F.xxhash64("digest"), F.lit(ranges)).cast("int")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, id, chars, digest) of all rows: a number of its own, the code points of the whole text, and the digest of what isn't white space."""
    text = F.coalesce(text_col, F.lit(""))
    bare = text
    for space in SPACES:
        bare = F.replace(bare, F.lit(space), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.length(text).cast("long").alias("chars"), F.unhex(F.sha2(bare, 256)).alias("digest"))
    return saved(rows.withColumn("uid", F.monotonically_increasing_id()))


def _groups(rows: DataFrame) -> DataFrame:
    """Each distinct digest once, with the row that stays and how many there are; summed up before anything is shuffled."""
    best = F.min(F.struct((-F.col("chars")).alias("chars"), "id", "uid")).alias("best")
    return rows.groupBy("digest").agg(best, F.count("*").alias("n")).select("digest", (-F.col("best.chars")).alias("chars"), "best.id", "best.uid", "n")


def build_index(groups: DataFrame, ranges: int) -> DataFrame:
    """The index of ``groups`` (digest, chars, id, uid, n; each digest once) in ``ranges`` ranges, as a table INDEX."""
    return saved(groups.withColumn("range", _range(ranges)).groupBy("range").applyInPandas(_built, INDEX))


def add_to_index(index: DataFrame, groups: DataFrame, ranges: int) -> DataFrame:
    """``index`` after ``groups``, all of whose digests it has."""
    return saved(index.groupBy("range").cogroup(groups.withColumn("range", _range(ranges)).groupBy("range")).applyInPandas(_updated, INDEX))


def look_up(rows: DataFrame, index: DataFrame, ranges: int) -> DataFrame:
    """(uid, known, keep_uid, keep_id, group_size) for each of ``rows`` (uid, digest): whether ``index`` has it, and what the index says of it."""
    rows = rows.select("uid", "digest").withColumn("range", _range(ranges))
    parts = saved(rows.groupBy("range").agg(F.count("*").alias("n")).select("range", F.ceil(F.col("n") / LOOKUP_ROWS).cast("int").alias("parts")))
    rows = join_checked(rows, parts, "range", "inner").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")).drop("parts")
    copies = index.join(parts, "range").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return rows.groupBy("range", "part").cogroup(copies.groupBy("range", "part")).applyInArrow(_looked_up, _FOUND)


def _ranges(n: int) -> int:
    return max(1, -(-n // RANGE_DIGESTS))


def dedup(docs: DataFrame, history: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, keep_id, group_size, kept, text_sha256, a row for each row of ``docs``.

    The rows for which the SQL condition ``history``, over ``id`` (null: 2^63 - 1), holds are those already indexed; the
    others arrive. Texts are equal when they are without their spaces and U+0009 to U+000D. Of equal texts the row with the
    most code points stays, then the one of the smallest id; keep_id is its id, group_size how many rows there are.

    - A null text counts as an empty one, and both equal texts of white space alone. Texts are taken whole, however long.
    - A null id comes after all others; if its row stays, keep_id is null. Of rows alike in all that counts one stays, the
      same one for as long as the table's files are. An empty table gives an empty result.
    - Which rows are history changes the way, never the result. Other columns, whatever their names, are not looked at.
    """
    rows = digests(docs, id_col, text_col)
    old, new = rows.where(history), rows.where(f"not coalesce({history}, false)")
    groups = saved(_groups(old))
    ranges = _ranges(groups.count())
    index = build_index(groups, ranges)

    found = saved(look_up(new, index, ranges).select("uid", "known"))
    arrived = saved(new.join(found, "uid"))
    index = add_to_index(index, saved(_groups(arrived.where("known"))), ranges)
    others = saved(_groups(arrived.where("not known")))
    other_ranges = _ranges(others.count())
    other_index = build_index(others, other_ranges)

    of_index = look_up(old.unionByName(arrived.where("known").drop("known")), index, ranges)
    of_others = look_up(arrived.where("not known"), other_index, other_ranges)
    out = rows.join(of_index.unionByName(of_others), "uid")
    plain = lambda c: F.nullif(F.col(c), F.lit(_NO_ID))
    id_type = docs.schema[id_col].dataType
    return out.select(plain("id").cast(id_type).alias(id_col), plain("keep_id").cast(id_type).alias("keep_id"), "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
