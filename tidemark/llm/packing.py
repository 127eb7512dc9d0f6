"""Packing of documents into training sequences by length patterns.

Documents are tokenised and cut into pieces of at most ``length`` tokens. Only the histogram of piece lengths, which has
``length`` entries however many documents there are, goes to the driver. There, patterns of up to three lengths that
fill a sequence are enumerated on a grid, their repeat counts fitted to the histogram by non-negative least squares and
rounded down; the last piece of a pattern is the longest that still fits exactly. What is left is packed best-fit,
longest first, into the room left over and then into new sequences. The plan says, for each length, which ranks of its
pieces go where, so placing the pieces is a numbering by length and a look-up.
"""

from __future__ import annotations

import bisect
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.tables import buckets_for, saved

#: Steps of the grid on which patterns are enumerated.
GRID = 256
_RANK_BITS = 40


class WordIds:
    """Ids of whole texts from a tokenizer that never joins characters across white space, word by word.

    A step's distinct words are tokenised once, and those that come up again and again are remembered.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = words.Recent(self._learn)
        # words of letters alone may go to the merges straight away, if the tokenizer is of the kind known here
        trial = ["abcdefgh", "thequickest", "\u00fcber", "caf\u00e9s", "stra\u00dfe", "\u00e0\u0161\u010d"]
        self.direct = all([t.id for t in self.tokenizer.model.tokenize(_spelled(w))] == self.tokenizer.encode(w, add_special_tokens=False).ids for w in trial)

    def _learn(self, new: list[str]) -> list[bytes]:
        spelled = [_spelled(w) if self.direct else None for w in new]
        others = [w for w, plain in zip(new, spelled, strict=True) if plain is None]
        found = iter([e.ids for at in range(0, len(others), 4096) for e in self.tokenizer.encode_batch_fast(others[at : at + 4096], add_special_tokens=False)])
        merge = self.tokenizer.model.tokenize
        return [np.array(next(found) if plain is None else [t.id for t in merge(plain)], np.uint32).tobytes() for plain in spelled]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts): text i has ``ids[starts[i]:starts[i + 1]]``."""
        codes, starts, vocabulary = words.split_words(texts)
        # the ids of the distinct words in a row, then those of the texts
        found = self.known.look_up([w for word in vocabulary.to_pylist() for w in _parts(word)])
        local = np.frombuffer(b"".join(found), np.uint32)
        begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)])[::2]
        size = np.diff(begin)[codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = local[np.repeat((begin[:-1][codes] - ends[:-1]).astype(np.int32), size) + np.arange(ends[-1], dtype=np.int32)]
        return ids, ends[starts]


# Byte-level vocabularies spell the bytes 33-126, 161-172 and 174-255 as these code points and the others,
# in order, as the code points from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLING = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}


def _spelled(word: str) -> str | None:
    """A composed word of Latin letters alone as byte-level vocabularies spell it, or None for any other."""
    if word.isascii():
        return word.lower() if word.isalpha() else None
    low = word.lower()
    if low.isalpha() and max(low) < "\u0250" and unicodedata.is_normalized("NFC", word):
        return low.encode().decode("latin-1").translate(_SPELLING)
    return None


def _parts(word: str) -> tuple[str, str]:
    """A word as what is before its closing punctuation and that punctuation; the tokenizer parts the two anyway.

    It does so only after what is a letter once normalised, as the capital dotted I is not: it ends in a mark. The case of
    A-Z is ignored, too; only words of ASCII alone are lower-cased here, as others may compose, and none that may hold a
    special token.
    """
    if "<|" in word:
        return word, ""
    core = word.rstrip(".,!?;:$%&*#")
    if not core or core[-1] >= "\u0250" or not unicodedata.normalize("NFC", core[-1]).lower()[-1].isalpha():
        core = word
    return core.lower() if core.isascii() else core, word[len(core) :]


_encoders: dict[str, WordIds] = {}


def _encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def _pieces(path: str, end_id: int, length: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in words.steps(batches, "text", 2 * words.STEP_BYTES):
            ids, starts = encoder.encode(batch.column("text"))
            row, piece, start, size, crc, cut = [], [], [], [], [], []
            for i in range(batch.num_rows):
                doc = np.append(ids[starts[i] : starts[i + 1]], np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(doc), length)):
                    part = doc[at : at + length]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    size.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        cut.append(part.astype(np.int32))
            columns = [batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, size, crc)]]
            if keep_ids:
                columns.append(pa.array(cut, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])
        encoder.known.forget()
        words.tidy()

    return run


def fit_patterns(counts: np.ndarray, length: int, grid: int = GRID, rounds: int = 200) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of up to three grid steps that add up to ``grid``, and how often to use each, most used first.

    ``counts[n]`` is the number of pieces of n tokens. Repeat counts x >= 0 minimise |A x - histogram| (multiplicative
    updates, which keep them non-negative), and are rounded down.
    """
    bins = np.zeros(grid + 1)
    np.add.at(bins, np.clip(np.rint(np.arange(len(counts)) * grid / length).astype(int), 1, grid), counts)
    patterns = [(a, grid - a) for a in range((grid + 1) // 2, grid) if bins[a] and bins[grid - a]]
    patterns += [(a, b, grid - a - b) for a in range(1, grid - 1) for b in range((grid - a + 1) // 2, min(a, grid - a - 1) + 1) if bins[a] and bins[b] and bins[grid - a - b]]
    if not patterns:
        return []
    column = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    row = np.array([i for p in patterns for i in p])

    def back(v: np.ndarray) -> np.ndarray:
        return np.bincount(column, weights=v[row], minlength=len(patterns))

    target = back(bins)
    x = target / max(1.0, target.max()) * bins.max() / len(patterns) + 1e-9
    for _ in range(rounds):
        x *= target / np.maximum(back(np.bincount(row, weights=x[column], minlength=grid + 1)), 1e-12)
    return sorted(((p, int(n)) for p, n in zip(patterns, x, strict=True) if n >= 1), key=lambda t: (-t[1], t[0]))


class _Plan:
    """Pieces placed so far, by runs of equal sequences."""

    def __init__(self, counts: np.ndarray, length: int) -> None:
        self.length, self.left, self.next_rank = length, counts.astype(np.int64), np.zeros(len(counts), np.int64)
        self.lengths = np.flatnonzero(counts).tolist()
        self.sequences = 0
        self.slots: list[tuple[int, int, int, int, int]] = []  # length, first rank, copies a sequence, first sequence, offset
        self.room: dict[int, list[tuple[int, int]]] = {}  # tokens left: (first sequence, how many)
        self.rooms: list[int] = []

    def put(self, n: int, copies: int, first: int, many: int, used: int) -> int:
        self.slots.append((n, int(self.next_rank[n]), copies, first, used))
        self.next_rank[n] += copies * many
        self.left[n] -= copies * many
        if not self.left[n]:
            del self.lengths[bisect.bisect_left(self.lengths, n)]
        return used + n * copies

    def keep_room(self, first: int, many: int, used: int) -> None:
        if (free := self.length - used) and many:
            if free not in self.room:
                bisect.insort(self.rooms, free)
            self.room.setdefault(free, []).append((first, many))

    def open(self, many: int) -> int:
        self.sequences += many
        return self.sequences - many

    def longest(self, most: int) -> int:
        """The longest length of at most ``most`` tokens of which pieces are left, or 0."""
        i = bisect.bisect_right(self.lengths, most)
        return self.lengths[i - 1] if i else 0


def plan_packing(counts: np.ndarray, length: int) -> tuple[np.ndarray, int]:
    """(slots, sequences) for ``counts[n]`` pieces of n tokens, n from 1 to ``length``.

    Rows of slots: length, first rank of the run, copies in each sequence, first sequence, first offset; sorted.
    """
    plan = _Plan(counts, length)
    if n := int(counts[length]):
        plan.put(length, 1, plan.open(n), n, 0)
    step = length / GRID
    for pattern, repeats in fit_patterns(plan.left, length):
        while repeats:
            chosen, free = [], length
            for i, part in enumerate(pattern):
                last = i == len(pattern) - 1
                n = plan.longest(free if last else min(free - 1, int((part + 0.5) * step)))
                if n < (part - (2 if last else 0.5)) * step:
                    break
                chosen.append(n)
                free -= n
            if len(chosen) < len(pattern):
                break
            many = min([repeats, *(int(plan.left[n]) // chosen.count(n) for n in chosen)])
            if not many:
                break
            first, used = plan.open(many), 0
            for n in sorted(set(chosen), reverse=True):
                used = plan.put(n, chosen.count(n), first, many, used)
            plan.keep_room(first, many, used)
            repeats -= many
    while plan.lengths:
        n = plan.lengths[-1]
        i = bisect.bisect_left(plan.rooms, n)
        if i < len(plan.rooms):
            free = plan.rooms[i]
            first, many = plan.room[free].pop()
            if not plan.room[free]:
                del plan.room[free], plan.rooms[i]
        else:
            free, many = length, max(1, int(plan.left[n]) // (length // n))
            first = plan.open(many)
        copies = min(free // n, int(plan.left[n]))
        fits = min(many, int(plan.left[n]) // copies)
        used = plan.put(n, copies, first, fits, length - free)
        plan.keep_room(first, fits, used)
        plan.keep_room(first + fits, many - fits, length - free)
    slots = np.array(sorted(plan.slots), np.int64).reshape(-1, 5)
    return slots, plan.sequences


def _placed(slots: np.ndarray):
    keys = (slots[:, 0] << _RANK_BITS) | slots[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            _, first, copies, sequence, offset = slots[np.searchsorted(keys, (n << _RANK_BITS) | rank, side="right") - 1].T
            within = rank - first
            more = [pa.array(sequence + within // copies), pa.array(offset + within % copies * n)]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *more], [*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, length: int = 4096, keep_ids: bool = False) -> DataFrame:
    """One row for each piece: ``id_col``, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    - A null or empty text is a document of the end id alone.
    - Only documents of more than ``length`` tokens are cut; very long texts are taken whole.
    - Null ids, repeated rows and ids on several rows are documents like others, each packed once.
    - An empty table gives an empty result; other columns of ``docs``, whatever their names, are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    pieces = saved(rows.mapInArrow(_pieces(tokenizer_path, end_id, length, keep_ids), schema))

    # numbered within each length by way of buckets, so that a common length isn't one task's
    buckets = buckets_for(pieces.count(), spark)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = saved(dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")))
    counts = np.zeros(length + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # ``length`` rows at most
        counts[row["length"]] = row["n"]
    slots, _ = plan_packing(counts, length)

    before = sizes.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("id", "piece", "ids_crc32"))
    ranked = dealt.withColumn("within", within).join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("within") - 1)
    columns = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    placed = ranked.select(*columns, "rank").mapInArrow(_placed(slots), schema + ", sequence_id long, offset long")
    return placed.select(F.col("id").alias(id_col), *[c for c in placed.columns if c != "id"])
