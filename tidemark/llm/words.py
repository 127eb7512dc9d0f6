"""Vectorised word and shingle helpers for Arrow batches, used inside tasks.

A word is a maximal run of characters other than space and U+0009..U+000D. All helpers take whole texts; a null text
counts as a text without words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that one step of a task handles at a time; a longer text is a step of its own.
STEP_BYTES = 4 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def tidy() -> None:
    """Gives free memory back to the system: a Python worker waits for its next task beside a JVM that needs it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``limit`` bytes of ``column``, so that long texts don't add up in memory.

    At the end of the task memory is given back.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
    tidy()


def split_words(texts: pa.Array, ascii_lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, starts, vocabulary): the words of all texts as codes into ``vocabulary``; text i has ``codes[starts[i]:starts[i + 1]]``."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if ascii_lower else texts)
    starts = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
    starts = starts - starts[0]
    codes, vocabulary = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    if (empty := vocabulary.index("").as_py()) >= 0:
        kept = codes != empty
        starts = np.concatenate([[0], np.cumsum(kept)])[starts]
        codes = codes[kept]
    return codes, starts, vocabulary


def hash_words(vocabulary: pa.Array) -> np.ndarray:
    """64-bit hashes of strings, the same in every task."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in vocabulary.to_pylist()), np.uint64, len(vocabulary))


def scramble(x: np.ndarray) -> np.ndarray:
    """The finishing step of SplitMix64, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` neighbouring entries; entry i covers ``hashes[i:i + width]``. They may span texts."""
    n = max(0, len(hashes) - width + 1)
    out = hashes[:n] + np.uint64(width)
    for k in range(1, width):
        out *= _ODD
        out ^= out >> np.uint64(29)
        out += hashes[k : k + n]
    return scramble(out)


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its ``width``-word shingles, A-Z lower-cased.

    A text with fewer words has its whole sequence as one shingle, and one without words the empty set.
    """
    codes, starts, vocabulary = split_words(texts, ascii_lower=True)
    hashes = hash_words(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint64)
    windows = window_hashes(hashes, width)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(windows[a : b - width + 1])
        else:
            yield window_hashes(hashes[a:b], b - a) if b > a else windows[:0]


class Recent:
    """What was found for words lately, in two generations: bounded memory that keeps the words that come up again.

    When the present generation has ``most`` characters or more it becomes the earlier one, and the one before that goes.
    """

    def __init__(self, learn: Callable[[list[str]], Iterable], most: int = 1_500_000) -> None:
        self.learn, self.most, self.chars = learn, most, 0
        self.now: dict[str, object] = {}
        self.before: dict[str, object] = {}

    def forget(self) -> None:
        self.now, self.before, self.chars = {}, {}, 0

    def look_up(self, words: list[str]) -> list:
        """What was found for each of ``words``; those not remembered are learned, each once and in sorted order."""
        if self.chars > self.most:
            self.now, self.before, self.chars = {}, self.now, 0
        now, before, missing = self.now, self.before, []
        for w in words:
            if w not in now:
                if (known := before.get(w)) is None:
                    missing.append(w)
                else:
                    now[w] = known
                    self.chars += len(w)
        missing = sorted(set(missing))
        now.update(zip(missing, self.learn(missing), strict=True))
        self.chars += sum(map(len, missing))
        return [now[w] for w in words]
