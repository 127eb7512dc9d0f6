"""Token counts of documents under a unigram segmentation, by a trie of distinct words.

A word's segmentation is the one with the highest sum of piece scores (ties: the fewest pieces). The forward scores of a
word's prefixes depend on the prefix alone, so the distinct words of a step are walked as a trie, in sorted order: the
states of the prefix that a word shares with the one before are kept, and only its new characters are scored. Terminal
counts are stored by word, and a document's count is the sum over its words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words

#: Put before each word, as the vocabulary's pieces have it.
WORD_START = "▁"


def zipf_scores(model_path: str) -> dict[str, float]:
    """Scores of a sentencepiece vocabulary's ordinary pieces by rank: the logarithm of 1 / (rank + 10), up to a constant."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = [model.id_to_piece(i) for i in range(len(model)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return {piece: -math.log(rank + 10) for rank, piece in enumerate(pieces)}


class Trie:
    """Forward states along the path of the word looked at last."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.missing = min(scores.values(), default=0.0) - 10  # for each byte of a character that no piece covers
        self.word = ""
        self.best: list[tuple[float, int]] = [(0.0, 0)]  # (score, minus the number of pieces) of each prefix

    def count(self, word: str) -> int:
        """How many pieces ``word`` has; cheapest if words come in sorted order."""
        shared = len(commonprefix([self.word, word]))
        best, scores = self.best, self.scores
        del best[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            n_bytes = len(word[end - 1].encode())
            score, pieces = best[end - 1]
            top = (score + n_bytes * self.missing, pieces - n_bytes)
            for start in range(max(0, end - self.longest), end):
                if (s := scores.get(word[start:end])) is not None:
                    score, pieces = best[start]
                    if (found := (score + s, pieces - 1)) > top:
                        top = found
            best.append(top)
        self.word = word
        return -best[-1][1]


class Counter:
    """Counts of distinct words, remembered while they come up again."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores, self.known = scores, words.Recent(self._learn)

    def _learn(self, new: list[str]) -> list[int]:
        trie = Trie(self.scores)
        return [trie.count(WORD_START + word) for word in new]

    def per_text(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(words, tokens) of each text."""
        codes, starts, vocabulary = words.split_words(texts)
        counts = np.array(self.known.look_up(vocabulary.to_pylist()), np.int64)[codes]
        total = np.concatenate([[0], np.cumsum(counts)])[starts]
        return np.diff(starts), np.diff(total)


_counters: dict[str, Counter] = {}


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, n_words, n_tokens.

    ``model_path`` is a sentencepiece vocabulary that every executor can read. Null, empty and wordless texts have counts
    of 0; very long texts are counted whole; null ids and repeated rows are rows like others; an empty table gives an
    empty result. Other columns of ``docs``, whatever their names, are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_path not in _counters:
            _counters[model_path] = Counter(zipf_scores(model_path))
        for batch in words.steps(batches, "text", 2 * words.STEP_BYTES):
            n_words, n_tokens = _counters[model_path].per_text(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words), pa.array(n_tokens)], ["id", "n_words", "n_tokens"])
        _counters[model_path].known.forget()
        words.tidy()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_words", "n_tokens")
