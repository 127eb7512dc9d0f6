"""Quality classifier by co-training of a text-content view and a page-metadata view.

The text view sees which words and pairs of words a text has, hashed, and how they repeat; the metadata view sees its
source, language and length class, and the page's layout: lines, capitals and signs. Neither sees what the other does.
Each is a logistic regression. Over a few rounds each labels the unlabelled documents that it is sure of, as measured on
held-out labels, for the other to learn from. The calibrated views are then combined by a
logistic regression on held-out labels, and the result scores every document.

Only a bounded sample of labelled rows is gathered: LABELLED_ROWS. All unlabelled documents take part in each round where
they are: which of them a view is sure of follows from its earlier weights, and their part in a step of the fit is a sum of
gradients and curvatures, whose size doesn't depend on the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.quality_rules import text_counts
from tidemark.llm.tables import join_checked, saved

#: Labelled rows that the fit gathers at most, by smallest hash of id.
LABELLED_ROWS = 12_000
#: Buckets of hashed words, of hashed pairs of words, and of hashed metadata values.
WORDS, PAIRS, VALUES = 64, 32, 64
#: Rounds, how sure a view must be to label a document, and what its labels of a class weigh in all, at most, to those given.
ROUNDS, SURE, SHARE = 3, 0.97, 0.2


def _shares(hashes: np.ndarray, owner: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """For each of ``n`` texts, the square roots of the shares of its hashes in ``buckets``."""
    counts = np.bincount(owner * buckets + (hashes % np.uint64(buckets)).astype(np.int64), minlength=n * buckets).reshape(n, buckets)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1), 1)[:, None])


def text_view(texts: pa.Array, counts: dict[str, np.ndarray]) -> np.ndarray:
    """Features of what each text says: shares of hashed words and pairs, word lengths, repeats, log words."""
    n, n_words = len(texts), np.maximum(counts["n_words"], 1)
    codes, starts, vocabulary = words.split_words(texts, ascii_lower=True)
    hashes = words.hash_words(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(starts))
    pairs, within = words.window_hashes(hashes, 2), owner[1:] == owner[:-1]
    columns = [counts["word_chars"] / n_words / 10, counts["n_repeat_words"] / n_words, counts["n_distinct"] / n_words, counts["n_same_next"] / n_words, np.log1p(counts["n_words"]) / 10]
    return np.column_stack([*columns, _shares(hashes, owner, n, WORDS), _shares(pairs[within], owner[1:][within], n, PAIRS)])


def layout(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Features of how each text is laid out: lines, repeated lines, words a line, signs, capitals."""
    n_words, n_lines, chars = (np.maximum(counts[c], 1) for c in ("n_words", "n_lines", "word_chars"))
    shares = [counts["n_dup_lines"] / n_lines, counts["n_symbols"] / chars, counts["n_exclaim"] / n_words, counts["n_upper"] / chars]
    return np.column_stack([np.log1p(counts["n_lines"]) / 10, np.log1p(counts["n_words"] / n_lines) / 10, *map(np.sqrt, shares)])


def metadata_view(columns: list[pa.Array], counts: dict[str, np.ndarray]) -> np.ndarray:
    """The layout, and hashed one-hot features of metadata values; numbers by their power of two, nulls as a value of their own."""
    n = len(counts["n_words"])
    out = np.zeros((n, VALUES))
    for k, column in enumerate(columns):
        if pa.types.is_integer(column.type) or pa.types.is_floating(column.type):
            size = np.log2(np.maximum(column.cast(pa.float64(), safe=False).fill_null(0).to_numpy(zero_copy_only=False), 0) + 1)
            column = pc.if_else(column.is_null(), None, pa.array(np.nan_to_num(size, posinf=1024).astype(int).astype(str)))
        coded = pc.fill_null(column.cast(pa.string()), "\0").dictionary_encode()
        names = pa.array([f"{k}:{v}" for v in coded.dictionary.to_pylist()], pa.string())
        out[np.arange(n), (words.hash_words(names) % np.uint64(VALUES)).astype(np.int64)[coded.indices.to_numpy()] if n else []] += 1
    return np.column_stack([layout(counts), out])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 12) -> np.ndarray:
    """Weights, the last one the intercept, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    keep = np.full(x.shape[1], penalty)
    keep[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        curve = x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None]) + np.diag(keep)
        w = w - np.linalg.solve(curve, x.T @ (p - y) + keep * w)
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass(frozen=True)
class Model:
    """Weights of the two views, and of their logits and the intercept in the score; unlabelled documents that each learnt from."""

    text: np.ndarray
    metadata: np.ndarray
    together: np.ndarray
    taken: tuple[int, ...] = (0, 0)

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        views = np.column_stack([np.clip(logit(text, self.text), -12, 12), np.clip(logit(metadata, self.metadata), -12, 12)])
        return _sigmoid(logit(views, self.together))


#: Weights of both views and of their calibrations after a round.
Round = tuple[list[np.ndarray], list[np.ndarray]]


def pseudo_labels(views: tuple[np.ndarray, np.ndarray], rounds: list[Round]) -> list[np.ndarray]:
    """For each view, the labels (NaN if none) that the other one gave to rows, each in the first round in which it was sure."""
    out = [np.full(len(x), np.nan) for x in views]
    for weights, scales in rounds:
        for i, x in enumerate(views):
            p = _sigmoid(logit(logit(x, weights[i])[:, None], scales[i]))
            sure = (np.maximum(p, 1 - p) >= SURE) & np.isnan(out[1 - i])
            out[1 - i][sure] = p[sure] > 0.5
    return out


def slopes(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows, gradient and curvature of the loss at ``w``, in one array."""
    x = np.column_stack([x, np.ones(len(x))])
    p = _sigmoid(x @ w)
    return np.concatenate([[len(x)], x.T @ (p - y), (x.T @ (x * np.maximum(p * (1 - p), 1e-6)[:, None])).ravel()])


def pool_slopes(views: tuple[np.ndarray, np.ndarray], rounds: list[Round], weights: list[np.ndarray]) -> np.ndarray:
    """slopes of the rows that have pseudo-labels, of each view and class, end to end."""
    parts = []
    for x, label, w in zip(views, pseudo_labels(views, rounds), weights, strict=True):
        parts += [slopes(x[label == c], np.full((label == c).sum(), float(c)), w) for c in (0, 1)]
    return np.concatenate(parts)


def fit_with_pool(own: list[tuple[np.ndarray, np.ndarray]], start: list[np.ndarray], summed: Callable[[list[np.ndarray]], np.ndarray], penalty: float = 1.0, steps: int = 12) -> tuple[list[np.ndarray], tuple[int, ...]]:
    """Weights of both views from their labelled rows and the pool's slopes, and the pool's rows in them, by Newton's method."""
    weights, taken = start, (0, 0)
    for _ in range(steps):
        pool, at, moved, after, rows = summed(weights), 0, 0.0, [], []
        for (x, y), w in zip(own, weights, strict=True):
            d = len(w)
            keep = np.full(d, penalty)
            keep[-1] = 1e-6
            total, n = slopes(x, y, w), 0
            for c in (0, 1):
                part = pool[at : at + 1 + d + d * d]
                at += len(part)
                n += int(part[0])
                total = total + part * min(1.0, SHARE * (y == c).sum() / max(part[0], 1))
            step = np.linalg.solve(total[1 + d :].reshape(d, d) + np.diag(keep), total[1 : 1 + d] + keep * w)
            step *= min(1.0, 5 / max(np.abs(step).max(), 1e-12))
            after.append(w - step)
            rows.append(n)
            moved = max(moved, np.abs(step).max())
        weights, taken = after, tuple(rows)
        if moved < 1e-4:
            break
    return [np.round(w, 9) for w in weights], taken  # sums differ in their last digits with the order of tasks


def co_train(text: np.ndarray, metadata: np.ndarray, y: np.ndarray, summed: Callable[[list[Round], list[np.ndarray]], np.ndarray]) -> Model:
    """The model from labelled rows and pool_slopes summed over the unlabelled ones; each third labelled row is held out for calibration."""
    held = np.arange(len(y)) % 3 == 2
    if not 0 < y[held].sum() < held.sum() or not 0 < y[~held].sum() < (~held).sum():
        held = np.zeros(len(y), bool)  # too few labels to hold any out
    check = held if held.any() else ~held
    views = (text, metadata)
    own = [(x[~held], y[~held]) for x in views]
    weights, taken, rounds = [fit_logistic(x, t, penalty=1.0) for x, t in own], (0, 0), []
    for _ in range(ROUNDS):
        rounds.append((weights, [fit_logistic(logit(x[check], w)[:, None], y[check], penalty=0.1) for x, w in zip(views, weights, strict=True)]))
        weights, taken = fit_with_pool(own, weights, lambda w: summed(rounds, w))
    z = np.column_stack([np.clip(logit(x[check], w), -12, 12) for x, w in zip(views, weights, strict=True)])
    return Model(*weights, fit_logistic(z, y[check], penalty=0.1), taken)


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    counts = text_counts(batch.column("text"))
    return text_view(batch.column("text"), counts), metadata_view([batch.column(c) for c in batch.schema.names if c.startswith("m_")], counts)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.steps(batches, "text"):
        arrays = []
        for x in _views(batch):
            flat = pa.array(x.astype(np.float32).ravel())
            arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat))
        yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", "t", "m"])


def _stored(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(float) for c in ("t", "m"))


def _summed(pool: DataFrame, rounds: list[Round], weights: list[np.ndarray]) -> np.ndarray:
    """pool_slopes over all rows of ``pool``, added up by the executors."""
    size = 2 * sum(1 + len(w) + len(w) ** 2 for w in weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += pool_slopes(_stored(batch), rounds, weights)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = pool.mapInArrow(run, "sums binary").rdd
    return parts.treeAggregate(np.zeros(size), lambda a, row: a + np.frombuffer(row[0]), lambda a, b: a + b)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", metadata_cols: tuple[str, ...] = ("source", "lang", "n_chars"), label_col: str = "quality") -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, score (0 to 1, six decimals), kept (score of at least 0.5).

    - Null or empty texts and null metadata have features like others and get a score.
    - Every document without a label, null ids and repeated rows too, can get one from a view that is sure of it.
    - Null labels are left out; an id with several labels is good if one of them is. Without labels of both kinds every
      score is 0.5. Null ids and repeated rows are rows like others; an empty table gives an empty result.
    - Very long texts are taken whole. Other columns of ``docs``, whatever their names, are not looked at.
    """
    columns = [F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"m_{i}") for i, c in enumerate(metadata_cols)]]
    rows = docs.select(*columns)
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("good"))
    marks = saved(marks)
    kind = rows.schema["id"].dataType.simpleString()
    featured = rows.mapInArrow(_featured, f"id {kind}, t array<float>, m array<float>")
    featured = saved(join_checked(featured, marks, "id", "left"))  # each text is read once
    chosen = marks.orderBy(F.xxhash64("id"), "id").limit(LABELLED_ROWS)
    # of an id on several rows one is taken, the same in each run: LABELLED_ROWS rows at most reach the driver
    found = featured.drop("good").join(F.broadcast(chosen), "id").groupBy("id", "good").agg(F.min_by(F.struct("t", "m"), F.xxhash64("t", "m")).alias("r"))
    found = found.select("id", "good", "r.t", "r.m").toPandas().sort_values("id")
    y = (found["good"] > 0).to_numpy(float)
    if not 0 < y.sum() < len(y):
        return rows.select(F.col("id").alias(id_col), F.lit(0.5).alias("score"), F.lit(True).alias("kept"))
    text, metadata = (np.stack(found[c].tolist()).astype(float) for c in ("t", "m"))
    pool = featured.where("good is null").select("t", "m")
    model = co_train(text, metadata, y, lambda rounds, weights: _summed(pool, rounds, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(*_stored(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.round(scores, 6))], ["id", "score"])

    scored = featured.select("id", "t", "m").mapInArrow(run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).alias("kept"))
