"""Quality rules: a decision list learned by sequential covering from labelled text statistics.

Rules are conjunctions of thresholds on statistics. Each is grown on two thirds of the labelled sample by information
gain, pruned on the other third, and kept only if it is precise there; then the rows it covers are put aside and the next
rule is learned. The list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words
from tidemark.llm.tables import masked, unmasked

#: Counts taken from every whole text. word_chars: code points in words; n_lines: lines with a word; n_dup_lines: such
#: lines equal to an earlier one; n_repeat_words: words in three-word windows found twice or more in the text;
#: n_same_next: words equal to the one before; n_upper: letters A-Z.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaim", "n_upper", "n_distinct", "n_same_next")
#: Statistics that rules may use, as SQL over the counts.
FEATURES = {
    "mean_word": "word_chars / n_words",
    "symbol_share": "n_symbols / word_chars",
    "exclaim_share": "n_exclaim / n_words",
    "upper_share": "n_upper / word_chars",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "distinct_share": "n_distinct / n_words",
    "same_next_share": "n_same_next / n_words",
}
#: Labelled documents that the rules are learned from at most, those with the smallest hashes of their ids.
SAMPLE_ROWS = 20_000

_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, [32, *range(9, 14)])
_HEAD = (_BYTES & 0xC0) != 0x80
_MARKS = {"n_symbols": np.isin(_BYTES, list(b"#*$%&|<>")), "n_exclaim": _BYTES == ord("!"), "n_upper": (_BYTES >= 65) & (_BYTES <= 90), "word_chars": _HEAD & ~_SPACE}


def _per_text(marked: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marked, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def _distinct(codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many distinct codes each owner has."""
    width = int(codes.max()) + 1 if len(codes) else 1
    return np.bincount(np.unique(owner * width + codes) // width, minlength=n)


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of each text; null texts count as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    out = {name: _per_text(table[data], offsets - offsets[0]) for name, table in _MARKS.items()}

    codes, starts, _ = words.split_words(texts.cast(pa.string()))
    codes = codes.astype(np.int64)
    out["n_words"] = np.diff(starts)
    owner = np.repeat(np.arange(n), out["n_words"])
    out["n_distinct"] = _distinct(codes, owner, n)
    together = owner[1:] == owner[:-1]
    out["n_same_next"] = np.bincount(owner[1:][together & (codes[1:] == codes[:-1])], minlength=n)

    at = np.flatnonzero(owner[2:] == owner[:-2])
    windows = words.window_hashes(words.scramble(codes.astype(np.uint64) + np.uint64(1)), 3)[at] ^ words.scramble(owner[at].astype(np.uint64) + np.uint64(1))
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    twice = at[times[which] > 1]
    covered = np.zeros(len(codes), bool)
    for k in range(3):
        covered[twice + k] = True
    out["n_repeat_words"] = np.bincount(owner[covered], minlength=n)

    lists = pc.split_pattern(texts, "\n")
    starts = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
    lines = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    full = (pc.binary_length(pc.ascii_trim_whitespace(coded.dictionary)).to_numpy() > 0)[lines]
    owner = np.repeat(np.arange(n), np.diff(starts))[full]
    out["n_lines"] = np.bincount(owner, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - _distinct(lines[full], owner, n)
    return out


def with_counts(docs: DataFrame, text_col: str = "text", into: str = "counts") -> DataFrame:
    """``docs`` with the struct ``into`` of COUNTS (long). An existing column of that name isn't allowed; choose another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.steps(batches, text_col):
            found = text_counts(batch.column(text_col))
            counts = pa.StructArray.from_arrays([pa.array(found[c].astype(np.int64)) for c in COUNTS], list(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*batch.schema.names, into])

    counts = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(into, counts)]))


def feature(name: str, counts: str = "counts") -> Column:
    """The statistic ``name`` of FEATURES over the struct ``counts``, 0 where it isn't defined."""
    above, below = FEATURES[name].split(" / ")
    return F.coalesce(F.try_divide(F.col(f"{counts}.{above}"), F.col(f"{counts}.{below}")), F.lit(0.0))


@dataclass(frozen=True)
class Rule:
    """Rejects what meets all conditions: (feature, '>' or '<=', threshold)."""

    conditions: tuple[tuple[str, str, float], ...]

    def column(self, counts: str = "counts") -> Column:
        out = F.lit(True)
        for name, sign, least in self.conditions:
            out = out & (feature(name, counts) > least if sign == ">" else feature(name, counts) <= least)
        return out

    def covers(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, sign, least in self.conditions:
            v = x[:, list(FEATURES).index(name)]
            out &= v > least if sign == ">" else v <= least
        return out


def _best_condition(x: np.ndarray, bad: np.ndarray) -> tuple[float, tuple[str, str, float]] | None:
    """The threshold with the highest information gain on the rows still covered."""
    p0, n0, best = bad.sum(), (~bad).sum(), None
    start = np.log2(p0 / (p0 + n0))
    for j, name in enumerate(FEATURES):
        order = np.argsort(x[:, j], kind="stable")
        v, b = x[order, j], bad[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        low_p = np.cumsum(b)[cut]
        low_n = cut + 1 - low_p
        for sign, p, n in (("<=", low_p, low_n), (">", p0 - low_p, n0 - low_n)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - start), -np.inf)
            k = int(gain.argmax())
            if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                best = (float(gain[k]), (name, sign, float((v[cut[k]] + v[cut[k] + 1]) / 2)))
    return best


def learn_rules(x: np.ndarray, bad: np.ndarray, most: int = 16, precision: float = 0.95, least_covered: int = 3) -> list[Rule]:
    """The decision list for the rows ``x`` of FEATURES, of which ``bad`` are to be rejected; ties to the first feature."""
    prune = np.arange(len(x)) % 3 == 2
    left, rules = np.ones(len(x), bool), []
    while len(rules) < most:
        gx, gb = x[left & ~prune], bad[left & ~prune]
        if gb.sum() < least_covered:
            break
        conditions: list[tuple[str, str, float]] = []
        inside = np.ones(len(gx), bool)
        while (~gb[inside]).any() and len(conditions) < 6 and (found := _best_condition(gx[inside], gb[inside])):
            conditions.append(found[1])
            inside = Rule(tuple(conditions)).covers(gx)
        px, pb = x[left & prune], bad[left & prune]

        def worth(k: int, conditions=conditions, px=px, pb=pb) -> float:
            hit = Rule(tuple(conditions[:k])).covers(px)
            return (pb[hit].sum() - (~pb[hit]).sum()) / max(1, hit.sum())

        if not conditions:
            break
        length = max(range(1, len(conditions) + 1), key=lambda k: (worth(k), -k))
        rule = Rule(tuple(conditions[:length]))
        hit = rule.covers(x) & left
        if bad[hit].sum() < least_covered or bad[hit].mean() < precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules learned from at most ``sample_rows`` labelled ids of ``docs``, one row of each; a label of 0 is bad, null labels are left out.

    Without labelled rows of both kinds there are no rules. An id with several labels is good if one of them is.
    """
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("good"))
    marks = marks.orderBy(F.xxhash64("id"), "id").limit(sample_rows)  # so few that they may be broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marks), "id")
    # of an id on several rows one is taken, so that no more than the sample reaches the driver
    found = with_counts(rows).groupBy("id", "good").agg(F.min(F.struct(*[feature(f).alias(f) for f in FEATURES])).alias("f"))
    found = found.select("id", "good", "f.*").toPandas().sort_values("id").reset_index(drop=True)
    bad = (found["good"] == 0).to_numpy()
    return learn_rules(found[list(FEATURES)].to_numpy(float), bad) if bad.any() and not bad.all() else []


def verdict(rules: list[Rule], counts: str = "counts") -> Column:
    """The number (from 1) of the first rule that rejects the row, else null."""
    if not rules:
        return F.lit(None).cast("int")
    out = F.when(rules[0].column(counts), F.lit(1))
    for i, rule in enumerate(rules[1:], 2):
        out = out.when(rule.column(counts), F.lit(i))
    return out


def base_failed(counts: str = "counts") -> Column:
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < 50) | (100 * repeated > 50 * n)


def score(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """``docs`` with ``counts`` (a struct of COUNTS), ``base_failed``, ``rule`` and ``kept``: neither the base nor a rule rejects it.

    Null, empty and wordless texts have counts of 0 and fail the base. Very long texts are counted whole. Each row is
    judged by itself: repeated rows and null ids are rows like others, and an empty table gives an empty result. Columns
    of ``docs`` with the names of the new ones give way to them.
    """
    rows, names = masked(docs)
    rows = with_counts(rows, names[text_col])
    kept = ~base_failed() & verdict(rules).isNull()
    return rows.select(unmasked(names, {"counts": F.col("counts"), "base_failed": base_failed(), "rule": verdict(rules), "kept": kept}))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the base and the learned rules keep, with their columns, whatever these are called."""
    rows, names = masked(docs)
    rejected = base_failed() | verdict(fit_rules(docs, labels, id_col, text_col)).isNotNull()
    return with_counts(rows, names[text_col]).where(~rejected).select(unmasked(names))
