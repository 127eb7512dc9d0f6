"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger is a table of the blobs already
scanned, each with the rule version and the spans found. A scan looks only at blobs that the ledger lacks under the
present rule version, adds them, and joins the ledger's spans back to all paths and versions.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.tables import join_checked, saved

#: (kind, pattern, whether letters match in either case, group that is measured, least length of that group), in order of rank. A
#: match that is too short is dropped after it was found, and what it covers stays used. None starts within a run of its
#: own characters or gives any back, so each takes time in proportion to a text.
RULES: list[tuple[str, str, bool, int, int]] = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", False, 0, 20),
    ("hex", r"[0-9a-f]+", False, 0, 24),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", False, 0, 1),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", False, 0, 30),
    ("bearer", r"(bearer)\x20++([A-Za-z0-9+/_.=~-]++)", True, 2, 16),
    ("url", r"(?<![a-z0-9+])[a-z][a-z0-9+]*+://[^\s/:@]++:([^\s/@]++)@", False, 1, 1),
]
#: Kinds of the base, whose spans are never changed by the others.
BASE = ("assign", "access", "hex")
#: What a text with a long enough match of a rule holds in any case, for RE2, which takes one pass over a whole batch.
_HINTS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
    "pem": r"PRIVATE KEY-----",
    "jwt": r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]",
    "bearer": r"(?i:bearer) ",
    "url": r"://[^ \t\n/:@]+:",
}
#: Which rules made a ledger's rows; it changes with any of them.
RULE_VERSION = hashlib.sha256(repr(RULES).encode()).hexdigest()[:16]

_RANK = {kind: i for i, (kind, *_) in enumerate(RULES)}


def find_spans(text: str, kinds: list[str] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret in ``text`` in code points, end exclusive, by start, then kind as in RULES."""
    found = []
    for kind, pattern, either_case, group, least in RULES:
        if kinds is None or kind in kinds:
            if kind == "hex":  # the same spans, without a match for each short run
                pattern = r"[0-9a-f]{24,}"
            for m in re.finditer(pattern, text, re.ASCII | (re.IGNORECASE if either_case else 0)):
                if m.end(group) - m.start(group) >= least:
                    found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda x: (x[0], _RANK[x[2]]))


_SPANS = "array<struct<start:int,end:int,kind:string>>"
LEDGER = f"blob binary, rule_version string, spans {_SPANS}"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    for batch in words.steps(batches, "text"):
        texts = batch.column("text")
        hints = {kind: pc.match_substring_regex(texts, hint).to_numpy(zero_copy_only=False) for kind, hint in _HINTS.items()}
        spans: list[list[dict]] = []
        for i in range(batch.num_rows):
            kinds = [kind for kind, hit in hints.items() if hit[i]]
            spans.append([{"start": a, "end": b, "kind": k} for a, b, k in find_spans(texts[i].as_py(), kinds)] if kinds else [])
        yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(spans, spans_type)], ["blob", "spans"])


def scan_into(versions: DataFrame, key_cols: list[str], path: str, text_col: str = "text") -> DataFrame:
    """The findings of scan_versions by the ledger at ``path``, to which what was scanned now is appended.

    ``path`` is a Parquet table in a folder that all machines share; if there is none, it is begun.
    """
    spark = versions.sparkSession
    try:
        ledger = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        ledger = spark.createDataFrame([], LEDGER)
    findings, scanned = _scanned(versions, key_cols, text_col, ledger)
    findings = saved(findings)  # before the ledger changes
    scanned.write.mode("append").parquet(path)
    return findings


def scan_versions(versions: DataFrame, key_cols: list[str], text_col: str = "text", ledger: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings, ledger): the spans in every row of ``versions``, and the ledger with what was scanned now.

    ``findings`` has a row for each row of ``versions``: ``key_cols`` (path, version or the like), ``blob`` (SHA-256 of the
    text, binary) and ``spans``, an array of (start, end, kind). The ledger has ``blob``, ``rule_version``, ``spans``; pass
    what the last call returned, and write it wherever it is kept.

    - A null text is scanned as an empty one. Null keys and repeated rows are rows like others.
    - A blob that the ledger has twice counts once. A blob on many rows is scanned once; very long texts are scanned whole; an empty table gives empty results.
    - Other columns of ``versions`` are not looked at. Key columns may have any names; they are renamed meanwhile.
    """
    findings, scanned = _scanned(versions, key_cols, text_col, ledger)
    return findings, scanned if ledger is None else ledger.select("blob", "rule_version", "spans").unionByName(scanned)


def _scanned(versions: DataFrame, key_cols: list[str], text_col: str, ledger: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(findings, the ledger's new rows)."""
    keys = [F.col(c).alias(f"key_{i}") for i, c in enumerate(key_cols)]
    rows = versions.select(*keys, F.coalesce(text_col, F.lit("")).alias("text")).withColumn("blob", F.unhex(F.sha2("text", 256)))
    names = [f"key_{i}" for i in range(len(keys))]
    paths = saved(rows.select(*names, "blob"))

    # the row to read each blob from: its least key
    source = paths.groupBy("blob").agg(F.min(F.struct(*names)).alias("at"), F.count("*").alias("n_rows"))
    if ledger is not None:
        known = ledger.where(F.col("rule_version") == RULE_VERSION).select("blob")
        source = source.join(known, "blob", "left_anti")
    source = saved(source)
    total = paths.count()
    n_rows, n_blobs = source.agg(F.sum("n_rows"), F.count("*")).first()
    if n_rows == total == n_blobs:
        unseen = rows.select("blob", "text")  # all blobs are new and each is on one row
    else:
        skip = saved(paths.select("blob", F.struct(*names).alias("at")).join(source.select("blob", "at"), ["blob", "at"], "left_anti").distinct())
        unseen = join_checked(rows.select("blob", F.struct(*names).alias("at"), "text"), skip, ["blob", "at"], "left_anti").select("blob", "text")
    scanned = unseen.mapInArrow(_scan, f"blob binary, spans {_SPANS}")
    scanned = saved(scanned.dropDuplicates(["blob"]).select("blob", F.lit(RULE_VERSION).alias("rule_version"), "spans"))
    every = scanned if ledger is None else ledger.select("blob", "rule_version", "spans").unionByName(scanned)
    hits = every.where((F.col("rule_version") == RULE_VERSION) & (F.size("spans") > 0)).select("blob", "spans")
    if ledger is not None:
        hits = hits.dropDuplicates(["blob"])  # two scans at once, or a retried one, may both have appended a blob
    findings = paths.join(hits, "blob", "left").withColumn("spans", F.coalesce("spans", F.expr(f"cast(array() as {_SPANS})")))
    return findings.select(*[F.col(n).alias(c) for n, c in zip(names, key_cols, strict=True)], "blob", "spans"), scanned


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, s -> s.kind || ':' || s.start || ':' || s.end), ',')"


def digest(findings: DataFrame, key_cols: list[str]) -> DataFrame:
    """Counts of the base kinds, a SHA-256 of the base spans and all spans as text, for each row of ``findings``."""
    base = f"filter(spans, s -> s.kind in {BASE})"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE]
    return findings.select(*key_cols, *counts, F.sha2(F.expr(_joined(base)), 256).alias("base_sha256"), F.expr(_joined("spans")).alias("spans"))
