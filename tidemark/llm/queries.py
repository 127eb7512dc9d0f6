"""Registered queries opN_<name>: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import conversation_trie, cotraining, exact_dedup, exact_topk, line_dedup, mixing, ngram_join, packing, quality_rules, secrets, sharding, token_counts, vector_codes
from tidemark.llm.tables import read_texts

#: Where the vocabulary files of public tokenizers are.
TOKENIZERS = os.environ.get("TIDEMARK_TOKENIZERS", "/opt/tokenizers")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return read_texts(spark, f"{sf_dir}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_read(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_read(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(_read(spark, sf_dir, "embeddings"), "id % 50 = 0")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_read(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_deleted")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scored = quality_rules.score(docs, quality_rules.fit_rules(docs, _read(spark, sf_dir, "labels")))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return scored.select("doc_id", *[f"counts.{c}" for c in base], "base_failed", "kept", "rule")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans by the ledger at the session's setting tidemark.secrets.ledger, if there is one, which later scans go on from."""
    docs, ledger = _read(spark, sf_dir, "documents"), spark.conf.get("tidemark.secrets.ledger", None)
    findings = secrets.scan_into(docs, ["doc_id"], ledger) if ledger else secrets.scan_versions(docs, ["doc_id"])[0]
    return secrets.digest(findings, ["doc_id"])


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(_read(spark, sf_dir, "conversations"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the lower half of the range of ids are the history, the others arrive; the result has all."""
    docs = _read(spark, sf_dir, "documents")
    least, most = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return exact_dedup.dedup(docs, "false" if least is None else f"id <= {(least + most) // 2}")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_sharding": op3_sharding,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_exact_topk": op5_exact_topk,
    "op6_source_mixing": op6_source_mixing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_secret_scan": op10_secret_scan,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_vector_codes": op13_vector_codes,
}

#: The CRC-32 of a short ASCII text, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length({0}) + 1), lambda i: CAST(ascii({0}[i]) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), CAST(range(8) AS BIGINT[])), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
#: (vec_id, part, entry) nearest to each part by the books {0}.
_NEAREST = """SELECT r, part, CAST(arg_min(entry, (away, entry)) AS BIGINT) AS entry, CAST(min(away) AS BIGINT) AS away FROM (SELECT p.r, part, b.entry,
    list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS away FROM p JOIN {0} b USING (part)) GROUP BY r, part"""
#: The books {0} after the parts were assigned as {1} says.
_MOVED = """SELECT part, entry, coalesce(m.c, b.c) AS c FROM {0} b LEFT JOIN (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM
    (SELECT part, entry, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM p JOIN {1} USING (r, part), range(1, len(x) + 1) AS t(i) GROUP BY ALL) GROUP BY part, entry) m USING (part, entry)"""

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o.both >= 75 * (p.n + q.n - o.both)),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, links.y FROM reach JOIN links ON links.x = reach.r)
SELECT d AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id FROM reach LEFT JOIN n ON n.doc_id = d GROUP BY d""",
    "op5_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * x.c[i])) AS BIGINT) AS score
    FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id AND len(q.c) = len(x.c)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_conversation_trie": f"""
WITH own AS (SELECT conv_id, list((coalesce(role, ''), coalesce(text, '')) ORDER BY turn NULLS FIRST) AS t FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, t, {_CRC.format('CAST(conv_id AS VARCHAR)')} % 6 AS h FROM own),
s AS (SELECT h.conv_id, list_concat(coalesce(b.t, [])[1:h.h], h.t[h.h + 1:]) AS s FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 100),
x AS (SELECT conv_id, s, d, s[1:d] AS p FROM s, range(len(s) + 1) AS t(d)),
n AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = len(s)), '')) AS ends_sha256 FROM x GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(n.p[d][2]) END AS own FROM n LEFT JOIN k ON k.p = n.p AND len(k.p) = n.d),
u AS (SELECT m.p[1:t.a] AS p, sum(own) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM m, range(d + 1) AS t(a) GROUP BY ALL)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, u.n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN u ON u.p = m.p LEFT JOIN m up ON m.d > 0 AND up.d = m.d - 1 AND up.p = m.p[1:m.d - 1]""",
    "op12_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept, text_sha256 FROM d""",
    "op13_vector_codes": f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS MATERIALIZED (SELECT r, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS x FROM kept, range(16) AS t(part)),
b0 AS (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= 64),
a1 AS MATERIALIZED ({_NEAREST.format('b0')}), b1 AS MATERIALIZED ({_MOVED.format('b0', 'a1')}),
a2 AS MATERIALIZED ({_NEAREST.format('b1')}), b2 AS MATERIALIZED ({_MOVED.format('b1', 'a2')}),
a3 AS MATERIALIZED ({_NEAREST.format('b2')}),
c AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(away) AS BIGINT) AS error FROM a3 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256 FROM kept JOIN c USING (r)""",
}
