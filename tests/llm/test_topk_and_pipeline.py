import collections
import math
import re

import numpy as np
import pytest
from llm_cases import edge_rows, prose

from tidemark.llm import exact_topk
from tidemark.llm.exact_topk import best_in_block, top_k


def brute(rows, k=5, every=3):
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in good:
        if i % every == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return collections.Counter(out)


@pytest.mark.parametrize("dim", [1, 3, 64])
def test_top_k(spark, dim):
    rnd = np.random.default_rng(dim)
    rows = [(i, [float(x) for x in rnd.normal(size=dim).astype(np.float32)]) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(12)] + [(7, rows[8][1])]  # ties and a repeated id
    rows += [(None, rows[0][1]), (501, None), (504, [None] * dim), (507, [float("nan")] * dim), (510, [float("inf")] * dim), (513, [1.0] * (dim + 1)), (516, [])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, block int").repartition(5)
    found = top_k(df, "id % 3 = 0", k=5)
    assert collections.Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()) == brute(rows)


def test_no_query_and_few_candidates(spark):
    schema = "vec_id long, embedding array<float>"
    assert top_k(spark.createDataFrame([], schema), "id % 50 = 0").count() == 0
    assert top_k(spark.createDataFrame([(1, [1.0])], schema), "id % 50 = 0").count() == 0
    assert [tuple(r) for r in top_k(spark.createDataFrame([(0, [1.0]), (1, [0.5])], schema), "id % 50 = 0").collect()] == [(0, 1, 1, 256 * 128)]


def test_scores_beyond_doubles():
    big = np.floor(np.array([[2.0**40 + 1, -(2.0**40)], [3.0, 2.0**41]]))
    q, x, score = best_in_block(big, np.array([1, 2]), big, np.array([1, 2]), 5, np.full(2, -np.inf))
    want = int(big[0, 0]) * 3 - 2**40 * 2**41
    assert score.tolist() == [max(want, -(2**63))] * 2 and q.tolist() == [0, 1] and x.tolist() == [1, 0]


@pytest.mark.parametrize("salted", [False, True])
def test_pairs_of_blocks_are_dropped(spark, monkeypatch, salted):
    """On clustered vectors few pairs of blocks are searched, and the result is whole, with queries broadcast or not."""
    if salted:
        monkeypatch.setattr(exact_topk, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(exact_topk, "is_small", lambda df: False)
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(12, 32)) * 4
    rows = [(i, [float(x) for x in centres[i % 12] + 0.05 * rnd.normal(size=32)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    blocks, queries = exact_topk._blocks_of(df, "id % 3 = 0", "vec_id", "embedding", 256)
    pairs, _ = exact_topk.block_pairs(blocks, queries, 5)
    assert pairs.count() < 0.5 * blocks.count() * queries.count()
    found = top_k(df, "id % 3 = 0")
    assert collections.Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()) == brute(rows)


def test_few_pairs_are_scored_one_by_one(monkeypatch):
    rnd = np.random.default_rng(2)
    cells = np.floor(256 * (np.repeat(rnd.normal(size=(40, 16)) * 3, 20, axis=0) + 0.01 * rnd.normal(size=(800, 16))))
    scored = []
    exact = exact_topk._exact
    monkeypatch.setattr(exact_topk, "_exact", lambda a, b: scored.append(len(a)) or exact(a, b))
    best_in_block(cells[:100], np.arange(100), cells, np.arange(800), 5, np.full(100, -np.inf))
    assert sum(scored) < 0.2 * 100 * 800


def test_components_that_leave_a_doubles_range(spark):
    rows = [(0, [1e307, 1.0]), (1, [1.0, 1.0]), (2, [-1e307, 0.0]), (3, [0.0, 2.0])]
    found = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "id = 0")
    assert [(r["rank"], r["vec_id"], r["score"]) for r in found.orderBy("rank").collect()] == [(1, 1, 2**63 - 1), (2, 3, 2 * 256 * 256), (3, 2, -(2**63))]


def shares(sizes):
    """Targets of sources of these sizes: 150 % by weights 3, 1, 2, none above twice its size."""
    weight = {k: (3, 1, 2)[i % 3] for i, k in enumerate(sorted(sizes))}
    capped = set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[k] for k in capped)
        total = sum(w for k, w in weight.items() if k not in capped)
        found = {k: 2 * sizes[k] if k in capped else left * weight[k] / total for k in sizes}
        over = {k for k in sizes if k not in capped and found[k] > 2 * sizes[k]}
        if not over:
            return found
        capped |= over


def passes_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    where = collections.defaultdict(list)
    for i in range(len(words) - 2):
        where[tuple(words[i : i + 3])].append(i)
    repeated = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(3)}
    return len(words) >= 50 and 100 * len(repeated) <= 50 * len(words)


def test_pipeline_of_empty_tables(spark, make_docs, tmp_path):
    """Without documents there is nothing at any stage; without labels the base rules alone reject."""
    import corpus_pipeline

    nothing = make_docs([])
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    rows = edge_rows()
    kept = corpus_pipeline.quality(spark, make_docs(rows), str(tmp_path))
    assert collections.Counter((r["doc_id"], r["text"]) for r in kept.collect()) == collections.Counter(r[:2] for r in rows if passes_base(r[1]))


def test_pipeline_stages(spark, make_docs, tmp_path):
    import corpus_pipeline
    from test_ngram_join import brute as groups
    from test_text_operators import clean_runs

    from tidemark.llm import quality_rules

    base = edge_rows() + [(5000 + i, " ".join(f"{w}***" for w in prose(i, 80).split())) for i in range(40)]
    docs = make_docs(base)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1) for i in range(10, 40)] + [(5000 + i, 0) for i in range(30)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, str(tmp_path))
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        after.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        a, b = before.toPandas(), after.toPandas()
        if name == "quality_rules":
            assert not (b["doc_id"] >= 5000).any() and set(range(10, 40)) <= set(b["doc_id"].dropna())
            # each row is kept if the base and every learned rule, looked at one by one, let it pass
            rules = quality_rules.fit_rules(before, spark.read.parquet(f"{tmp_path}/labels.parquet"))
            hit = quality_rules.with_counts(before).select("doc_id", "text", *[quality_rules.feature(f).alias(f) for f in quality_rules.FEATURES]).toPandas()
            rejected = np.zeros(len(hit), bool)
            for rule in rules:
                rejected |= rule.covers(hit[list(quality_rules.FEATURES)].to_numpy(float))
            expected = collections.Counter((str(i), t) for i, t, r in zip(hit["doc_id"], hit["text"], rejected, strict=True) if not r and passes_base(t))
            assert rules and collections.Counter(zip(b["doc_id"].map(str), b["text"], strict=True)) == expected
        if name == "line_dedup":
            assert (b["n_chars"] == b["text"].str.len()).all() and b["text"].str.contains("A line that all").sum() == 1
            pairs = [(r["doc_id"], r["text"]) for r in before.collect()]
            cleaned = clean_runs(pairs)
            expected = collections.Counter((i, cleaned[i, t][0]) for i, t in pairs if not cleaned[i, t][1] or cleaned[i, t][0])
            assert collections.Counter((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tmp_path}/{name}").collect()) == expected
        if name == "ngram_jaccard_join":
            # rows without an id are not compared and stay; of rows of one id and text one stays
            named = a.dropna(subset=["doc_id"]).drop_duplicates(["doc_id", "text"])
            assert named["doc_id"].is_unique and b["doc_id"].isna().sum() == a["doc_id"].isna().sum()
            kept = {c for _, c in groups(dict(zip(named["doc_id"], named["text"], strict=True))).values()}
            assert sorted(b["doc_id"].dropna()) == sorted(kept)
        if name == "source_mixing":
            assert set(b["doc_id"].dropna()) <= set(a["doc_id"].dropna()) and b["doc_id"].value_counts().max() <= 2
            sizes, taken = ({k: g["text"].str.split().str.len().tolist() for k, g in x.fillna({"source": "~"}).groupby("source")} for x in (a, b))
            wanted = shares({k: sum(v) for k, v in sizes.items()})
            assert all(abs(sum(taken.get(k, [])) - wanted[k]) <= max(v) / 2 for k, v in sizes.items())
        before = after
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert packed.where("piece = 0").count() == before.count()
