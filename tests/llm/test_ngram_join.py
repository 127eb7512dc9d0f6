import re

import pytest
from llm_cases import edge_rows, prose

from tidemark.llm.components import components
from tidemark.llm.ngram_join import keep_one, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(docs):
    """{id: (n, component)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in docs.items()}
    label = {i: i for i in docs}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in docs:
        for b in docs:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    return {i: (len(sets[i]), root(i)) for i in docs}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def brute_of_rows(rows):
    """Sorted (id, n, component) of each id and text, where an id links its texts that have words, and a text may have no id."""
    docs = sorted(set(rows), key=str)
    found = brute(dict(enumerate(t for _, t in docs)))
    label = {k: k for k in range(len(docs))}
    for _ in docs:
        for a, (i, _t) in enumerate(docs):
            for b, (j, _u) in enumerate(docs):
                if found[a][0] and found[b][0] and ((i is not None and i == j) or found[a][1] == found[b][1]):
                    label[a] = label[b] = min(label[a], label[b])
    least = {}
    for k, (i, _t) in enumerate(docs):
        if i is not None and found[k][0]:
            least[label[k]] = min(i, least.get(label[k], i))
    return sorted(((i, found[k][0], least.get(label[k]) if found[k][0] else i) for k, (i, _t) in enumerate(docs)), key=str)


def test_edge_cases(make_docs):
    rows = edge_rows()
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(make_docs(rows, clashes=True)).collect()]
    assert sorted(found, key=str) == brute_of_rows([r[:2] for r in rows])
    rows = [r for r in rows if r[0] is not None]
    assert got(near_duplicates(make_docs(rows, clashes=True))) == brute({r[0]: r[1] for r in rows})


def test_ids_with_several_texts(make_docs):
    a, b, c = (prose(800 + i, 60) for i in range(3))
    rows = [(1, a), (2, b), (7, a), (7, b), (8, c), (8, None), (9, ""), (10, ""), (10, c), (None, a), (None, "alone here"), (11, None)]
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(make_docs(rows)).collect()]
    assert sorted(found, key=str) == brute_of_rows(rows)
    assert (2, 56, 1) in found and (7, 56, 1) in found
    found = got(near_duplicates(make_docs([(1, a), (7, a)])))
    assert found == {1: (56, 1), 7: (56, 1)}
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(make_docs([(1, a), (7, a), (7, "")])).collect()]
    assert sorted(found) == [(1, 56, 1), (7, 0, 7), (7, 56, 1)]  # a row without words is linked with nothing


def test_common_shingles_change_nothing(make_docs, monkeypatch):
    from tidemark.llm import ngram_join

    shared = prose(50, 40)
    rows = [(i, f"{prose(i // 3, 12)} {shared} {prose(900 + i // 2, 5)}") for i in range(60)]
    monkeypatch.setattr(ngram_join, "LOOKED_AT", 20)
    monkeypatch.setattr(ngram_join, "COMMON", 2)
    assert got(near_duplicates(make_docs(rows))) == brute(dict(rows))


def test_chains_of_near_copies_and_threshold(make_docs):
    """Each text differs from the next in a few words, so links reach far beyond direct similarity; lengths vary, too."""
    words = prose(7, 80).split()
    rows, n = [], 0
    for step in range(12):
        words[6 * step % 80] = f"changed{step}"
        rows.append((n, " ".join(words)))
        rows.append((n + 1, " ".join(words[: 80 - 2 * step])))
        n += 2
    for k in range(1, 12):
        rows.append((n, " ".join(words[:k])))
        rows.append((n + 1, " ".join(words[:k]).upper()))
        n += 2
    assert got(near_duplicates(make_docs(rows))) == brute(dict(rows))


def test_large_group_of_near_copies(make_docs):
    words = prose(9, 100).split()
    rows = [(i, " ".join([*words[: i % 50], f"own{i}", *words[i % 50 + 1 :]])) for i in range(150)]
    assert {c for _, c in got(near_duplicates(make_docs(rows))).values()} == {0}


def test_empty_table(make_docs):
    assert near_duplicates(make_docs([])).count() == 0
    assert keep_one(make_docs([])).count() == 0


def test_keep_one(make_docs):
    rows = edge_rows()
    docs = make_docs(rows, clashes=True)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    first = {c for _, c in brute({r[0]: r[1] for r in rows if r[0] is not None}).values()}
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(first)
    assert ids.count(None) == 2


def test_keep_one_where_texts_of_an_id_differ(make_docs):
    a, b, c, d, e = (prose(700 + i, 80) for i in range(5))
    near = a.replace(a.split()[40], "other", 1)
    rows = [(1, a), (1, b), (2, near), (0, b), (3, c), (3, c), (5, d), (5, e), (5, e), (6, e), (7, None), (7, d), (None, a)]
    kept = keep_one(make_docs(rows, clashes=True).repartition(3))
    found = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in kept.collect())
    assert found == sorted([(1, a), (0, b), (3, c), (5, d), (5, e), (7, ""), (-1, a)])


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)] + [(100, 101), (101, 100)]])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    label = {}
    for a, b in links:
        if a != b:
            label.setdefault(a, a)
            label.setdefault(b, b)
    for _ in range(len(links)):
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert {r["node"]: r["component"] for r in components(df).collect()} == label
