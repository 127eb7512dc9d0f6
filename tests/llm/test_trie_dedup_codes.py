import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from llm_cases import edge_rows

from tidemark.llm import conversation_trie, exact_dedup, vector_codes
from tidemark.llm.queries import QUERIES

# conversations ------------------------------------------------------------------------------------------------------


def brute_trie(rows):
    """Nodes of rebuilt conversations from (conv_id, turn, role, text)."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [t[3] for t in sorted(x)] for c, x in own.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        seq = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = collections.Counter(s[:-1] for s in members if s)
    out = collections.Counter()
    leaves, saved = collections.Counter(), collections.Counter()
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = leaves[s] or 1
        saved[s] += (len(members[s]) - 1) * len(s[-1][1]) if s else 0
        if s:
            leaves[s[:-1]] += leaves[s]
            saved[s[:-1]] += saved[s]
        sha = hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest()
        out[min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]), children[s], leaves[s], saved[s], sha] += 1
    return out


def conversations():
    rnd = np.random.default_rng(5)
    rows = []
    for c in range(420):
        kind = c % 7
        if kind == 0:  # copies, of which there are many
            turns = [("user", "same"), ("assistant", "all"), ("user", "along é")]
        elif kind == 1:  # a comb
            turns = [("user", f"step {i}") for i in range(c // 7)]
        elif kind == 2:  # equal beginnings that part late
            turns = [("user", "start")] * 12 + [("user", f"end {c % 5}")]
        else:
            turns = [(("user", "assistant")[i % 2], f"{rnd.integers(3)}" * int(rnd.integers(1, 4))) for i in range(rnd.integers(0, 9))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(700, i, "user", f"long {i // 40}") for i in range(900)] + [(705, i, "user", f"long {i // 40}") for i in range(700)] + [(706, i, "user", f"long {i // 40}" if i < 500 else "other") for i in range(650)]
    rows += [(900, 0, "user", "x")] * 300 + [(901, 0, "user", "x")] * 200  # repeated rows of one number
    rows += [(c, 0, "u", "only") for c in (1003, 1005, 1007, 1010)]  # without a base, so that some have no turn left
    rows += [(1100, None, None, None), (1100, None, "user", None), (1100, 3, None, "t"), (1101, 5, "user", ""), (-150, 0, "a", "b"), (-100, 0, "c", "d"), (None, 0, "user", "lost")]
    return rows


def nodes_of(df):
    return collections.Counter(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


@pytest.fixture(scope="module")
def talk(spark):
    return spark.createDataFrame([(*r, 7, "z") for r in conversations()], "conv_id long, turn long, role string, text string, n int, prefix string").repartition(5)


@pytest.mark.parametrize(("piece", "group"), [(256, 100_000), (256, 40), (5, 12)])
def test_trie(talk, piece, group, monkeypatch):
    """Whole, with groups that are cut, and with long conversations in many pieces, turns and ids in many ranges, and cut groups."""
    if piece == 5:
        monkeypatch.setattr(conversation_trie, "NUMBERED", 7)
        monkeypatch.setattr(conversation_trie, "IDS", 3)
    assert nodes_of(conversation_trie.trie(talk, piece, group)) == brute_trie(conversations())


def test_no_conversation(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert conversation_trie.trie(spark.createDataFrame([], schema)).count() == 0
    only = conversation_trie.trie(spark.createDataFrame([(3, 0, "a", "b")], schema))  # h is 5
    assert nodes_of(only) == brute_trie([(3, 0, "a", "b")]) and only.count() == 1


# exact dedup --------------------------------------------------------------------------------------------------------


def brute_dedup(rows):
    groups = collections.defaultdict(list)
    bare = lambda t: "".join(x for x in t or "" if x not in " \t\n\v\f\r")
    for r in rows:
        groups[bare(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] or 0))
    out = collections.Counter()
    for text, found in groups.items():
        found.sort()
        keep = None if found[0][1] else found[0][2]
        for i, (_, null, doc) in enumerate(found):
            out[None if null else doc, keep, len(found), i == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def dedup_rows():
    rows = [r[:2] for r in edge_rows()]
    rows += [(100 + i, "copy of  a text"[: 15 - i % 2] if i % 3 else "copy of\ta text ") for i in range(60)]
    rows += [(300, "a\x0bb"), (301, "a\x85b"), (302, "a b"), (303, "ab"), (304, " a b"), (None, "null id"), (None, "null  id"), (305, "null id")]
    return rows


@pytest.mark.parametrize("history", ["id < 104", "false", "true"])
def test_dedup(spark, make_docs, history):
    df = make_docs(dedup_rows(), clashes=True).repartition(4)
    found = exact_dedup.dedup(df, history)
    assert collections.Counter(tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == brute_dedup(dedup_rows())


def test_dedup_in_many_ranges_and_parts(spark, make_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "RANGE_DIGESTS", 5)
    monkeypatch.setattr(exact_dedup, "LOOKUP_ROWS", 3)
    found = exact_dedup.dedup(make_docs(dedup_rows()), "id % 2 = 0 or id is null")
    assert collections.Counter(tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == brute_dedup(dedup_rows())


def test_dedup_of_an_empty_table(make_docs):
    assert exact_dedup.dedup(make_docs([]), "id < 5").count() == 0


@pytest.mark.parametrize("levels", [0, 1, 40])
def test_perfect_hash(monkeypatch, levels):
    """Minimal, perfect, and nothing foreign is found, even with the digests that no level took."""
    monkeypatch.setattr(exact_dedup, "LEVELS", levels)
    known = np.stack([np.frombuffer(hashlib.sha256(str(i).encode()).digest(), np.uint8) for i in range(3000)])
    sizes, bits, rest, slots = exact_dedup.perfect_hash(known)
    assert sorted(slots.tolist()) == list(range(3000))
    table = known[np.argsort(slots)]
    near = known.copy()
    near[:, 31] ^= 1  # agree in all but the last byte
    assert exact_dedup.slots_of(known, sizes, bits, rest, table).tolist() == slots.tolist()
    assert (exact_dedup.slots_of(near, sizes, bits, rest, table) == -1).all()


# vector codes -------------------------------------------------------------------------------------------------------


def brute_codes(rows, parts=16, entries=64, rounds=2):
    good = [(i, label, [math.floor(256 * float(x)) for x in v]) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    good = [r for r in good if len(r[2]) == len(good[0][2])]
    if not good:
        return collections.Counter()
    width = len(good[0][2]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(r[2])[p] for r in good[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assigned():
        return [[min(range(len(books[p])), key=lambda e: (away(x, books[p][e]), e)) for p, x in enumerate(cut(r[2]))] for r in good]

    for _ in range(rounds):
        codes = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(r[2])[p] for r, c in zip(good, codes, strict=True) if c[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
        # the next assignment sees the new books
    codes = assigned()
    errors = [sum(away(x, books[p][c[p]]) for p, x in enumerate(cut(r[2]))) for r, c in zip(good, codes, strict=True)]
    labels = collections.Counter()
    for r, e in zip(good, errors, strict=True):
        labels[r[1]] += e
    sha = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return collections.Counter((r[0], "".join(f"{x:02x}" for x in c), e, labels[r[1]], sha) for r, c, e in zip(good, codes, errors, strict=True))


def vector_rows(n, dim, seed=1):
    rnd = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rnd.normal(size=dim).astype(np.float32)], None if i % 11 == 0 else i % 4) for i in range(n)]
    bad = [(n + 1, None, 0), (n + 2, [None] * dim, 0), (n + 3, [float("nan")] * dim, 1), (n + 4, [float("inf")] + [0.0] * (dim - 1), 1), (n + 5, [], 1), (n + 6, [1.0] * (dim + 1), 1)]
    return rows + bad + [rows[i] for i in (0, 0, 3)] + [(5, rows[6][1], 2), (None, rows[7][1], 2), (None, rows[8][1], None)]


def codes_of(df):
    return collections.Counter(tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


@pytest.mark.parametrize(("n", "dim"), [(150, 32), (9, 16), (90, 16)])
def test_codes(spark, n, dim):
    rows = vector_rows(n, dim)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, id int, code string").repartition(4)
    assert codes_of(vector_codes.compress(df)) == brute_codes(rows)


def test_labels_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "is_small", lambda df: False)
    rows = vector_rows(80, 16)
    assert codes_of(vector_codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))) == brute_codes(rows)


def test_codes_of_few_and_wrong_vectors(spark):
    schema = "vec_id long, embedding array<double>, label int"
    assert vector_codes.compress(spark.createDataFrame([], schema)).count() == 0
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1)], schema)).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 17, 1)], schema))
    with pytest.raises(Exception, match="a long can't hold"):
        vector_codes.compress(spark.createDataFrame([(1, [1e30] * 16, 1)], schema)).count()


def test_large_components_are_exact():
    most = vector_codes.largest_component(64)
    rnd = np.random.default_rng(2)
    x = rnd.integers(-most, most, (20, 16, 4))
    books = rnd.integers(-most, most, (16, 8, 4))
    index, distance = vector_codes.nearest(x, books)
    for r in range(20):
        for p in range(16):
            d = [sum((int(a) - int(b)) ** 2 for a, b in zip(x[r, p], c, strict=True)) for c in books[p]]
            assert (index[r, p], distance[r, p]) == (d.index(min(d)), min(d))


# registered queries -------------------------------------------------------------------------------------------------


def test_registered_queries(spark, tmp_path, make_docs, talk):
    make_docs([r for r in dedup_rows() if r[0] is not None]).write.parquet(f"{tmp_path}/documents.parquet")
    talk.write.parquet(f"{tmp_path}/conversations.parquet")
    rows = vector_rows(70, 16)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert nodes_of(QUERIES["op11_conversation_trie"](spark, str(tmp_path))) == brute_trie(conversations())
    found = QUERIES["op12_exact_dedup"](spark, str(tmp_path)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert collections.Counter(tuple(r) for r in found.collect()) == brute_dedup([r for r in dedup_rows() if r[0] is not None])
    assert codes_of(QUERIES["op13_vector_codes"](spark, str(tmp_path))) == brute_codes(rows)
