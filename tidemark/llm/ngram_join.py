"""Near-duplicate join on word shingles.

Two documents are linked when the Jaccard similarity of their sets of word shingles is at least ``percent`` / 100.
The join is a prefix-filter join with the rarest shingles first:

1. Equal texts are folded into one node, so a group of copies costs one node, however large it is.
2. Elimination. With any fixed order of shingles, linked sets share at least k of their first n - ceil(t n) + k
   shingles. In the order of their hashes that prefix, a third of the set, is dealt out by shingle; a node too few of
   whose shingles there occur in another node has no partner at all. Its whole set is never shuffled.
3. The remaining nodes' sets are counted exactly, and their shingles put in order of document frequency, rarest first.
   Prefix shingles with their position are the join's keys.
4. Each prefix shingle's nodes are first compared with one of them, then with a few; at last all nodes that aren't known
   to be connected are joined with each other. Length and positional filters are conditions of the join itself, the suffix
   filter compares counts by hash range, and the pairs left are verified once on their whole sets. So a group of
   thousands of near copies never becomes a table of all its pairs, yet no link that matters to a component is lost.
5. Connected components by alternating stars.

Sets are held as 64-bit hashes: with 10^9 distinct shingles, some two of them collide with probability 3 %, and such a
collision matters only to a pair exactly at the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.components import components
from tidemark.llm.tables import join_checked, masked, saved, unmasked

#: The elimination's prefix is longer than the shortest valid one by a shingle for each so many in the set.
SPARE = 20
#: Nodes of a prefix shingle that its others are compared with before all that are still unconnected are.
LEADERS = 24
#: Documents looked at, and hits among them from which a shingle counts as common. Common ones go last in the order of
#: rarity and aren't counted; which they are changes the way of the join, never its result.
LOOKED_AT, COMMON = 20_000, 5
#: Ranges of hashes whose counts the suffix filter compares.
RANGES = 64


def _least_overlap(n: str, percent: int) -> str:
    return f"(({percent} * {n} + 99) div 100)"


def _prefixes(percent: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.steps(batches, "text"):
            ids, tokens, sizes = [], [], []
            for node, shingles in zip(batch.column("id").to_pylist(), words.shingle_sets(batch.column("text"), width), strict=True):
                n = len(shingles)
                first = min(n, n - (percent * n + 99) // 100 + 1 + n // SPARE)
                # one more row holds the size, under a key of its own
                tokens += [shingles[:first], words.scramble(np.array([node], np.int64).view(np.uint64))]
                ids.append(np.full(first + 1, node, np.int64))
                sizes += [np.full(first, n, np.int32), np.array([-n - 1], np.int32)]
            if ids:
                columns = [np.concatenate(ids), np.concatenate(tokens).view(np.int64), np.concatenate(sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "token", "n"])

    return run


def _whole_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.steps(batches, "text"):
            sets = list(words.shingle_sets(batch.column("text"), width))
            counts = [np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=RANGES).astype(np.int32).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(counts, pa.binary())],
                ["node", "n", "shingles", "counts"],
            )

    return run


def _one_row_a_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            n = part.column("n").to_numpy()
            tokens = np.frombuffer(b"".join(part.column("shingles").to_pylist()), np.int64)
            columns = [np.repeat(part.column("node").to_numpy(), n), tokens, np.repeat(n, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "token", "n"])


def _kept_pairs(kind: str, percent: int):
    """Pairs whose overlap, or the bound of it by hash ranges, reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            total = batch.column("total").to_pylist()
            keep = []
            for p, q, n in zip(x, y, total, strict=True):
                if kind == "bound":
                    both = int(np.minimum(np.frombuffer(p, np.int32), np.frombuffer(q, np.int32)).sum())
                else:
                    both = len(np.intersect1d(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), assume_unique=True))
                keep.append(100 * both >= percent * (n - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    for kind, column in (("bound", "counts"), ("exact", "shingles")):
        a = sets.select(F.col("node").alias("a"), F.col(column).alias("x"), F.col("n").alias("na"))
        b = sets.select(F.col("node").alias("b"), F.col(column).alias("y"), F.col("n").alias("nb"))
        pairs = pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y", F.expr("na + nb").alias("total")).mapInArrow(_kept_pairs(kind, percent), "a long, b long")
    return saved(pairs)


def _common(texts: DataFrame, documents: int, width: int) -> DataFrame:
    """Shingles that some thousandths of a percent of all texts have: a table of a bounded size, from LOOKED_AT texts."""
    some = texts.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(max(1, documents // LOOKED_AT))) == 0)
    tokens = some.mapInArrow(_whole_sets(width), "node long, n int, shingles binary, counts binary").mapInArrow(_one_row_a_shingle, "node long, token long, n int")
    hits = tokens.groupBy("token").agg(F.count("*").alias("hits")).where(F.col("hits") >= COMMON)
    return saved(hits.orderBy(F.desc("hits"), "token").limit(LOOKED_AT).select("token", F.lit(True).alias("common")))


def _counted(entries: DataFrame, common: DataFrame, extra: str = "false") -> DataFrame:
    """``entries`` with df, in how many of them their tokens are, if in two or more (or ``extra`` holds); of common ones, the highest number."""
    marked = entries.join(F.broadcast(common), "token", "left")  # LOOKED_AT rows at most
    # the rows of a common one are dealt out by node, so none is one task's
    marked = marked.withColumn("dealt", F.when(F.col("common"), F.xxhash64("node", "token")).otherwise(F.col("token")))
    df = F.when(F.col("common"), F.lit(2**62)).otherwise(F.count("*").over(Window.partitionBy("common", "dealt")))
    return marked.withColumn("df", df).where(f"df > 1 or {extra}").drop("common", "dealt")


def _nodes(ids: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, texts): the node of each id, which has one text, and the text of each node, once."""
    groups = saved(ids.where("print is not null").groupBy("print").agg(F.min("id").alias("node"), F.count("*").alias("n")).where("n > 1").drop("n"))
    members = saved(join_checked(ids, groups, "print", "left").withColumn("node", F.coalesce("node", "id")))
    present = rows.where("text is not null")
    texts = join_checked(present, saved(members.where("id <> node or n_rows > 1").select("id")), "id", "left_anti")
    again = saved(members.where("id = node and n_rows > 1 and print is not null").select("id"))
    if not again.isEmpty():
        texts = texts.unionByName(join_checked(present, again, "id", "inner").select("id", "text").dropDuplicates(["id"]))
    return members, texts


def _by_text(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """near_duplicates where ids are null or have several texts: each text is a node, and an id links its own."""
    docs = saved(rows.select("id", F.unhex(F.md5("text")).alias("print")).distinct())
    nodes = saved(saved(docs.where("print is not null").select("print").distinct()).withColumn("node", F.monotonically_increasing_id()))
    numbered = join_checked(rows.where("text is not null").select(F.unhex(F.md5("text")).alias("print"), "text"), nodes, "print", "inner")
    found = near_duplicates(numbered, "node", "text", width, percent).select("node", "n_shingles", F.col("component_id").alias("class"))
    docs = saved(docs.join(nodes.join(found, "node"), "print", "left").select("id", F.coalesce("n_shingles", F.lit(0).cast("long")).alias("n"), F.when(F.col("n_shingles") > 0, F.col("class")).alias("class")))
    least = docs.where("class is not null").groupBy("class").agg(F.min("id").alias("least"))
    linked = components(docs.join(least, "class").where("id is not null").select(F.col("id").alias("a"), F.col("least").alias("b")))
    out = docs.join(least, "class", "left").withColumn("own", F.coalesce("id", "least")).join(linked, F.col("own") == F.col("node"), "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("component", "own")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """One row for each id and text of ``docs``: ``id_col``, ``n_shingles``, ``component_id``.

    ``component_id`` is the smallest id reachable over links, the id itself included. Ids are integers.

    - Null or empty text, or text without words: an empty set, n_shingles 0, linked with nothing.
    - Repeated rows of an id and text have one row. Each text of an id takes part, and those with words are linked by their id.
    - A text without an id is linked, too; its component is null if no id is reachable.
    - Equal texts are one node and so always linked; very long texts are taken whole.
    - An empty table gives an empty result; other columns of ``docs``, whatever their names, are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    prints = rows.where("id is not null").select("id", F.unhex(F.md5("text")).alias("print"))
    ids = prints.groupBy("id").agg(F.min("print").alias("print"), F.max("print").alias("other"), F.count("*").alias("n_rows"), F.count("print").alias("n_texts"))
    ids = saved(ids)
    several = ids.where("print <> other or n_texts not in (0, n_rows)")
    if not several.isEmpty() or not docs.where(F.col(id_col).isNull()).isEmpty():
        return _by_text(rows, width, percent).select(F.col("id").alias(id_col), "n_shingles", "component_id")
    members, texts = _nodes(ids.select("id", "print", "n_rows"), rows)

    common = _common(texts, ids.count(), width)
    entries = texts.mapInArrow(_prefixes(percent, width), "node long, token long, n int")
    marks = _counted(entries, common, "n < 0")
    sizes = saved(marks.groupBy("node").agg(F.max(F.expr("-n - 1")).alias("n"), F.count_if(F.col("n") >= 0).alias("shared")))
    # a partner has at least this many shingles, and as many of the prefix's spare ones
    alive = saved(sizes.where(f"shared >= 1 + {_least_overlap('n', percent)} div {SPARE}").select(F.col("node").alias("id")))

    sets = saved(join_checked(texts, alive, "id", "left_semi").mapInArrow(_whole_sets(width), "node long, n int, shingles binary, counts binary"))
    tokens = sets.select("node", "n", "shingles").mapInArrow(_one_row_a_shingle, "node long, token long, n int")
    ranked = _counted(tokens, common)
    ranked = ranked.select("node", "token", "n", F.row_number().over(Window.partitionBy("node").orderBy("df", "token")).alias("at"), F.count("*").over(Window.partitionBy("node")).alias("k"))
    prefix = saved(ranked.withColumn("pos", F.expr("int(n - k + at)")).where(f"pos <= n - {_least_overlap('n', percent)} + 1").select("token", "node", "n", "pos"))

    #: lengths and positions (from 1) of a common shingle after which the threshold can still be reached
    possible = f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and {100 + percent} * (1 + least(x.n - x.pos, y.n - y.pos)) >= {percent} * (x.n + y.n)"
    ends = [F.expr("least(x.node, y.node)").alias("a"), F.expr("greatest(x.node, y.node)").alias("b")]
    first = prefix.groupBy("token").agg(F.min(F.struct("node", "n", "pos")).alias("one")).select("token", "one.*")
    to_one = saved(prefix.alias("x").join(first.alias("y"), F.expr(f"x.token = y.token and x.node <> y.node and {possible}")).select(*ends).distinct())
    links = _verified(to_one, sets, percent)

    def connected(links: DataFrame) -> DataFrame:
        return prefix.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))

    # then with a few more, the same ones for many shingles, which leaves little of a dense group unconnected
    known = saved(connected(links))
    place = F.row_number().over(Window.partitionBy("token").orderBy(F.xxhash64("node"), "node"))
    some = known.withColumn("place", place).where(F.col("place") <= LEADERS).drop("place")
    to_some = known.alias("x").join(some.alias("y"), F.expr(f"x.token = y.token and x.component <> y.component and {possible}"))
    to_some = saved(to_some.select(*ends).distinct().join(to_one, ["a", "b"], "left_anti"))
    links = links.union(_verified(to_some, sets, percent))

    known = connected(links)
    # lengths in bands so wide that a partner is in the same or the next one
    known = known.withColumn("band", F.expr(f"int(floor(ln(n) / -ln({percent} / 100.0D) + 1e-9))"))
    longer = known.select("*", F.explode(F.array("band", F.col("band") - 1)).alias("with")).drop("band")
    pairs = known.alias("x").join(longer.alias("y"), F.expr(f"x.token = y.token and x.band = y.with and (x.n, x.node) < (y.n, y.node) and x.component <> y.component and {possible}"))
    others = saved(pairs.select(*ends).distinct().join(to_one.union(to_some), ["a", "b"], "left_anti"))
    linked = components(links.union(_verified(others, sets, percent)))

    out = members.join(sizes.select("node", "n"), "node", "left").join(linked, "node", "left")
    n = F.coalesce(F.col("n").cast("long"), F.lit(0).cast("long"))
    return out.select(F.col("id").alias(id_col), n.alias("n_shingles"), F.when(n == 0, F.col("id")).otherwise(F.coalesce("component", "node")).alias("component_id"))


def _one_of_each(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """The row of each combination of ``keys`` whose hash is least, so that it is the same one in each run."""
    hashed = F.xxhash64(*[F.col(c) for c, kind in rows.dtypes if "map<" not in kind])
    return rows.groupBy(*[k.alias(f"key{i}") for i, k in enumerate(keys)]).agg(F.min_by(F.struct("*"), hashed).alias("row")).select("row.*")


def _keep_texts(rows: DataFrame, key: Column, text: Column, width: int, percent: int) -> DataFrame:
    """keep_one where texts of one id differ: each (id, text) is a node; of a component the one of least id and MD5 stays."""
    mine = F.unhex(F.md5(text))
    nodes = saved(saved(rows.select(key.alias("id"), mine.alias("print")).distinct()).withColumn("node", F.monotonically_increasing_id()))
    same = key.eqNullSafe(F.col("id")) & mine.eqNullSafe(F.col("print"))
    numbered = join_checked(rows, nodes, same, "inner").select("node", text.alias("text"))
    found = near_duplicates(numbered, "node", "text", width, percent).select("node", F.col("component_id").alias("component"))
    best = found.join(nodes, "node").groupBy("component").agg(F.min(F.struct("id", "print")).alias("best"))
    return _one_of_each(join_checked(rows, saved(best.select("best.*")), same, "left_semi"), [key, mine])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with the document of the smallest id of each group of near duplicates; rows without an id stay.

    Of an id on several rows of one text one row stays. Different texts of an id are documents of their own, ordered by
    MD5. Other cases as in near_duplicates; all columns stay, whatever their names.
    """
    rows, names = masked(docs)
    key, text = F.col(names[id_col]), F.col(names[text_col])
    again = saved(rows.where(key.isNotNull()).groupBy(key.cast("long").alias("id"), F.md5(text).alias("print")).agg(F.count("*").alias("n")).groupBy("id").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).where("n > 1"))
    if not again.where("texts > 1").isEmpty():
        return _keep_texts(rows.where(key.isNotNull()), key, text, width, percent).unionByName(rows.where(key.isNull())).select(unmasked(names))
    found = saved(near_duplicates(docs.where(F.col(id_col).isNotNull()), id_col, text_col, width, percent).toDF("id", "n", "component"))
    left = join_checked(rows, saved(found.where("id <> component").select("id")), key == F.col("id"), "left_anti")
    again = again.select("id")
    if not again.isEmpty():
        repeated = _one_of_each(join_checked(left, again, key == F.col("id"), "left_semi"), [key])
        left = join_checked(left, again, key == F.col("id"), "left_anti").unionByName(repeated)
    return left.select(unmasked(names))
