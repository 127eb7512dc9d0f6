"""Prefix trie of conversations: which beginnings they share, and what a cache of prefixes would save.

Texts are replaced by digests of (role, text) and their length where they are read. Conversations that are equal turn by
turn are folded into one sequence with a weight. A sequence is cut into pieces of PIECE turns at most; a piece is known by
the digest of all turns up to its end, so equal beginnings are one piece, whatever follows.

Pieces that begin after the same turns and with the same next turn make a group, and a group's pieces a trie of their own:
for the first pieces these are the tries by first turn. They are dealt out by the digest of what they have in common, and
many of them are built in one ``applyInPandas``, with children in dictionaries and one pass over the nodes in postorder.
A group too large for that is cut once more behind the turns that all of its pieces share, so its pieces go on by their
next turn in groups of their own, again and again until every group is small enough; the length of a piece bounds how often.

What lies below a piece's last node comes from other tries. Every group has one sequence of the least id that runs through
it, so its sums are added to that sequence and, from there, to each piece before it: one window, not a pass for each depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import join_checked, saved

#: Turns of a piece at most, turns of a group above which it is cut, and turns that one task takes, about.
PIECE, GROUP_TURNS, TASK_TURNS = 256, 100_000, 100_000
#: Turns numbered together, and ids that are joined to one text together.
NUMBERED, IDS = 1024, 4096
#: Conversations take their first turns from that of the next lower multiple of BASE, fewer than HEADS of them.
BASE, HEADS = 100, 6

_ROOT = hashlib.md5(b"").hexdigest()
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_PIECE = "conv_id", "w", "start", "prefix", "end", "keys", "chars", "sha"
_NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, n, key, chars): the turns of each conversation in order; equal ones of one number are a row, from place ``at`` on.

    Order is that of turn (null first), then of role and text by their digest.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), key.alias("key"), F.length(text).cast("long").alias("chars"))
    rows = rows.groupBy("conv_id", "turn", "key", "chars").agg(F.count("*").alias("n"))
    # by ranges of turns, so that a conversation of any length is numbered by many tasks
    rows = rows.withColumn("range", F.floor(F.col("turn") / NUMBERED))
    sizes = rows.groupBy("conv_id", "range").agg(F.sum("n").alias("size"))
    before = F.sum("size").over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("range"))) - F.col("size")
    sizes = saved(sizes.select(F.col("conv_id").alias("_c"), F.col("range").alias("_r"), before.alias("before")))
    within = F.sum("n").over(Window.partitionBy("conv_id", "range").orderBy(F.asc_nulls_first("turn"), "key", "chars").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    rows = rows.withColumn("within", within).join(sizes, (F.col("conv_id") == F.col("_c")) & F.col("range").eqNullSafe(F.col("_r")))
    return saved(rows.select("conv_id", (F.col("before") + F.col("within")).alias("at"), "n", "key", "chars"))


def _head_turns() -> Column:
    """How many first turns a conversation takes from its base."""
    return F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ids): the turns of the rebuilt conversations in the same form, and all conversations, also those without turns."""
    ids = saved(turns.select("conv_id").distinct().withColumn("heads", _head_turns()).withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE))
    least = F.least(F.col("n"), HEADS - F.col("at"))
    heads = turns.where((F.col("conv_id") % BASE == 0) & (F.col("at") < HEADS)).select(F.col("conv_id").alias("base"), "at", "key", "chars", F.explode(F.sequence(F.lit(0).cast("long"), least - 1)).alias("more"))
    heads = heads.groupBy("base").agg(F.array_sort(F.collect_list(F.struct((F.col("at") + F.col("more")).alias("at"), "key", "chars"))).alias("first"))  # HEADS at most
    taken = ids.join(heads, "base", "left").withColumn("first", F.expr("slice(coalesce(first, cast(array() as array<struct<at:bigint,key:string,chars:bigint>>)), 1, heads)"))
    taken = saved(taken.select("conv_id", "heads", "first", F.size("first").cast("long").alias("have")))
    first = taken.select("conv_id", F.explode("first").alias("t")).select("conv_id", "t.at", F.lit(1).cast("long").alias("n"), "t.key", "t.chars")

    # own turns behind the first ones; a conversation's rows are dealt out by their place, as it may be long
    dealt = F.floor(F.col("at") / NUMBERED)
    most = turns.groupBy("conv_id").agg(F.max(dealt).alias("last"))
    parts = taken.select("conv_id", "heads", "have").join(most, "conv_id").withColumn("dealt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    own = turns.withColumn("dealt", dealt).join(parts, ["conv_id", "dealt"])
    skipped = F.greatest(F.col("heads") - F.col("at"), F.lit(0))
    own = own.where(skipped < F.col("n")).select("conv_id", (F.greatest(F.col("at"), F.col("heads")) - F.col("heads") + F.col("have")).alias("at"), (F.col("n") - skipped).alias("n"), "key", "chars")
    return first.unionByName(own), ids.select("conv_id")


def _pieces(turns: DataFrame, length: int) -> DataFrame:
    """(conv_id, start, end, prefix, keys, chars): every conversation in pieces of ``length`` turns."""
    last = F.col("at") + F.col("n") - 1
    rows = turns.withColumn("piece", F.explode(F.sequence(F.floor(F.col("at") / length), F.floor(last / length))))
    begin = F.greatest(F.col("at"), F.col("piece") * length)
    n = F.least(last, (F.col("piece") + 1) * length - 1) - begin + 1
    rows = rows.groupBy("conv_id", "piece").agg(F.array_sort(F.collect_list(F.struct(begin.alias("at"), n.cast("int").alias("n"), "key", "chars"))).alias("t"))
    rows = rows.select("conv_id", "piece", F.expr("flatten(transform(t, x -> array_repeat(x.key, x.n)))").alias("keys"), F.expr("flatten(transform(t, x -> array_repeat(x.chars, x.n)))").alias("chars"))
    digest = F.md5(F.array_join("keys", ","))
    upto = Window.partitionBy("conv_id").orderBy("piece")
    joined = F.array_join(F.collect_list(digest).over(upto.rowsBetween(Window.unboundedPreceding, 0)), ",")
    rows = rows.withColumn("end", F.md5(joined))
    prefix = F.coalesce(F.lag("end").over(upto), F.lit(_ROOT))
    return rows.select("conv_id", (F.col("piece") * length).alias("start"), "end", prefix.alias("prefix"), "keys", "chars")


def _ends(members: DataFrame) -> DataFrame:
    """(whole, sha): the SHA-256 of the sorted ids of each set of equal conversations, over ids that were joined by ranges before."""
    ranges = members.groupBy("whole", F.floor(F.col("conv_id") / IDS).alias("range")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))  # IDS at most
    joined = ranges.select("whole", "range", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for whole, text in zip(batch.column("whole").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if whole != last:
                    if sha is not None:
                        done.append((last, sha.hexdigest()))
                    last, sha = whole, hashlib.sha256(text.encode())
                else:
                    sha.update(f",{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], ["whole", "sha"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([sha.hexdigest()])], ["whole", "sha"])

    # a digest is made in order, but from rows that stream by: no set of ids is held
    return joined.repartition("whole").sortWithinPartitions("whole", "range").mapInArrow(digests, "whole string, sha string")


def _folded(pieces: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pieces of the sequence of the least id of equal conversations, with weight and sha; (n, least, sha) of those without turns)."""
    whole = pieces.groupBy("conv_id").agg(F.max_by("end", "start").alias("whole"))
    members = saved(ids.join(whole, "conv_id", "left").withColumn("whole", F.coalesce("whole", F.lit(_ROOT))))
    sets = saved(members.groupBy("whole").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("w")).join(_ends(members), "whole"))
    last = F.when(F.col("end") == F.col("whole"), F.col("sha"))
    kept = pieces.join(sets, "conv_id").select("conv_id", "w", "start", "prefix", "end", "keys", "chars", last.alias("sha"))
    return saved(kept), sets.where(F.col("whole") == _ROOT)


def _merged(pieces: DataFrame) -> DataFrame:
    """Each piece once: the least id and the weight of all sequences that have it."""
    same = pieces.groupBy("end").agg(F.min("conv_id").alias("conv_id"), F.sum("w").alias("w"), F.max("sha").alias("sha"))
    one = pieces.select(F.col("end").alias("_end"), F.col("conv_id").alias("_conv"), "start", "prefix", "keys", "chars")
    return one.join(same, (F.col("_end") == F.col("end")) & (F.col("_conv") == F.col("conv_id"))).select(*_PIECE)


def _group() -> list[Column]:
    return [F.col("prefix"), F.element_at("keys", 1).alias("first")]


def _cut(pieces: DataFrame, merged: DataFrame, limit: int) -> DataFrame | None:
    """``pieces`` with those of groups beyond ``limit`` turns cut behind the turns that their groups share; None if there is no such group."""
    sizes = merged.groupBy(*_group()).agg(F.sum(F.size("keys")).alias("n"), F.count("*").alias("pieces"), F.min_by("keys", "end").alias("example"))
    large = saved(sizes.where((F.col("n") > limit) & (F.col("pieces") > 1)).select(F.col("prefix").alias("_prefix"), F.col("first").alias("_first"), "example"))
    if large.isEmpty():
        return None
    of = (F.col("prefix") == F.col("_prefix")) & (F.element_at("keys", 1) == F.col("_first"))
    marked = join_checked(pieces, large, of, "left")
    # so many first turns are those of the example
    differ = F.filter(F.sequence(F.lit(1), F.least(F.size("keys"), F.size("example"))), lambda i: F.element_at("keys", i) != F.element_at("example", i))
    shared = F.when(F.size(differ) > 0, differ[0] - 1).otherwise(F.least(F.size("keys"), F.size("example")))
    marked = saved(marked.withColumn("shared", F.when(F.col("example").isNotNull(), shared)).drop("example"))
    cuts = saved(marked.where("shared is not null").groupBy("_prefix", "_first").agg(F.min("shared").alias("cut")))
    marked = join_checked(marked.drop("_prefix", "_first", "shared"), cuts, of, "left")
    upper = F.slice("keys", 1, F.col("cut"))
    middle = F.md5(F.concat_ws(",", F.lit("cut"), "prefix", F.array_join(upper, ",")))
    goes_on = F.size("keys") > F.col("cut")
    top = F.struct("start", "prefix", middle.alias("end"), upper.alias("keys"), F.slice("chars", 1, F.col("cut")).alias("chars"), F.when(~goes_on, F.col("sha")).alias("sha"))
    rest = F.struct(
        (F.col("start") + F.col("cut")).alias("start"), middle.alias("prefix"), "end",
        F.expr("slice(keys, cut + 1, size(keys))").alias("keys"), F.expr("slice(chars, cut + 1, size(chars))").alias("chars"), "sha",
    )
    whole = F.struct("start", "prefix", "end", "keys", "chars", "sha")
    parts = F.when(F.col("cut").isNull(), F.array(whole)).when(goes_on, F.array(top, rest)).otherwise(F.array(top))
    return saved(marked.select("conv_id", "w", F.explode(parts).alias("p")).select("conv_id", "w", "p.start", "p.prefix", "p.end", "p.keys", "p.chars", "p.sha"))


class _Node:
    __slots__ = ("below", "chars", "children", "conv", "leaves", "more_leaves", "more_saved", "n", "saved", "sha")

    def __init__(self, chars: int, conv: int) -> None:
        self.children: dict[str, _Node] = {}
        self.chars, self.conv, self.n = chars, conv, 0
        self.below = self.more_leaves = self.more_saved = self.leaves = self.saved = 0
        self.sha = _EMPTY_SHA


_COLUMNS = ("prefix", "first", "conv_id", "w", "start", "keys", "chars", "sha", "below", "leaves", "saved")


def _groups(rows: pd.DataFrame) -> Iterator[list[tuple]]:
    """The pieces of each group, as tuples of _COLUMNS."""
    groups: dict[tuple[str, str], list[tuple]] = {}
    for row in zip(*(rows[c].tolist() for c in _COLUMNS), strict=True):
        groups.setdefault(row[:2], []).append(row)
    yield from groups.values()


def build(pieces: list[tuple]) -> _Node:
    """The trie of one group (tuples of _COLUMNS): its top stands for what all pieces follow."""
    top = _Node(0, 0)
    for _, _, conv, w, _, keys, chars, sha, below, leaves, more in pieces:
        node = top
        for key, size in zip(keys, chars, strict=True):
            child = node.children.get(key)
            if child is None:
                child = node.children[key] = _Node(int(size), conv)
            child.conv, child.n, node = min(child.conv, conv), child.n + w, child
        node.below, node.more_leaves, node.more_saved = node.below + below, node.more_leaves + leaves, node.more_saved + more
        if isinstance(sha, str):
            node.sha = sha
    return top


def summed(top: _Node) -> list[tuple[_Node, _Node, int]]:
    """(node, parent, depth below the top) of all nodes but the top, children before parents, with the sums of their subtrees."""
    order, stack = [], [(child, top, 1) for child in top.children.values()]
    while stack:
        node, parent, depth = stack.pop()
        order.append((node, parent, depth))
        stack += [(child, node, depth + 1) for child in node.children.values()]
    order.reverse()
    for node, parent, _ in order:
        node.leaves = node.leaves + node.more_leaves if node.children or node.below else 1
        node.saved += (node.n - 1) * node.chars + node.more_saved
        parent.leaves += node.leaves
        parent.saved += node.saved
    return order


def _sums(rows: pd.DataFrame) -> pd.DataFrame:
    """For each group: the sequence of the least id, where the group starts, and the leaves and savings of its own nodes."""
    out = []
    for pieces in _groups(rows):
        top = build(pieces)
        summed(top)
        out.append((min(p[2] for p in pieces), pieces[0][4], top.leaves, top.saved))
    return pd.DataFrame(out, columns=["conv_id", "start", "leaves", "saved"])


def _nodes(rows: pd.DataFrame) -> pd.DataFrame:
    ups = dict(zip(rows["prefix"], rows["up"].tolist(), strict=True))
    out = []
    for pieces in _groups(rows):
        top, start = build(pieces), pieces[0][4]
        top.conv = ups[pieces[0][0]]
        out += [(n.conv, start + depth, parent.conv, n.n, len(n.children) + n.below, n.leaves, n.saved, n.sha) for n, parent, depth in summed(top)]
    return pd.DataFrame(out, columns=[c.split(" ")[0] for c in _NODES.split(", ")])


def _in_tasks(pieces: DataFrame, tasks: int, run, schema: str) -> DataFrame:
    rows = pieces.withColumn("first", F.element_at("keys", 1)).withColumn("task", F.pmod(F.xxhash64("prefix", "first"), F.lit(tasks)))
    return rows.groupBy("task").applyInPandas(run, schema)


def trie(conversations: DataFrame, piece: int = PIECE, group_turns: int = GROUP_TURNS) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation c is rebuilt from the first h turns of conversation c - c % 100 (h is the CRC-32 of its decimal id, modulo
    6) and its own turns behind its first h. A node is a distinct sequence of first turns; it is named by the smallest id of
    the conversations that begin with it.

    - Turns are ordered by ``turn``, null first; those of one number by a digest of role and text. Null role or text: empty.
      Repeated rows are turns of their own.
    - Rows without a conv_id belong to no conversation and are left out. A conversation that is left without turns ends at
      the root. Texts may be of any length, and so may conversations.
    - An empty table has no conversation and so gives an empty result, without a root.
    - Other columns of ``conversations``, whatever their names, are not looked at.
    """
    turns, ids = rebuilt(turns_of(conversations))
    pieces, without = _folded(saved(_pieces(turns, piece)), ids)
    while True:
        merged = saved(_merged(pieces))
        cut = _cut(pieces, merged, group_turns)
        if cut is None:
            break
        pieces = cut

    n_turns = merged.agg(F.sum(F.size("keys"))).first()[0] or 0
    tasks = max(1, -(-n_turns // TASK_TURNS), min(int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_turns // 2000))
    zero = F.lit(0).cast("long")
    ups = merged.select(F.col("end").alias("prefix"), F.col("conv_id").alias("up"))
    below = merged.groupBy("prefix").agg(F.count_distinct(F.element_at("keys", 1)).alias("below")).withColumnRenamed("prefix", "end")
    plain = merged.withColumns({"below": zero, "leaves": zero, "saved": zero})
    deeper = merged.where(F.col("prefix") != _ROOT)
    if not deeper.isEmpty():
        joined = saved(merged.join(below, "end", "left").withColumns({"below": F.coalesce("below", zero), "leaves": zero, "saved": zero}))
        own = saved(_in_tasks(joined.where(F.col("prefix") != _ROOT), tasks, _sums, "conv_id long, start long, leaves long, saved long"))
        after = Window.partitionBy("conv_id").orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, -1)
        along = pieces.select("conv_id", "start", "end").join(own, ["conv_id", "start"], "left")
        along = along.select("end", F.sum("leaves").over(after).alias("leaves"), F.sum("saved").over(after).alias("saved"))
        tails = along.groupBy("end").agg(F.coalesce(F.sum("leaves"), zero).alias("leaves"), F.coalesce(F.sum("saved"), zero).alias("saved"))
        plain = joined.drop("leaves", "saved").join(tails, "end")
    root = ids.agg(F.min("conv_id").alias("least"), F.count("*").alias("n_all"))
    least = root.first()["least"]
    if least is None:
        return conversations.sparkSession.createDataFrame([], _NODES)
    ready = plain.join(ups, "prefix", "left").withColumn("up", F.coalesce("up", F.lit(least)))
    nodes = saved(_in_tasks(ready, tasks, _nodes, _NODES))
    firsts = nodes.where("depth = 1").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    top = root.crossJoin(firsts).join(without.select("sha"), F.lit(True), "left")  # relations of one row each
    top = top.select(
        F.col("least").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("n_all").alias("n_convs"), "n_children",
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("sha", F.lit(_EMPTY_SHA)).alias("ends_sha256"),
    )
    return nodes.unionByName(top)
