"""Shards of equal row counts by balanced label propagation over linked documents.

Documents of equal text are linked. They start in random shards of equal sizes and move in rounds:

1. Every group asks for the shard that most of its documents are in, of those that still have a place for the whole group
   (ties change with the round). A shard takes the groups that ask for it, large ones and those that have most there first,
   up to its quota; the others ask again, for what is left. A group larger than a shard has whole shards of its own.
2. The documents that aren't where their group is to be want to go there. All of a shard's wishes can't be granted at once
   where it is full, so the moves admitted are the most that leave every shard within its quota: a largest circulation over
   the numbers of wishes from shard to shard, whose cycles go through full shards, too.

Documents of one group in one shard are alike, so they move as a number, whole or in part, and a group of any size is a few
rows. The state with the fewest links cut is kept. At last all documents without links, which cut no edge anywhere, fill the
shards up to their exact quotas. DataFrame functions only; windows go by way of hash buckets, so none has a whole shard or
group; the driver sees numbers by shard, and groups larger than a shard, of which there are fewer than shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import buckets_for, join_checked, saved

#: Rounds of propagation at most, beyond which documents stay where they are, and how often a group asks in each.
ROUNDS, ASKS = 12, 6


def _numbered(df: DataFrame, keys: list[str], spread: Column, order: list[Column | str], buckets: int, into: str, weight: str | None = None) -> DataFrame:
    """``df`` with ``into``: rows (or the sum of ``weight``) before each row within ``keys``, by buckets of ``spread``."""
    df = df.withColumn("_bucket", F.pmod(spread, F.lit(buckets)))
    amount = F.col(weight) if weight else F.lit(1)
    sizes = df.groupBy(*keys, "_bucket").agg(F.sum(amount).alias("_size"))
    before = sizes.select(*keys, "_bucket", (F.sum("_size").over(Window.partitionBy(*keys).orderBy("_bucket")) - F.col("_size")).alias("_before"))
    within = F.sum(amount).over(Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - amount
    df = df.withColumn("_within", within)
    return join_checked(df, saved(before), [*keys, "_bucket"], "inner").withColumn(into, F.col("_before") + F.col("_within")).drop("_bucket", "_before", "_within")


def admitted(want: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """The most moves from shard to shard, of those wanted, that leave every shard with no more than it has room for.

    A move takes a place and leaves one, so this is a largest circulation, with one more node for the room: cycles that gain
    moves are pushed until there is none. The graph has a node for each shard.
    """
    n = len(room)
    graph: list[list[list[int]]] = [[] for _ in range(n + 1)]  # of edges [to, capacity, gain, place of the edge back]

    def edge(a: int, b: int, capacity: int, gain: int) -> None:
        graph[a].append([b, capacity, gain, len(graph[b])])
        graph[b].append([a, 0, -gain, len(graph[a]) - 1])

    for (a, b), moves in sorted(want.items()):
        if a != b and moves > 0:
            edge(a, b, moves, 1)
    for s, free in enumerate(room):
        edge(s, n, max(0, free), 0)  # what a shard takes in beyond what leaves it
        edge(n, s, sum(want.values()), 0)
    while (cycle := _gaining(graph)) is not None:
        least = min(graph[u][i][1] for u, i in cycle)
        for u, i in cycle:
            there = graph[u][i]
            there[1] -= least
            graph[there[0]][there[3]][1] += least
    flows = {(a, e[0]): graph[e[0]][e[3]][1] for a in range(n) for e in graph[a] if e[2] == 1}
    return {k: m for k, m in flows.items() if m > 0}


def _gaining(graph: list[list[list[int]]]) -> list[tuple[int, int]] | None:
    """A cycle of edges with capacity left whose gains add up to more than 0, as (node, edge), by longest walks."""
    nodes = len(graph)
    best, by, last = [0] * nodes, [(0, 0)] * nodes, -1
    for _ in range(nodes):
        last = -1
        for u in range(nodes):
            for i, (v, capacity, gain, _) in enumerate(graph[u]):
                if capacity > 0 and best[u] + gain > best[v]:
                    best[v], by[v], last = best[u] + gain, (u, i), v
        if last < 0:
            return None
    for _ in range(nodes):
        last = by[last][0]
    cycle, v = [], last
    while not cycle or v != last:
        cycle.append(by[v])
        v = by[v][0]
    return cycle


#: A group's print, as the key of a dictionary.
Print = bytes | str


def _by_shard(near: DataFrame) -> dict[Print, dict[int, int]]:
    """The documents of few groups by shard."""
    out: dict[Print, dict[int, int]] = {}
    for r in near.select("print", "shard", "c").collect():
        out.setdefault(bytes(r["print"]) if isinstance(r["print"], bytearray) else r["print"], {})[r["shard"]] = r["c"]
    return out


def giants(parts: dict[Print, dict[int, int]], quotas: list[int]) -> dict[Print, dict[int, int]]:
    """For each group larger than a shard (print to its documents by shard) how many of them each of its shards is to have.

    Largest first, each fills the free shards in which it has most; what is left goes to one more.
    """
    free, out = list(quotas), {}
    for group in sorted(parts, key=lambda g: (-sum(parts[g].values()), g)):
        left, mine = sum(parts[group].values()), {}
        for s in sorted(range(len(quotas)), key=lambda s: (-min(left, free[s]), -parts[group].get(s, 0), s)):
            if (n := min(left, free[s])) > 0:
                mine[s] = n
                free[s] -= n
                left -= n
        out[group] = mine
    return out


def _allowed(moves: DataFrame, flows: dict[tuple[int, int], int], buckets: int) -> DataFrame:
    """The part of ``moves`` that ``flows`` has room for: most neighbours first, by powers of two."""
    allowed = moves.sparkSession.createDataFrame([(a, b, n) for (a, b), n in flows.items()], "shard int, to int, allowed long")  # a row for two shards
    width = max(1, buckets // 64)
    turn = (63 - F.least(F.lit(63), F.floor(F.log2("there")))) * width + F.pmod(F.xxhash64("print"), F.lit(width))
    moves = _numbered(moves, ["shard", "to"], turn, ["print"], 64 * width, "before", "c").join(F.broadcast(allowed), ["shard", "to"])
    return saved(moves.where("before < allowed").select("print", "shard", "to", F.expr("least(c, allowed - before)").alias("c")))


def _homes(groups: DataFrame, place: list[int], turn: int, buckets: int) -> DataFrame:
    """(print, home) for ``groups`` (print, n, parts), as far as shards that they are in have ``place`` for them: the sums of n by home keep to it."""
    place, found, open_ = list(place), None, groups
    for ask in range(ASKS):
        free = F.array(*[F.lit(p).cast("long") for p in place])
        chance = lambda p: F.pmod(F.xxhash64("print", p["shard"], F.lit(turn), F.lit(ask)), F.lit(1000)) / 50_000  # noqa: E731, B023
        score = lambda p: p["c"] / F.col("n") + chance(p)  # noqa: E731, B023
        fits = F.filter("parts", lambda p: F.element_at(free, p["shard"] + 1) >= F.col("n"))  # noqa: B023
        best = F.array_max(F.transform(fits, lambda p: F.struct(score(p).alias("score"), p["shard"].alias("home"))))  # noqa: B023
        asks = saved(open_.withColumn("best", best).where("best is not null").select("print", "n", "parts", "best.score", "best.home"))
        asked = {r["home"]: r["n"] for r in asks.groupBy("home").agg(F.sum("n").alias("n")).collect()}  # a row for each shard
        if not asked:
            break
        if all(n <= place[s] for s, n in asked.items()):
            taken = asks
        else:  # large groups first, then those that have most there
            width = max(1, buckets // 64)
            order = (63 - F.least(F.lit(63), F.floor(F.log2("n")))) * width + F.least(F.lit(width - 1), F.floor((1.02 - F.col("score")) * width))
            quota = F.element_at(free, F.col("home") + 1)
            taken = _numbered(asks, ["home"], order, [F.desc("score"), "print"], 64 * width, "before", "n").where(F.col("before") + F.col("n") <= quota)
        taken = saved(taken.select("print", "home", "n"))
        found = taken if found is None else found.unionByName(taken)
        for r in taken.groupBy("home").agg(F.sum("n").alias("n")).collect():  # a row for each shard
            place[r["home"]] -= r["n"]
        if taken is asks or asks.count() == taken.count():
            break
        open_ = join_checked(asks.select("print", "n", "parts"), taken.select("print"), "print", "left_anti")
    return groups.select("print", F.lit(0).alias("home")).limit(0) if found is None else found.select("print", "home")


def propagated(near: DataFrame, quotas: list[int], buckets: int) -> tuple[DataFrame, int, int]:
    """``near`` (print, shard, c: so many documents of a group in a shard) after propagation, and the links cut before and after."""
    links = lambda c: F.coalesce(F.sum(F.expr(f"{c} * ({c} - 1) div 2").cast("decimal(38,0)")), F.lit(0))
    near = saved(near)
    sizes = near.groupBy("print").agg(F.sum("c").alias("n"))
    every = int(sizes.agg(links("n")).first()[0])
    # fewer than there are shards
    aims = giants(_by_shard(near.join(F.broadcast(sizes.where(F.col("n") > min(quotas))), "print")), quotas)
    kept_free = [q - sum(mine.get(s, 0) for mine in aims.values()) for s, q in enumerate(quotas)]
    cuts, best, idle = [], near, 0
    is_large = F.col("print").isin([F.lit(g) for g in aims]) if aims else F.lit(False)
    while True:
        rows = near.groupBy("shard").agg(F.sum("c").alias("n"), links("c").alias("kept")).collect()  # a row for each shard
        cuts.append(every - sum(int(r["kept"]) for r in rows))
        if cuts[-1] <= min(cuts):
            best = near
        if idle == 3 or len(cuts) > ROUNDS or not cuts[-1] or (len(cuts) > 4 and min(cuts[:-3]) - min(cuts[-3:]) < 0.001 * every):
            return best, cuts[0], min(cuts)
        room = list(quotas)
        for r in rows:
            room[r["shard"]] -= r["n"]
        groups = near.where(~is_large).groupBy("print").agg(F.sum("c").alias("n"), F.collect_list(F.struct("shard", "c")).alias("parts"))  # ``n_shards`` parts at most
        groups = saved(groups)
        # groups that are whole stay
        place = list(kept_free)
        for r in groups.where("size(parts) = 1").groupBy(F.col("parts")[0]["shard"].alias("shard")).agg(F.sum("n").alias("n")).collect():  # a row for each shard
            place[r["shard"]] -= r["n"]
        split = groups.where("size(parts) > 1")
        homes = _homes(split, place, len(cuts), buckets)
        moves = join_checked(near, saved(homes), "print", "inner").where("shard <> home")
        there = F.coalesce(F.filter("parts", lambda p: p["shard"] == F.col("home"))[0]["c"], F.lit(0))
        moves = join_checked(moves.select("print", "shard", F.col("home").alias("to"), "c"), saved(split.join(homes, "print").select("print", there.cast("long").alias("there"))), "print", "inner")
        moves = saved(moves.select("print", "shard", "to", "c", "there").unionByName(_giant_moves(near.where(is_large), aims)))
        want = {(r["shard"], r["to"]): r["n"] for r in moves.groupBy("shard", "to").agg(F.sum("c").alias("n")).collect()}  # a row for two shards
        flows = admitted(want, room)
        if not flows:
            idle += 1
            continue
        idle = 0
        if flows != want:
            moves = _allowed(moves, flows, buckets)
        moves = moves.withColumnRenamed("c", "m")
        after = near.unionByName(moves.select("print", "shard", (-F.col("m")).alias("c"))).unionByName(moves.select("print", F.col("to").alias("shard"), F.col("m").alias("c")))
        near = saved(after.groupBy("print", "shard").agg(F.sum("c").alias("c")).where("c > 0"))


def _giant_moves(near: DataFrame, aims: dict[Print, dict[int, int]]) -> DataFrame:
    """What groups larger than a shard still have to move to have as many documents in each shard as ``aims`` says: rows by shards."""
    rows = []
    for group, parts in (_by_shard(near) if aims else {}).items():  # fewer groups than there are shards
        short = {s: n - parts.get(s, 0) for s, n in aims[group].items() if n > parts.get(s, 0)}
        for s, c in parts.items():
            over = c - aims[group].get(s, 0)
            for t in list(short):
                if over > 0 and (n := min(over, short[t])) > 0:
                    rows.append((group, s, t, n, parts.get(t, 0)))
                    over, short[t] = over - n, short[t] - n
    kind = near.schema["print"].dataType.simpleString()
    return near.sparkSession.createDataFrame(rows, f"print {kind}, shard int, to int, c long, there long")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = 16) -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: counts of shards are at most one apart. Slots are numbered from 0 without gaps in each shard.
    size is the UTF-8 bytes of the text plus 1; grown_shard is null.

    - A null text has size 1, no checksum and no links; empty texts are equal to each other.
    - Null ids and repeated rows are rows like others. A group may be of any size; one too large for a shard is split.
      Very long texts are read whole, in one pass. An empty table gives an empty result.
    - Other columns of ``docs``, whatever their names, are not looked at.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text)).alias("print"))
    rows = saved(rows.withColumn("uid", F.monotonically_increasing_id()))  # a number of its own for each row
    total = rows.count()
    buckets = buckets_for(total, docs.sparkSession)
    quotas = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]

    groups = saved(rows.where("print is not null").groupBy("print").agg(F.count("*").alias("n_group")).where("n_group > 1"))
    linked = join_checked(rows.select("uid", "print"), groups, "print", "inner").select("uid", "print")
    # random shards of equal sizes to start from
    linked = saved(_numbered(linked, [], F.xxhash64("uid"), ["uid"], buckets, "at").withColumn("start", F.pmod("at", F.lit(n_shards)).cast("int")).drop("at"))
    near, _, _ = propagated(linked.groupBy("print", F.col("start").alias("shard")).agg(F.count("*").alias("c")), quotas, buckets)
    free = list(quotas)
    for r in near.groupBy("shard").agg(F.sum("c").alias("n")).collect():  # a row for each shard
        free[r["shard"]] -= r["n"]

    # a group's documents are alike: by their numbers they go to its shards in turn
    ends = F.sum("c").over(Window.partitionBy("print").orderBy("shard"))
    ends = saved(near.withColumn("end", ends).groupBy("print").agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("ends")))  # ``n_shards`` at most
    ranked = join_checked(_numbered(linked.select("uid", "print"), ["print"], F.xxhash64("uid"), ["uid"], buckets, "at"), ends, "print", "inner")
    placed = ranked.select("uid", F.filter("ends", lambda e: e["end"] > F.col("at"))[0]["shard"].alias("shard"))

    rows = saved(rows.drop("print").join(placed, "uid", "left"))
    rest = _numbered(rows.where("shard is null"), [], F.xxhash64("uid"), ["uid"], buckets, "at")
    upto = [sum(free[: s + 1]) for s in range(n_shards)]
    filled = rest.withColumn("shard", sum(((F.col("at") >= e).cast("int") for e in upto[:-1]), F.lit(0))).drop("at")
    out = rows.where("shard is not null").unionByName(filled).select("uid", "id", "size", "text_crc32", "shard")
    out = _numbered(out, ["shard"], F.xxhash64("uid"), ["uid"], buckets, "slot")
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
