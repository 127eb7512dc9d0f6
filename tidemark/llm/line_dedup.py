"""Line dedup by a suffix array over line ids, built by distributed prefix doubling.

Positions (document, line) are ranked by their first 1, 2, 4, ... lines; a round makes the rank by 2h lines from the
ranks by h lines here and h lines on, until no rank is shared. A rank is where an interval of the suffix array begins, all
of whose positions have that many lines in common; positions alone in their interval are discarded as they come up.

Then the longest-common-prefix intervals of all lengths between the powers of two are found from above: an interval's
members go on with those that share half as many lines more, and the earliest of each such part goes on with the
earliest ones of the others. So every position but the earliest of its interval ends with the longest run of lines from it
on that occurs from an earlier position on, and rows never exceed twice the positions that have one. Of those, the runs
that no run from the line before contains are the maximal repeated runs; the later copies of the long enough ones go.

Equal texts are folded into one before, so a group of copies costs one text, however large it is. DataFrame functions
only; only hashes of lines are shuffled, never texts unless too many documents change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import join_checked, masked, saved, unmasked

#: A run is deleted from so many lines on, if they have so many characters together, or is one line of LONG_LINE.
MIN_LINES, MIN_CHARS, LONG_LINE = 2, 40, 60

_DOC = ["id", "print"]
#: Ranks of so many bits are one range.
_RANGE = 12


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _me() -> Column:
    return F.struct(*_DOC, "pos")


def _first_ranks(lines: DataFrame) -> DataFrame:
    """Positions of lines that occur twice or more, with rank (by one line) and the earliest position of each rank."""
    same = lines.groupBy("l1", "l2").agg(F.count("*").alias("n"), F.min(_me()).alias("first")).where("n > 1")
    same = saved(same.withColumn("range", F.shiftright("l1", 52)))
    ranges = same.groupBy("range").agg(F.sum("n").alias("total"))  # 4,096 at most
    ranges = ranges.select("range", (F.sum("total").over(Window.orderBy("range")) - F.col("total")).alias("before"))
    within = F.sum("n").over(Window.partitionBy("range").orderBy("l1", "l2")) - F.col("n")
    same = same.withColumn("within", within).join(F.broadcast(ranges), "range")
    same = saved(same.select("l1", "l2", (F.col("before") + F.col("within")).alias("rank"), "first"))
    return join_checked(lines, same, ["l1", "l2"], "inner").drop("l1", "l2")


def _doubled(ranked: DataFrame, ahead: int) -> DataFrame:
    """Ranks by ``ahead`` more lines, of the positions that have them, discarding those alone in their interval."""
    by_doc = Window.partitionBy(*_DOC).orderBy("pos")
    there = F.last("rank").over(by_doc.rangeBetween(ahead, ahead))
    pairs = ranked.select(*_DOC, "pos", "rank", there.alias("then")).where("then is not null")
    same = pairs.groupBy("rank", "then").agg(F.count("*").alias("n"), F.min(_me()).alias("first"))
    # a common line may go on in many ways, so these are counted by ranges first
    same = same.where("n > 1").withColumn("range", F.shiftright("then", _RANGE))
    ranges = same.groupBy("rank", "range").agg(F.sum("n").alias("total"))
    ranges = ranges.select("rank", "range", (F.sum("total").over(Window.partitionBy("rank").orderBy("range")) - F.col("total")).alias("before"))
    within = F.sum("n").over(Window.partitionBy("rank", "range").orderBy("then")) - F.col("n")
    same = same.withColumn("within", within).join(ranges, ["rank", "range"])
    same = same.select("rank", "then", (F.col("rank") + F.col("before") + F.col("within")).alias("deeper"), "first")
    return pairs.join(same, ["rank", "then"]).select(*_DOC, "pos", F.col("deeper").alias("rank"), "first")


def _at(rows: DataFrame, table: DataFrame, place: Column, columns: dict[str, str]) -> DataFrame:
    """``rows`` with ``columns`` (new name to old) of the position ``place`` of their documents, null if it isn't in ``table``."""
    there = table.select(F.col("id").alias("_i"), F.col("print").alias("_p"), F.col("pos").alias("_pos"), *[F.col(old).alias(new) for new, old in columns.items()])
    on = F.col("id").eqNullSafe(F.col("_i")) & (F.col("print") == F.col("_p")) & (place == F.col("_pos"))
    return rows.join(there, on, "left").drop("_i", "_p", "_pos")


def _levels(lines: DataFrame) -> list[DataFrame]:
    """Ranks by 1, 2, 4, ... lines of all positions that share them."""
    levels = [saved(_first_ranks(lines))]
    while True:
        deeper = saved(_doubled(levels[-1], 1 << (len(levels) - 1)))
        if deeper.isEmpty():
            return levels
        levels.append(deeper)


def _members(levels: list[DataFrame], k: int) -> DataFrame:
    """(id, print, pos, first, length): the positions of the intervals of 2^k lines that are alone or the earliest in those of twice as many."""
    rows = levels[k].select(*_DOC, "pos", "first", F.lit(1 << k).alias("length"))
    if k + 1 == len(levels):
        return rows
    rows = _at(rows, levels[k + 1], F.col("pos"), {"deeper": "first"})
    return rows.where(F.col("deeper").isNull() | (F.col("deeper") == _me())).drop("deeper")


def _halved(rows: DataFrame, ranked: DataFrame, more: int) -> DataFrame:
    """The intervals in ``rows`` parted by their next ``more`` lines: the parts of two or more, and the earliest of all parts."""
    rows = _at(rows, ranked, F.col("pos") + F.col("length"), {"next": "rank"})
    parts = rows.where("next is not null").groupBy("first", "length", "next").agg(F.count("*").alias("n"), F.min(_me()).alias("earliest"))
    out = rows.join(parts.where("n > 1"), ["first", "length", "next"], "left")
    inner = F.when(F.col("n").isNotNull(), F.struct(F.col("earliest").alias("first"), (F.col("length") + more).alias("length")))
    outer = F.when(F.col("n").isNull() | (F.col("earliest") == _me()), F.struct("first", "length"))
    out = out.select(*_DOC, "pos", F.explode(F.array_compact(F.array(inner, outer))).alias("part"))
    return out.select(*_DOC, "pos", "part.first", "part.length")


def _runs(levels: list[DataFrame]) -> DataFrame:
    """(id, print, at, to, chars, first): the maximal runs of lines that occur from an earlier position on, which ``first`` is an example of."""
    rows = None
    for k in range(len(levels) - 1, -1, -1):
        if rows is not None:
            rows = saved(_halved(rows, levels[k], 1 << k))
        rows = _members(levels, k) if rows is None else rows.unionByName(_members(levels, k))
    runs = saved(rows.where(F.col("first") < _me()))
    by_doc = Window.partitionBy(*_DOC).orderBy("pos")
    end = F.col("pos") + F.col("length")
    runs = runs.withColumn("within", F.coalesce(F.lag(end).over(by_doc), F.lit(-1)) >= end).where("not within")
    upto = saved(levels[0].select(*_DOC, "pos", "chars", F.sum("chars").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)).alias("upto")))
    runs = _at(_at(runs, upto, F.col("pos"), {"from": "upto", "one": "chars"}), upto, end - 1, {"upto": "upto"})
    return runs.select(*_DOC, F.col("pos").alias("at"), (end - 1).alias("to"), (F.col("upto") - F.col("from") + F.col("one")).alias("chars"), "first")


def _folded(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(lines, copies): the lines of each text where it stands first, and the other documents of equal texts, with their size."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    whole = F.unhex(F.md5("text")).alias("whole")
    n_lines = F.length("text") - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    keys = saved(rows.select("id", F.xxhash64("text").alias("print"), whole, n_lines.alias("n_lines"), (F.length("text") - n_lines + 1).alias("chars")))
    groups = keys.groupBy("whole", "id").agg(F.count("*").alias("n")).groupBy("whole").agg(F.sum("n").alias("all"), F.min(F.struct("id", "n")).alias("head"))
    groups = saved(groups.where("all > 1").select("whole", F.col("head.id").alias("head"), F.col("head.n").alias("n_heads")))
    copies = join_checked(keys, groups, "whole", "inner").where(~F.col("id").eqNullSafe(F.col("head"))).select(*_DOC, "n_lines", "chars").distinct()

    def exploded(part: DataFrame) -> DataFrame:
        part = part.select("id", F.xxhash64("text").alias("print"), F.posexplode(_lines(text)).alias("pos", "line"))
        return part.select(*_DOC, "pos", F.xxhash64("line").alias("l1"), F.hash("line").alias("l2"), F.length("line").alias("chars"))

    dealt = join_checked(rows.select("id", "text", whole), groups, "whole", "left").where(F.col("n_heads").isNull() | F.col("id").eqNullSafe(F.col("head")))
    lines = exploded(dealt.where("coalesce(n_heads, 1) = 1"))
    if not groups.where("n_heads > 1").isEmpty():  # repeated rows of an id and text
        lines = lines.unionByName(exploded(dealt.where("n_heads > 1")).distinct())
    return saved(lines), copies


def _merged(runs: DataFrame) -> DataFrame:
    """Places ``at`` to ``to`` of documents, those that overlap as one."""
    by_doc = Window.partitionBy(*_DOC).orderBy("at", "to")
    before = F.max("to").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(*_DOC, "at", "to", F.when(F.col("at") <= before, 0).otherwise(1).alias("fresh"))
    runs = runs.withColumn("run", F.sum("fresh").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*_DOC, "run").agg(F.min("at").alias("at"), F.max("to").alias("to")).drop("run")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print, at, to, chars, first): every maximal run of lines that occurred earlier, in order of id, hash of text and place.

    Only one document of each text takes part, the first one. ``first`` is a struct (id, print, pos) of an earlier place
    where the run begins, too; ``at`` and ``to`` count from 0, and ``chars`` are those of the run's lines.
    """
    lines, _ = _folded(docs, id_col, text_col)
    return _runs(_levels(lines))


def later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS, long_line: int = LONG_LINE) -> DataFrame:
    """(id, print, runs, n_gone, long_only): for each document with lines to delete, the runs of them (at, to).

    Of a document whose text stood earlier there are no runs: all lines go, or, where ``long_only``, those of ``long_line``.
    """
    lines, copies = _folded(docs, id_col, text_col)
    levels = _levels(lines)
    later = _runs(levels).where((F.col("to") - F.col("at") + 1 >= min_lines) & (F.col("chars") >= min_chars)).select(*_DOC, "at", "to")
    one = levels[0].where((F.col("chars") >= long_line) & (F.col("first") < _me())).select(*_DOC, F.col("pos").alias("at"), F.col("pos").alias("to"))
    found = _merged(later.unionByName(one)).groupBy(*_DOC).agg(F.collect_list(F.struct("at", "to")).alias("runs"), F.sum(F.col("to") - F.col("at") + 1).alias("n_gone")).withColumn("long_only", F.lit(False))
    whole = (F.col("n_lines") >= min_lines) & (F.col("chars") >= min_chars)
    copies = copies.where(whole | (F.col("chars") >= long_line)).select(*_DOC, F.lit(None).cast(found.schema["runs"].dataType).alias("runs"), F.col("n_lines").cast("long").alias("n_gone"), (~whole).alias("long_only"))
    return found.unionByName(copies)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS, long_line: int = LONG_LINE) -> DataFrame:
    """``docs`` with ``text_col`` cleaned, and n_lines and n_deleted (long).

    Deleted are the lines of every run of ``min_lines`` or more lines, with ``min_chars`` characters or more together, that
    occurred earlier, in order of id and place, and single lines of ``long_line`` characters that did. A text all of whose
    lines go is empty.

    - A null text stays null, with 0 lines; an empty text has one empty line. Null ids are rows like others, and first.
    - Rows of equal id and text are one document: they keep and lose the same lines. Other rows of one id are ordered
      by the hash of their texts. Very long texts are taken whole; an empty table gives an empty result.
    - Columns of ``docs`` named n_lines or n_deleted give way to the new ones; others stay, whatever their names.
    """
    found = saved(later_copies(docs, id_col, text_col, min_lines, min_chars, long_line))
    rows, names = masked(docs)
    text = F.col(names[text_col])
    joined = join_checked(rows, found, F.col(names[id_col]).eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("print")), "left")
    rest = F.filter(_lines(text), lambda line, i: ~F.exists("runs", lambda r: i.between(r["at"], r["to"])))
    rest = F.when(F.col("runs").isNotNull(), rest).when(F.col("long_only"), F.filter(_lines(text), lambda line: F.length(line) < long_line)).otherwise(F.array().cast("array<string>"))
    n_lines = F.when(text.isNull(), F.lit(0)).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    gone = F.when(F.col("long_only"), n_lines - F.size(rest)).otherwise(F.coalesce("n_gone", F.lit(0))).cast("long")
    cleaned = F.when(F.col("long_only").isNull(), text).otherwise(F.array_join(rest, "\n"))
    columns = [cleaned.alias(m) if m == names[text_col] else F.col(m) for m in names.values()]
    out = joined.select(*columns, n_lines.alias("n_lines"), gone.alias("n_deleted"))
    return out.select(unmasked(names, {"n_lines": F.col("n_lines"), "n_deleted": F.col("n_deleted")}))
