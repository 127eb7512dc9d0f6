"""Mixing of sources to target weights by Efraimidis-Spirakis sampling.

A source's target is its share of the mix by weight, capped at a multiple of its size. Complete epochs come first; the
rest of the target is filled by weighted sampling without replacement: documents in order of exponential keys divided
by a quality weight, up to the budget. A document longer than what is left is passed over and the sum goes on behind it,
in rounds, until none fits. Keys come from hashes of the rows, so that reruns agree; equal rows are numbered, so that each
has a key of its own. Prefix sums go by way of buckets of keys, so no source is one task's, and what decides a row is its
source's list of cuts: in each round, the last key within the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import buckets_for, join_checked, masked, saved, unmasked

#: Weights of the sources in order of code point, null last, repeating.
WEIGHTS = (3.0, 1.0, 2.0)


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: str) -> Column:
    """1 for plain prose down to 0.05, by the share of symbols among words."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>!]")), F.lit(0))
    return F.greatest(F.lit(0.05), 1 - F.least(F.lit(1.0), symbols / F.greatest(n_words(text), F.lit(1))))


def numbered_copies(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``rows`` with ``_copy``: numbers from 0 for the rows that are equal in ``keys``, by buckets, so a group isn't one task's."""
    groups = saved(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1"))
    if groups.isEmpty():
        return rows.withColumn("_copy", F.lit(0).cast("long"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_g{k}"))
    found = join_checked(rows, groups.withColumnsRenamed({k: f"_g{k}" for k in keys}), same, "left").drop(*[f"_g{k}" for k in keys])
    alone = found.where("_n is null").withColumn("_copy", F.lit(0).cast("long"))
    # equal rows may change places, so any number of a row's own will do to deal them out
    more = found.where("_n > 1").withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.pmod(F.xxhash64("_row"), F.least(F.lit(buckets), F.ceil(F.col("_n") / 1000))))
    sizes = more.groupBy(*keys, "_part").agg(F.count("*").alias("_size_of"))
    before = sizes.select(*[F.col(k).alias(f"_g{k}") for k in keys], F.col("_part").alias("_gpart"), (F.sum("_size_of").over(Window.partitionBy(*keys).orderBy("_part")) - F.col("_size_of")).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy("_row")) - 1
    more = more.withColumn("_within", within).join(before, same & (F.col("_part") == F.col("_gpart")))
    return alone.unionByName(more.withColumn("_copy", F.col("_before") + F.col("_within")).select(alone.columns)).drop("_n")


def sampling_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, buckets: int, quality_col: str | None = None) -> DataFrame:
    """``docs`` as columns _id, _source, _size, _key besides its own."""
    weight = F.greatest(F.lit(0.001), F.coalesce(F.col(quality_col).cast("double"), F.lit(1.0))) if quality_col else quality_weight(text_col)
    rows = docs.withColumns({"_id": F.col(id_col), "_print": F.md5(text_col), "_source": F.col(source_col), "_size": n_words(text_col), "_weight": weight})
    rows = numbered_copies(rows, ["_id", "_print", "_source"], buckets)
    number = F.when(F.col("_copy") > 0, F.col("_copy"))  # a null adds nothing to the hash
    chance = (F.shiftright(F.xxhash64(F.lit(seed), "_id", "_print", number), 11) + F.lit(float(1 << 52)) + 0.5) / float(1 << 53)
    return rows.withColumn("_key", -F.ln(chance) / F.col("_weight")).drop("_print", "_weight", "_copy")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sizes`` (_source, source_size) with each source's target: least(most * size, level * weight), adding up to share.

    The excess of capped sources is shared out again by weight until none is above its cap. There is one row for each
    source, and only sums of them come to the driver.
    """
    place = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    sizes = saved(sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))))
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("source_size") * most <= F.col("w") * level
        row = sizes.agg(F.coalesce(F.sum(F.when(full, F.col("source_size") * most)), F.lit(0.0)), F.sum(F.when(~full, F.col("w"))), F.count_if(full)).first()
        if row[2] == capped or not row[1]:
            break
        capped, level = row[2], max(level, (share * total - row[0]) / row[1])
    return sizes.select("_source", "source_size", F.least(F.col("source_size") * most, F.col("w") * level).alias("target"))


def _of(source: str) -> Column:
    return F.col("_source").eqNullSafe(F.col(source))


def _taken(mark: Column) -> Column:
    """Whether a row lies within one of its source's rounds."""
    return F.exists("rounds", lambda r: (r["after"].isNull() | (mark > r["after"])) & (mark <= r["upto"]) & (F.col("_size") <= r["most"]))


def cuts(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """For each source of the saved table ``rows`` (_id, _source, _size, _key): source_size, target, epochs, and which rows are taken once more.

    These are the rows of each of ``rounds``, behind ``after``, up to ``upto`` and of at most ``most`` words, and a last
    one, ``extra``, if it brings the sum nearer to the target.
    """
    buckets = buckets_for(rows.count(), rows.sparkSession)
    rows = rows.withColumn("bucket", F.floor((1 - F.exp(-F.col("_key"))) * buckets)).withColumn("mark", F.struct("_key", "_id", "_size"))
    sources = targets(rows.groupBy("_source").agg(F.sum("_size").alias("source_size")), weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    sources = sources.withColumnRenamed("_source", "_from").withColumn("epochs", epochs).withColumn("gap", F.col("target") - F.col("epochs") * F.col("source_size"))
    kind = rows.schema["mark"].dataType.simpleString()
    sources = saved(sources.withColumn("rounds", F.array().cast(f"array<struct<after:{kind},upto:{kind},most:double>>")).withColumn("last", F.lit(None).cast(kind)))
    while True:
        left = join_checked(rows, sources.select("_from", "gap", "last"), _of("_from"), "inner")
        left = left.where((F.col("_size") > 0) & (F.col("_size") <= F.col("gap")) & (F.col("last").isNull() | (F.col("mark") > F.col("last"))))
        sums = left.groupBy("_source", "bucket").agg(F.sum("_size").alias("sum"))
        before = sums.select(F.col("_source").alias("_s"), F.col("bucket").alias("_b"), (F.sum("sum").over(Window.partitionBy("_source").orderBy("bucket")) - F.col("sum")).alias("before"))
        before = before.join(sources.select("_from", "gap"), F.col("_s").eqNullSafe(F.col("_from"))).where("before < gap").select("_s", "_b", "before")  # the others hold nothing within the budget
        reached = F.sum("_size").over(Window.partitionBy("_source", "bucket").orderBy("mark").rowsBetween(Window.unboundedPreceding, 0))
        inside = left.select("_source", "bucket", "mark", "_size", "gap").join(before, _of("_s") & (F.col("bucket") == F.col("_b"))).withColumn("reached", reached).where("before + reached <= gap")
        found = saved(inside.groupBy(F.col("_source").alias("_s")).agg(F.max("mark").alias("upto"), F.sum("_size").alias("got")))
        if found.isEmpty():
            break
        sources = sources.join(found, F.col("_from").eqNullSafe(F.col("_s")), "left")
        one = F.struct(F.col("last").alias("after"), "upto", F.col("gap").alias("most"))
        sources = saved(sources.select("_from", "source_size", "target", "epochs", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap"), F.when(F.col("upto").isNull(), F.col("rounds")).otherwise(F.array_append("rounds", one)).alias("rounds"), F.coalesce("upto", "last").alias("last")))
    # no row is left that fits; one more is taken if that is nearer to the target
    near = join_checked(rows, sources.select("_from", "gap", "rounds"), _of("_from"), "inner").where((F.col("_size") > 0) & (F.col("_size") < 2 * F.col("gap")) & ~_taken(F.col("mark")))
    extra = near.groupBy(F.col("_source").alias("_s")).agg(F.min(F.struct("_size", "mark"))["mark"].alias("extra"))
    return saved(sources.join(extra, F.col("_from").eqNullSafe(F.col("_s")), "left").select("_from", "source_size", "target", "epochs", "rounds", "extra"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 17, quality_col: str | None = None) -> DataFrame:
    """``docs`` with size (words), source_size, target, and copies: how often the mix takes the row.

    Rows of higher quality are likelier to be taken in the last, incomplete epoch: ``quality_col`` holds their weights (a
    classifier's score, say; null counts as 1), or else these are quality_weight of the text.

    - Null, empty and wordless texts have size 0, add nothing and are taken in complete epochs alone. A null source is a
      source, the last one.
    - Equal rows (id, text and source) are numbered, and each is taken or not on its own; which of them is which is open.
    - Documents are taken whole: a source's sum misses its target by half of its shortest document not taken at most.
    - Very long texts count whole; an empty table gives an empty result. Columns of ``docs`` with the names of the new
      ones give way to them; others stay, whatever their names.
    """
    docs, names = masked(docs)
    buckets = buckets_for(0, docs.sparkSession)
    rows = sampling_rows(docs, names[id_col], names[text_col], names[source_col], seed, buckets, names[quality_col] if quality_col else None)
    plan = cuts(saved(rows.select("_id", "_source", "_size", "_key")), weights, share, most)
    out = join_checked(rows, plan, _of("_from"), "inner")
    mark = F.struct("_key", "_id", "_size")
    once = _taken(mark) | F.coalesce(mark == F.col("extra"), F.lit(False))
    return out.select(unmasked(names, {"size": F.col("_size"), "source_size": F.col("source_size"), "target": F.col("target"), "copies": F.col("epochs") + once.cast("long")}))
