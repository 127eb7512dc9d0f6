"""Which versions of a dataset may follow which: an allow-list of transitions, and what can be reached over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The newest versions, and the transitions between (schema, feature) versions that are allowed. Those that
# coalesce may be taken several at once. From schema 1 to 2 any feature version is kept.
SCHEMA, FEATURE = 11, 6
KEEPING = [(1, f, 2, f) for f in range(1, FEATURE + 1)]
STEPS = [(2, 1, 3, 2), (3, 2, 4, 3), (4, 3, 5, 4), (5, 4, 6, 5), (6, 5, 7, 6)]
COALESCING = [(7, 6, 8, 6), (8, 6, 9, 6), (9, 6, 10, 6), (10, 6, 11, 6)]

_EDGE = "from_schema int, from_feature int, to_schema int, to_feature int, coalesces boolean"


class IncompatibleVersions(ValueError):
    """A copy's versions can't go on to the build's."""


def transitions(spark: SparkSession) -> DataFrame:
    """The allow-list as a table."""
    return spark.createDataFrame([(*t, t in COALESCING) for t in (*KEEPING, *STEPS, *COALESCING)], _EDGE)


def reachable(edges: DataFrame) -> DataFrame:
    """(from_schema, from_feature, to_schema, to_feature, n_steps, at_once): every pair of versions joined by a path over ``edges``.

    ``n_steps`` is the least number of transitions; ``at_once`` says that one sync may do it, over one transition or over
    coalescing ones alone. The edges must have no cycle; the recursion is as deep as their longest path.
    """
    edges.createOrReplaceTempView("_tidemark_transitions")
    return edges.sparkSession.sql(
        """WITH RECURSIVE paths AS (
            SELECT from_schema, from_feature, to_schema, to_feature, 1 AS n_steps, true AS at_once, coalesces FROM _tidemark_transitions
            UNION ALL
            SELECT p.from_schema, p.from_feature, t.to_schema, t.to_feature, n_steps + 1, p.coalesces AND t.coalesces, p.coalesces AND t.coalesces
            FROM paths p JOIN _tidemark_transitions t ON p.to_schema = t.from_schema AND p.to_feature = t.from_feature)
        SELECT from_schema, from_feature, to_schema, to_feature, min(n_steps) AS n_steps, bool_or(at_once) AS at_once FROM paths GROUP BY ALL"""
    )


def version_gate(states: DataFrame, edges: DataFrame) -> DataFrame:
    """``states`` (prior_schema, prior_feature, schema_version, feature_version, ...) with verdict and n_steps.

    ``verdict`` is new where there is no prior state, same, upgrade (allowed at once), stepwise (only over versions between,
    ``n_steps`` of them) or refused. The table of reachable pairs is of the allow-list's size.
    """
    paths = reachable(edges)
    on = (F.col("prior_schema") == F.col("from_schema")) & (F.col("prior_feature") == F.col("from_feature")) & (F.col("schema_version") == F.col("to_schema")) & (F.col("feature_version") == F.col("to_feature"))
    same = (F.col("prior_schema") == F.col("schema_version")) & (F.col("prior_feature") == F.col("feature_version"))
    verdict = F.when(F.col("prior_schema").isNull() | F.col("prior_feature").isNull(), "new").when(same, "same").when(F.col("at_once"), "upgrade").when(F.col("n_steps") > 0, "stepwise").otherwise("refused")
    n_steps = F.when(verdict.isin("new", "same"), 0).otherwise(F.col("n_steps"))
    joined = states.join(F.broadcast(paths), on, "left")
    return joined.select(*states.columns, verdict.alias("verdict"), n_steps.alias("n_steps"))


def require_compatible(states: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """``states`` whose versions may all be synced at once; otherwise IncompatibleVersions, which names the first pair that may not."""
    bad = version_gate(states, transitions(states.sparkSession) if edges is None else edges).where("verdict in ('stepwise', 'refused')").first()
    if bad is not None:
        raise IncompatibleVersions(f"{bad['prior_schema']}/{bad['prior_feature']} to {bad['schema_version']}/{bad['feature_version']}: {bad['verdict']}")
    return states
