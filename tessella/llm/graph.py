"""Connected components of edges that don't fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessella.llm.common import forget, materialize


#: edges up to which the smallest ids around them are broadcast; more are joined
SMALL_EDGES = 1 << 15
#: files that a round of few edges is written to, at most
SMALL_FILES = 8


def _moves(edges: DataFrame) -> tuple[int, bool]:
    """The number of edges, and whether an id has several above it or an end is a centre: something is left to move."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("b"), F.lit(0), F.lit(1)))
    seen = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    found = seen.agg(F.sum("up").alias("n"), F.max(F.expr("up > 1 or (up > 0 and down > 0)")).alias("moves")).first()
    return found["n"] or 0, bool(found["moves"])


def _around(edges: DataFrame) -> DataFrame:
    """``b, m``: the smallest id around each id, its own included."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    return both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))


def _small_round(now: DataFrame) -> DataFrame:
    """Both stars where the smallest ids fit every task: edges stay where they are until the last step."""
    large = now.join(F.broadcast(_around(now)), "b").select("a", F.col("m").alias("b"))
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    ends = F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                             F.struct(F.col("a"), F.col("m").alias("b"))))
    return large.join(F.broadcast(low), "a").select(ends.alias("e")).select("e.*").where("a <> b").distinct().coalesce(SMALL_FILES)


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every id on an edge ``a, b``: the smallest id it can reach.

    Alternates large and small stars (Kiveris et al., 2014): each round hangs every id and its
    neighbours below the smallest of them. Rounds grow with the logarithm of a component's size,
    each is written to the shared folder, and ids are only ever joined and aggregated. With few edges
    the smallest ids are broadcast, which spares four shuffles and three tables a round. Edges from
    an id to itself say nothing; without edges the result is empty.
    """
    now = materialize(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while (left := _moves(now))[1]:
        if left[0] <= SMALL_EDGES:
            made = materialize(_small_round(now), "edges")
            forget(now)
            now = made
            continue
        # written, since a join splits a hot centre only between two scans, not beside an aggregate
        least = materialize(_around(now), "least")
        # large star: neighbours above an id move to the smallest around it
        large = materialize(now.join(least, "b").select("a", F.col("m").alias("b")).distinct(), "large")
        # small star: an id and its smaller neighbours move to the smallest of them
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        made = materialize(small, "edges")
        for used in (now, least, large, low):
            forget(used)
        now = made
    own = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(own)
