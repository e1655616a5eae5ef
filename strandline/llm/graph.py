"""Connected components by alternating large-star and small-star steps.

Links are rewritten as (vertex, smaller neighbour) pairs until nothing changes;
each round is two aggregations with map-side combining and two joins, and a
round's links are written to shared storage, so no vertex list ever reaches the
driver and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize_at, remove


def _star(edges: DataFrame, large: bool) -> tuple[DataFrame, str]:
    """edges (u, v), both directions for large, only v < u for small; the result, written, and its folder."""
    low, folder = materialize_at(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
    linked = edges.join(low, "u")  # two bare shuffles: a vertex with very many links is one that Spark can split
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # the least neighbour too: u itself goes to it
        out = linked.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    done = materialize_at(out.where("u != v").distinct(), "cc-star")
    remove(edges.sparkSession, folder)
    return done


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """links (u long, v long) -> (id long, label long): label is the least id reachable.

    Rows with a null end, self links and repeated links are ignored; ids without
    a link are absent; an empty table gives an empty result.
    """
    edges = links.where("u IS NOT NULL AND v IS NOT NULL AND u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    spark = links.sparkSession
    edges, folder = materialize_at(edges, "cc-links")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        middle, between = _star(both, True)
        edges, new = _star(middle, False)
        for done in (folder, between):
            remove(spark, done)  # all that comes reads the new round
        folder = new
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(roots)
