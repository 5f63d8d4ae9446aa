"""Connected components by alternating large-star / small-star.

Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii, "Connected Components
in MapReduce and Beyond", SoCC 2014.  Each round is two group-bys and two
joins over the edge list; the edge set is checkpointed (reliable
checkpoint into ``spark.checkpoint.dir``) every round, so lineage stays
short and a lost executor recomputes at most one round.  A component ends
as a star centred on its smallest node id, which becomes the label.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize


def _both(e: DataFrame) -> DataFrame:
    return e.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
        e.select(F.col("v").alias("a"), F.col("u").alias("b")))


def _norm(df: DataFrame, x: str, y: str) -> DataFrame:
    return (df.select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v"))
            .where(F.col("u") != F.col("v")).distinct())


def _large_star(e: DataFrame) -> DataFrame:
    d = _both(e)
    m = d.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _norm(d.join(m, "a").where(F.col("b") > F.col("a")), "b", "m")


def _small_star(e: DataFrame) -> DataFrame:
    d = _both(e).where(F.col("b") < F.col("a"))
    m = d.groupBy("a").agg(F.min("b").alias("m"))
    j = d.join(m, "a")
    return _norm(j.select(F.col("b").alias("x"), F.col("m").alias("y"))
                 .unionByName(j.select(F.col("a").alias("x"), F.col("m").alias("y"))), "x", "y")


def connected_components(edges: DataFrame, nodes: DataFrame | None = None,
                         src: str = "src", dst: str = "dst", node: str = "node") -> DataFrame:
    """Label every node with the smallest node id of its component.

    ``edges``: undirected (src, dst) long ids.  ``nodes``: optional table
    with column ``node`` so that isolated nodes are labelled too.
    Returns ``(node, component)``.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = materialize(_norm(edges, src, dst))
    n_old = e.count()
    while True:
        # persisted, then checkpointed: the round is computed once
        new = materialize(_small_star(_large_star(e)))
        n_new = new.count()
        if n_new == n_old and new.join(e, ["u", "v"], "left_anti").isEmpty():
            e = new
            break
        e, n_old = new, n_new
    d = _both(e)
    labels = d.groupBy(F.col("a").alias(node)).agg(F.least(F.min("b"), F.col("a")).alias("component"))
    if nodes is not None:
        labels = (nodes.select(node).distinct().join(labels, node, "left")
                  .select(node, F.coalesce("component", node).alias("component")))
    return labels
