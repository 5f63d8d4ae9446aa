"""Same-day duplicate removal: F1 title dedup, F2 keep-first, E4 cluster
report and the J2 composition ``erase_similar``."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .similarity import dense_links, similar_text_pairs


def dedup_title_keep_last(df: DataFrame, id_col: str = "article_id", day_col: str = "datetime",
                          title_col: str = "title") -> DataFrame:
    """within a day, an article is dropped when a later article (larger
    id) has the same title; null titles are equal to each other.

    The winner per (day, title) is a ``max`` aggregation (combined map-side,
    so a title shared by a third of the rows is no hot task), then the rows
    are kept by a semi-join on the unique id.
    """
    winners = df.groupBy(day_col, title_col).agg(F.max(id_col).alias(id_col))
    return df.join(winners.select(id_col), id_col, "left_semi")


def component_labels(df: DataFrame, eps: float = 0.35, text_col: str = "text",
                     id_col: str = "article_id", day_col: str = "datetime",
                     k: int = 3) -> DataFrame:
    """E3 over D7: ``(id, cluster_id)`` for every row of ``df``.

    The cluster id is the smallest id of the connected component of the
    eps-graph (DBSCAN with min_samples=1 is exactly this).  Rows whose text
    has no words are singletons.
    """
    edges, copies, nodes = similar_text_pairs(df, eps, text_col, id_col, day_col, k)
    comp = connected_components(edges, nodes, src="id_a", dst="id_b")
    rep_lab = comp.select(F.col("node").alias("id"), F.col("component").alias("cluster_id"))
    copy_lab = copies.join(rep_lab.withColumnRenamed("id", "rep"), "rep").select("id", "cluster_id")
    lab = rep_lab.unionByName(copy_lab)
    return (df.select(F.col(id_col).alias("id")).join(lab, "id", "left")
            .select("id", F.coalesce("cluster_id", "id").alias("cluster_id")))


def dense_component_labels(vectors: DataFrame, eps: float, id_col: str = "article_id",
                           day_col: str = "datetime", vec_col: str = "vec") -> DataFrame:
    """E3 over dense D7: ``(id, cluster_id)`` for every vector, from spanning
    links of each pair of blocks; the pairs themselves are never rows."""
    links = dense_links(vectors, eps, id_col, day_col, vec_col)
    nodes = vectors.select(F.col(id_col).alias("node"))
    comp = connected_components(links, nodes, src="id", dst="to")
    return comp.select(F.col("node").alias("id"), F.col("component").alias("cluster_id"))


def keep_first(df: DataFrame, labels: DataFrame, id_col: str = "article_id") -> DataFrame:
    """keep the first (smallest id) row of each cluster."""
    firsts = labels.where(F.col("id") == F.col("cluster_id")).select(F.col("id").alias(id_col))
    return df.join(firsts, id_col, "left_semi")


def cluster_report(df: DataFrame, labels: DataFrame, id_col: str = "article_id",
                   title_col: str = "title", original_col: str = "original_index") -> DataFrame:
    """E4 in long form: one row per member of a cluster that has others.

    ``(cluster_id, article_id, is_representative, original_index, title,
    n_members)``.  The representative is the first member.  The report is
    kept long (no per-cluster list), so a cluster of any size stays spread
    over tasks.
    """
    sizes = labels.groupBy("cluster_id").agg(F.count("*").alias("n_members")).where("n_members > 1")
    m = labels.join(sizes, "cluster_id").withColumnRenamed("id", id_col)
    cols = [c for c in (original_col, title_col) if c in df.columns]
    return (m.join(df.select(id_col, *cols), id_col)
            .select("cluster_id", id_col, (F.col(id_col) == F.col("cluster_id")).alias("is_representative"),
                    *cols, "n_members"))


def erase_similar(df: DataFrame, eps: float = 0.35, text_col: str = "text",
                  id_col: str = "article_id", day_col: str = "datetime",
                  title_col: str = "title", k: int = 3) -> DataFrame:
    """Title dedup (keep last), then near-duplicate clusters of the
    survivors within each day, keeping the first of each cluster."""
    f1 = dedup_title_keep_last(df, id_col, day_col, title_col)
    labels = component_labels(f1, eps, text_col, id_col, day_col, k)
    return keep_first(f1, labels, id_col)
