"""F8 cluster representative, I9 span rewrite, J4 coreference resolution.

Spans come from a coreference model as a table ``(article_id, cluster_id,
start, end, string)`` with 0-based ``[start, end)`` character offsets."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def cluster_representative(spans: DataFrame, id_col: str = "article_id") -> DataFrame:
    """F8: per (article, cluster): among the distinct strings that start with
    an upper-case ASCII letter, the longest (ties: smallest string), with a
    trailing "'s" removed; clusters without one get a null ``rep``."""
    keys = [id_col, "cluster_id"]
    d = spans.select(*keys, "string").distinct()
    cand = d.where(F.col("string").rlike("^[A-Z]"))
    w = W.partitionBy(*keys).orderBy(F.desc(F.length("string")), "string")
    best = (cand.withColumn("_r", F.row_number().over(w)).where("_r = 1")
            .select(*keys, F.regexp_replace("string", "'s$", "").alias("rep")))
    return d.select(*keys).distinct().join(best, keys, "left")


def outermost_spans(spans: DataFrame, id_col: str = "article_id") -> DataFrame:
    """One row per article with a usable span: ``spans``, those that are
    applied in start order, and ``nested_spans``, whether some were left out.

    Spans are read by start, the longer first, then by ``rep``; one that begins
    before the end of the last applied span is left out.  So of nested spans
    the outermost counts, of spans that overlap the earlier one, and no
    character is rewritten twice.  Spans without bounds, text or ``rep`` are no
    spans; repeated rows count once.

    Spans are first cut into islands that share no character (a running
    maximum of the ends), so that the choice runs over a few spans."""
    sp = spans.select(id_col, "start", "end", "rep").where("rep IS NOT NULL AND start >= 0 AND end > start")
    order = W.partitionBy(id_col).orderBy("start", F.desc("end"), "rep")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    new = F.coalesce(F.col("start") >= F.max("end").over(before), F.lit(True))
    sp = sp.withColumn("_new", new.cast("int"))
    sp = sp.withColumn("_island", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    island = sp.groupBy(id_col, "_island").agg(F.array_distinct(F.sort_array(F.collect_list(F.struct(
        "start", (-F.col("end")).alias("neg"), "end", "rep")))).alias("_a"))
    item = F.transform("_a", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rep"].alias("rep")))
    kept = F.aggregate(item, F.slice(item, 1, 1), lambda acc, s: F.when(
        s["start"] >= F.element_at(acc, -1)["end"], F.concat(acc, F.array(s))).otherwise(acc))
    chosen = island.select(id_col, kept.alias("_k"), F.size("_a").alias("_n"))
    return chosen.groupBy(id_col).agg(
        F.sort_array(F.flatten(F.collect_list("_k"))).alias("spans"),
        F.max(F.size("_k") < F.col("_n")).alias("nested_spans"))


def rewrite_spans(df: DataFrame, spans: DataFrame, text_col: str = "text",
                  id_col: str = "article_id", out_col: str = "resolved_text") -> DataFrame:
    """Replace spans ``[start, end)`` of the text by their ``rep``.

    ``spans(article_id, start, end, rep)``; of nested and overlapping spans
    ``outermost_spans`` chooses, ``nested_spans`` says that it left some out, and
    the text is kept in every case.  Rows without spans keep their text; a null
    text stays null.  The spans of one article are gathered into one array
    (bounded by that article's text) and the output is assembled in-row."""
    packed = outermost_spans(spans, id_col).select(id_col, F.col("spans").alias("_sp"),
                                                   F.col("nested_spans").alias("_nested"))
    j = df.join(packed, id_col, "left")
    sp = F.col("_sp")
    pieces = F.transform(sp, lambda s, i: F.concat(
        F.substring(F.col(text_col), F.coalesce(F.get(sp, i - 1)["end"], F.lit(0)) + 1,
                    s["start"] - F.coalesce(F.get(sp, i - 1)["end"], F.lit(0))), s["rep"]))
    tail = F.substring(F.col(text_col), F.element_at(sp, -1)["end"] + 1, 1 << 30)
    return (j.withColumn(out_col, F.when(sp.isNull(), F.col(text_col))
                         .otherwise(F.concat(F.array_join(pieces, ""), tail)))
            .withColumn("nested_spans", F.coalesce("_nested", F.lit(False))).drop("_sp", "_nested"))


def resolve_coref(df: DataFrame, spans: DataFrame, text_col: str = "text",
                  id_col: str = "article_id", out_col: str = "resolved_text") -> DataFrame:
    """Representatives per cluster, then rewrite every span of a cluster
    that has one."""
    reps = cluster_representative(spans, id_col).where(F.col("rep").isNotNull())
    sp = spans.join(reps, [id_col, "cluster_id"]).select(id_col, "start", "end", "rep")
    return rewrite_spans(df, sp, text_col, id_col, out_col)
