"""Sentence-level operators: I4 split, E2 flatten/regroup, D10/J3 glossary
translation and I14 extractive summary."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as tx
from . import automaton, entities
from .common import BROADCAST_BYTES, attach_row, join_terms


def split_sentences(df: DataFrame, text_col: str = "text", out_col: str = "split_text") -> DataFrame:
    """C5 + I4: drop rows whose text is null, add the sentence list."""
    return df.where(F.col(text_col).isNotNull()).withColumn(out_col, tx.split_sentences_expr(text_col))


def explode_list(df: DataFrame, list_col: str, id_col: str = "article_id",
                 pos_col: str = "pos", item_col: str = "item") -> DataFrame:
    """Flatten: one row per element, remembering the position.  Rows with an
    empty or null list keep one row with a null position so that regrouping
    gives them back as empty lists."""
    return df.select(id_col, F.posexplode_outer(list_col).alias(pos_col, item_col))


def regroup_list(flat: DataFrame, id_col: str = "article_id", pos_col: str = "pos",
                 item_col: str = "item", out_col: str = "items") -> DataFrame:
    """Regroup in position order; a group whose only row has a null position
    becomes an empty list.  A group is one source row, so its size is
    bounded by that row."""
    packed = F.sort_array(F.collect_list(F.when(F.col(pos_col).isNotNull(),
                                                F.struct(pos_col, item_col))))
    return flat.groupBy(id_col).agg(F.transform(packed, lambda s: s[item_col]).alias(out_col))


def map_list(df: DataFrame, list_col: str, fn: Callable[[Column], Column], out_col: str,
             id_col: str = "article_id", exploded: bool = False) -> DataFrame:
    """Apply ``fn`` to every element of a list column.

    With ``exploded=False`` (default) the map is an in-row ``transform``: no
    shuffle, works for any column expression.  ``exploded=True`` flattens,
    maps and regroups (the reference's flatten-batch-rebuild); use it when
    ``fn`` is a pandas UDF that wants dense batches across rows.
    """
    if not exploded:
        return df.withColumn(out_col, F.transform(list_col, fn))
    flat = explode_list(df, list_col, id_col)
    mapped = flat.withColumn("item", F.when(F.col("pos").isNotNull(), fn(F.col("item"))))
    back = regroup_list(mapped, id_col, out_col=out_col)
    return df.join(back, id_col, "left")


def glossary_map(df: DataFrame, glossary, list_col: str = "split_text",
                 out_col: str = "translated_text", src: str = "src", dst: str = "dst",
                 id_col: str = "article_id", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Translate each sentence through a glossary.

    Tokens are the sentence split on single spaces; a run of tokens whose
    lower-case form is in the glossary (the longest at a place, left to right)
    is replaced, others are kept.  ``glossary`` is a DataFrame ``(src, dst)`` of
    any size, or a Python dict of fixed values; a source may be several words,
    and one with several targets has the first of them.

    A glossary of at most ``max_bytes`` (counted) goes to the workers as an
    automaton, which reads each sentence once, in its row: no shuffle.  A larger
    one is joined with the sentences' token runs, and the matches (bounded by a
    sentence) are put back into their article.
    """
    if isinstance(glossary, dict):
        rows = list(glossary.items())
    else:
        g = glossary.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where(
            "src is not null and dst is not null")
        rows = automaton.small_rows(g, max_bytes)
    if rows is not None:
        values = dict(sorted(rows, reverse=True))        # the first target wins
        return df.withColumn(out_col, automaton.translated(list_col, values))

    flat = df.select(id_col, F.posexplode(list_col).alias("spos", "s"))
    lows = flat.select(F.struct(id_col, "spos").alias("at"),
                       F.array_join(F.transform(F.split("s", " "), lambda t: F.lower(t)), " ").alias("text"))
    found = entities.gazetteer_mentions(lows, g.select(F.col("src").alias("phrase"), F.col("dst").alias("entity_group")),
                                        "text", "at", max_bytes=max_bytes)
    runs = found.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("pos", "word", "entity_group"))).alias("runs"))
    runs = runs.select(F.col(f"at.{id_col}").alias(id_col), F.col("at.spos").alias("spos"), "runs")

    # tokens before, values and tokens between, tokens behind
    toks = F.split(F.coalesce("s", F.lit("")), " ")
    size = lambda r: F.size(F.split(r["word"], " "))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    walked = F.aggregate("runs", start, lambda acc, r: F.struct(
        (r["pos"] + size(r)).cast("int").alias("at"),
        F.concat(acc["out"], F.slice(toks, acc["at"] + 1, r["pos"] - acc["at"]), F.array(r["entity_group"])).alias("out")))
    item = F.array_join(F.concat(walked["out"], F.slice(toks, walked["at"] + 1, F.size(toks))), " ")
    sent = flat.join(runs, [id_col, "spos"], "left").select(
        id_col, F.col("spos").alias("pos"), F.when(F.col("runs").isNull(), F.coalesce("s", F.lit(""))).otherwise(item)
        .alias("item"))
    back = regroup_list(sent, id_col, out_col=out_col)
    return df.join(back, id_col, "left").withColumn(
        out_col, F.coalesce(out_col, F.array().cast("array<string>")))


def translate(df: DataFrame, fn: Callable[[Column], Column], mode: int = 1) -> DataFrame:
    """Translation modes.

    1 = each sentence of ``split_text`` -> ``translated_text`` list;
    0 = ``summarized_text`` -> ``translated_summary``;
    2 = ``text`` -> ``translated_summary``.  ``fn`` maps a string column.
    """
    if mode == 1:
        return map_list(df, "split_text", fn, "translated_text")
    if mode == 0:
        return df.withColumn("translated_summary", fn(F.col("summarized_text")))
    if mode == 2:
        return df.withColumn("translated_summary", fn(F.col("text")))
    raise ValueError(f"unknown translate mode {mode!r}; use 0, 1 or 2")


def sentence_table(df: DataFrame, list_col: str = "split_text", id_col: str = "article_id") -> DataFrame:
    """Exploded sentences ``(article_id, pos, sentence)``, positions 0-based."""
    return df.select(id_col, F.posexplode(list_col).alias("pos", "sentence"))


def extractive_summary(df: DataFrame, k: int = 3, min_words: int = 10, max_words: int = 250,
                       list_col: str = "split_text", id_col: str = "article_id",
                       out_col: str = "summarized_text") -> DataFrame:
    """Extractive summary by average IDF of a sentence's word tokens.

    * idf(term) = ln(N / df) over the articles of ``df``;
    * a sentence's score is the mean idf of its tokens, rounded to 6 places
      (ties -> earlier sentence);
    * sentences are taken in rank order: rank ≤ k, or when fewer than
      ``min_words`` words rank above it; a sentence is dropped
      when it and all better-ranked sentences pass ``max_words`` words
      (the best one is always kept);
    * the kept sentences are joined with one space in text order.

    Articles without sentences get an empty summary.  The idf of a term (at
    least of a frequent one) goes to the tokens, see ``join_terms``; what is
    dealt is a partial mean of each sentence, not its tokens.
    """
    sents = sentence_table(df, list_col, id_col)
    toks = sents.select(id_col, "pos", F.explode(tx.word_tokens("sentence")).alias("term"))
    n_docs = df.agg(F.count_distinct(id_col).cast("double").alias("n_docs"))
    # document frequency from each article's distinct tokens (an in-row
    # array_distinct; the count is combined map-side), no (article, term)
    # distinct shuffle
    art_terms = df.select(F.explode(F.array_distinct(F.flatten(
        F.transform(list_col, lambda s: tx.word_tokens(s))))).alias("term"))
    dfreq = art_terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = attach_row(dfreq, n_docs).select("term", F.log(F.col("n_docs") / F.col("df")).alias("idf"), "df")
    scored = (join_terms(toks, idf, "term", "df")
              .groupBy(id_col, "pos")
              .agg(F.round(F.avg("idf"), 6).alias("score")))
    words = sents.select(id_col, "pos", "sentence",
                         F.size(F.split(F.regexp_replace("sentence", "^[ \t\n\r\f]+", ""),
                                        "[ \t\n\r\f]+")).alias("nw"))
    s = words.join(scored, [id_col, "pos"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    w = W.partitionBy(id_col).orderBy(F.desc("score"), "pos")
    s = s.withColumn("rank", F.row_number().over(w)) \
        .withColumn("before", F.coalesce(F.sum("nw").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    keep = ((F.col("rank") <= k) | (F.col("before") < min_words)) & \
        ((F.col("rank") == 1) | (F.col("before") + F.col("nw") <= max_words))
    summ = (s.where(keep).groupBy(id_col)
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "sentence"))),
                                          lambda x: x["sentence"]), " ").alias(out_col)))
    return df.join(summ, id_col, "left").withColumn(out_col, F.coalesce(out_col, F.lit("")))
