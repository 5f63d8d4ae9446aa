"""Relation extraction: D2 entity pairs, D3 candidates, I8 hypotheses, K4
scoring, E5/E6 selection, E10 nested record (J6)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.scoring import score, token_share
from .common import bounded_broadcast
from .ontology import candidate_relations


def entity_pairs(entities: DataFrame, cands: DataFrame, id_col: str = "article_id") -> DataFrame:
    """D2 + D3: ordered pairs (sbj, obj) of an article's entities with
    sbj != obj on (text, type), joined with the relations allowed for their
    types.  Entities meet by article and the candidate table (bounded by the
    ontology) is looked up in the row of the pair, so what is dealt are
    entities: never pairs, and no entity once for each relation of its type.
    Rows: ``(article_id, sbj_idx, sbj_text, sbj_type, obj_idx, obj_text,
    obj_type, prop, prop_ord)``."""
    s = entities.select(id_col, F.col("eidx").alias("sbj_idx"), F.col("text").alias("sbj_text"),
                        F.col("type").alias("sbj_type"), tx.word_tokens("text").alias("sbj_toks"))
    o = entities.select(id_col, F.col("eidx").alias("obj_idx"), F.col("text").alias("obj_text"),
                        F.col("type").alias("obj_type"), tx.word_tokens("text").alias("obj_toks"))
    # a merge join at any size: its rows stay dealt by article, as the premise
    # and the choice of a pair's best relation want them
    return (s.join(o.hint("merge"), id_col)
            .where(~((F.col("sbj_text") == F.col("obj_text")) & (F.col("sbj_type") == F.col("obj_type"))))
            .join(bounded_broadcast(cands), ["sbj_type", "obj_type"]))


def hypotheses(pairs: DataFrame, templates: DataFrame) -> DataFrame:
    """I8: one hypothesis per template of each candidate relation; ``hord``
    orders all hypotheses of a pair (property order, then template order)."""
    # a template whose placeholders touch no letter/digit cannot merge an
    # entity's token with its own: its hypothesis tokens are then the
    # template's tokens plus the entities' (tokenised once per entity)
    glued = "[\\p{L}\\p{N}]\\{(sbj|obj)\\}|\\{(sbj|obj)\\}[\\p{L}\\p{N}]"
    t = bounded_broadcast(templates.select(
        F.col("prop"), F.col("ord").alias("t_ord"), F.col("text").alias("tmpl"),
        (~F.col("text").rlike(glued)).alias("t_safe"),
        tx.word_tokens(F.regexp_replace("text", "\\{(sbj|obj)\\}", " ")).alias("t_toks")))
    return (pairs.join(t, "prop")
            .withColumn("hypothesis", tx.fill_template("tmpl", "sbj_text", "obj_text"))
            .withColumn("hord", F.struct("prop_ord", "t_ord")))


def score_hypotheses(hyp: DataFrame, premises: DataFrame, premise_col: str = "premise",
                     id_col: str = "article_id", scorer=None, **kw) -> DataFrame:
    """K4: ``prob`` = share of hypothesis tokens present in the premise, or
    what ``scorer`` (any K1 form: a Column, a score table, a fitted model, a
    pandas UDF with ``inputs=``) gives for the rows of ``hyp`` with the premise
    attached, e.g. the entailment probability of an NLI model."""
    if scorer is not None:
        p = premises.select(id_col, F.col(premise_col).alias("premise"))
        hyp = hyp.join(p, id_col, "left")
        if isinstance(scorer, DataFrame) and id_col in (kw.get("keys") or []):
            scored = _table_scores(hyp, scorer, kw["keys"], id_col)
        else:
            scored = score(hyp, scorer, "prob", **kw)
        return scored.drop("premise", "tmpl", "t_safe", "t_toks", "sbj_toks", "obj_toks")
    p = premises.select(id_col, F.array_distinct(tx.word_tokens(premise_col)).alias("_pt"))
    pt = F.coalesce("_pt", F.array().cast("array<string>"))
    h = F.array_distinct(F.concat("t_toks", "sbj_toks", "obj_toks"))
    fast = F.when(F.size(h) > 0, F.size(F.array_intersect(h, pt)) / F.size(h)).otherwise(F.lit(0.0))
    # the string path is inlined (not the ``hypothesis`` column) so that a
    # query that never selects the hypothesis text does not build it
    slow = token_share(tx.fill_template("tmpl", "sbj_text", "obj_text"), pt)
    prob = F.when(F.col("t_safe"), fast).otherwise(slow)
    return (hyp.join(p, id_col, "left").withColumn("prob", prob)
            .drop("_pt", "tmpl", "t_safe", "t_toks", "sbj_toks", "obj_toks"))


def _table_scores(hyp: DataFrame, table: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """K1 by a score table that has the article among its keys: the scores of
    an article meet its hypotheses by article alone, as the premise does, and
    the other keys are compared in the row, so no hypothesis is dealt anew."""
    others = [k for k in keys if k != id_col]
    lists = table.groupBy(id_col).agg(F.collect_list(F.struct(*others, F.struct("prob").alias("v"))).alias("_s"))
    mine = F.filter("_s", lambda x: F.forall(F.array(*(x[k] == F.col(k) for k in others)), lambda same: same)
                    if others else F.lit(True))
    j = hyp.join(lists, id_col, "left")
    return j.select(*hyp.columns, F.explode_outer(mine).alias("_m")).select(*hyp.columns, F.col("_m.v.prob").alias("prob"))


_PAIR = ["article_id", "sbj_idx", "sbj_text", "sbj_type", "obj_idx", "obj_text", "obj_type"]
_KEY = ["article_id", "sbj_idx", "obj_idx"]


def best_relation(scored: DataFrame, threshold: float = 0.78) -> DataFrame:
    """E5: per ordered pair, the hypothesis with the highest probability
    (ties: lowest ``hord``); a triplet iff that probability > threshold.

    Two hash aggregates with map-side combine on the pair's integer key, which
    never carry the entity or relation names: the lowest property ordinal of
    each probability of a pair (template ordinals only order hypotheses of one
    relation), then that of the highest probability.  Ordinals and
    probabilities are carried as they are, so any size of ontology and any
    scorer's values fit.  Hypotheses at or below the threshold cannot win and
    are dropped before.  Returns ``(article_id, sbj_idx, obj_idx, prop_ord,
    prob)``; ``name_triplets`` adds the texts."""
    return (scored.where(F.col("prob") > threshold)
            .select(*_KEY, "prob", F.col("hord.prop_ord").alias("prop_ord"))
            .groupBy(*_KEY, "prob").agg(F.min("prop_ord").alias("prop_ord"))
            .groupBy(*_KEY).agg(F.max_by("prop_ord", "prob").alias("prop_ord"), F.max("prob").alias("prob")))


def name_triplets(best: DataFrame, entities: DataFrame, props: DataFrame,
                  id_col: str = "article_id") -> DataFrame:
    """Attach entity texts/types (by index) and the relation name (by
    ordinal, from the bounded property table)."""
    s = entities.select(id_col, F.col("eidx").alias("sbj_idx"), F.col("text").alias("sbj_text"),
                        F.col("type").alias("sbj_type"))
    o = entities.select(id_col, F.col("eidx").alias("obj_idx"), F.col("text").alias("obj_text"),
                        F.col("type").alias("obj_type"))
    p = bounded_broadcast(props.select(F.col("name").alias("relation"), F.col("ord").alias("prop_ord")))
    return (best.join(s, [id_col, "sbj_idx"]).join(o, [id_col, "obj_idx"]).join(p, "prop_ord")
            .select(*_PAIR, "relation", "prob"))


def all_relations(scored: DataFrame, threshold: float = 0.78) -> DataFrame:
    """Every hypothesis above the threshold (the multi-relation variant)."""
    return scored.where(F.col("prob") > threshold).select(*_PAIR, F.col("prop").alias("relation"), "prob", "hord")


def attach_entities(articles: DataFrame, entities: DataFrame, id_col: str = "article_id") -> DataFrame:
    """``found_entities array<struct<text,type>>`` in entity order, empty for
    articles without any."""
    ent = entities.groupBy(id_col).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("eidx", "text", "type"))),
        lambda e: F.struct(e["text"].alias("text"), e["type"].alias("type"))).alias("found_entities"))
    empty = F.array().cast("array<struct<text:string,type:string>>")
    return (articles.join(ent, id_col, "left")
            .withColumn("found_entities", F.coalesce("found_entities", empty)))


def extract_relations(articles: DataFrame, entities: DataFrame, onto: dict[str, DataFrame],
                      premises: DataFrame | None = None, threshold: float = 0.78,
                      premise_col: str = "translated_summary", id_col: str = "article_id",
                      scorer=None, **kw) -> DataFrame:
    """J6 + E10: the triplet record per article.

    ``found_entities array<struct<text,type>>`` in entity order and
    ``found_relations array<struct<sbj,relation,obj>>`` in (sbj, obj)
    order; articles with none keep empty arrays.  The per-article lists are
    bounded by the article's own entity count."""
    prem = premises if premises is not None else articles.select(id_col, F.col(premise_col).alias("premise"))
    pairs = entity_pairs(entities, candidate_relations(onto), id_col)
    scored = score_hypotheses(hypotheses(pairs, onto["template"]), prem, "premise", id_col, scorer, **kw)
    trip = name_triplets(best_relation(scored, threshold), entities, onto["property"], id_col)
    rel = trip.groupBy(id_col).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("sbj_idx", "obj_idx", "sbj_text", "sbj_type", "relation",
                                             "obj_text", "obj_type"))),
        lambda r: F.struct(F.struct(r["sbj_text"].alias("text"), r["sbj_type"].alias("type")).alias("sbj"),
                           r["relation"].alias("relation"),
                           F.struct(r["obj_text"].alias("text"), r["obj_type"].alias("type")).alias("obj"))
    ).alias("found_relations"))
    empty_r = F.array().cast("array<struct<sbj:struct<text:string,type:string>,relation:string,"
                             "obj:struct<text:string,type:string>>>")
    return (attach_entities(articles, entities, id_col).join(rel, id_col, "left")
            .withColumn("found_relations", F.coalesce("found_relations", empty_r)))
