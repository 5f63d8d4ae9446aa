"""Registered queries: one Spark builder per operator group of the survey's
inventory, each over the driver's tables at ``sf_dir``.

Every builder returns a DataFrame whose columns are named exactly as in the
matching SQL of ``plans/oracle.py``.  Floating values are rounded in both.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import (abbreviations, coref, dedup, entities, indexing, ontology, relations, relevance,
                         sentences, similarity, trainset, uncertainty, vectors)
from ..operators.common import attach_row, bounded_broadcast, spread
from ..session import materialize
from ..sources import ingest
from ..sources import tables as tb

# --- fixed parameters of the registered queries --------------------------
NEAR_DUP_EPS = 0.35          # reference default for erase_similar
TFIDF_EPS = 0.1              # cosine 0.9 on hashed TF-IDF vectors
DENSE_EPS = 0.7              # dense vectors: 0.35 links nothing in this data
RELATION_THRESHOLD = 0.78    # the reference's script value
RELEVANCE_THRESHOLD = -0.4   # the reference's default
SUMMARY_K = 3
PREFIX_CHARS = 500
UNLABELED_CHARS = 750
CHUNK_ROWS = 256
# "the" and "la" also stand inside the phrases: matches overlap
GAZETTEER = [("and", "CONJ"), ("with", "PREP"), ("is", "VERB"), ("the", "DET"), ("la", "DET"),
             ("of the", "PHRASE"), ("in the", "PHRASE"), ("de la", "PHRASE")]
# ---------------------------------------------------------------------------


def _articles(spark, sf):
    return tb.articles(spark, sf)


def q_normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    a = _articles(spark, sf)
    return a.select("article_id", tx.strip_subword_marker(tx.normalize_text("text")).alias("norm_text"))


def q_relevance_filter(spark, sf):
    a = _articles(spark, sf).join(tb.labels(spark, sf).withColumnRenamed("doc_id", "article_id"),
                                  "article_id", "left")
    s = (F.coalesce("quality", F.lit(0)) - F.coalesce("toxic", F.lit(0))).cast("double")
    return relevance.relevance_filter(a, s, RELEVANCE_THRESHOLD).select("article_id", "datetime", "score")


def q_title_dedup_keep_last(spark, sf):
    return dedup.dedup_title_keep_last(_articles(spark, sf)).select("article_id", "datetime")


def q_near_dup_edges(spark, sf):
    f1 = dedup.dedup_title_keep_last(_articles(spark, sf))
    return similarity.all_text_pairs(f1, NEAR_DUP_EPS)


def q_near_dup_survivors(spark, sf):
    return dedup.erase_similar(_articles(spark, sf), NEAR_DUP_EPS).select("article_id", "datetime")


def q_cluster_report(spark, sf):
    a = _articles(spark, sf)
    f1 = dedup.dedup_title_keep_last(a)
    lab = dedup.component_labels(f1, NEAR_DUP_EPS)
    rep = dedup.cluster_report(f1, lab)
    return rep.select("cluster_id", "article_id", F.col("is_representative").cast("int").alias("is_rep"),
                      "original_index", "title", "n_members")


def q_dense_near_dup_edges(spark, sf):
    e = similarity.dense_pairs(tb.embeddings(spark, sf), DENSE_EPS)
    return e.select("id_a", "id_b")


def q_dense_clusters(spark, sf):
    lab = dedup.dense_component_labels(tb.embeddings(spark, sf), DENSE_EPS)
    return lab.select(F.col("id").alias("vec_id"), "cluster_id")


def q_tfidf_near_dups(spark, sf):
    return (vectors.similar_texts(_articles(spark, sf), TFIDF_EPS)
            .select(F.col("id").alias("article_id"), "cluster_id", "n_links"))


def _split(spark, sf):
    return sentences.split_sentences(_articles(spark, sf))


def q_sentence_split(spark, sf):
    return sentences.sentence_table(_split(spark, sf))


def q_flatten_regroup(spark, sf):
    s = _split(spark, sf)
    fn = lambda x: F.concat(F.length(x).cast("string"), F.lit(":"), x)
    m = sentences.map_list(s, "split_text", fn, "mapped", exploded=True)
    return m.select("article_id", F.size("mapped").alias("n_items"),
                    F.array_join("mapped", "\u001f").alias("joined"))


def q_glossary_translate(spark, sf):
    s = _split(spark, sf)
    t = sentences.glossary_map(s, dict(tb.GLOSSARY))
    return t.select("article_id", F.posexplode("translated_text").alias("pos", "translated"))


def q_extractive_summary(spark, sf):
    s = sentences.extractive_summary(_split(spark, sf), k=SUMMARY_K)
    return s.select("article_id", "summarized_text")


def q_paragraph_prefix(spark, sf):
    return trainset.paragraph_prefix(_articles(spark, sf), n=PREFIX_CHARS).select("article_id", "text_prefix")


def q_train_labels(spark, sf):
    lab = tb.labels(spark, sf).where("quality = 1").select(F.col("doc_id").alias("article_id"))
    t = trainset.build_labeled(_articles(spark, sf), lab, ["article_id"], n=PREFIX_CHARS)
    return t.select("article_id", "labels", "text")


def q_unlabeled_guard(spark, sf):
    flag = ~F.col("text").rlike("\\p{L}")
    t = trainset.build_unlabeled(_articles(spark, sf), UNLABELED_CHARS, error_flag=flag)
    return t.select("article_id", "title", "text")


def q_token_keep_mask(spark, sf):
    a = _articles(spark, sf)
    toks = F.transform(F.split("text", " "), lambda t: F.struct(
        t.alias("token"), F.when(t.rlike("\\p{L}"), 0).otherwise(1).alias("label")))
    drop = F.when(F.col("lang") == "en", 1).otherwise(0)
    kept = F.filter(toks, lambda x: x["label"] != drop)
    return a.select("article_id", tx.strip_subword_marker(
        F.array_join(F.transform(kept, lambda x: x["token"]), " ")).alias("kept_text"),
        F.size(kept).alias("n_kept"))


def q_step_entropy(spark, sf):
    s = uncertainty.step_entropy(tb.gen_steps(spark, sf))
    return s.select("article_id", "step", F.round("entropy", 6).alias("entropy"), "argmax")


def q_uncertain_tokens(spark, sf):
    u = uncertainty.uncertain_tokens(tb.gen_steps(spark, sf), threshold=tb.ENTROPY_THRESHOLD,
                                     end_id=tb.END_TOKEN_ID)
    return u.select("article_id", F.array_join("error_captured", " ").alias("captured"))


def q_only_uncertain(spark, sf):
    """Articles with a captured token."""
    u = uncertainty.uncertain_tokens(tb.gen_steps(spark, sf), threshold=tb.ENTROPY_THRESHOLD,
                                     end_id=tb.END_TOKEN_ID)
    return uncertainty.only_uncertain(u).select("article_id", F.array_join("error_captured", " ").alias("captured"))


def q_prompted_text(spark, sf):
    """I7 + I10: sentences joined to one paragraph behind the prompt."""
    return _split(spark, sf).select("article_id", tx.with_prompt(tx.join_paragraphs("split_text")).alias("prompt"))


def q_scored_relations(spark, sf):
    """K1 + E5: relations by a model's score table (here a score per article
    and property, from the line count of the article's order)."""
    onto = tb.ontology(spark, sf)
    lines = tb.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("article_id")).agg(
        F.count("*").alias("n"))
    props = onto["property"].select(F.col("name").alias("prop"), F.col("ord").alias("_ord"))
    table = lines.withColumn("prop", F.explode(F.array(*(F.lit(p) for p, _ in tb.PROPERTIES)))).join(
        bounded_broadcast(props), "prop").select(
        "article_id", "prop", ((F.col("n") * 7 + F.col("_ord") * 3) % 11 / 10.0).alias("prob"))
    pairs = relations.entity_pairs(_entities(spark, sf), ontology.candidate_relations(onto))
    scored = relations.score_hypotheses(relations.hypotheses(pairs, onto["template"]), tb.premises(spark, sf),
                                        scorer=table, keys=["article_id", "prop"])
    b = relations.best_relation(scored, RELATION_THRESHOLD)
    named = props.select(F.col("prop").alias("relation"), F.col("_ord").alias("prop_ord"))
    return (b.join(bounded_broadcast(named), "prop_ord")
            .select("article_id", "sbj_idx", "obj_idx", "relation", F.round("prob", 9).alias("prob")))


def q_cluster_rep(spark, sf):
    return coref.cluster_representative(tb.coref_spans(spark, sf))


def q_coref_rewrite(spark, sf):
    d = tb.table(spark, sf, "documents").select(F.col("doc_id").alias("article_id"), "text")
    r = coref.resolve_coref(d, tb.coref_spans(spark, sf))
    return r.select("article_id", "resolved_text")


def q_coref_nested(spark, sf):
    """I9, J4 on mentions that nest and overlap."""
    d = tb.table(spark, sf, "documents").select(F.col("doc_id").alias("article_id"), "text")
    r = coref.resolve_coref(d, tb.coref_nested_spans(spark, sf))
    return r.select("article_id", "resolved_text", "nested_spans")


def q_step_entropy_long(spark, sf):
    """E8 on traces in long form."""
    s = uncertainty.step_entropy_long(tb.gen_logits(spark, sf))
    return s.select("article_id", "step", F.round("entropy", 6).alias("entropy"), "argmax")


def q_learned_abbreviations(spark, sf):
    """I4: abbreviations found in the corpus itself."""
    counts = materialize(abbreviations.type_counts(_articles(spark, sf)))
    return abbreviations.abbreviations(counts).select("type", "n_dot", "n_plain", F.round("score", 6).alias("score"))


def q_learned_sentences(spark, sf):
    """I4: sentences, uncut behind the corpus's own abbreviations."""
    a = _articles(spark, sf)
    counts = materialize(abbreviations.type_counts(a))
    s = abbreviations.split_sentences_learned(
        spread(a.select("article_id", "text")), abbreviations.abbreviations(counts).select("type"),
        abbreviations.starters(counts))
    # outer: no filter on the list's size is pushed below, which would cut every text twice
    return (s.select("article_id", F.posexplode_outer("split_text").alias("pos", "sentence"))
            .where("sentence IS NOT NULL"))


def q_class_closure(spark, sf):
    return ontology.class_closure(tb.ontology(spark, sf)["class"])


def q_candidate_relations(spark, sf):
    return ontology.candidate_relations(tb.ontology(spark, sf)).select("sbj_type", "obj_type", "prop")


def q_first_mentions(spark, sf):
    return entities.first_mentions(tb.mentions(spark, sf))


def _coarse(spark, sf):
    onto = tb.ontology(spark, sf)
    coarse, _ = ontology.class_levels(onto["class"], tb.ROOT_CLASS)
    return entities.coarse_types(tb.mentions(spark, sf), tb.tag_map(spark, sf), coarse,
                                 scorer=tb.type_scores(spark, sf))


def q_coarse_type(spark, sf):
    return _coarse(spark, sf).select("article_id", "word", "type", "branch")


def _entities(spark, sf):
    onto = tb.ontology(spark, sf)
    return entities.extract_entities(tb.mentions(spark, sf), tb.tag_map(spark, sf), onto,
                                     tb.ROOT_CLASS, tb.KEEP_COARSE, scorer=tb.type_scores(spark, sf))


def q_fine_type(spark, sf):
    return _entities(spark, sf).select("article_id", "eidx", "text", "type")


def _scored(spark, sf):
    onto = tb.ontology(spark, sf)
    ents = _entities(spark, sf)
    pairs = relations.entity_pairs(ents, ontology.candidate_relations(onto))
    hyp = relations.hypotheses(pairs, onto["template"])
    return relations.score_hypotheses(hyp, tb.premises(spark, sf))


def q_hypotheses(spark, sf):
    return _scored(spark, sf).select("article_id", "sbj_idx", "obj_idx", F.col("prop").alias("relation"),
                                     "hypothesis", F.round("prob", 9).alias("prob"))


def q_best_relation(spark, sf):
    b = relations.best_relation(_scored(spark, sf), RELATION_THRESHOLD)
    props = tb.ontology(spark, sf)["property"].select(F.col("name").alias("relation"), F.col("ord").alias("prop_ord"))
    return (b.join(bounded_broadcast(props), "prop_ord")
            .select("article_id", "sbj_idx", "obj_idx", "relation", F.round("prob", 9).alias("prob")))


def triplet_records(spark, sf):
    """J6 flagship: the per-article triplet record over the order tables."""
    onto = tb.ontology(spark, sf)
    prem = tb.premises(spark, sf)
    arts = prem.select("article_id", F.col("premise").alias("translated_summary"))
    return relations.extract_relations(arts, _entities(spark, sf), onto, premises=prem,
                                       threshold=RELATION_THRESHOLD)


def q_triplets(spark, sf):
    r = triplet_records(spark, sf)
    ent = F.array_join(F.transform("found_entities", lambda e: F.concat_ws("/", e["text"], e["type"])), ";")
    rel = F.array_join(F.transform("found_relations", lambda t: F.concat_ws(
        "|", t["sbj"]["text"], t["relation"], t["obj"]["text"])), ";")
    return r.select("article_id", F.size("found_entities").alias("n_entities"),
                    F.size("found_relations").alias("n_relations"), ent.alias("entities"),
                    rel.alias("relations"))


def q_gazetteer_mentions(spark, sf):
    d = tb.table(spark, sf, "documents").select(F.col("doc_id").alias("article_id"), "text")
    g = spark.createDataFrame(GAZETTEER, "phrase string, entity_group string")
    return entities.gazetteer_mentions(d, g)


def q_high_water_mark(spark, sf):
    return ingest.high_water_mark(tb.source_days(spark, sf))


def _landed(spark, sf):
    ev = tb.table(spark, sf, "events")
    # micros since the epoch of a zone-less timestamp: independent of the
    # session time zone
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    mid = ev.agg((F.min(us) + (F.max(us) - F.min(us)) / 2).alias("_mid"))
    return attach_row(ev, mid).where(us < F.col("_mid")).select(tx.day_key("ts").alias("datetime"))


def q_catch_up_days(spark, sf):
    src = tb.source_days(spark, sf)
    local = ingest.high_water_mark(_landed(spark, sf))
    remote = ingest.high_water_mark(src)
    got = ingest.catch_up_days(src, local, remote)
    return got.groupBy("datetime").agg(F.count("*").alias("n_rows"))


def q_daily_counts(spark, sf):
    return _articles(spark, sf).groupBy("datetime").agg(F.count("*").alias("n_articles"))


def q_dense_index_chunks(spark, sf):
    a = indexing.with_dense_index(_articles(spark, sf).select("article_id", "title", "text"), ["article_id"])
    return indexing.with_chunk(a, CHUNK_ROWS).select("article_id", "index", "chunk", "title",
                                                     F.length("text").alias("text_chars"))


def q_nli_entailment(spark, sf):
    """I11 on stand-in logits (entail, neutral, contradiction), both softmax
    variants."""
    from ..functions.scoring import nli_softmax
    st = tb.nli_logits(spark, sf)
    return st.select("article_id", "step", F.round(nli_softmax("logits", True), 9).alias("p_neutral"),
                     F.round(nli_softmax("logits", False), 9).alias("p_two_way"))


def q_predicted_positives(spark, sf):
    """Steps whose argmax label is 1."""
    pp = relevance.predicted_positives(tb.gen_steps(spark, sf))
    return pp.select("article_id", "step", "pred")


def q_confusion(spark, sf):
    """Counts of (label, prediction); label = returned line."""
    st = tb.gen_steps(spark, sf)
    am = (F.array_position("logits", F.array_max("logits")) - 1).cast("int")
    return relevance.confusion(st.withColumn("pred", am), "label", "pred")


def q_all_relations(spark, sf):
    """Every hypothesis above the threshold."""
    a = relations.all_relations(_scored(spark, sf), RELATION_THRESHOLD)
    return a.select("article_id", "sbj_idx", "obj_idx", "relation", F.round("prob", 9).alias("prob"))


def q_tweet_clean(spark, sf):
    """Strip t.co links, keep texts of at least 10 characters."""
    c = tb.table(spark, sf, "conversations")
    return trainset.clean_tweets(c).select("conv_id", "turn", "text")


def q_relevance_model(spark, sf):
    a = _articles(spark, sf)
    lab = tb.labels(spark, sf).select(F.col("doc_id").alias("article_id"), F.col("quality").alias("label"))
    model = relevance.fit_term_odds(a.join(lab, "article_id"))
    scores = relevance.term_odds_scores(a, model)
    kept = relevance.relevance_filter(a, scores, RELEVANCE_THRESHOLD, keys=["article_id"])
    return kept.select("article_id", F.round("score", 6).alias("score"))


QUERIES = {
    "normalize_text": q_normalize_text,
    "relevance_filter": q_relevance_filter,
    "title_dedup_keep_last": q_title_dedup_keep_last,
    "near_dup_edges": q_near_dup_edges,
    "near_dup_survivors": q_near_dup_survivors,
    "cluster_report": q_cluster_report,
    "dense_near_dup_edges": q_dense_near_dup_edges,
    "dense_clusters": q_dense_clusters,
    "tfidf_near_dups": q_tfidf_near_dups,
    "sentence_split": q_sentence_split,
    "flatten_regroup": q_flatten_regroup,
    "glossary_translate": q_glossary_translate,
    "extractive_summary": q_extractive_summary,
    "paragraph_prefix": q_paragraph_prefix,
    "train_labels": q_train_labels,
    "unlabeled_guard": q_unlabeled_guard,
    "token_keep_mask": q_token_keep_mask,
    "step_entropy": q_step_entropy,
    "uncertain_tokens": q_uncertain_tokens,
    "only_uncertain": q_only_uncertain,
    "prompted_text": q_prompted_text,
    "scored_relations": q_scored_relations,
    "cluster_rep": q_cluster_rep,
    "coref_rewrite": q_coref_rewrite,
    "class_closure": q_class_closure,
    "candidate_relations": q_candidate_relations,
    "first_mentions": q_first_mentions,
    "coarse_type": q_coarse_type,
    "fine_type": q_fine_type,
    "hypotheses": q_hypotheses,
    "best_relation": q_best_relation,
    "triplets": q_triplets,
    "gazetteer_mentions": q_gazetteer_mentions,
    "high_water_mark": q_high_water_mark,
    "catch_up_days": q_catch_up_days,
    "daily_counts": q_daily_counts,
    "dense_index_chunks": q_dense_index_chunks,
    "nli_entailment": q_nli_entailment,
    "predicted_positives": q_predicted_positives,
    "confusion": q_confusion,
    "all_relations": q_all_relations,
    "tweet_clean": q_tweet_clean,
    "relevance_model": q_relevance_model,
    "coref_nested": q_coref_nested,
    "step_entropy_long": q_step_entropy_long,
    "learned_abbreviations": q_learned_abbreviations,
    "learned_sentences": q_learned_sentences,
}
