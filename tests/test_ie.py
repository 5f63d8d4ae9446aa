"""Ontology, typing and relations (FIXTURES F8-F11), uncertainty."""
import math

from pyspark.sql import functions as F

from newsgraph.operators import entities, ontology, relations, uncertainty


def _onto(spark):
    classes = [("Entity", None), ("Person", "Entity"), ("Organization", "Entity"), ("Place", "Entity"),
               ("Company", "Organization"), ("City", "Place")]
    return {
        "class": spark.createDataFrame(classes, "name string, parent string"),
        "property": spark.createDataFrame([("works_for", 0), ("located_in", 1), ("free", 2)], "name string, ord int"),
        "domain": spark.createDataFrame([("works_for", "Person"), ("located_in", "Organization")],
                                        "prop string, class string"),
        "range": spark.createDataFrame([("works_for", "Organization"), ("located_in", "Place")],
                                       "prop string, class string"),
        "template": spark.createDataFrame([("works_for", 0, "{sbj} works for {obj}"),
                                           ("located_in", 0, "{sbj} is located in {obj}")],
                                          "prop string, ord int, text string"),
    }


def test_closure_and_candidates(spark):
    o = _onto(spark)
    clo = {(r.name, r.ancestor) for r in ontology.class_closure(o["class"]).collect()}
    assert ("Company", "Entity") in clo and ("City", "City") in clo and ("Person", "Place") not in clo
    c = {(r.sbj_type, r.obj_type, r.prop) for r in ontology.candidate_relations(o).collect()}
    assert ("Person", "Company", "works_for") in c and ("Company", "City", "located_in") in c
    assert not any(t[0] == "City" and t[1] == "Person" for t in c)
    assert not any(t[2] == "free" for t in c)


def test_multiple_parents(spark):
    cls = spark.createDataFrame([("A", None), ("B", "A"), ("C", "A"), ("D", "B"), ("D", "C")],
                                "name string, parent string")
    anc = {r.ancestor for r in ontology.class_closure(cls).where("name = 'D'").collect()}
    assert anc == {"A", "B", "C", "D"}


def test_levels(spark):
    coarse, fine = ontology.class_levels(_onto(spark)["class"])
    assert {r.name for r in coarse.collect()} == {"Person", "Organization", "Place"}
    assert {r.name for r in fine.collect()} == {"Company", "City"}


def test_typing(spark):
    o = _onto(spark)
    m = spark.createDataFrame([(1, 0, "Kim", "PER"), (1, 1, "Acme", "ORG"), (1, 2, "Kim", "ORG"), (1, 3, "Foo", "MISC")],
                              "article_id long, pos int, word string, entity_group string")
    tag = spark.createDataFrame([("PER", "Person"), ("ORG", "Organization")], "entity_group string, type string")
    scores = spark.createDataFrame([("Foo", "Organization", 0.9), ("Foo", "Person", 0.1),
                                    ("Acme", "Company", 0.8), ("Acme", "City", 0.3),
                                    ("Foo", "City", 0.7), ("Foo", "Company", 0.2)],
                                   "word string, label string, score double")
    e = entities.extract_entities(m, tag, o, scorer=scores, checkpoint=False).orderBy("eidx").collect()
    assert [(r.text, r.type) for r in e] == [("Acme", "Company"), ("Foo", "City"), ("Kim", "Person")]


def test_best_relation_ties_and_threshold(spark):
    rows = [(1, 0, 1, "r0", 0, 0, 0.9), (1, 0, 1, "r1", 1, 0, 0.9),   # tie -> lower ordinal
            (1, 1, 0, "r0", 0, 0, 0.78),                               # strict >
            (1, 2, 0, "r0", 0, 0, 0.781)]
    df = spark.createDataFrame(rows, "article_id long, sbj_idx int, obj_idx int, prop string, prop_ord int, "
                                     "t_ord int, prob double")
    df = df.withColumn("hord", F.struct("prop_ord", "t_ord"))
    got = {(r.sbj_idx, r.obj_idx, r.prop_ord) for r in relations.best_relation(df, 0.78).collect()}
    assert got == {(0, 1, 0), (2, 0, 0)}


def test_best_relation_of_a_large_ontology_and_any_score(spark):
    rows = [(1, 0, 1, 1024, 0, 0.9), (1, 0, 1, 3000, 0, 0.9),       # ordinals beyond 10 bits
            (1, 1, 0, 5, 1500, 0.9), (1, 1, 0, 7, 0, 0.9),          # template ordinals as well
            (1, 2, 0, 1, 0, 9.5), (1, 2, 0, 0, 0, 1e12),            # a scorer that is no probability
            (1, 3, 0, 4, 0, 0.9), (1, 3, 0, 2, 0, 0.9 - 1e-14)]     # nearly equal is not equal
    df = spark.createDataFrame(rows, "article_id long, sbj_idx int, obj_idx int, prop_ord int, t_ord int, prob double")
    best = relations.best_relation(df.withColumn("hord", F.struct("prop_ord", "t_ord")), 0.78)
    assert {(r.sbj_idx, r.prop_ord, r.prob) for r in best.collect()} == {
        (0, 1024, 0.9), (1, 5, 0.9), (2, 0, 1e12), (3, 4, 0.9)}
    assert "SortAggregate" not in best._jdf.queryExecution().executedPlan().toString()


def test_triplet_record_keeps_empty(spark):
    o = _onto(spark)
    arts = spark.createDataFrame([(1, "Kim works for Acme"), (2, "nothing")], "article_id long, translated_summary string")
    ents = spark.createDataFrame([(1, 0, "Kim", "Person"), (1, 1, "Acme", "Company")],
                                 "article_id long, eidx int, text string, type string")
    rec = {r.article_id: r for r in relations.extract_relations(arts, ents, o, threshold=0.78).collect()}
    assert [(t.sbj.text, t.relation, t.obj.text) for t in rec[1].found_relations] == [("Kim", "works_for", "Acme")]
    assert rec[2].found_entities == [] and rec[2].found_relations == []


def test_gazetteer_longest_nonoverlapping(spark):
    d = spark.createDataFrame([(1, "x of the world of the")], "article_id long, text string")
    g = spark.createDataFrame([("of the", "P"), ("the world", "Q"), ("world", "W")], "phrase string, entity_group string")
    got = [(r.pos, r.word) for r in entities.gazetteer_mentions(d, g).orderBy("pos").collect()]
    assert got == [(1, "of the"), (3, "world"), (4, "of the")]


def _uniform(k, marker_last=True):
    return [0.0] * k


def test_entropy_and_uncertain(spark):
    # article 1: step0 uniform over 40 (ln 40 ≥ 3.5), step1 uniform over 33, step2 argmax = 2 (end)
    z40 = [0.0] * 40
    z33 = [0.0] * 33 + [-1e9] * 7
    end = [0.0, 0.0, 50.0] + [0.0] * 37
    steps = spark.createDataFrame([(1, 0, z40, "a"), (1, 1, z33, "b"), (1, 2, end, "c"),
                                   (2, 0, z40, "x")], "article_id long, step int, logits array<double>, token string")
    e = {(r.article_id, r.step): r for r in uncertainty.step_entropy(steps).collect()}
    assert math.isclose(e[(1, 0)].entropy, math.log(40), rel_tol=1e-9)
    assert math.isclose(e[(1, 1)].entropy, math.log(33), rel_tol=1e-9)
    assert e[(1, 2)].argmax == 2 and e[(1, 0)].argmax == 0
    u = {r.article_id: r.error_captured for r in uncertainty.uncertain_tokens(steps, threshold=3.5).collect()}
    assert u == {1: ["a"], 2: ["pass"]}
    assert uncertainty.only_uncertain(uncertainty.uncertain_tokens(steps, threshold=3.5)).count() == 1


def test_top_label_column_scorer(spark):
    from newsgraph.functions.scoring import char_overlap
    words = spark.createDataFrame([("europa",), ("asiatic",), ("zzz",)], "word string")
    labels = spark.createDataFrame([("EUROPE", 0), ("ASIA", 1), ("AFRICA", 2)], "name string, ord int")
    got = {r.word: r.label for r in entities.top_label(words, labels, char_overlap).collect()}
    # europa covers 4/5 of EUROPE's letters; asiatic covers all of ASIA;
    # zzz scores 0 everywhere -> lowest ordinal
    assert got == {"europa": "EUROPE", "asiatic": "ASIA", "zzz": "EUROPE"}


def test_pack_logits_long_form(spark):
    long_rows = [(1, 0, 2, 0.5), (1, 0, 0, 1.5), (1, 0, 1, -1.0)]
    df = spark.createDataFrame(long_rows, "article_id long, step int, token_id int, logit double")
    r = uncertainty.pack_logits(df).first()
    assert r.logits == [1.5, -1.0, 0.5]


def _keys_dealt(df):
    import re
    return set(re.findall(r"hashpartitioning\(([^)]*)\)", re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())))


def test_pairs_and_hypotheses_are_not_dealt(spark):
    """Entities and premises meet by article; no pair, hypothesis or candidate
    relation is shuffled on its way to the best relation."""
    o = _onto(spark)
    ents = spark.createDataFrame([(1, 0, "Kim", "Person"), (1, 1, "Acme", "Company"), (2, 0, "Lee", "Person"),
                                  (2, 1, "Lee", "Company"), (None, 0, "Foo", "Company"), (2, 2, None, "Company")],
                                 "article_id long, eidx int, text string, type string")
    prem = spark.createDataFrame([(1, "Kim works for Acme"), (2, "Lee works")], "article_id long, premise string")
    hyp = relations.hypotheses(relations.entity_pairs(ents, ontology.candidate_relations(o)), o["template"])
    best = relations.best_relation(relations.score_hypotheses(hyp, prem), 0.7)
    assert [tuple(r) for r in best.collect()] == [(1, 0, 1, 0, 1.0)]
    assert _keys_dealt(best) == {"article_id, 8"}

    # a score table: rows of one key all count, keys without a row have no score
    table = spark.createDataFrame([(1, "works_for", 0.9), (1, "works_for", 0.8), (2, None, 0.9), (None, "works_for", 0.9)],
                                  "article_id long, prop string, prob double")
    scored = relations.score_hypotheses(hyp, prem, scorer=table, keys=["article_id", "prop"])
    got = sorted((r.article_id, r.sbj_idx, r.obj_idx, r.prob or 0.0) for r in scored.where("prop = 'works_for'").collect())
    assert got == [(1, 0, 1, 0.8), (1, 0, 1, 0.9), (2, 0, 1, 0.0), (2, 0, 2, 0.0)]
    assert _keys_dealt(scored) == {"article_id, 8"}


def test_entities_are_dealt_by_article_only(spark):
    """Labels go to the mentions; ties and null keys as before."""
    o = _onto(spark)
    m = spark.createDataFrame([(1, 0, "Kim", "PER"), (1, 2, "Kim", "ORG"), (1, 1, "Acme", "MISC"), (1, 1, "Acme", "ORG"),
                               (None, 0, "Kim", "PER"), (2, 0, None, "PER"), (2, None, "Foo", "PER"), (2, 1, "Foo", "MISC")],
                              "article_id long, pos int, word string, entity_group string")
    first = entities.first_mentions(m)
    assert sorted(tuple(r) for r in first.collect()) == [
        (1, 0, "Kim", "PER"), (1, 1, "Acme", "MISC"), (1, 1, "Acme", "ORG"), (2, 1, "Foo", "MISC")]
    tag = spark.createDataFrame([("PER", "Person"), ("ORG", "Organization")], "entity_group string, type string")
    ents = entities.extract_entities(m.repartition(4, "article_id"), tag, o, checkpoint=False)
    # the tag map is dealt by tag, the mentions by nothing else than their article
    assert _keys_dealt(ents) <= {"article_id, 4", "entity_group, 8"}
