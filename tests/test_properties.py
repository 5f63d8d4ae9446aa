"""SURVEY §5 properties and edge rows not covered elsewhere."""
from pyspark.sql import functions as F

from newsgraph.operators import dedup, indexing, ontology, relevance
from newsgraph.plans import registry
from newsgraph.sources import tables as tb

SF = "/root/testdata/sf0.001"


def test_relevance_threshold_inclusive(spark):
    """FIXTURES F3: score == threshold is kept."""
    arts = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "article_id long, text string")
    scores = spark.createDataFrame([(0, -0.4), (1, -0.41), (2, 3.0)], "article_id long, score double")
    kept = relevance.relevance_filter(arts, scores, -0.4)
    assert sorted(r.article_id for r in kept.collect()) == [0, 2]


def test_relevance_model_scores_every_row(spark):
    rows = [(i, "t", ("good news market" if i % 2 else "bad noise spam") + f" w{i}", float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "article_id long, title string, text string, label double")
    model = relevance.fit_relevance(df, max_iter=5, num_features=1 << 10)
    scored = relevance.relevance_filter(df, model, float("-inf"))
    assert scored.count() == 40
    pos = {r.article_id for r in relevance.relevance_filter(df, model, 0.0).collect()}
    assert pos == {i for i in range(40) if i % 2}


def test_empty_texts_are_singletons(spark):
    rows = [(0, "d", "t0", ""), (1, "d", "t1", ""), (2, "d", "t2", "!!!"), (3, "d", "t3", "a b c d")]
    df = spark.createDataFrame(rows, "article_id long, datetime string, title string, text string")
    lab = {r.id: r.cluster_id for r in dedup.component_labels(df, 0.35).collect()}
    assert lab == {0: 0, 1: 1, 2: 2, 3: 3}


def test_triplets_within_candidate_relations(spark):
    onto = tb.ontology(spark, SF)
    cands = ontology.candidate_relations(onto).select("sbj_type", "obj_type", F.col("prop").alias("relation"))
    rec = registry.triplet_records(spark, SF)
    trip = rec.select(F.explode("found_relations").alias("t")).select(
        F.col("t.sbj.type").alias("sbj_type"), F.col("t.obj.type").alias("obj_type"), F.col("t.relation").alias("relation"))
    assert trip.count() > 0
    assert trip.join(cands, ["sbj_type", "obj_type", "relation"], "left_anti").count() == 0


def test_dense_index_is_dense_and_ordered(spark):
    df = spark.range(0, 1000, 3).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    out = sorted((r.k, r["index"]) for r in indexing.with_dense_index(df, ["k"], num_partitions=4).collect())
    assert [i for _, i in out] == list(range(len(out)))


def test_dense_index_over_a_million_rows(spark):
    n = 1_000_000
    df = spark.range(n).select(F.xxhash64("id").alias("k"), F.concat(F.lit("t"), "id").alias("title"),
                               F.repeat(F.lit("x"), (F.col("id") % 9).cast("int")).alias("text"))
    ix = indexing.with_dense_index(df, ["k"]).persist()
    assert ix.agg(F.count("*"), F.countDistinct("index"), F.min("index"), F.max("index")).first()[:] == (n, n, 0, n - 1)
    wrong = (ix.alias("a").join(ix.alias("b"), F.col("a.index") + 1 == F.col("b.index"))
             .where(F.col("a.k") >= F.col("b.k")).count())
    assert wrong == 0 and ix.columns == ["k", "title", "text", "index"]
    assert indexing.with_chunk(ix, 256).groupBy("chunk").count().where("count > 256").count() == 0
    ix.unpersist()


def test_class_closure_with_a_cycle_and_two_parents(spark):
    from newsgraph.operators.ontology import class_closure
    c = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("d", "e"), ("e", None)],
                              "name string, parent string")
    got = {(r.name, r.ancestor) for r in class_closure(c).collect()}
    loop = {(x, y) for x in "abc" for y in "abc"}
    assert got == loop | {("d", y) for y in "abcde"} | {("e", "e")}


def test_relation_scorer_by_score_table(spark):
    from newsgraph.operators import relations
    hyp = spark.createDataFrame([(1, 0, 1, "p", 0, 0), (1, 0, 1, "q", 1, 0), (1, 1, 0, "p", 0, 0)],
                                "article_id long, sbj_idx int, obj_idx int, prop string, prop_ord int, t_ord int")
    hyp = hyp.withColumn("hord", F.struct("prop_ord", "t_ord"))
    table = spark.createDataFrame([("p", 0.5), ("q", 0.9)], "prop string, prob double")
    prem = spark.createDataFrame([(1, "text")], "article_id long, premise string")
    best = relations.best_relation(relations.score_hypotheses(hyp, prem, scorer=table), 0.4)
    assert sorted(map(tuple, best.collect())) == [(1, 0, 1, 1, 0.9), (1, 1, 0, 0, 0.5)]
    assert "SortAggregate" not in best._jdf.queryExecution().executedPlan().toString()


def test_missing_shared_folder_raises_on_a_cluster():
    import pytest
    from newsgraph.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
