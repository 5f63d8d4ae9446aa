"""J1 with entity and relation stages, the triplet files (B4), resumed runs."""
import json
import os

import pytest
from pyspark.sql import functions as F

from newsgraph.plans.pipeline import PipelineConfig, run_pipeline, stage_keys
from newsgraph.sinks.writers import TRIPLET_FIELDS, read_triplets, write_triplets

SCHEMA = "article_id long, datetime string, title string, text string"
ROWS = [(0, "20200101", "Jobs", "Kim works for Acme . Nothing else ."),
        (1, "20200101", "Place", "Acme is located in Seoul ."),
        (2, "20200102", None, "no names here ."),
        (3, None, "Dayless", "Kim works for Acme .")]


def _config(spark, **kw):
    gazetteer = spark.createDataFrame([("Kim", "PER"), ("Acme", "ORG"), ("Seoul", "LOC")],
                                      "phrase string, entity_group string")
    tags = spark.createDataFrame([("PER", "Person"), ("ORG", "Organization"), ("LOC", "Place")],
                                 "entity_group string, type string")
    onto = {
        "class": spark.createDataFrame([("Entity", None), ("Person", "Entity"), ("Organization", "Entity"),
                                        ("Place", "Entity"), ("Company", "Organization"), ("City", "Place")],
                                       "name string, parent string"),
        "property": spark.createDataFrame([("works_for", 0), ("located_in", 1)], "name string, ord int"),
        "domain": spark.createDataFrame([("works_for", "Person"), ("located_in", "Organization")],
                                        "prop string, class string"),
        "range": spark.createDataFrame([("works_for", "Organization"), ("located_in", "Place")],
                                       "prop string, class string"),
        "template": spark.createDataFrame([("works_for", 0, "{sbj} works for {obj}"),
                                           ("located_in", 0, "{sbj} is located in {obj}")],
                                          "prop string, ord int, text string"),
    }
    scores = spark.createDataFrame([("Acme", "Company", 0.9), ("Acme", "City", 0.1), ("Seoul", "City", 0.9)],
                                   "word string, label string, score double")
    return PipelineConfig(gazetteer=gazetteer, tag_map=tags, ontology=onto, entity_scorer=scores,
                          translate_fn=lambda c: c, translate_mode=2, relation_threshold=0.9,
                          versions={"gazetteer": "g1", "tag_map": "t1", "ontology": "o1", "entity_scorer": "s1",
                                    "translate_fn": "same"}, **kw)


TASKS = ["translate", "extract_entities", "extract_relations"]


def _records(spark, path):
    return {r.day: r for r in read_triplets(spark, path).orderBy("day").collect()}


def test_articles_to_triplet_files(spark, tmp_dir):
    out = run_pipeline(spark.createDataFrame(ROWS, SCHEMA), TASKS, _config(spark, output_path=f"{tmp_dir}/out"))
    assert out.count() == 4
    lines = []
    for day in sorted(d for d in os.listdir(f"{tmp_dir}/out/triplets") if d.startswith("day=")):
        for name in sorted(n for n in os.listdir(f"{tmp_dir}/out/triplets/{day}") if n.startswith("part-")):
            with open(f"{tmp_dir}/out/triplets/{day}/{name}", encoding="utf-8") as f:
                lines += [(day, json.loads(line)) for line in f]
    assert [d for d, _ in lines] == ["day=20200101", "day=20200101", "day=20200102", "day=null"]
    assert all(list(r) == TRIPLET_FIELDS for _, r in lines)
    kim, acme = {"text": "Kim", "type": "Person"}, {"text": "Acme", "type": "Company"}
    seoul = {"text": "Seoul", "type": "City"}
    first, second, third, last = (r for _, r in lines)
    assert sorted(e["text"] for e in first["found_entities"]) == ["Acme", "Kim"]
    assert first["found_relations"] == [{"sbj": kim, "relation": "works_for", "obj": acme}]
    assert second["found_relations"] == [{"sbj": acme, "relation": "located_in", "obj": seoul}]
    assert third == {"original_title": None, "original_text": "no names here .",
                     "translated_summary": "no names here .", "found_entities": [], "found_relations": []}
    assert last["found_relations"] == first["found_relations"]
    back = read_triplets(spark, f"{tmp_dir}/out/triplets")
    assert back.where("day = '20200101'").count() == 2
    assert back.where(F.size("found_relations") > 0).count() == 3


def test_triplets_replace_only_their_days(spark, tmp_dir):
    empty = "array<struct<text:string,type:string>>"
    df = (spark.createDataFrame(ROWS, SCHEMA).withColumn("translated_summary", F.col("text"))
          .withColumn("found_entities", F.array().cast(empty))
          .withColumn("found_relations", F.array().cast(
              "array<struct<sbj:struct<text:string,type:string>,relation:string,obj:struct<text:string,type:string>>>")))
    write_triplets(df, f"{tmp_dir}/t")
    write_triplets(df.where("article_id = 1"), f"{tmp_dir}/t")
    got = sorted((r.day, r.original_title) for r in read_triplets(spark, f"{tmp_dir}/t").collect()
                 if r.original_title)
    assert got == [("20200101", "Place"), ("null", "Dayless")]


def test_entity_stages_say_what_they_need(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError, match="tag_map"):
        run_pipeline(df, ["extract_entities"], PipelineConfig())
    with pytest.raises(ValueError, match="found_entities"):
        run_pipeline(df, ["extract_relations"], _config(spark))


def _counted(spark, log, fail=()):
    def stage(name):
        def run(df, cfg):
            if name in fail:
                raise RuntimeError(name)
            log.append(name)
            return df.withColumn(name, F.lit(1))
        return run
    return {n: stage(n) for n in ("one", "two", "three")}


def test_resume_starts_behind_the_last_whole_stage(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, SCHEMA)
    tasks = ["one", "two", "three"]
    log = []

    def run(fail=(), versions=None, version="v1", out=None):
        cfg = PipelineConfig(extra_stages=_counted(spark, log, fail), output_path=out,
                             versions={"one": 1, "two": 1, "three": 1, **(versions or {})})
        return run_pipeline(df, tasks, cfg, run_path=f"{tmp_dir}/run", input_version=version)

    with pytest.raises(RuntimeError):
        run(fail=("three",))
    assert log == ["one", "two"]
    got = run()                                   # only the failed stage runs
    assert log == ["one", "two", "three"] and got.count() == 4 and "three" in got.columns
    run()
    assert len(log) == 3                          # nothing left to do
    run(versions={"two": 2})                      # a changed stage and those behind it
    assert log[3:] == ["two", "three"]
    run(version="v2")                             # another input: all
    assert log[5:] == ["one", "two", "three"]
    run(out=f"{tmp_dir}/out")                     # files at another place: written whole
    assert log[8:] == ["one", "two", "three"] and spark.read.json(f"{tmp_dir}/out/three").count() == 4


def test_a_stage_cut_off_while_writing_is_not_done(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, SCHEMA)
    broken = F.udf(lambda x: 1 // 0, "int")
    cfg = PipelineConfig(extra_stages={"one": lambda d, c: d.withColumn("x", broken("article_id"))},
                         versions={"one": 1})
    with pytest.raises(Exception):
        run_pipeline(df, ["one"], cfg, run_path=f"{tmp_dir}/run", input_version="v1")
    cfg.extra_stages["one"] = lambda d, c: d.withColumn("x", F.lit(1))
    assert run_pipeline(df, ["one"], cfg, run_path=f"{tmp_dir}/run", input_version="v1").count() == 4


def test_keys_need_names_for_functions(spark):
    cfg = _config(spark)
    keys = stage_keys(TASKS, cfg, "v1")
    assert keys == stage_keys(TASKS, _config(spark), "v1") and len(set(keys)) == 3
    cfg.relation_threshold = 0.5
    changed = stage_keys(TASKS, cfg, "v1")
    assert changed[:2] == keys[:2] and changed[2] != keys[2]
    del cfg.versions["ontology"]
    with pytest.raises(ValueError, match="ontology"):
        stage_keys(TASKS, cfg, "v1")
    with pytest.raises(ValueError, match="input_version"):
        run_pipeline(spark.createDataFrame(ROWS, SCHEMA), [], cfg, run_path="/tmp/none")
