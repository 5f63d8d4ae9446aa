"""Sources, sinks, ingest (FIXTURES F14), streaming = batch, pipeline."""
import os

from pyspark.sql import functions as F

from newsgraph.operators import dedup
from newsgraph.plans.pipeline import PipelineConfig, run_pipeline
from newsgraph.sinks.writers import write_by_day, write_with_errors
from newsgraph.sources import ingest
from newsgraph.sources.readers import read_articles, read_ontology


def _source(spark):
    rows = [("20200101", 1), ("20200102", 2), ("20200103", 3), ("20200104", 4), ("nan", 5), (None, 6)]
    return spark.createDataFrame(rows, "datetime string, v int")


def test_marks_and_catch_up(spark):
    src = _source(spark)
    assert ingest.high_water_mark(src).first().mark == "20200104"
    got = sorted(r.datetime for r in ingest.catch_up_days(src, "20200102", ingest.high_water_mark(src)).collect())
    assert got == ["20200102", "20200103", "20200104"]


def test_update_tables(spark, tmp_dir):
    src = _source(spark).where("datetime <> 'nan' OR datetime IS NULL")
    path = f"{tmp_dir}/landed"
    ingest.land_days(src.where("datetime <= '20200102'"), path)
    r1 = ingest.update_tables(spark, [{"name": "news", "source": src, "path": path}]).first()
    assert (r1.local, r1.remote, r1.n_days, r1.action) == ("20200102", "20200104", 3, "fetched")
    landed = spark.read.parquet(path)
    assert landed.count() == 4 and landed.select("datetime").distinct().count() == 4
    r2 = ingest.update_tables(spark, [{"name": "news", "source": src, "path": path}]).first()
    assert r2.action == "up-to-date"


def test_write_by_day_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "20200101", ["a"]), (2, "20200102", []), (3, None, ["b"])],
                               "article_id long, datetime string, l array<string>")
    write_by_day(df, f"{tmp_dir}/j", "json")
    back = spark.read.json(f"{tmp_dir}/j")
    assert back.count() == 3
    assert {r.datetime for r in back.collect()} == {"20200101", "20200102", None}
    write_by_day(df, f"{tmp_dir}/c", "csv")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/c").count() == 3


def test_write_with_errors(spark, tmp_dir):
    df = spark.createDataFrame([("20200101", "s", "t", ["pass"]), ("20200101", "s2", "t2", ["tok"]),
                                ("20200102", "s3", "t3", ["pass"])],
                               "datetime string, summarized_text string, translated_summary string, "
                               "error_captured array<string>")
    write_with_errors(df, f"{tmp_dir}/tr")
    err = spark.read.option("header", True).csv(f"{tmp_dir}/tr_errors")
    assert err.count() == 1
    assert [d for d in os.listdir(f"{tmp_dir}/tr_errors") if d.startswith("day=")] == ["day=20200101"]
    assert spark.read.option("header", True).csv(f"{tmp_dir}/tr").count() == 3


def test_read_articles_years(spark, tmp_dir):
    d = f"{tmp_dir}/in"
    os.makedirs(d)
    for name, title in [("2016_a.csv", "old"), ("2017_b.csv", "kept"), ("2023_c.csv", "late")]:
        with open(f"{d}/{name}", "w") as f:
            f.write(',title,text,datetime\n0,"%s","line1\nline2",20200101\n' % title)
    df = read_articles(spark, d, "csv", years=(2017, 2023))
    rows = df.collect()
    assert [r.title for r in rows] == ["kept"] and rows[0].text == "line1\nline2"
    assert "original_index" in df.columns


def test_read_ontology_ntriples(spark, tmp_dir):
    p = f"{tmp_dir}/o.nt"
    ex = "http://ex.org/o#"
    lines = [
        f"<{ex}Entity> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://www.w3.org/2002/07/owl#Class> .",
        f"<{ex}Person> <http://www.w3.org/2000/01/rdf-schema#subClassOf> <{ex}Entity> .",
        f"<{ex}works_for> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://www.w3.org/2002/07/owl#ObjectProperty> .",
        f"<{ex}works_for> <http://www.w3.org/2000/01/rdf-schema#domain> <{ex}Person> .",
        f'<{ex}works_for> <http://www.w3.org/2000/01/rdf-schema#comment> "{{sbj}} works for {{obj}}"@en .',
    ]
    open(p, "w").write("\n".join(lines) + "\n")
    o = read_ontology(spark, p)
    assert {(r.name, r.parent) for r in o["class"].collect()} >= {("Person", "Entity")}
    assert [r.text for r in o["template"].collect()] == ["{sbj} works for {obj}"]
    assert [(r.prop, r["class"]) for r in o["domain"].collect()] == [("works_for", "Person")]


SCHEMA = "article_id long, datetime string, title string, text string"


def test_stream_ingest_and_dedup_equal_batch(spark, tmp_dir):
    from newsgraph.streaming.ingest import stream_ingest, stream_title_dedup
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(SCHEMA)
    rows = [(0, "20200101", "A", "x"), (1, "20200101", "B", "y"), (2, "20200101", "A", "z"),
            (3, "20200102", "A", "w"), (4, "20200102", None, "p"), (5, "20200102", None, "q")]
    src = f"{tmp_dir}/src"
    spark.createDataFrame(rows[:3], SCHEMA).write.parquet(f"{src}/f1")
    q = stream_ingest(spark, f"{src}/*", f"{tmp_dir}/land", f"{tmp_dir}/ck1", schema)
    q.awaitTermination()
    spark.createDataFrame(rows[2:], SCHEMA).write.parquet(f"{src}/f2")   # day 1 re-fetched (row 2 again)
    q = stream_ingest(spark, f"{src}/*", f"{tmp_dir}/land", f"{tmp_dir}/ck1", schema)
    q.awaitTermination()
    landed = spark.read.parquet(f"{tmp_dir}/land")
    assert sorted(r.article_id for r in landed.collect()) == [0, 1, 2, 3, 4, 5]
    q = stream_title_dedup(spark, f"{src}/*", f"{tmp_dir}/dd", f"{tmp_dir}/ck2", schema)
    q.awaitTermination()
    got = sorted(r.article_id for r in spark.read.parquet(f"{tmp_dir}/dd").collect())
    want = sorted(r.article_id for r in dedup.dedup_title_keep_last(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == want == [1, 2, 3, 5]


def test_stream_daily_counts(spark, tmp_dir):
    from newsgraph.streaming.ingest import stream_daily_counts
    from pyspark.sql.types import StructType
    ev = spark.range(48).select((F.lit(1577836800) + F.col("id") * 3600).cast("timestamp").alias("ts"))
    ev.write.parquet(f"{tmp_dir}/ev")
    q = stream_daily_counts(spark, f"{tmp_dir}/ev", f"{tmp_dir}/ck3", StructType.fromDDL("ts timestamp"),
                            lateness="1 hour", name="dc_test")
    q.awaitTermination()
    got = {r.datetime: r.n for r in spark.sql("SELECT * FROM dc_test").collect()}
    assert got.get("20200101") == 24


def test_pipeline_order_and_unknown(spark):
    df = spark.createDataFrame([(0, "20200101", "A", "Hello―there. Next one!"), (1, "20200101", "A", "x")], SCHEMA)
    out = run_pipeline(df, ["preprocess", "erase_similar", "split_sentence"], PipelineConfig())
    r = out.collect()
    assert [x.article_id for x in r] == [1]
    try:
        run_pipeline(df, ["nope"])
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_day_predicates_inclusive():
    from newsgraph.sources.ingest import day_predicates
    assert day_predicates("20200228", "20200302") == [
        "datetime = '20200228'", "datetime = '20200229'", "datetime = '20200301'", "datetime = '20200302'"]


def test_write_by_day_keeps_order(spark, tmp_dir):
    df = spark.createDataFrame([(i, "20200101") for i in (5, 3, 9, 1)], "article_id long, datetime string").coalesce(1)
    write_by_day(df, f"{tmp_dir}/o", "json", order_col="article_id")
    assert [r.article_id for r in spark.read.json(f"{tmp_dir}/o").collect()] == [1, 3, 5, 9]


def test_stream_ingest_replay_is_idempotent(spark, tmp_dir):
    """All source files replayed under a fresh checkpoint (every batch seen
    again): the landed days hold each key once."""
    from newsgraph.streaming.ingest import stream_ingest
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(SCHEMA)
    rows = [(0, "20200101", "A", "x"), (1, "20200101", "B", "y"), (2, "20200102", "C", "z")]
    src = f"{tmp_dir}/src"
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{src}/f1")
    stream_ingest(spark, f"{src}/*", f"{tmp_dir}/land", f"{tmp_dir}/ck_a", schema).awaitTermination()
    stream_ingest(spark, f"{src}/*", f"{tmp_dir}/land", f"{tmp_dir}/ck_b", schema).awaitTermination()
    landed = spark.read.parquet(f"{tmp_dir}/land")
    assert sorted(r.article_id for r in landed.collect()) == [0, 1, 2]


def test_csv_columns_follow_their_names(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    for name, lines in [("2020_a.csv", ["title,text,datetime", "T1,x1,20200101"]),
                        ("2021_b.csv", ["text,title,datetime", "x2,T2,20210101"]),
                        ("2024b.csv", ["title,text", "T3,x3"]), ("plain.csv", ["title,text", "T4,x4"])]:
        with open(f"{tmp_dir}/in/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    rows = read_articles(spark, f"{tmp_dir}/in").collect()
    assert sorted((r.title, r.text, r.datetime) for r in rows) == [
        ("T1", "x1", "20200101"), ("T2", "x2", "20210101"), ("T3", "x3", None), ("T4", "x4", None)]
    from newsgraph.sources.readers import ARTICLE_SCHEMA
    typed = read_articles(spark, f"{tmp_dir}/in", schema=ARTICLE_SCHEMA)
    assert typed.schema == ARTICLE_SCHEMA and {r.title for r in typed.collect()} == {"T1", "T2", "T3", "T4"}
    assert read_articles(spark, f"{tmp_dir}/in", sample=2).count() == 2


def _stream(spark, tmp_dir, run, batches, schema):
    from pyspark.sql.types import StructType
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/src/f{i}")
        run(spark, f"{tmp_dir}/src/*", f"{tmp_dir}/dst", f"{tmp_dir}/ck", StructType.fromDDL(schema)).awaitTermination()
    return sorted((r.article_id, r.datetime, r.title, r.text) for r in spark.read.schema(SCHEMA).parquet(
        f"{tmp_dir}/dst").collect())


def test_stream_ingest_newest_version_and_moved_day(spark, tmp_dir):
    from newsgraph.streaming.ingest import stream_ingest
    got = _stream(spark, tmp_dir, stream_ingest, [
        [(1, "20200101", "A", "old"), (2, "20200102", "B", "y")],
        [(1, "20200103", "A", "new")],              # moved: its first day is left empty
        [(2, "20200102", "B", "v1")], [(2, "20200102", "B", "v2")]], SCHEMA)
    assert got == [(1, "20200103", "A", "new"), (2, "20200102", "B", "v2")]


def test_stream_title_dedup_retitle_equals_batch(spark, tmp_dir):
    from newsgraph.streaming.ingest import stream_title_dedup
    got = _stream(spark, tmp_dir, stream_title_dedup, [
        [(1, "20200101", "A", "x"), (2, "20200101", "A", "y")],
        [(2, "20200101", "C", "z")]], SCHEMA)
    assert got == [(1, "20200101", "A", "x"), (2, "20200101", "C", "z")]


def test_a_failed_read_is_not_an_empty_table(spark, tmp_dir):
    import pytest
    os.makedirs(f"{tmp_dir}/t")
    with open(f"{tmp_dir}/t/part-0.parquet", "w") as f:
        f.write("this is no parquet file")
    with pytest.raises(Exception):
        ingest.read_landed(spark, f"{tmp_dir}/t").collect()
    assert ingest.read_landed(spark, f"{tmp_dir}/missing") is None


def test_pipeline_runs_each_stage_once(spark, tmp_dir):
    ran = spark.sparkContext.accumulator(0)

    def count(rows):
        for pdf in rows:
            ran.add(len(pdf))
            yield pdf

    stage = lambda df, cfg: df.mapInPandas(count, df.schema)
    df = spark.createDataFrame([(i, "20200101", f"T{i}", "x y z.") for i in range(20)], SCHEMA)
    cfg = PipelineConfig(output_path=f"{tmp_dir}/out", extra_stages={"counted": stage})
    out = run_pipeline(df, ["counted", "preprocess", "split_sentence"], cfg)
    assert out.count() == 20 and ran.value == 20
