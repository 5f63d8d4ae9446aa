"""Versioned day tables: whole versions, pinned readers, failures between the writes."""
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from newsgraph.operators.dedup import dedup_title_keep_last
from newsgraph.sources import files
from newsgraph.sources.daytable import DayTable, VersionConflict
from newsgraph.streaming.ingest import stream_ingest, stream_title_dedup

DDL = "article_id long, datetime string, title string, text string"
SCHEMA = StructType([StructField("article_id", LongType()),
                     *(StructField(n, StringType()) for n in ("datetime", "title", "text"))])


def _rows(spark, *rows):
    return spark.createDataFrame([(i, d, t, "x") for i, d, t in rows], DDL)


def _titles(df):
    return sorted(((r.datetime or ""), r.article_id, r.title) for r in df.collect())


def test_versions_replace_days_and_stay_readable(spark, tmp_dir):
    t = DayTable(spark, f"{tmp_dir}/t", SCHEMA)
    assert t.version() == 0 and t.read().count() == 0
    t.replace(_rows(spark, (1, "20200101", "a"), (2, "20200102", "b"), (3, None, "n"), (4, "a/b=c %", "odd")))
    pinned = t.read()
    t.replace(_rows(spark, (5, "20200102", "c")))
    days = spark.createDataFrame([("20200101",), (None,), ("a/b=c %",), ("19990101",)], "d string")
    assert t.replace(_rows(spark), days) == 3
    assert _titles(t.read()) == [("20200102", 5, "c")]
    assert _titles(t.read(2)) == [("", 3, "n"), ("20200101", 1, "a"), ("20200102", 5, "c"), ("a/b=c %", 4, "odd")]
    assert _titles(pinned) == _titles(t.read(1)) and pinned.count() == 4
    assert {r.day for r in t.read(1).collect()} == {"20200101", "20200102", None, "a/b=c %"}


def test_a_day_filter_prunes_folders(spark, tmp_dir):
    t = DayTable(spark, f"{tmp_dir}/t", SCHEMA)
    t.replace(_rows(spark, (1, "20200101", "a"), (2, "20200102", "b")))
    t.replace(_rows(spark, (3, "20200103", "c")))
    one = t.read().where("day = '20200103'")
    assert [r.article_id for r in one.collect()] == [3]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_failure_between_the_writes_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    t = DayTable(spark, f"{tmp_dir}/t", SCHEMA)
    t.replace(_rows(spark, (1, "20200101", "a"), (2, "20200102", "b")))

    def die(*a):
        raise OSError("lost between the rows and the manifest")

    with monkeypatch.context() as m:
        m.setattr(files, "publish_text", die)
        with pytest.raises(OSError):
            t.replace(_rows(spark, (9, "20200101", "z"), (9, "20200102", "z")))
    assert t.version() == 1 and _titles(t.read()) == [("20200101", 1, "a"), ("20200102", 2, "b")]
    assert t.collect(older_than=3600) == []                  # may belong to a writer at work
    assert len(t.collect(older_than=0)) == 1                 # the orphan of the failed write
    assert len(os.listdir(f"{tmp_dir}/t/data")) == 1
    t.replace(_rows(spark, (3, "20200102", "c")))
    assert _titles(t.read()) == [("20200101", 1, "a"), ("20200102", 3, "c")]


def test_collect_keeps_what_kept_versions_name(spark, tmp_dir):
    t = DayTable(spark, f"{tmp_dir}/t", SCHEMA)
    for i, day in enumerate(["20200101", "20200102", "20200102", "20200102"]):
        t.replace(_rows(spark, (i, day, "t")))
    assert len(t.collect(keep=2, older_than=0)) == 1 and t.versions() == [3, 4]
    assert _titles(t.read(3)) == [("20200101", 0, "t"), ("20200102", 2, "t")]
    assert _titles(t.read()) == [("20200101", 0, "t"), ("20200102", 3, "t")]


def test_two_writers_on_one_version(spark, tmp_dir):
    t = DayTable(spark, f"{tmp_dir}/t", SCHEMA)
    t.replace(_rows(spark, (1, "20200101", "a")))
    t.replace(_rows(spark, (2, "20200101", "b")), built_on=1)
    with pytest.raises(VersionConflict):
        t.replace(_rows(spark, (3, "20200101", "c")), built_on=1)
    assert _titles(t.read()) == [("20200101", 2, "b")]
    assert not [n for n in os.listdir(f"{tmp_dir}/t/versions") if n.startswith(".0") and "json" in n
                and not n.endswith(".crc")]


BATCHES = [[(1, "20200101", "A"), (2, "20200101", "A"), (3, "20200102", "B")],
           [(2, "20200101", "C"), (3, "20200103", "B"), (4, "20200103", "B")],
           [(1, "20200104", "A"), (2, "20200104", "A")]]
LAST = [(1, "20200104", "A"), (2, "20200104", "A"), (3, "20200103", "B"), (4, "20200103", "B")]


def _feed(spark, tmp_dir, run, table):
    for i, rows in enumerate(BATCHES):
        _rows(spark, *rows).coalesce(1).write.parquet(f"{tmp_dir}/src/f{i}")
        run(spark, f"{tmp_dir}/src/*", table, f"{tmp_dir}/ck", SCHEMA).awaitTermination()


def test_streams_into_a_day_table_equal_batch(spark, tmp_dir):
    raw = DayTable(spark, f"{tmp_dir}/raw", SCHEMA)
    _feed(spark, f"{tmp_dir}/a", stream_ingest, raw)
    assert _titles(raw.read()) == _titles(_rows(spark, *LAST)) and raw.version() == 3
    dd = DayTable(spark, f"{tmp_dir}/dd", SCHEMA)
    _feed(spark, f"{tmp_dir}/b", stream_title_dedup, dd)
    assert _titles(dd.read()) == _titles(dedup_title_keep_last(_rows(spark, *LAST)))


def test_a_stream_that_dies_in_a_batch_goes_on(spark, tmp_dir, monkeypatch):
    """The second batch fails after its rows are written: the readers keep the
    first version, and the restarted stream does the batch anew."""
    t = DayTable(spark, f"{tmp_dir}/t", SCHEMA)
    _rows(spark, *BATCHES[0]).coalesce(1).write.parquet(f"{tmp_dir}/src/f0")
    stream_ingest(spark, f"{tmp_dir}/src/*", t, f"{tmp_dir}/ck", SCHEMA).awaitTermination()
    _rows(spark, *BATCHES[1]).coalesce(1).write.parquet(f"{tmp_dir}/src/f1")

    def die(*a):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(files, "publish_text", die)
        with pytest.raises(Exception):
            stream_ingest(spark, f"{tmp_dir}/src/*", t, f"{tmp_dir}/ck", SCHEMA).awaitTermination()
    assert _titles(t.read()) == _titles(_rows(spark, *BATCHES[0]))
    stream_ingest(spark, f"{tmp_dir}/src/*", t, f"{tmp_dir}/ck", SCHEMA).awaitTermination()
    assert _titles(t.read()) == [("20200101", 1, "A"), ("20200101", 2, "C"), ("20200103", 3, "B"),
                                 ("20200103", 4, "B")]


def test_plain_folder_clears_its_staging(spark, tmp_dir):
    _feed(spark, tmp_dir, stream_ingest, f"{tmp_dir}/plain")
    assert not [n for n in os.listdir(f"{tmp_dir}/plain_staging") if n.startswith("batch=")]
    assert spark.read.schema(DDL).parquet(f"{tmp_dir}/plain").select(F.col("article_id")).count() == 4
