"""Article files through the Python data source, and the other article formats."""
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.sources import articles
from newsgraph.sources.articles import ArticleFiles, file_schema
from newsgraph.sources.readers import read_articles, read_label_index

STRINGS = T.StructType([T.StructField(c, T.StringType()) for c in ("datetime", "title", "text")])


def _write(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
            f.write(text)


FILES = {
    "2019_a.csv": ',title,text,datetime\n0,T0,"a ""quoted"" line\nand another, with commas",20190101\n1,,"",20190102\n',
    "2020_b.csv": "text,datetime,title\nx2,20200101,T2\n",          # other order
    "2020_c.csv": "title,text,extra\r\nT3,x3,e3\r\n\r\n",            # a column more, one less, an empty line
    "2021_d.csv": "﻿title,text,datetime\n漢字,ça,20210101\n",   # byte order mark
    "notes.csv": "title,text\nT5,x5\n",                              # no year
    "empty.csv": "",
    "2022_only_header.csv": "title,text\n",
    "_hidden.csv": "title\nno\n",
}


def _load(spark, path, schema=STRINGS, groups=3):
    spark.dataSource.register(ArticleFiles)
    return (spark.read.format("article_files").schema(file_schema(schema)).option("path", path)
            .option("groups", groups).load())


def test_mixed_headers(spark, tmp_dir):
    _write(f"{tmp_dir}/in", FILES)
    want = [("20190101", "T0", 'a "quoted" line\nand another, with commas'), ("20190102", None, ""),
            ("20200101", "T2", "x2"), ("20210101", "漢字", "ça"), (None, "T3", "x3"), (None, "T5", "x5")]
    for groups in (1, 3, 50):
        df = _load(spark, f"{tmp_dir}/in", groups=groups)
        assert df.rdd.getNumPartitions() == groups
        rows = df.select("datetime", "title", "text").collect()
        assert sorted(map(tuple, rows), key=lambda r: (r[0] or "9", r[1] or "")) == want
    years = {os.path.basename(r[0]): r[1] for r in df.select(articles.SOURCE_FILE, articles.FILE_YEAR).collect()}
    assert years == {"2019_a.csv": 2019, "2020_b.csv": 2020, "2020_c.csv": 2020, "2021_d.csv": 2021, "notes.csv": None}
    all_columns = read_articles(spark, f"{tmp_dir}/in")
    assert set(all_columns.columns) == {"original_index", "title", "text", "datetime", "extra"}
    assert [r.extra for r in all_columns.where("title = 'T3'").collect()] == ["e3"]


def test_years_are_pushed_and_other_files_stay_closed(spark, tmp_dir):
    _write(f"{tmp_dir}/in", {"2020_b.csv": FILES["2020_b.csv"], "2020_c.csv": FILES["2020_c.csv"]})
    with open(f"{tmp_dir}/in/2018_broken.csv", "wb") as f:
        f.write(b"title,text\n\xff\xfe\xff,broken\n")                # no UTF-8: fails where it is opened
    with pytest.raises(Exception):
        _load(spark, f"{tmp_dir}/in").collect()
    year = F.col(articles.FILE_YEAR)
    for cond, n in [(year == 2020, 2), ((year > 2018) & (year <= 2020), 2), (year.isin(2020, 2021), 2),
                    ((year >= 2019) & (year < 2020), 0)]:
        df = _load(spark, f"{tmp_dir}/in").where(cond)
        assert df.count() == n
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Filter " not in plan, plan                           # the source has taken all of it
    assert read_articles(spark, f"{tmp_dir}/in", years=(2019, 2021), schema=STRINGS).count() == 2
    both = _load(spark, f"{tmp_dir}/in").where((year == 2020) & (F.col("title") == "T3"))
    assert [r.text for r in both.collect()] == ["x3"]                # Spark decides the other half


def test_paths_and_long_texts(spark, tmp_dir, monkeypatch):
    long = "word " * 400_000
    _write(f"{tmp_dir}/a", {"2020.csv": f'title,text\nlong,"{long}"\n' + "".join(f"t{i},x\n" for i in range(5000))})
    _write(f"{tmp_dir}/b", {"2020.csv": "title,text\nother,y\n"})
    df = _load(spark, json.dumps([f"{tmp_dir}/a", f"{tmp_dir}/b/2020.csv"]))
    assert df.count() == 5002
    assert df.where("title = 'long'").select(F.length("text")).first()[0] == len(long)
    assert _load(spark, f"file://{tmp_dir}/b").count() == 1
    with pytest.raises(Exception, match="missing"):
        _load(spark, f"{tmp_dir}/missing").collect()
    wrong = T.StructType([T.StructField("title", T.LongType())])
    with pytest.raises(Exception, match="cast it afterwards"):
        _load(spark, f"{tmp_dir}/b", wrong).collect()


def test_json_and_parquet_articles_by_year(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/j")
    for year in (2019, 2020):
        with open(f"{tmp_dir}/j/{year}0101.json", "w") as f:
            f.write(json.dumps({"title": f"T{year}", "text": "x", "datetime": f"{year}0101"}) + "\n")
    assert [r.title for r in read_articles(spark, f"{tmp_dir}/j", "json", years=[2020]).collect()] == ["T2020"]
    assert read_articles(spark, f"{tmp_dir}/j", "json").count() == 2
    assert read_articles(spark, f"{tmp_dir}/j", "json").columns == ["datetime", "text", "title"]


def test_label_index(spark, tmp_dir):
    with open(f"{tmp_dir}/labels.json", "w") as f:
        json.dump({"2020_a.csv": [3, 1, 3], "2020_b.csv": []}, f, indent=2)
    assert sorted(map(tuple, read_label_index(spark, f"{tmp_dir}/labels.json").collect())) == [
        ("2020_a.csv", 1), ("2020_a.csv", 3)]
