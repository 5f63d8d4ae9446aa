"""Readers: article scans (A1-A5, H1, C11), label index (A10), ontology."""
from __future__ import annotations

import csv
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import articles

ARTICLE_SCHEMA = T.StructType([
    T.StructField("original_index", T.LongType()),
    T.StructField("datetime", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
])


_FILE = articles.SOURCE_FILE


def _csv_schema(spark: SparkSession, path: str | list[str]) -> T.StructType:
    """The columns of all files, by the order in which the headers (those of
    the first file in name order first) bring them.  The distinct headers reach
    the driver, not the files."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("at"))
    first = lines.where("at = 0").groupBy("file").agg(F.first("value").alias("header"))
    heads = first.groupBy("header").agg(F.min("file").alias("file")).orderBy("file")
    names: dict[str, None] = {}
    for r in heads.collect():
        header = next(csv.reader([r["header"].removeprefix("\ufeff")]), [])
        names.update(dict.fromkeys(articles.column_names(header)))
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _read_csv_by_name(spark: SparkSession, path: str | list[str], schema: T.StructType | None,
                      groups: int | None) -> DataFrame:
    columns = _csv_schema(spark, path) if schema is None else T.StructType(
        [T.StructField(f.name, T.StringType()) for f in schema.fields])
    spark.dataSource.register(articles.ArticleFiles)
    paths = [path] if isinstance(path, str) else list(path)
    out = (spark.read.format("article_files").schema(articles.file_schema(columns))
           .option("path", json.dumps(paths))
           .option("groups", groups or max(2 * spark.sparkContext.defaultParallelism, 2)).load())
    if schema is None:
        return out
    return out.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields), _FILE,
                      articles.FILE_YEAR)


def read_articles(spark: SparkSession, path: str | list[str], fmt: str = "csv",
                  years: tuple[int, int] | Iterable[int] | None = None,
                  schema: T.StructType | None = None,
                  sample: int | None = None, seed: int = 111, groups: int | None = None) -> DataFrame:
    """Scan article files in one job.

    * ``fmt`` is explicit ("csv", "json" or "parquet"); the reference guessed
      it from a substring of the first path.
    * ``years``: a ``(start, end)`` pair is end-exclusive; any other iterable
      is an explicit year list; ``None`` keeps every file.  The filter is on
      the first four characters of the *file name*, one job for all years; CSV
      files of other years are not opened.  A file without a year in front is
      left out by any filter.
    * CSV goes through the data source ``article_files``: ``groups`` tasks
      (default: twice the cluster's cores) each read their share of the files,
      and columns are aligned by name (a column that a file lacks is null).
      With ``schema`` its columns are picked by name; without one the headers
      are read first.  A file is read by one task, in batches.
    * A pandas index column ``__index_level_0__`` is dropped, and the
      unnamed leading index column is renamed ``original_index``, both only
      when present.
    * ``sample``: keep ``sample`` files chosen by a seeded hash of the path
      (debug runs); rows of the other files are never read.
    """
    if fmt == "csv":
        df = _read_csv_by_name(spark, path, schema, groups)
    else:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.format(fmt).load(path).select("*", F.col("_metadata.file_path").alias(_FILE))
        head = F.substring(F.element_at(F.split(_FILE, "/"), -1), 1, 4)
        df = df.withColumn(articles.FILE_YEAR, F.when(head.rlike("^[0-9]{4}$"), head.cast("int")))
    if years is not None:
        year = F.col(articles.FILE_YEAR)
        if isinstance(years, tuple) and len(years) == 2:
            df = df.where((year >= years[0]) & (year < years[1]))
        else:
            df = df.where(year.isin([int(y) for y in years]))
    if sample is not None:
        files = df.select(_FILE).distinct().orderBy(F.xxhash64(_FILE, F.lit(seed))).limit(sample)
        df = df.join(F.broadcast(files), _FILE, "left_semi")  # ``sample`` names
    df = df.drop(_FILE, articles.FILE_YEAR)
    if "__index_level_0__" in df.columns:
        df = df.drop("__index_level_0__")
    # the unnamed leading index column: pandas calls it 'Unnamed: 0', Spark's
    # CSV reader '_c0'
    for unnamed in ("Unnamed: 0", "_c0"):
        if unnamed in df.columns and "original_index" not in df.columns:
            df = df.withColumnRenamed(unnamed, "original_index")
    return df


def read_label_index(spark: SparkSession, path: str) -> DataFrame:
    """A10: a JSON object ``{file: [row positions]}`` -> rows ``(file, idx)``.

    The file is read as text (one job), parsed with ``from_json`` into a
    map and exploded twice.  Works for a single pretty-printed file.
    """
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", T.MapType(T.StringType(), T.ArrayType(T.IntegerType())))
    return (raw.select(F.explode(m).alias("file", "idxs"))
            .select("file", F.explode("idxs").alias("idx")).distinct())


_NT = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:@[A-Za-z-]+|\^\^<[^>]*>)?)\s*\.\s*$'
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
OWL = "http://www.w3.org/2002/07/owl#"


def read_ontology(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """N-Triples ontology -> the five ontology tables.

    ``class(name, parent)``, ``property(name, ord)``, ``domain(prop, class)``,
    ``range(prop, class)``, ``template(prop, ord, text)``.  Names are IRI
    local names.  Property and template ordinals follow file order.
    """
    lines = spark.read.text(path).withColumn("_ln", F.monotonically_increasing_id())
    t = lines.select(
        "_ln",
        F.regexp_extract("value", _NT, 1).alias("s"),
        F.regexp_extract("value", _NT, 2).alias("p"),
        F.regexp_extract("value", _NT, 3).alias("o_iri"),
        F.regexp_extract("value", _NT, 4).alias("o_lit"),
    ).where(F.col("s") != "")
    local = lambda c: F.regexp_extract(c, "([^#/]+)$", 1)
    t = t.select("_ln", local("s").alias("s"), "p", local("o_iri").alias("o"), "o_lit")
    is_type = F.col("p") == RDF + "type"
    classes_decl = t.where(is_type & (F.col("o") == "Class")).select(F.col("s").alias("name"))
    sub = t.where(F.col("p") == RDFS + "subClassOf").select(F.col("s").alias("name"),
                                                           F.col("o").alias("parent"))
    classes = (classes_decl.join(sub, "name", "left")
               .unionByName(sub).distinct())
    props = t.where(is_type & (F.col("o") == "ObjectProperty")).groupBy(F.col("s").alias("name")) \
        .agg(F.min("_ln").alias("_ln"))
    from pyspark.sql import Window as W
    props = props.select("name", (F.row_number().over(W.orderBy("_ln")) - 1).alias("ord"))
    domain = t.where(F.col("p") == RDFS + "domain").select(F.col("s").alias("prop"), F.col("o").alias("class"))
    rng = t.where(F.col("p") == RDFS + "range").select(F.col("s").alias("prop"), F.col("o").alias("class"))
    tmpl = t.where(F.col("p") == RDFS + "comment").select(
        F.col("s").alias("prop"), "_ln",
        F.regexp_replace(F.regexp_replace("o_lit", r'\\"', '"'), r"\\\\", r"\\").alias("text"))
    tmpl = tmpl.select("prop", (F.row_number().over(W.partitionBy("prop").orderBy("_ln")) - 1).alias("ord"),
                       "text")
    return {"class": classes, "property": props, "domain": domain, "range": rng, "template": tmpl}
