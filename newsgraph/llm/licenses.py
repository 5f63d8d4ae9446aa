"""License scan by diagonal voting.

Texts and license templates are sequences of words.  Every run of k words of a
text (k = ``SHORT`` for templates under ``LONG`` words, else ``LONG``) whose
hash is that of a template's run is joined with the template's positions; the
hashes of the templates, a fixed set, are pushed down as a filter before the
positions are exploded, and the join compares the words themselves.  A hit at
text position p and template position q votes for the diagonal p - q.  Votes
are aggregated by (text, template, diagonal); neighbouring diagonals, no more
than a tenth of the template's words apart (an inserted or lost word moves the
diagonal), are merged.  A merged span is verified by the share of the
template's runs found in it, ``MIN_COVER`` at least, and by its length, twice
the template's at most.  Base phrases are templates of one run: a hit is a
place where the phrase stands.

Null text counts as empty.  Rows are told apart even with equal or null ids;
extra columns are ignored.  Texts without a license keep empty labels, null
positions and score 0.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import let, stage

SHORT, LONG = 2, 4
MIN_COVER = 0.6
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Phrases and opening sentences of public licenses.
TEMPLATES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "creative commons attribution": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "all rights reserved": "all-rights-reserved",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
    "the license you may obtain a copy of the license at": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
}


def _templates(phrases: list[tuple[str, str, bool]]) -> list[tuple]:
    """(template, label, base, n_grams, slack, n_words, k, q, gram) rows."""
    rows = []
    for t, (phrase, label, base) in enumerate(phrases):
        ws = phrase.split()
        k = LONG if len(ws) >= LONG else SHORT
        grams = len(ws) - k + 1
        rows += [(t, label, base, grams, len(ws) // 10, len(ws), k, q, " ".join(ws[q:q + k])) for q in range(grams)]
    return rows


PHRASES = [(p, label, True) for p, label in BASE.items()] + [(p, label, False) for p, label in TEMPLATES.items()]
ROWS = _templates(PHRASES)
_SCHEMA = ("template int, label string, base boolean, n_grams int, slack int, template_words int, "
           "k int, q int, gram string")


def license_words(text: Column) -> Column:
    upper = "".join(chr(c) for c in range(65, 91))
    text = F.translate(F.coalesce(text.cast("string"), F.lit("")), upper, upper.lower())
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(0))


def _gram_hashes(spark: SparkSession) -> dict[int, list[int]]:
    """Hashes of the templates' runs, by k, as Spark computes them."""
    table = spark.createDataFrame(ROWS, _SCHEMA).select("k", "gram").distinct()
    hashed = table.withColumn("h", _run_hash(F.transform(F.split("gram", " "), lambda w: F.xxhash64(w)), F.lit(0), F.col("k")))
    out: dict[int, list[int]] = {SHORT: [], LONG: []}
    for r in hashed.collect():
        out[r["k"]].append(r["h"])
    return out


def _run_hash(h: Column, i: Column, k: Column | int) -> Column:
    if isinstance(k, int):
        return F.xxhash64(*(F.get(h, i + j) for j in range(k)))
    return F.when(k == SHORT, _run_hash(h, i, SHORT)).otherwise(_run_hash(h, i, LONG))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and the hits (k, p, gram) of every row, with a key."""
    known = _gram_hashes(docs.sparkSession)

    def hits(ws: Column, k: int) -> Column:
        def found(h: Column) -> Column:
            places = F.filter(F.transform(h, lambda w, i: F.when(
                (i + k <= F.size(h)) & F.coalesce(_run_hash(h, i, k).isin(known[k]), F.lit(False)), i)),
                lambda p: p.isNotNull())
            return F.transform(places, lambda p: F.struct(
                F.lit(k).alias("k"), p.cast("long").alias("p"),
                F.array_join(F.slice(ws, p + 1, F.lit(k)), " ").alias("gram")))
        return let(F.transform(ws, lambda w: F.xxhash64(w)), found)

    facts = let(license_words(F.col("text")), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"), F.concat(hits(ws, SHORT), hits(ws, LONG)).alias("hits")))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), facts.alias("f"))
            .select(F.monotonically_increasing_id().alias("row"), "doc_id", "f.n_words", "f.hits"))


def vote(scanned: DataFrame) -> DataFrame:
    """Verified spans: row, label, base, first, last (the spans' word range),
    cover.  A base phrase's every place is a span."""
    grams = F.broadcast(scanned.sparkSession.createDataFrame(ROWS, _SCHEMA))  # fixed, under 300 rows
    hits = scanned.select("row", F.explode("hits").alias("hit")).select("row", "hit.*").join(grams, ["k", "gram"])
    diagonals = (hits.withColumn("diagonal", F.col("p") - F.col("q"))
                 .groupBy("row", "template", "label", "base", "n_grams", "slack", "template_words", "diagonal")
                 .agg(F.min("p").alias("first"), F.max(F.col("p") + F.col("k")).alias("end"),
                      F.collect_set("q").alias("qs")))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > F.col("slack")
    merged = (diagonals.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int"))
              .withColumn("span", F.sum("apart").over(order))
              .groupBy("row", "template", "label", "base", "n_grams", "template_words", "span")
              .agg(F.min("first").alias("first"), F.max("end").alias("end"),
                   F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("found")))
    return (merged.withColumn("cover", F.col("found") / F.col("n_grams"))
            .where((F.col("cover") >= MIN_COVER) & (F.col("end") - F.col("first") <= 2 * F.col("template_words")))
            .select("row", "label", "base", "first", (F.col("end") - 1).alias("last"), "cover"))


def op4(docs: DataFrame) -> DataFrame:
    scanned = stage(scan(docs), "license-hits")
    labels = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    start = F.when(F.col("base"), F.col("first"))
    found = vote(scanned).groupBy("row").agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        labels(F.when(F.col("base"), F.col("label"))).alias("base_labels"), labels("label").alias("labels"),
        F.max("cover").alias("score"))
    return scanned.drop("hits").join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


_VALUES = ", ".join(f"({t}, '{label}', {base}, {n}, {slack}, {words}, {k}, {q}, '{gram}')"
                    for t, label, base, n, slack, words, k, q, gram in ROWS)
_ALPHABET = "".join(chr(c) for c in range(65, 91))

SQL = rf"""
WITH grams(template, label, base, n_grams, slack, template_words, k, q, gram) AS (VALUES {_VALUES}),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_ALPHABET}', '{_ALPHABET.lower()}'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), places AS (
  SELECT r, ws, unnest(range(0, len(ws))) AS p FROM d
), runs AS (
  SELECT r, p, k, array_to_string(ws[p + 1:p + k], ' ') AS gram, p + k <= len(ws) AS whole
  FROM places, (VALUES ({SHORT}), ({LONG})) AS s(k)
), hits AS (
  SELECT r, p, p - q AS diagonal, grams.* FROM runs JOIN grams USING (k, gram) WHERE whole
), diagonals AS (
  SELECT r, template, label, base, n_grams, slack, template_words, diagonal, min(p) AS first_p, max(p + k) AS end_p,
         list(DISTINCT q) AS qs
  FROM hits GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= slack
                 THEN 0 ELSE 1 END AS apart FROM diagonals
), numbered AS (
  SELECT *, sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM marked
), spans AS (
  SELECT r, template, label, base, n_grams, template_words, span, min(first_p) AS first_p, max(end_p) AS end_p,
         len(list_distinct(flatten(list(qs)))) AS found
  FROM numbered GROUP BY ALL
), verified AS (
  SELECT *, found / n_grams AS cover FROM spans
  WHERE found / n_grams >= {MIN_COVER} AND end_p - first_p <= 2 * template_words
), per_doc AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(first_p) FILTER (base) AS first_word,
         max(first_p) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
  FROM verified GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN per_doc USING (r)
"""
