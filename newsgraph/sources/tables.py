"""Views over the driver's parquet tables that stand in for the reference's
inputs (articles, labels, ontology, NER mentions, generation traces,
coreference spans, source day marks).

Every view is a lazy DataFrame over the given tables, so its work grows
with them.  Each one is mirrored by a SQL view in ``plans/oracle.py``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.common import spread

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- fixed values of the stand-in ontology -----------------------------
# Root class; coarse classes are the region names, fine ones the nations.
ROOT_CLASS = "Entity"
# Properties in declaration order.
PROPERTIES = [("supplies", 0), ("partners_with", 1), ("located_near", 2), ("free", 3)]
DOMAINS = [("supplies", "ASIA"), ("supplies", "EUROPE"), ("partners_with", "Entity"),
           ("located_near", "MIDDLE EAST")]
RANGES = [("supplies", "AMERICA"), ("supplies", "AFRICA"), ("partners_with", "Entity"),
          ("located_near", "MIDDLE EAST"), ("located_near", "EUROPE")]
TEMPLATES = [("supplies", 0, "{sbj} supplies {obj}"),
             ("supplies", 1, "{sbj} ships goods to {obj}"),
             ("partners_with", 0, "{sbj} and {obj}"),
             ("partners_with", 1, "{sbj} supplies parts with {obj}"),
             ("located_near", 0, "{sbj} is near {obj}"),
             ("free", 0, "{sbj} {obj}")]
# The coarse class that keeps its coarse type (the reference's 'Person').
KEEP_COARSE = "AMERICA"
# Coarse tags with no class mapping (the reference's MISC branch).
UNMAPPED_REGION = "MIDDLE EAST"
# Stand-in coreference clusters: words matched as whole space-separated tokens.
COREF_WORDS = [(0, "The"), (0, "the"), (0, "This"), (0, "this"),
               (1, "it"), (1, "It's"), (1, "Its"),
               (2, "he"), (2, "He")]
# Generation-trace stand-in: end-of-sequence token id and entropy threshold.
END_TOKEN_ID = 2
ENTROPY_THRESHOLD = 1.0
# Glossary for the translation stand-in (source word -> English).
GLOSSARY = [("le", "the"), ("la", "the"), ("les", "the"), ("des", "of the"), ("du", "of the"),
            ("de", "of"), ("et", "and"), ("un", "a"), ("une", "a"), ("qui", "who"),
            ("pour", "for"), ("par", "by"), ("en", "in"), ("au", "to the"), ("elle", "she"),
            ("der", "the"), ("die", "the"), ("das", "the"), ("und", "and"), ("ein", "a"),
            ("eine", "a"), ("mit", "with"), ("von", "from"), ("ist", "is"), ("nicht", "not"),
            ("el", "the"), ("los", "the"), ("las", "the"), ("y", "and"), ("con", "with"),
            ("por", "by"), ("para", "for"), ("que", "that"), ("es", "is")]
# ------------------------------------------------------------------------


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 article table from ``documents``: the first line is the title and
    the day key spreads documents over seven consecutive days."""
    d = spread(table(spark, sf_dir, "documents"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 7).cast("int"))
    return d.select(
        F.col("doc_id").alias("article_id"),
        F.date_format(day, "yyyyMMdd").alias("datetime"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        "text", "lang", "source",
        F.col("doc_id").alias("original_index"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")


def ontology(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Ontology tables: Entity > region names > nation names."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    root = spark.createDataFrame([(ROOT_CLASS, None)], "name string, parent string")
    coarse = region.select(F.col("r_name").alias("name"), F.lit(ROOT_CLASS).alias("parent"))
    fine = nation.join(region, nation.n_regionkey == region.r_regionkey) \
        .select(F.col("n_name").alias("name"), F.col("r_name").alias("parent"))
    classes = root.unionByName(coarse).unionByName(fine)
    return {
        "class": classes,
        "property": spark.createDataFrame(PROPERTIES, "name string, ord int"),
        "domain": spark.createDataFrame(DOMAINS, "prop string, class string"),
        "range": spark.createDataFrame(RANGES, "prop string, class string"),
        "template": spark.createDataFrame(TEMPLATES, "prop string, ord int, text string"),
    }


def tag_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NER tag -> coarse class: a nation tag maps to its region, except the
    nations of one region, which stay unmapped (the MISC branch)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .where(F.col("r_name") != UNMAPPED_REGION)
            .select(F.col("n_name").alias("entity_group"), F.col("r_name").alias("type")))


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _line_pos():
    return F.row_number().over(W.partitionBy("l_orderkey").orderBy(*_LINE_ORDER))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NER output stand-in: one mention per order line, the word is the
    supplier name, the tag is the supplier's nation."""
    li = table(spark, sf_dir, "lineitem")
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    j = (li.join(sup, li.l_suppkey == sup.s_suppkey)
         .join(nat, sup.s_nationkey == nat.n_nationkey))
    return j.select(F.col("l_orderkey").alias("article_id"),
                    (_line_pos() - 1).cast("int").alias("pos"),
                    F.col("s_name").alias("word"), F.col("n_name").alias("entity_group"))


def type_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-shot typing model output stand-in, as a score table
    ``(word, label, score)``: a supplier name scores 1.0 for its nation and
    for its nation's region."""
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    reg = table(spark, sf_dir, "region")
    j = sup.join(nat, sup.s_nationkey == nat.n_nationkey).join(reg, nat.n_regionkey == reg.r_regionkey)
    return (j.select(F.col("s_name").alias("word"), F.col("n_name").alias("label"), F.lit(1.0).alias("score"))
            .unionByName(j.select(F.col("s_name").alias("word"), F.col("r_name").alias("label"),
                                  F.lit(1.0).alias("score"))))


def premises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Premise stand-in per order: '<supplier> supplies <part>' per line."""
    li = table(spark, sf_dir, "lineitem")
    sup = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part")
    j = li.join(sup, li.l_suppkey == sup.s_suppkey).join(part, li.l_partkey == part.p_partkey)
    line = F.concat_ws(" ", "s_name", F.lit("supplies"), "p_name")
    return (j.select(F.col("l_orderkey").alias("article_id"), _line_pos().alias("pos"),
                     line.alias("line"))
            .groupBy("article_id")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))),
                                          lambda x: x["line"]), ". ").alias("premise")))


def gen_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation-trace stand-in: one step per order line, a 4-way logit
    vector derived from the line's numbers and the line's part as token."""
    li = table(spark, sf_dir, "lineitem")
    z = F.array((F.col("l_quantity") / 50.0) * 5.0,
                (F.col("l_extendedprice") / 100000.0) * 5.0,
                (F.col("l_discount") * 10.0) * 5.0,
                (F.col("l_tax") * 10.0) * 5.0)
    return li.select(F.col("l_orderkey").alias("article_id"),
                     (_line_pos() - 1).cast("int").alias("step"),
                     z.alias("logits"),
                     F.concat(F.lit("tok"), F.col("l_partkey").cast("string")).alias("token"),
                     (F.col("l_returnflag") == "R").cast("int").alias("label"))


def nli_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NLI stand-in: three logits (entail, neutral, contradiction) per order
    line, from the line's discount, tax and quantity."""
    li = table(spark, sf_dir, "lineitem")
    z = F.array((F.col("l_discount") * 10.0) * 5.0, (F.col("l_tax") * 10.0) * 5.0,
                (F.col("l_quantity") / 50.0) * 5.0)
    return li.select(F.col("l_orderkey").alias("article_id"), (_line_pos() - 1).cast("int").alias("step"),
                     z.alias("logits"))


def _coref_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed words of ``documents`` with their offsets and the word behind."""
    d = table(spark, sf_dir, "documents")
    words = spark.createDataFrame(COREF_WORDS, "cluster_id int, string string")
    toks = d.select(F.col("doc_id").alias("article_id"),
                    F.posexplode(F.split("text", " ")).alias("tpos", "tok"))
    order = W.partitionBy("article_id").orderBy("tpos")
    w = order.rowsBetween(W.unboundedPreceding, -1)
    toks = toks.withColumn("start", F.coalesce(F.sum(F.length("tok") + 1).over(w), F.lit(0)))
    toks = toks.withColumn("next", F.lead("tok").over(order))
    return toks.join(F.broadcast(words), toks.tok == words.string)


def coref_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coreference span stand-in: offsets of listed words in ``documents``.

    Offsets are 0-based ``[start, end)`` over the text split on single
    spaces; a cluster is (article, word group)."""
    return _coref_tokens(spark, sf_dir).select(
        "article_id", "cluster_id", F.col("start").cast("int").alias("start"),
        (F.col("start") + F.length("tok")).cast("int").alias("end"), "string")


def coref_nested_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same words, and each with the word behind it as a mention of a
    second cluster: these nest, and overlap where two listed words meet."""
    t = _coref_tokens(spark, sf_dir)
    start = F.col("start").cast("int")
    word = F.struct("cluster_id", (F.col("start") + F.length("tok")).cast("int").alias("end"),
                    F.col("tok").alias("string"))
    two = F.struct((F.col("cluster_id") + 10).alias("cluster_id"),
                   (F.col("start") + F.length("tok") + 1 + F.length("next")).cast("int").alias("end"),
                   F.concat_ws(" ", "tok", "next").alias("string"))
    both = F.when(F.col("next").isNotNull(), F.array(word, two)).otherwise(F.array(word))
    return t.select("article_id", start.alias("start"), F.explode(both).alias("s")).select(
        "article_id", "s.cluster_id", "start", "s.end", "s.string")


def gen_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traces of ``gen_steps`` in long form: one row per step and token id."""
    s = gen_steps(spark, sf_dir)
    return s.select("article_id", "step", F.posexplode("logits").alias("token_id", "logit"))


def source_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote source stand-in for the catch-up job: events with a day key."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", tx.day_key("ts").alias("datetime"), "event_type", "value")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense vectors: ``label`` plays the day block."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("article_id"), F.col("label").cast("string").alias("datetime"),
                    F.col("embedding").cast("array<double>").alias("vec"))
