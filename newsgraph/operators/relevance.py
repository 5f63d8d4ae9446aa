"""C4 relevance filter, K2 relevance model, C10 prediction listing."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.scoring import score
from ..session import materialize
from .common import attach_row, join_terms


def relevance_filter(df: DataFrame, scorer, threshold: float = -0.4, out_col: str = "score",
                     keep_score: bool = True, **kw) -> DataFrame:
    """C4: keep rows whose class-1 score is ≥ threshold (inclusive).

    The score column is computed once in a projection and the filter reads
    that column, so a model scorer is not evaluated twice."""
    s = score(df, scorer, out_col, **kw)
    kept = s.where(F.col(out_col) >= threshold)
    return kept if keep_score else kept.drop(out_col)


def fit_relevance(df: DataFrame, label_col: str = "label", title_col: str = "title",
                  text_col: str = "text", num_features: int = 1 << 18, max_iter: int = 20):
    """K2: a distributed relevance classifier on title + text.

    RegexTokenizer -> HashingTF -> IDF -> LogisticRegression; the fitted
    pipeline is a scorer for ``relevance_filter`` (its margin of class 1 is
    the score, so the threshold is on a logit, as in the reference)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, SQLTransformer

    pair = SQLTransformer(statement=f"SELECT *, concat_ws(' ', {title_col}, {text_col}) AS _pair FROM __THIS__")
    tok = RegexTokenizer(inputCol="_pair", outputCol="_tok", pattern="[^\\p{L}\\p{N}]+", toLowercase=True)
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="features")
    lr = LogisticRegression(labelCol=label_col, featuresCol="features", maxIter=max_iter)
    return Pipeline(stages=[pair, tok, tf, idf, lr]).fit(df)


def _terms(df: DataFrame, keep: list, title_col: str, text_col: str) -> DataFrame:
    """``keep`` columns, ``term``, ``n``: one row per distinct term of a row,
    counted inside the row."""
    counts = tx.term_counts(tx.word_tokens(F.concat_ws(" ", title_col, text_col)))
    counted = df.select(*keep, F.explode(counts).alias("_c"))
    return counted.select(*counted.columns[:-1], "_c.term", "_c.n")


def fit_term_odds(df: DataFrame, label_col: str = "label", title_col: str = "title",
                  text_col: str = "text") -> DataFrame:
    """K2: multinomial naive Bayes on the word counts of *all* labelled rows.

    ``(term, weight, n, prior)``: the smoothed log odds of a term between label 1
    and label 0, how often it stands in the labelled rows, and the log odds of
    the labels themselves on every row."""
    rows = df.where(F.col(label_col).isin(0, 1))
    prior = rows.agg((F.log(F.count(F.when(F.col(label_col) == 1, 1)) + 1)
                      - F.log(F.count(F.when(F.col(label_col) == 0, 1)) + 1)).alias("prior"))
    sums = lambda y: F.coalesce(F.sum(F.when(F.col("_y") == y, F.col("n"))), F.lit(0))
    counts = (_terms(rows, [F.col(label_col).alias("_y")], title_col, text_col)
              .groupBy("term").agg(sums(1).alias("pos"), sums(0).alias("neg")))
    totals = counts.agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"), F.count("*").alias("_v"))
    weight = (F.log((F.col("pos") + 1) / (F.col("_p") + F.col("_v")))
              - F.log((F.col("neg") + 1) / (F.col("_n") + F.col("_v"))))
    return attach_row(attach_row(counts, totals).select(
        "term", weight.alias("weight"), (F.col("pos") + F.col("neg")).alias("n")), prior)


def term_odds_scores(df: DataFrame, model: DataFrame, id_col: str = "article_id", title_col: str = "title",
                     text_col: str = "text") -> DataFrame:
    """``(id, score)``: the log odds of the model that was fitted, that is the
    prior plus every known term's weight times its count in the row; a score
    table for ``relevance_filter``.  Rows without a known term score the
    prior."""
    terms = _terms(df, [id_col], title_col, text_col)
    model = materialize(model)                       # read for the prior and for the weights
    weights = model.select("term", "weight", F.col("n").alias("freq"))
    sums = join_terms(terms, weights, "term", "freq").groupBy(id_col).agg(F.sum(F.col("weight") * F.col("n")).alias("_w"))
    prior = model.agg(F.max("prior").alias("_prior"))
    return (attach_row(df.select(id_col).join(sums, id_col, "left"), prior)
            .select(id_col, (F.col("_prior") + F.coalesce("_w", F.lit(0.0))).alias("score")))


def predicted_positives(df: DataFrame, logits_col: str = "logits", positive: int = 1) -> DataFrame:
    """Rows whose argmax label (first maximum, 0-based) is ``positive``."""
    am = F.array_position(logits_col, F.array_max(logits_col)) - 1
    return df.withColumn("pred", am.cast("int")).where(F.col("pred") == positive)


def confusion(df: DataFrame, label_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """Counts per (label, prediction)."""
    return df.groupBy(label_col, pred_col).agg(F.count("*").alias("n"))
