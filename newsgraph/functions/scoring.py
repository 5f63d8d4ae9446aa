"""Score contract (K1-K5).

A *scorer* adds a numeric column.  Accepted forms:

* a ``Column`` expression or a ``callable(df) -> Column`` (JVM-side);
* a ``DataFrame`` score table ``(key..., score)`` joined on its keys;
* a fitted ``pyspark.ml`` ``Transformer`` whose ``rawPrediction`` margin of
  class 1 becomes the score;
* a pandas UDF (``@pandas_udf``) called on named input columns, for a model
  loaded once per Python worker.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx


def score(df: DataFrame, scorer, out_col: str = "score", keys: list[str] | None = None,
          inputs: list[str] | None = None) -> DataFrame:
    """K1: add ``out_col`` to ``df`` using any scorer form above."""
    if isinstance(scorer, Column):
        return df.withColumn(out_col, scorer)
    if isinstance(scorer, DataFrame):
        keys = keys or [c for c in scorer.columns if c != out_col and c in df.columns]
        return df.join(scorer.select(*keys, out_col), keys, "left")
    try:
        from pyspark.ml import Transformer
        if isinstance(scorer, Transformer):
            from pyspark.ml.functions import vector_to_array
            out = scorer.transform(df)
            out = out.withColumn(out_col, vector_to_array("rawPrediction")[1])
            return out.select(*df.columns, out_col)
    except ImportError:  # pragma: no cover
        pass
    if hasattr(scorer, "evalType") and inputs:
        return df.withColumn(out_col, scorer(*[F.col(c) for c in inputs]))
    if callable(scorer):
        return df.withColumn(out_col, scorer(df))
    raise TypeError(f"unsupported scorer {scorer!r}")


def token_share(hyp_col, premise_tokens_col) -> Column:
    """K4: share of the hypothesis' distinct word tokens found in the premise
    token set, in [0, 1] (0 for a hypothesis with no tokens)."""
    h = F.array_distinct(tx.word_tokens(hyp_col))
    return F.when(F.size(h) > 0, F.size(F.array_intersect(h, premise_tokens_col)) / F.size(h)) \
        .otherwise(F.lit(0.0))


def char_overlap(word_col, label_col) -> Column:
    """K5: share of the label's distinct lower-case characters that also
    occur in the word."""
    lab = F.array_distinct(F.split(F.lower(label_col), ""))
    wrd = F.array_distinct(F.split(F.lower(word_col), ""))
    return F.when(F.size(lab) > 0, F.size(F.array_intersect(lab, wrd)) / F.size(lab)).otherwise(F.lit(0.0))


def nli_softmax(logits_col, use_neutral: bool = True) -> Column:
    """Entailment probability from NLI logits [entail, neutral, contra].

    ``use_neutral``: 3-way softmax, class 0.  Otherwise the row-wise 2-way
    softmax of (entail, contradiction)."""
    z = F.col(logits_col) if isinstance(logits_col, str) else logits_col
    if use_neutral:
        m = F.array_max(z)
        s = F.aggregate(z, F.lit(0.0), lambda acc, x: acc + F.exp(x - m))
        return F.exp(F.element_at(z, 1) - m) / s
    a, c = F.element_at(z, 1), F.element_at(z, 3)
    m = F.greatest(a, c)
    return F.exp(a - m) / (F.exp(a - m) + F.exp(c - m))
