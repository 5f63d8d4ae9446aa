"""E8 step entropy, F4 end-marker prefix, F5 uncertain tokens (C9 filter).

A generation trace is a table of steps ``(article_id, step, logits
array<double>)`` — the array form keeps one row per step, so the softmax and
entropy are in-row expressions with no shuffle — plus the chosen token per
step ``(article_id, step, token)``.  A long-form trace ``(article_id, step,
token_id, logit)`` is scored by ``step_entropy_long``, or packed to the array
form by ``pack_logits``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pack_logits(long_df: DataFrame, id_col: str = "article_id") -> DataFrame:
    """Long form -> array form (one group per step: bounded by the vocabulary)."""
    return (long_df.groupBy(id_col, "step")
            .agg(F.sort_array(F.collect_list(F.struct("token_id", "logit"))).alias("z"))
            .select(id_col, "step", F.transform("z", lambda s: s["logit"]).alias("logits")))


#: Width of the ranges of logits that share one reference value.
LOGIT_RANGE = 64.0


def step_entropy_long(long_df: DataFrame, id_col: str = "article_id", argmax: bool = True) -> DataFrame:
    """E8 on the long form ``(article_id, step, token_id, logit)``: one row per
    step with ``entropy`` and, if asked for, ``argmax`` (the smallest token id
    of the largest logit).

    The state (reference, S = sum exp(z - r), E = sum exp(z - r) * z) merges by
    addition where the reference r is the same, so logits are grouped by ranges
    of 64 that share the range's upper end: exp stays within e^-64 and 1, the
    vocabulary is combined map-side, and a step's few ranges are rescaled to its
    largest one at the end.  No array of the vocabulary is built.  Logits of
    minus infinity have no weight; null logits are none; a step with only those
    has a null entropy; NaN and plus infinity give NaN."""
    z = F.col("logit").cast("double")
    low = z == F.lit(float("-inf"))
    ref = F.when(F.isnan(z) | (z == F.lit(float("inf"))), F.lit(float("inf"))).when(
        low, F.lit(None).cast("double")).otherwise((F.floor(z / LOGIT_RANGE) + 1) * LOGIT_RANGE)
    rows = long_df.where(z.isNotNull()).withColumn("_z", z).withColumn("_r", ref)
    w = F.exp(F.col("_z") - F.col("_r"))
    best = [F.max(F.struct("_z", (-F.col("token_id")).alias("_t"))).alias("_b")] if argmax else []
    ranges = rows.groupBy(id_col, "step", "_r").agg(F.sum(w).alias("_s"), F.sum(w * F.col("_z")).alias("_e"), *best)
    top = [F.max("_b").alias("_b")] if argmax else []
    steps = ranges.groupBy(id_col, "step").agg(
        F.max("_r").alias("_m"), F.collect_list(F.struct("_r", "_s", "_e")).alias("_a"), *top)
    total = lambda f: F.aggregate(
        F.filter("_a", lambda x: x["_r"].isNotNull()), F.lit(0.0),
        lambda acc, x: acc + F.exp(x["_r"] - F.col("_m")) * x[f])
    steps = steps.withColumn("_s", total("_s")).withColumn("_e", total("_e"))
    out = [(F.col("_m") + F.log("_s") - F.col("_e") / F.col("_s")).alias("entropy")]
    if argmax:
        out.append((-F.col("_b._t")).cast("int").alias("argmax"))
    return steps.select(id_col, "step", *out)


def _sum(arr, f):
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + f(x))


def step_entropy(steps: DataFrame, logits_col: str = "logits") -> DataFrame:
    """Entropy (nats) of softmax(logits) per step, stable log-sum-exp:
    H = m + ln(S) - sum(exp(z - m) * z) / S with m = max z, S = sum exp(z - m).
    Adds ``entropy`` and ``argmax`` (first index of the maximum, 0-based)."""
    m = steps.withColumn("_m", F.array_max(logits_col))
    m = m.withColumn("_s", _sum(F.col(logits_col), lambda x: F.exp(x - F.col("_m")))) \
        .withColumn("_e", _sum(F.col(logits_col), lambda x: F.exp(x - F.col("_m")) * x))
    return (m.withColumn("entropy", F.col("_m") + F.log("_s") - F.col("_e") / F.col("_s"))
            .withColumn("argmax", (F.array_position(logits_col, F.col("_m")) - 1).cast("int"))
            .drop("_m", "_s", "_e"))


def end_steps(scored: DataFrame, end_id: int = 2, id_col: str = "article_id") -> DataFrame:
    """first step whose argmax is the end marker, per article (null if none)."""
    return scored.groupBy(id_col).agg(
        F.min(F.when(F.col("argmax") == end_id, F.col("step"))).alias("end_step"))


def uncertain_tokens(steps: DataFrame, tokens: DataFrame | None = None, threshold: float = 3.5,
                     end_id: int = 2, token_shift: int = 0, id_col: str = "article_id") -> DataFrame:
    """``(article_id, error_captured array<string>)`` for every article.

    Steps before the first end marker with entropy ≥ threshold are
    uncertain; their tokens (read at ``step + token_shift``) are listed in
    step order.  No end marker, a marker at step 0, or no uncertain step
    gives ``['pass']``.  A trace is bounded by the generator's maximum
    length, so the per-article list is too.
    """
    sc = step_entropy(steps)
    ends = end_steps(sc, end_id, id_col)
    hot = (sc.join(ends, id_col)
           .where(F.col("end_step").isNotNull() & (F.col("step") < F.col("end_step"))
                  & (F.col("entropy") >= threshold))
           .select(id_col, (F.col("step") + token_shift).alias("step")))
    tok_src = tokens if tokens is not None else steps.select(id_col, "step", "token")
    caught = (hot.join(tok_src.select(id_col, "step", "token"), [id_col, "step"], "left")
              .groupBy(id_col)
              .agg(F.transform(F.sort_array(F.collect_list(F.struct("step", "token"))),
                               lambda s: s["token"]).alias("error_captured")))
    return (ends.select(id_col).join(caught, id_col, "left")
            .select(id_col, F.coalesce("error_captured", F.array(F.lit("pass"))).alias("error_captured")))


def only_uncertain(df: DataFrame, col: str = "error_captured") -> DataFrame:
    """Rows whose captured list is not ``['pass']``."""
    return df.where(F.col(col) != F.array(F.lit("pass")))
