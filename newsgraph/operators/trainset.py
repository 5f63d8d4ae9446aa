"""Training-set builders (J7): D1 label join, C6/C7 guards, F6 paragraph
prefix, G4 truncation, I5 paragraphs, I6 link stripping."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def label_rows(df: DataFrame, label_index: DataFrame, keys: list[str], out_col: str = "labels") -> DataFrame:
    """1 when the row's key is in the label index, else 0 (a key of an
    unknown file also gives 0).  The index is de-duplicated first so the
    left join can never multiply rows."""
    idx = label_index.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return df.join(idx, keys, "left").withColumn(out_col, F.coalesce("_hit", F.lit(0))).drop("_hit")


def paragraph_prefix(df: DataFrame, text_col: str = "text", n: int = 500,
                     out_col: str = "text_prefix") -> DataFrame:
    """I5 + C7 + F6: split into paragraphs, drop rows with none, and keep the
    paragraph prefix grown while its length before adding is < n."""
    p = df.withColumn("_paras", tx.paragraphs(text_col))
    return p.where(F.size("_paras") >= 1).withColumn(out_col, tx.prefix_until("_paras", n)).drop("_paras")


def build_labeled(df: DataFrame, label_index: DataFrame, keys: list[str], n: int = 500) -> DataFrame:
    """J7 labelled set: ``(title, text, labels)`` with the paragraph prefix as text."""
    p = paragraph_prefix(df, "text", n)
    return label_rows(p, label_index, keys).select(*keys, "title", F.col("text_prefix").alias("text"), "labels")


def build_unlabeled(df: DataFrame, n_chars: int = 750, error_flag: Column | None = None,
                    min_title: int = 2, min_text: int = 20) -> DataFrame:
    """C6 + G4: drop null or short titles (< ``min_title`` chars), texts
    flagged as errors, and texts shorter than ``min_text``; keep the first
    ``n_chars`` characters of the text (the truncation is the feature)."""
    ok = F.col("title").isNotNull() & (F.length("title") >= min_title) & \
        F.col("text").isNotNull() & (F.length("text") >= min_text)
    if error_flag is not None:
        ok = ok & ~F.coalesce(error_flag, F.lit(False))
    return df.where(ok).withColumn("text", tx.first_chars("text", n_chars))


def clean_tweets(df: DataFrame, text_col: str = "text", min_len: int = 10) -> DataFrame:
    """Strip t.co links to end of line, drop texts under ``min_len``."""
    c = df.withColumn(text_col, tx.strip_tco_links(text_col))
    return c.where(F.length(text_col) >= min_len)
