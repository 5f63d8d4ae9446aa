"""Sinks B1-B4, B6, B7: per-day JSON / CSV / Parquet, error side output, triplet records."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stage output folders, in pipeline order (the reference's naming).
STAGE_DIRS = {"preprocess": "1", "filter": "1_", "erase_similar": "1_2_",
              "split_sentence": "1_2_3(SPL)", "translate": "1_2_3(SPL)_4"}

# The triplet record of a news article, in the reference's order.
TRIPLET_FIELDS = ["original_title", "original_text", "translated_summary", "found_entities", "found_relations"]


def _csv_safe(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_by_day(df: DataFrame, path: str, fmt: str = "json", day_col: str = "datetime",
                 order_col: str | None = None) -> None:
    """One folder per day ``day=<key>``; ``day_col`` stays in the
    rows (a partition value is re-read as a number and a null day becomes
    a default partition, so the copy is what is partitioned on).  Only the
    days present are overwritten.  JSON is written as JSON lines with
    non-ASCII kept; CSV gets array/struct columns as JSON strings.
    The rows are dealt by day, so that a day becomes few files however many
    tasks made it; AQE splits a large day and joins small ones by their
    measured size.  ``order_col`` keeps rows in that order inside each written
    file."""
    out = df.withColumn("day", F.coalesce(F.col(day_col).cast("string"), F.lit("null"))).hint("rebalance", "day")
    if order_col is not None:
        out = out.sortWithinPartitions("day", order_col)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day")
    if fmt == "csv":
        out = _csv_safe(out)
        w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day") \
            .option("header", True).option("escape", '"')
    w.format(fmt).save(path)


def write_with_errors(df: DataFrame, path: str, cols: list[str] | None = None,
                      day_col: str = "datetime", err_col: str = "error_captured") -> None:
    """All rows per day, plus ``<path>_errors`` with only the rows whose
    captured list is not ['pass'] (days without such rows get no folder)."""
    cols = cols or ["summarized_text", "translated_summary", err_col]
    sel = df.select(day_col, *cols).persist()
    try:
        write_by_day(sel, path, "csv", day_col)
        write_by_day(sel.where(F.col(err_col) != F.array(F.lit("pass"))), path + "_errors", "csv", day_col)
    finally:
        sel.unpersist()


def write_triplets(df: DataFrame, path: str, day_col: str = "datetime", title_col: str = "title",
                   text_col: str = "text", premise_col: str = "translated_summary",
                   order_col: str = "article_id") -> None:
    """The triplet records as JSON lines, one folder per day, every record
    with exactly ``TRIPLET_FIELDS`` (a null is written as such).

    ``df`` carries ``found_entities`` and ``found_relations`` as
    ``relations.extract_relations`` returns them; the day is in the folder's
    name only (a null day: ``day=null``).  Rows of a file follow
    ``order_col``; only the days present are overwritten."""
    day = F.coalesce(F.col(day_col).cast("string"), F.lit("null"))
    out = df.select(day.alias("day"), F.col(order_col).alias("_order"), F.col(title_col).alias(TRIPLET_FIELDS[0]),
                    F.col(text_col).alias(TRIPLET_FIELDS[1]), F.col(premise_col).alias(TRIPLET_FIELDS[2]),
                    *TRIPLET_FIELDS[3:])
    (out.hint("rebalance", "day").sortWithinPartitions("day", "_order").drop("_order")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False)
     .partitionBy("day").json(path))


def read_triplets(spark: SparkSession, path: str) -> DataFrame:
    """The records of ``write_triplets`` with their ``day``."""
    entity = "struct<text:string,type:string>"
    return spark.read.schema(
        f"original_title string, original_text string, translated_summary string, found_entities array<{entity}>, "
        f"found_relations array<struct<sbj:{entity},relation:string,obj:{entity}>>, day string").json(path)


def save_table(df: DataFrame, path: str) -> None:
    """A prepared training set as Parquet."""
    df.write.mode("overwrite").parquet(path)


def stage_path(root: str, stage: str) -> str:
    """Folder of a pipeline stage under ``root``."""
    return f"{root}/{STAGE_DIRS.get(stage, stage)}"
