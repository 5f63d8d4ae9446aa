"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space, tab, line feed, vertical tab, form
#: feed, carriage return.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    ``spark.checkpoint.dir`` is read from the session (or from the context,
    where it was set by ``setCheckpointDir``).  Only a plain local session,
    whose driver is its one executor, gets a temporary folder of its own;
    on a cluster without the setting this raises.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="newsgraph-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the files instead of
    recomputing what made them) and lets several later steps read only the
    columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer may copy a column's expression into every place that uses
    it, also into a lambda that runs once per array element; a lambda's own
    variable is never copied.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of the maximal runs of non-white-space characters."""
    for c in WS_CHARS[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def without(text: Column, chars: str) -> Column:
    """``text`` without any of ``chars``.  One byte search per character, which
    is several times as fast as ``translate`` or a regular expression."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text
