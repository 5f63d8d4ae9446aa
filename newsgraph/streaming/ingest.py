"""Structured Streaming forms of the day-keyed jobs (L1-L3)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_title_keep_last
from ..sources import files
from ..sources.daytable import DayTable
from ..sources.ingest import read_landed

_ARRIVED = "_arrived"


def _landed(spark: SparkSession, dst: str | DayTable, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The landed rows, empty where nothing has landed yet (only a missing
    path counts as that; other failures stop the batch)."""
    if isinstance(dst, DayTable):
        return dst.read(version).select(*schema.fieldNames())
    found = read_landed(spark, dst, schema)
    return spark.createDataFrame([], schema) if found is None else found.select(*schema.fieldNames())


def _replace_days(spark: SparkSession, days: DataFrame, rows: DataFrame, dst: str | DayTable, batch_id: int,
                  day_col: str, schema: T.StructType, version: int | None = None) -> None:
    """Make ``rows`` the whole content of the given ``days`` of ``dst``.

    A ``DayTable`` publishes them as the next of ``version``, in one step.  In a plain
    folder the rows are written to a per-batch staging folder first (Spark refuses to
    overwrite a path the same job reads), then replace exactly those day
    partitions.  A day that is left without rows is overwritten with none.
    Re-running a batch id rewrites the same folders: idempotent.  The staging
    folder is removed once the days are replaced."""
    if isinstance(dst, DayTable):
        dst.replace(rows, days, version)
        return
    root = dst.rstrip("/")
    staged = f"{root}_staging/batch={batch_id}"
    rows.withColumn("day", F.col(day_col)).write.mode("overwrite").parquet(staged)
    new = spark.read.parquet(staged)
    (new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(dst))
    empty = days.join(new.select(day_col).distinct(), day_col, "left_anti").where(F.col(day_col).isNotNull())
    for r in empty.collect():  # day names only
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{root}/day={r[0]}")
    files.delete(spark, staged)


def _upsert(spark: SparkSession, batch: DataFrame, batch_id: int, dst: str | DayTable, key: str, day_col: str,
            schema: T.StructType) -> DataFrame:
    """Land a batch: the newest version of a key wins, wherever it was before.
    Returns the touched days: those of the batch and those its keys left."""
    columns = schema.fieldNames()
    newest = W.partitionBy(key).orderBy(F.col(_ARRIVED).desc(), F.col("_row").desc())
    b = (batch.withColumn("_row", F.monotonically_increasing_id())
         .withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").select(*columns))
    version = dst.version() if isinstance(dst, DayTable) else None
    old = _landed(spark, dst, schema, version)
    left = old.join(b.select(key), key, "left_semi").select(day_col)
    days = b.select(day_col).unionByName(left).distinct().persist()
    merged = (old.join(days, day_col, "left_semi").join(b.select(key), key, "left_anti").unionByName(b))
    _replace_days(spark, days, merged, dst, batch_id, day_col, schema, version)
    return days


def _start(spark: SparkSession, src: str, checkpoint: str, schema: T.StructType, fmt: str, available_now: bool,
           land) -> StreamingQuery:
    stream = spark.readStream.schema(schema).format(fmt).load(src)
    # arrival order: file time, then file name; rows of one file by position
    stream = stream.withColumn(_ARRIVED, F.struct("_metadata.file_modification_time", "_metadata.file_path"))

    def once(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read several times below
        try:
            land(batch, batch_id)
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_ingest(spark: SparkSession, src: str, dst: str | DayTable, checkpoint: str, schema: T.StructType,
                  key: str = "article_id", day_col: str = "datetime", fmt: str = "parquet",
                  available_now: bool = True) -> StreamingQuery:
    """L1: new article files -> day partitions of ``dst``.

    A key that arrives again is replaced by its newest version, also when its
    day has changed; only the touched days are rewritten.

    With a ``DayTable`` every batch is one published version, so a batch that
    fails half way leaves the readers what they had, and is done anew on
    restart.  A plain folder is replaced day by day."""
    def land(batch: DataFrame, batch_id: int) -> None:
        _upsert(spark, batch, batch_id, dst, key, day_col, schema).unpersist()

    return _start(spark, src, checkpoint, schema, fmt, available_now, land)


def stream_title_dedup(spark: SparkSession, src: str, dst: str | DayTable, checkpoint: str, schema: T.StructType,
                       key: str = "article_id", day_col: str = "datetime", title_col: str = "title",
                       fmt: str = "parquet", available_now: bool = True) -> StreamingQuery:
    """L2: same-day title dedup on a stream, keeping the LAST article as the
    batch operator does.  All articles land in ``<dst>_raw`` (newest version
    per key); the days a batch touches are deduplicated again from there, so
    an article that a later retitle sets free comes back.
    (``dropDuplicatesWithinWatermark`` keeps the first row, so it would not be
    equivalent.)"""
    if isinstance(dst, DayTable):
        raw = DayTable(spark, dst.path + "_raw", schema, day_col)
    else:
        raw = dst.rstrip("/") + "_raw"

    def land(batch: DataFrame, batch_id: int) -> None:
        days = _upsert(spark, batch, batch_id, raw, key, day_col, schema)
        rows = _landed(spark, raw, schema).join(days, day_col, "left_semi")
        _replace_days(spark, days, dedup_title_keep_last(rows, key, day_col, title_col), dst, batch_id,
                      day_col, schema)
        days.unpersist()

    return _start(spark, src, checkpoint, schema, fmt, available_now, land)


def stream_daily_counts(spark: SparkSession, src: str, checkpoint: str, schema: T.StructType,
                        ts_col: str = "ts", lateness: str = "1 day", sink: str = "memory",
                        name: str = "daily_counts", path: str | None = None,
                        fmt: str = "parquet") -> StreamingQuery:
    """L3: rows per day with a late-data bound: a day is emitted once the
    watermark (max event time - ``lateness``) passes its end.  The last open
    day therefore stays in the state until later events arrive."""
    stream = spark.readStream.schema(schema).format(fmt).load(src)
    agg = (stream.withWatermark(ts_col, lateness)
           .groupBy(F.window(ts_col, "1 day").alias("w"))
           .agg(F.count("*").alias("n"))
           .select(F.date_format("w.start", "yyyyMMdd").alias("datetime"), "n"))
    w = agg.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if sink == "memory":
        w = w.format("memory").queryName(name)
    else:
        w = w.format(sink).option("path", path)
    return w.trigger(availableNow=True).start()
