"""C3 dense row index, G1/G2 chunk keys."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

_LOW33 = (1 << 33) - 1


def with_dense_index(df: DataFrame, order_cols: list[str], out_col: str = "index",
                     num_partitions: int | None = None) -> DataFrame:
    """Dense 0..n-1 index following ``order_cols`` (must be a total order).

    Range-partition and sort, then index = rows in earlier partitions + the
    position inside the partition.  The sorted table is materialised once and
    read by both branches: planned twice, each branch would sample its own
    range bounds and the offsets would not fit the rows.  Only the
    per-partition counts (one row per partition) are gathered.  Without
    ``num_partitions`` the session's shuffle partitions and their coalescing
    by size decide how many there are."""
    s = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    s = materialize(s.sortWithinPartitions(*order_cols).withColumn("_mid", F.monotonically_increasing_id()))
    s = s.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    counts = s.groupBy("_pid").agg(F.count("*").alias("_c"))
    offs = counts.withColumn("_off", F.coalesce(
        F.sum("_c").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_c")
    return (s.join(F.broadcast(offs), "_pid")  # one row per partition
            .withColumn(out_col, F.col("_off") + F.col("_loc"))
            .drop("_mid", "_pid", "_loc", "_off"))


def with_chunk(df: DataFrame, n: int, index_col: str = "index", out_col: str = "chunk") -> DataFrame:
    """chunk = floor(index / n); every row is kept, the last chunk may
    be short."""
    return df.withColumn(out_col, F.floor(F.col(index_col) / n).cast("long"))
