"""Small helpers shared by operators."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Bytes, as the optimizer estimates them, up to which a side table is
# broadcast.  Larger ones are joined with a shuffle (and AQE may still
# broadcast them at run time when their measured size turns out small).
BROADCAST_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, an upper bound for the plans of side
    tables (scans, projections, filters, unions).  Starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def counted_bytes(df: DataFrame) -> int:
    """The bytes of a table's values, by an aggregate over it."""
    width = [F.coalesce(F.octet_length(F.to_json(F.struct(n)) if d.startswith(("array", "struct", "map"))
                                       else F.col(n).cast("string")), F.lit(0)) + 8 for n, d in df.dtypes]
    return df.agg(F.sum(sum(width, F.lit(0))).alias("n")).first()["n"] or 0


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a side table of at most ``max_bytes``; else return it as it
    is.  A table made from rows or by an aggregate has no useful estimate (it
    is taken for huge): where the estimate is too large, its values are
    counted."""
    small = estimated_bytes(df) <= max_bytes or counted_bytes(df) <= max_bytes
    return F.broadcast(df) if small else df


def measured_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` computed once, and broadcast where its values, as counted, take
    at most ``max_bytes``: for tables whose estimate says little, such as
    aggregates."""
    df = materialize(df)
    return F.broadcast(df) if counted_bytes(df) <= max_bytes else df


#: Terms that are broadcast where not all of a vocabulary can be.
FREQUENT_TERMS = 200_000


def join_terms(rows: DataFrame, table: DataFrame, key: str, freq: str, max_bytes: int = BROADCAST_BYTES,
               n_frequent: int = FREQUENT_TERMS) -> DataFrame:
    """``rows.join(table, key)`` for rows of a text's words and a table of a
    vocabulary.  Where the table takes at most ``max_bytes`` as counted it is
    broadcast; else its most frequent terms (by ``freq``) are, which are nearly
    all rows of a text, and only the rows of rarer ones are dealt by term."""
    table = materialize(table)
    if counted_bytes(table) <= max_bytes:
        return rows.join(F.broadcast(table), key)
    top = materialize(table.where(F.col(key).isNotNull()).orderBy(F.desc(freq), key).limit(n_frequent).select(key))
    common = F.broadcast(table.join(F.broadcast(top), key, "left_semi"))
    rest = table.join(F.broadcast(top), key, "left_anti")
    rare = rows.join(F.broadcast(top), key, "left_anti")
    return rows.join(common, key).unionByName(rare.join(rest, key))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a freshly scanned ``df`` only when it has fewer
    partitions than cores.

    A scan of one large row group is a single task; CPU-heavy text work
    after it would use one core.  At cluster scale the scan already has
    thousands of splits and this is a no-op (no extra shuffle).  Apply it
    to scans only: on a plan with shuffles, asking for the partition count
    would run those shuffles early.
    """
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row table (a global aggregate) to every row.

    Each column becomes a scalar subquery (``DataFrame.scalar()``): Spark
    runs the aggregate once and uses its value as a constant, so no join
    (and no pairing) is planned at all.  ``one_row`` must be an aggregate
    without grouping keys, i.e. exactly one row.
    """
    for c in one_row.columns:
        df = df.withColumn(c, one_row.select(c).scalar())
    return df
