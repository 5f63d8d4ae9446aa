"""Importance resampling toward a target distribution over hashed word n-grams.

A text's features are its runs of 1 to 3 consecutive words, joined by one
space, repeats counted; a feature's bucket is the CRC-32 of its bytes modulo
``N_BUCKETS``.  What a bucket gains is the logarithm of its smoothed share in
the target texts over its share in the documents; a document's weight is the
sum over its features.  Rows with at least ``min_words`` words are drawn
without replacement by the Gumbel top-k rule: weight plus noise made from the
``doc_id``, the highest scores first.

The CRCs come from *length-bucketed matrices*: the distinct features of a
block of words are grouped by their length in bytes, each group is one
two-dimensional ``uint8`` array, all its CRCs are updated column by column, and
the buckets are scattered back to where the features stand.  Texts are worked
off in blocks of ``BLOCK_WORDS`` words whatever their length, so a long text
takes no more memory than its own bytes and word places.

Every text is hashed once; the buckets (two bytes a feature) are kept in the
shared folder, from which both the counts over all documents and the weights
are read.  The only thing that goes through the driver are the ``N_BUCKETS``
gains.

Null text has no words.  A null ``doc_id`` takes its noise from the empty
string and wins ties.  Rows with equal score and ``doc_id`` are ranked one
after the other.  Repeated rows count as often as they stand there, extra
columns are ignored.  Without documents the result is empty; without target
texts every bucket's share in the target is the smoothed one.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.indexing import with_dense_index
from .shared import stage

N_BUCKETS = 10_000
N_MAX = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42

#: Words whose features are hashed at once, and bytes of text read at once.
BLOCK_WORDS = 1 << 18
BLOCK_BYTES = 2 << 20
#: Longer features are too few of a length to fill a matrix.
LONGEST_ROW = 256

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
_IN_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


def crc_table() -> np.ndarray:
    """CRC-32 of each byte: the reflected polynomial, one bit at a time."""
    table = _BYTES.astype(np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


_CRC = crc_table()


def crc32_rows(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[starts[i]:starts[i] + lengths[i]]`` for every i."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        rows, length = order[a:b], int(lengths[order[a]])
        if length > LONGEST_ROW:
            for r in rows:
                out[r] = zlib.crc32(data[starts[r]:starts[r] + length])
            continue
        matrix = data[starts[rows][None, :] + np.arange(length)[:, None]]  # one line per column of the features
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in matrix:
            crc = _CRC[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[rows] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts, each followed by one space, as one array of
    bytes; where each word starts in it; its length; and where the words of
    text i begin (one entry more than texts)."""
    raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    inside = _IN_WORD[raw]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    begin, end = edges[::2], edges[1::2]
    text_at = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(begin, text_at)
    inside[end] = True
    raw[end] = 0x20
    lengths = end - begin
    return raw[inside], np.cumsum(lengths + 1) - lengths - 1, lengths, first


def word_ids(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The same number for equal words (exact), from 0."""
    ids, n = np.empty(len(starts), np.int64), 0
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        rows, length = order[a:b], int(lengths[order[a]])
        if len(rows) == 1:
            ids[rows], n = n, n + 1
            continue
        matrix = np.ascontiguousarray(data[starts[rows][:, None] + np.arange(length)])
        distinct, inverse = np.unique(matrix.view(f"S{length}").ravel(), return_inverse=True)
        ids[rows], n = inverse + n, n + len(distinct)
    return ids


def feature_buckets(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                    n_buckets: int = N_BUCKETS, n_max: int = N_MAX) -> list[np.ndarray]:
    """For n = 1 .. n_max the buckets of the runs of n words that start at word
    0, 1, 2, ...: what stands across two texts is for the caller to leave out."""
    out = [np.zeros(len(starts), np.uint16) for _ in range(n_max)]
    for a in range(0, len(starts), BLOCK_WORDS):
        b = min(a + BLOCK_WORDS, len(starts))
        more = min(b + n_max - 1, len(starts))
        ids = word_ids(data, starts[a:more], lengths[a:more])
        n_words, run = int(ids.max()) + 1, ids
        for n in range(n_max):
            size = min(b, len(starts) - n) - a
            if size <= 0:
                break
            run = run[:size] if not n else run[:size] * n_words + ids[n:n + size]
            _, first, inverse = np.unique(run, return_index=True, return_inverse=True)
            last = first + a + n
            crc = crc32_rows(data, starts[first + a], starts[last] + lengths[last] - starts[first + a])
            out[n][a:a + size] = (crc % np.uint32(n_buckets)).astype(np.uint16)[inverse]
            run = inverse.astype(np.int64)
    return out


def hashed_features(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key``, n_words and ``buckets``: the bucket of every feature of the
    text, as little-endian unsigned 16-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = 0
            while a < batch.num_rows:
                part, size = [], 0
                while a + len(part) < batch.num_rows and (not part or size < BLOCK_BYTES):
                    part.append(batch.column(1)[a + len(part)].as_py() or b"")
                    size += len(part[-1])
                data, starts, lengths, first = split_words(part)
                runs = [r.astype("<u2", copy=False) for r in feature_buckets(data, starts, lengths)]
                buckets = [b"".join(r[i:max(i, j - n)].tobytes() for n, r in enumerate(runs))
                           for i, j in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(part)), pa.array(np.diff(first), pa.int64()),
                     pa.array(buckets, pa.binary())], names=[key, "n_words", "buckets"])
                a += len(part)

    slim = texts.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").cast("binary").alias("text"))
    return slim.mapInArrow(run, f"{key} long, n_words long, buckets binary")


def bucket_counts(features: DataFrame, n_buckets: int = N_BUCKETS) -> DataFrame:
    """(bucket, n) over all features; each task adds up its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), "<u2"), minlength=n_buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_buckets)), pa.array(total)], names=["bucket", "n"])

    counted = features.select("buckets").mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(features: DataFrame, target: DataFrame, n_buckets: int = N_BUCKETS) -> list[int]:
    """What one feature of each bucket adds to a document's weight."""
    spark = features.sparkSession
    corpus = bucket_counts(features, n_buckets).withColumnRenamed("n", "s")
    wanted = bucket_counts(target, n_buckets).withColumnRenamed("n", "t")
    both = (spark.range(n_buckets).withColumnRenamed("id", "bucket")
            .join(corpus, "bucket", "left").join(wanted, "bucket", "left").na.fill(0, ["s", "t"]))
    rows = both.select("bucket", "s", "t").toPandas().sort_values("bucket")   # n_buckets rows
    s, t = rows["s"].to_numpy(np.float64), rows["t"].to_numpy(np.float64)
    ratio = ((t + 1) * (s.sum() + n_buckets)) / ((s + 1) * (t.sum() + n_buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64).tolist()


def weigh(features: DataFrame, key: str, gains: list[int]) -> DataFrame:
    """``key``, n_words, n_features, weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.array(gains, np.int64)
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in found], pa.int64()),
                 pa.array([int(gain[x].sum()) for x in found], pa.int64())],
                names=[key, "n_words", "n_features", "weight"])

    return features.select(key, "n_words", "buckets").mapInArrow(
        run, f"{key} long, n_words long, n_features long, weight long")


def rank_documents(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
                   seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document;
    the rank is null where it is not drawn."""
    features = stage(hashed_features(docs, "doc_id"), "importance-features")
    wanted = target.select(F.lit(0).alias("doc_id"), "text")
    gains = bucket_gains(features, hashed_features(wanted, "doc_id"))

    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = stage(weigh(features, "doc_id", gains).withColumn("score", F.col("weight") + noise),
                   "importance-scores")

    fit = scored.where(F.col("n_words") >= min_words)
    n_drawn = percent * fit.count() // 100
    ordered = with_dense_index(fit.withColumn("_down", -F.col("score")), ["_down", "doc_id", "weight", "n_features"],
                               "_index").drop("_down")
    rank = F.when(F.col("_index") < n_drawn, F.col("_index") + 1)
    rest = scored.where(F.col("n_words") < min_words)
    return (ordered.withColumn("rank", rank).drop("_index")
            .unionByName(rest.withColumn("rank", F.lit(None).cast("long"))))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns.  Where a ``doc_id``
    stands for several texts, all of them come with the drawn one."""
    drawn = rank_documents(docs, target, percent, min_words, seed).where("rank is not null")
    return docs.join(drawn.select("doc_id").distinct(), "doc_id", "left_semi")


def op11(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return rank_documents(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")
