"""N-gram Jaccard join by MinHash banding.

Every text is the set of its runs of ``N`` words (64-bit hashes; a text with
fewer words is one run).  Texts with equal sets form a class; only one
signature per class goes on.  ``choose_bands`` picks the band and row counts
whose chance of missing a pair at the threshold is at most ``1 - RECALL``.
Classes are shuffled on their band hashes, and pairs that share a bucket are
verified on the full sets.

Buckets are worked off in tiles: a bucket's members fall into blocks of at
most about ``BLOCK``, and each pair of blocks is one task-sized group, so a
bucket of any size is spread over many groups.  Inside a tile the pairs are
compared as arrays and never become rows: a tile returns, per member, how
many texts it is linked to and one member of its linked group.  A pair that
shares several buckets is counted in the lowest of its bands only.

Result: one row per input row with the class (the smallest ``doc_id`` among
all documents linked directly or through others), the number of other texts
its text is linked to (similarity at or above the threshold), and the number
of documents with the same text.

Null text counts as empty.  Empty texts (no words) are copies of each other
and of nothing else.  Equal rows and equal ids are rows of their own; a null
id is kept, and a class whose ids are all null has a null class id.  Extra
columns are ignored.  An empty table gives no rows.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .shared import stage, words

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
BLOCK = 256


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL,
                 max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band (so the fewest false
    candidates) whose bands, as many as the target recall at the threshold
    needs, fit into ``max_hashes``."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = threshold ** rows
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("max_hashes is too small for this recall")
    return best


def word_hashes(text: Column) -> Column:
    return F.transform(words(F.coalesce(text.cast("string"), F.lit(""))), lambda w: F.xxhash64(w))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, n: int = N) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``n`` words (of all words where
    there are fewer); empty without words."""
    h = hashes.astype(np.uint64, copy=False)
    if not len(h):
        return h
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        out = _mix(out * _MIX + h[i:len(h) - k + 1 + i])
    return np.unique(out)


class MinHasher:
    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.mask = rng.integers(0, 2**64, bands * rows, dtype=np.uint64)
        self.factor = rng.integers(0, 2**64, bands * rows, dtype=np.uint64) | np.uint64(1)

    def band_hashes(self, s: np.ndarray) -> np.ndarray:
        sig = np.array([((s ^ m) * f).min() for m, f in zip(self.mask, self.factor, strict=True)])
        sig = sig.reshape(self.bands, self.rows)
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        for i in range(self.rows):
            out = _mix(out * _MIX + sig[:, i])
        return out


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield flat[a:b].view(np.uint64)


def set_key(s: np.ndarray) -> str:
    return hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest()


def sketches(docs: DataFrame, bands: int, rows: int, n: int = N) -> DataFrame:
    """doc_id, text_key, set_key, band hashes of every row; no band hashes
    for texts without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHasher(bands, rows)
        for batch in batches:
            keys, out = [], []
            for h in _lists(batch.column(2)):
                s = shingles(h, n)
                keys.append(set_key(s))
                out.append(hasher.band_hashes(s).view(np.int64) if len(s) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.string()),
                 pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "text_key", "set_key", "bands"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("text_key"),
                        word_hashes(F.col("text")).alias("h"))
            .mapInArrow(run, "doc_id long, text_key string, set_key string, bands array<long>"))


def full_sets(docs: DataFrame, n: int = N) -> DataFrame:
    """set_key and the set itself (bytes of sorted 64-bit hashes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(h, n) for h in _lists(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(s) for s in sets], pa.string()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["set_key", "shingles"])

    return docs.select(word_hashes(F.col("text")).alias("h")).mapInArrow(run, "set_key string, shingles binary")


def classes_of(sketch: DataFrame) -> DataFrame:
    """One row per set: set_key, rep (smallest doc_id), n_texts, bands."""
    texts = sketch.groupBy("set_key", "text_key").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    return texts.groupBy("set_key").agg(F.min("rep").alias("rep"), F.count("*").alias("n_texts"),
                                        F.first("bands").alias("bands"))


def tiles(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Members of every bucket that holds two classes or more, dealt into
    tiles: set_key, band, bucket, i, j (the tile's blocks), own (the member's
    block).  Of buckets with the same members only the lowest band's stays."""
    spread = classes.select("set_key", "n_texts", F.posexplode("bands").alias("band", "bucket"))
    buckets = (spread.groupBy("band", "bucket")
               .agg(F.count("*").alias("size"), F.sum(F.xxhash64("set_key").cast("decimal(38,0)")).alias("sum"),
                    F.bit_xor(F.xxhash64("set_key", F.lit(1))).alias("xor"))
               .where("size > 1")
               .groupBy("size", "sum", "xor").agg(F.min(F.struct("band", "bucket")).alias("at"))
               .select("at.band", "at.bucket", F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    members = spread.join(buckets, ["band", "bucket"])
    own = F.pmod(F.xxhash64("set_key", F.lit(2)), F.col("blocks")).cast("int")
    return (members.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("set_key", "n_texts", "band", "bucket", F.least("own", "other").alias("i"),
                    F.greatest("own", "other").alias("j"), "own"))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each member's linked group."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (a, b)."""
    sizes = np.array([len(s) for s in sets])
    if (sizes[a] + sizes[b]).sum() < 40 * len(sets) ** 2:  # few pairs: merge them one by one
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                         for x, y in zip(a, b, strict=True)], dtype=np.int64)
    used = np.unique(np.concatenate([a, b]))
    who = np.repeat(used, sizes[used])
    _, column, count = np.unique(np.concatenate([sets[x] for x in used]), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    who, column = who[shared], np.unique(column[shared], return_inverse=True)[1]
    out, width = np.zeros((len(sets), len(sets)), np.float32), 4096
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [first, first + width])
        dense = np.zeros((len(sets), width), np.float32)
        dense[who[lo:hi], column[lo:hi] - first] = 1
        out += dense @ dense.T
    return out[a, b].astype(np.int64)


def verify_tile(band: int, i: int, j: int, own: np.ndarray, bands: np.ndarray, sets: list[np.ndarray],
                n_texts: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, root, links) of the members that are linked in this tile."""
    m = len(sets)
    allowed = np.triu(np.ones((m, m), bool), 1)
    if i != j:  # members of the same block meet in their own tile
        allowed &= own[:, None] != own[None, :]
    for k in range(band):  # counted in a lower band
        allowed &= bands[:, k][:, None] != bands[:, k][None, :]
    sizes = np.array([len(s) for s in sets])
    low, high = np.minimum(sizes[:, None], sizes[None, :]), np.maximum(sizes[:, None], sizes[None, :])
    allowed &= low >= threshold * high
    a, b = np.nonzero(allowed)
    if len(a):
        both = _common(sets, a, b)
        linked = both >= threshold * (sizes[a] + sizes[b] - both) - 1e-9
        a, b = a[linked], b[linked]
    links = np.bincount(a, n_texts[b], m) + np.bincount(b, n_texts[a], m)
    member = np.nonzero(links)[0]
    return member, _roots(m, a, b)[member], links[member].astype(np.int64)


def verified_links(docs: DataFrame, classes: DataFrame, threshold: float = THRESHOLD, n: int = N,
                   block: int = BLOCK) -> DataFrame:
    """set_key, root (a set_key of the same linked group), links: one row per
    linked class and tile."""
    members = stage(tiles(classes, block), "tiles")
    met = members.select("set_key").distinct().join(classes, "set_key")
    reps = met.select("rep").distinct()
    texts = docs.join(reps, docs["doc_id"].eqNullSafe(reps["rep"]), "left_semi")
    sets = full_sets(texts, n).join(met.select("set_key", "bands"), "set_key")
    rows = members.join(sets, "set_key")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        band, _, i, j = (k.as_py() for k in key)
        keys = np.array(table.column("set_key").to_pylist())
        keys, at = np.unique(keys, return_index=True)  # a repeated document id brings its class twice
        table = table.take(pa.array(at))
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("shingles")]
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        member, root, links = verify_tile(band, i, j, table.column("own").to_numpy(), bands, sets,
                                          table.column("n_texts").to_numpy(), threshold)
        return pa.table({"set_key": pa.array(keys[member].tolist(), pa.string()),
                         "root": pa.array(keys[root].tolist(), pa.string()), "links": links})

    return rows.groupBy("band", "bucket", "i", "j").applyInArrow(run, "set_key string, root string, links long")


def joined(docs: DataFrame, threshold: float = THRESHOLD, n: int = N, recall: float = RECALL,
           block: int = BLOCK) -> DataFrame:
    """doc_id, class_id, n_links, n_copies for every row of ``docs``, with
    ``text_key`` (the text's digest) and ``class_key`` (one per class)."""
    bands, rows = choose_bands(threshold, recall)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = stage(sketches(docs, bands, rows, n), "sketches")
    classes = stage(classes_of(sketch), "classes")
    links = stage(verified_links(docs, classes, threshold, n, block), "links")
    counts = links.groupBy("set_key").agg(F.sum("links").alias("links"))
    edges = links.where("set_key <> root").select(F.col("set_key").alias("src"), F.col("root").alias("dst")).distinct()
    labels = connected_components(edges).withColumnRenamed("node", "set_key")
    linked = classes.select("set_key", "rep", "n_texts").join(labels, "set_key", "left").join(counts, "set_key", "left")
    named = linked.join(linked.where("component is not null").groupBy("component").agg(F.min("rep").alias("least")),
                        "component", "left")
    per_class = named.select(
        "set_key", F.coalesce("component", "set_key").alias("class_key"),
        F.when(F.col("component").isNotNull(), F.col("least")).otherwise(F.col("rep")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("n_texts") - 1).alias("n_links"))
    copies = sketch.groupBy("set_key", "text_key").agg(F.count("*").alias("n_copies"))
    return sketch.select("doc_id", "set_key", "text_key").join(copies.join(per_class, "set_key"),
                                                               ["set_key", "text_key"])


def jaccard_join(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, class_id, n_links, n_copies for every row of ``docs``."""
    return joined(docs, **settings).select("doc_id", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """One document of each class: the one with the smallest id (null ids
    last; of equal ids, the smallest text digest), with the columns of
    ``docs``."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = joined(docs, **settings).groupBy("class_key").agg(F.min(order).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("_kept_id"), F.col("first.text_key").alias("_kept_text"))
    keyed = docs.withColumn("_text_key", F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    left = keyed.join(kept, keyed["doc_id"].cast("long").eqNullSafe(kept["_kept_id"])
                      & (keyed["_text_key"] == kept["_kept_text"]), "left_semi")
    return left.dropDuplicates(["doc_id", "_text_key"]).select(docs.columns)
