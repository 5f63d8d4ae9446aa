"""K3: vectors from text, and D7 on them through random projections.

``tfidf_vectors`` makes the vector of a text or title: its lower-cased words
hashed into ``N_FEATURES`` buckets, counts times ``ln((1 + n) / (1 + df)) + 1``,
unit length.  Words are hashed in the JVM and counted inside the row, so no word
is ever a shuffled row; only document frequencies are, combined map-side to
``N_FEATURES`` counts at most.

``similar_vector_pairs`` finds same-day pairs of vectors with cosine distance at
most eps.  Candidates share a *band*: the signs of ``bits`` random projections,
packed into one number.  Two vectors at angle a agree in one sign with
probability 1 - a / pi, from which ``choose_bands`` takes the number of bands
that lets a pair exactly at eps be missed with probability 1 - recall (closer
pairs less).  Every candidate is then checked on the vectors themselves, so
nothing wrong is returned; what is missed is bounded by the recall asked for.

Equal vectors of a day are collapsed to the smallest id before any pairing.  The
rows of a day go in blocks, and the pairs of two blocks are found in one task: by
the bands, then by all signs (``most_signs_apart``), then on the vectors.  A
candidate is never a row of a table; a near pair is.
"""
from __future__ import annotations

import hashlib
import math
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import materialize, stage_table
from .common import measured_broadcast
from .components import connected_components

# executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hash buckets of words; also the bound on what is sent to every task.
N_FEATURES = 1 << 18
#: Signs in one band: two texts without a common word share a band once in 2 ** BITS.
BITS = 20
RECALL = 0.95
#: Rows of a day that are compared in one task with as many: about 25 MB sent, four times that in memory.
BLOCK_ROWS = 1 << 16
#: Rows packed together, and words held meanwhile.
PACKED_ROWS, PACKED_WORDS = 512, 1 << 21
#: Pairs, and words of their vectors, that a task holds at a time.
PAIRS, GATHERED = 1 << 16, 1 << 19

VECTOR = "idx array<int>, w array<double>"


def hashed_words(col: str | Column, n_features: int = N_FEATURES) -> Column:
    """The hash bucket of every word of a text, in order."""
    return F.transform(tx.word_tokens(col), lambda t: F.pmod(F.xxhash64(t), F.lit(n_features)).cast("int"))


def _counted(df: DataFrame) -> DataFrame:
    """(id, day, idx, tf, sig): distinct buckets, ascending, and how often
    each; ``sig`` is the hash of both, null without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx, tf, sig = [], [], []
            for x in batch.column(2):
                found, n = np.unique(np.array(x.values if x.is_valid else [], dtype=np.int32), return_counts=True)
                idx.append(found)
                tf.append(n)
                sig.append(hashlib.sha256(found.astype("<i4").tobytes() + n.astype("<i4").tobytes()).digest()
                           if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(idx, pa.list_(pa.int32())),
                 pa.array(tf, pa.list_(pa.int32())), pa.array(sig, pa.binary())],
                names=["id", "day", "idx", "tf", "sig"])

    return df.mapInArrow(run, "id long, day string, idx array<int>, tf array<int>, sig binary")


def word_counts(df: DataFrame, text_col: str = "text", id_col: str = "article_id", day_col: str = "datetime",
                n_features: int = N_FEATURES) -> DataFrame:
    """(id, day, idx, tf, sig): the distinct word buckets of a text, ascending,
    how often each, and a hash of both; written once, as several later steps
    read it."""
    slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(day_col).cast("string").alias("day"),
                     hashed_words(text_col, n_features).alias("words"))
    return stage_table(_counted(slim), "word-counts")


def tfidf_vectors(df: DataFrame, text_col: str = "text", id_col: str = "article_id", day_col: str = "datetime",
                  n_features: int = N_FEATURES) -> DataFrame:
    """K3: (id, day, idx, w), w the unit-length TF-IDF weights of the word
    buckets ``idx`` (ascending).

    A text without words (or null) has the empty vector, which is near
    nothing.  Two words may share a bucket: their counts add up."""
    counted = word_counts(df, text_col, id_col, day_col, n_features)
    return _weighed(counted, _idf(counted, n_features))


def _idf(counted: DataFrame, n_features: int) -> Broadcast:
    """The weight of every bucket (n_features numbers), on all workers."""
    def texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_features, np.int64)
        for batch in batches:
            df += np.bincount(np.asarray(batch.column(0).flatten()), minlength=n_features)
        i = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(df[i])], names=["i", "df"])

    n_docs = counted.count()
    # n_features rows at most, from a task and in all
    dfreq = (counted.select("idx").mapInArrow(texts_with, "i int, df long")
             .groupBy("i").agg(F.sum("df").alias("df")).toPandas())
    idf = np.full(n_features, math.log(1 + n_docs) + 1, np.float32)
    idf[dfreq["i"].to_numpy()] = np.log((1 + n_docs) / (1 + dfreq["df"].to_numpy(np.float64))) + 1
    return counted.sparkSession.sparkContext.broadcast(idf)


def _weights(idx: pa.ListScalar, tf: pa.ListScalar, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i = np.asarray(idx.values)
    v = np.asarray(tf.values, np.float64) * idf[i]
    return i, v / math.sqrt(float(v @ v)) if len(v) else v


def _weighed(counted: DataFrame, idf: Broadcast) -> DataFrame:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = [_weights(i, n, idf.value)[1] for i, n in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(w, pa.list_(pa.float64()))],
                                             names=["id", "day", "idx", "w"])

    return counted.select("id", "day", "idx", "tf").mapInArrow(weigh, f"id long, day string, {VECTOR}")


def choose_bands(eps: float, recall: float = RECALL, bits: int = BITS) -> int:
    """Bands so that a pair exactly at distance eps shares one with
    probability ``recall``."""
    same = 1 - math.acos(max(-1.0, 1.0 - eps)) / math.pi
    return 1 if same >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - same ** bits)))


def random_signs(idx: np.ndarray, n_bits: int, seed: int = 0) -> np.ndarray:
    """One row of ``n_bits`` random signs (0 or 1) for each feature, made from
    its number alone."""
    words = -(-n_bits // 64)
    x = idx.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64) + np.uint64(seed << 40)
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.unpackbits(x.astype("<u8").view(np.uint8), axis=1)[:, :n_bits]


def _signs(idx: np.ndarray, w: np.ndarray, n_bits: int) -> np.ndarray:
    """The signs (true or false) of a vector's projections."""
    # sum of +-w over the features: twice the sum of those with sign 1, less all of them
    return 2 * (w.astype(np.float32) @ random_signs(idx, n_bits).astype(np.float32)) > w.sum()


def bands_of(counted: DataFrame, idf: Broadcast, n_bands: int, bits: int = BITS) -> DataFrame:
    """(id, bands array<long>): the packed signs of every band, each with its
    day and number hashed in; the empty vector has none.  The definition of the
    candidates, in rows; ``similar_vector_pairs`` compares bands in its tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.int64(1) << np.arange(bits, dtype=np.int64)
        for batch in batches:
            out = []
            for i, n in zip(batch.column(2), batch.column(3)):
                idx, w = _weights(i, n, idf.value)
                if not len(idx):
                    out.append([])
                    continue
                out.append(_signs(idx, w, n_bands * bits).reshape(n_bands, bits) @ place)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], names=["id", "day", "bands"])

    signs = counted.select("id", "day", "idx", "tf").mapInArrow(run, "id long, day string, bands array<long>")
    return signs.where("day is not null").select(
        "id", F.transform("bands", lambda b, k: F.xxhash64("day", k, b)).alias("bands"))


def collapse_equal(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(reps, copies)``: the row with the smallest id of each group of equal
    words and counts of a day, and (id, rep) for the others.  Rows without
    words or day are never merged."""
    keyed = counted.select("id", "day", F.when(F.col("day").isNotNull(), F.col("sig")).alias("sig"))
    least = (keyed.where("sig is not null").groupBy("day", "sig")
             .agg(F.min("id").alias("rep"), F.count("*").alias("n")).where("n > 1").drop("n"))
    least = measured_broadcast(least)
    copies = materialize(keyed.join(least, ["day", "sig"]).where("id <> rep").select("id", "rep"))
    # the words are not dealt to drop the copies' rows; an id may have other rows that stay
    ids = measured_broadcast(copies.select("id").distinct())
    stay = (keyed.join(ids, "id", "left_semi").join(least, ["day", "sig"], "left")
            .where("rep is null or rep = id").select("id").distinct())
    gone = measured_broadcast(ids.join(stay, "id", "left_anti"))
    return counted.where("id is not null").join(gone, "id", "left_anti"), copies


def _buckets(bands: DataFrame, tile_rows: int) -> DataFrame:
    """(key, id, n, tiles, t): the members of every band with at least two,
    their number, and the tile of each."""
    rows = bands.select("id", F.explode("bands").alias("key")).repartition("key")   # dealt once, read twice
    # a bucket of one row pairs nothing; a large one is cut into tiles
    sizes = (rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
             .select("key", "n", F.ceil(F.col("n") / tile_rows).cast("int").alias("tiles")))
    return stage_table(rows.join(sizes, "key").withColumn(
        "t", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")), "band-buckets")


def _met(rows: DataFrame) -> DataFrame:
    """Distinct (id_a, id_b), id_a < id_b, that share a bucket."""
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    # tile pair (i, j), i <= j: every pair of rows meets in just one
    left = rows.select("key", F.col("id").alias("x"), F.col("t").alias("i"), F.explode(
        F.filter(every, lambda j: j >= F.col("t"))).alias("j"))
    right = rows.select("key", F.col("id").alias("y"), F.col("t").alias("j"), F.explode(
        F.filter(every, lambda i: i <= F.col("t"))).alias("i"))
    met = left.join(right, ["key", "i", "j"]).where((F.col("i") < F.col("j")) | (F.col("x") < F.col("y")))
    return met.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def _candidates(bands: DataFrame, tile_rows: int) -> DataFrame:
    """Distinct (id_a, id_b), id_a < id_b, that share a band of one day."""
    return _met(_buckets(bands, tile_rows))


def most_signs_apart(eps: float, n_bits: int, chance: float = 2.0 ** -64) -> int:
    """The number of signs of ``n_bits`` above which two vectors of distance
    ``eps`` differ with at most ``chance`` (Chernoff's bound): as unlikely as
    two words with one 64-bit hash."""
    p = max(1e-6, math.acos(max(-1.0, min(1.0, 1.0 - eps))) / math.pi)

    def exponent(k: int) -> float:
        q = k / n_bits
        return n_bits * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0))

    return next((k - 1 for k in range(math.floor(p * n_bits) + 1, n_bits + 1) if exponent(k) >= -math.log(chance)), n_bits)


def _planes(x: np.ndarray) -> bytes:
    """Numbers as their low bytes, then their next ones: high bytes are nearly
    all zero, which compresses well."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _packed(reps: DataFrame, idf: Broadcast, n_bits: int, block_rows: int) -> DataFrame:
    """(day, block, blocks, ids, norms, signs, words): the rows of a day, dealt
    into blocks of about ``block_rows``, some hundreds to a row of the table:
    ids, lengths and signs as bytes, and compressed the number of words of
    each, the gaps between its buckets and their counts.  About two bytes a
    word, where an array of numbers has eight."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        names = ["day", "block", "blocks", "ids", "norms", "signs", "words"]

        def packed(key: tuple) -> pa.RecordBatch:
            ids, norms, signs, gaps, tfs = zip(*held.pop(key))
            words = zlib.compress(_planes(np.array([len(g) for g in gaps])) + _planes(np.concatenate(gaps))
                                  + _planes(np.concatenate(tfs)), 1)
            columns = [*key, np.array(ids, "<i8").tobytes(), np.array(norms, "<f8").tobytes(), b"".join(signs), words]
            kinds = [pa.string(), pa.int32(), pa.int32()] + 4 * [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(columns, kinds)], names=names)

        n_words = 0
        for batch in batches:
            for i, day, block, blocks, idx, tf in zip(*batch.columns):
                x, n = np.asarray(idx.values), np.asarray(tf.values)
                if not len(x):
                    continue
                v = np.asarray(n, np.float64) * idf.value[x]
                norm = math.sqrt(float(v @ v))
                key = (day.as_py(), block.as_py(), blocks.as_py())
                rows = held.setdefault(key, [])
                rows.append((i.as_py(), norm, np.packbits(_signs(x, v / norm, n_bits)).tobytes(),
                             np.diff(x, prepend=-1), n))
                n_words += len(x)
                if len(rows) >= PACKED_ROWS:
                    n_words -= sum(len(r[3]) for r in rows)
                    yield packed(key)
                elif n_words >= PACKED_WORDS:
                    n_words = 0
                    yield from [packed(k) for k in list(held)]
        yield from [packed(k) for k in list(held)]

    rows = reps.where("day is not null").select("id", "day", "idx", "tf")
    blocks = rows.groupBy("day").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    cut = rows.join(measured_broadcast(blocks), "day").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    return stage_table(cut.select("id", "day", "block", "blocks", "idx", "tf").mapInArrow(
        pack, "day string, block int, blocks int, ids binary, norms binary, signs binary, words binary"), "packed-words")


class _Block:
    """The rows of a block, by id: ``ids``, ``norms``, ``keys`` (one number a
    band), ``signs`` (64 in a word), and the words of row r at ``at[r]:at[r +
    1]`` of ``idx`` and ``tf``."""

    def __init__(self, table: pa.Table, n_bands: int, bits: int):
        def all_of(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

        self.ids, self.norms = all_of("ids", "<i8"), all_of("norms", "<f8")
        wide = -(-n_bands * bits // 8)
        signs = all_of("signs", np.uint8).reshape(-1, wide)
        place = 1 << np.arange(bits, dtype=np.int64)
        self.keys = np.empty((len(signs), n_bands), np.int64 if bits > 31 else np.int32)
        for k in range(0, len(signs), 2048):
            on = np.unpackbits(signs[k:k + 2048], axis=1)[:, :n_bands * bits]
            self.keys[k:k + 2048] = on.reshape(-1, n_bands, bits) @ place
        self.signs = np.zeros((len(signs), -(-wide // 8) * 8), np.uint8)
        self.signs[:, :wide] = signs
        self.signs = self.signs.view(np.uint64)
        lengths, idx, tf = [], [], []
        for ids, words in zip(table.column("ids"), table.column("words")):
            n = len(ids.as_py()) // 8
            flat = zlib.decompress(words.as_py())
            many = _numbers(flat[:4 * n])
            gaps, counts = (_numbers(x) for x in (flat[4 * n:(len(flat) + 4 * n) // 2], flat[(len(flat) + 4 * n) // 2:]))
            whole = np.cumsum(gaps, dtype=np.int64)          # buckets begin at gap - 1 in each row
            start = np.cumsum(many) - many
            idx.append((whole - np.repeat(whole[start] - gaps[start], many) - 1).astype(np.int32))
            tf.append(counts.astype(np.min_scalar_type(counts.max(initial=0))))
            lengths.append(many)
        self.at = np.concatenate([[0], np.cumsum(np.concatenate([*lengths, np.zeros(0, np.int64)]))]).astype(np.int64)
        self.idx = np.concatenate([*idx, np.zeros(0, np.int32)])
        del idx                                              # as large as all of it
        self.tf = np.concatenate([*tf, np.zeros(0, np.uint8)])


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def _sharing(x: _Block, y: _Block, apart: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of two blocks (of one, each pair once) that share a band
    and differ in at most ``apart`` signs, each pair at its first band."""
    for band in range(x.keys.shape[1]):
        ox = np.argsort(x.keys[:, band], kind="stable")
        kx = x.keys[ox, band]
        if x is y:
            oy, first, last = ox, np.arange(1, len(kx) + 1), np.searchsorted(kx, kx, "right")
        else:
            oy = np.argsort(y.keys[:, band], kind="stable")
            ky = y.keys[oy, band]
            first, last = np.searchsorted(ky, kx, "left"), np.searchsorted(ky, kx, "right")
        n = last - first
        ends = np.cumsum(n)
        for k in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):   # as many at a time, also of one row
            pair = np.arange(k, min(k + PAIRS, int(ends[-1])))
            left = np.searchsorted(ends, pair, "right")
            a, b = ox[left], oy[first[left] + pair - (ends[left] - n[left])]
            ok = np.bitwise_count(x.signs[a] ^ y.signs[b]).sum(axis=1) <= apart
            ok &= x.ids[a] != y.ids[b]
            a, b = a[ok], b[ok]
            new = ~(x.keys[a, :band] == y.keys[b, :band]).any(axis=1)
            if new.any():
                yield a[new], b[new]


def _cosines(x: _Block, y: _Block, a: np.ndarray, b: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The cosine of each pair of rows, ``a`` ascending."""
    out, wide = np.empty(len(a)), np.zeros(len(idf))
    cuts = np.flatnonzero(np.diff(a, prepend=-1, append=-1))
    for s, e in zip(cuts[:-1], cuts[1:]):
        own = slice(x.at[a[s]], x.at[a[s] + 1])
        i, weight = x.idx[own], idf[x.idx[own]].astype(np.float64)
        wide[i] = x.tf[own] * weight / x.norms[a[s]] * weight
        size = y.at[b[s:e] + 1] - y.at[b[s:e]]
        part = np.cumsum(size) // GATHERED
        for p in np.unique(part):
            some = s + np.flatnonzero(part == p)
            length = y.at[b[some] + 1] - y.at[b[some]]
            start = np.cumsum(length) - length
            take = np.repeat(y.at[b[some]] - start, length) + np.arange(length.sum())
            out[some] = np.add.reduceat(wide[y.idx[take]] * y.tf[take], start) / y.norms[b[some]]
        wide[i] = 0
    return out


def similar_vector_pairs(reps: DataFrame, idf: Broadcast, eps: float, recall: float = RECALL, bits: int = BITS,
                         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """D7, approximate: (id_a, id_b, day, dist) with dist <= eps, of different
    vectors of a day.  Every pair is checked; see ``choose_bands`` for those
    that may be missed.

    The rows of a day go in compressed blocks, each pair of blocks to one task,
    which compares bands, signs and vectors there: a pair is a row only when it
    is near, and a vector is sent once for every block of its day."""
    n_bands = choose_bands(eps, recall, bits)
    apart = most_signs_apart(eps, n_bands * bits)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        x = _Block(left, n_bands, bits)
        y = _Block(right, n_bands, bits) if right.num_rows else x
        near: list[tuple[np.ndarray, ...]] = []

        def check(some: list[tuple[np.ndarray, np.ndarray]]) -> None:
            a, b = (np.concatenate(c) for c in zip(*some))
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            dist = 1.0 - _cosines(x, y, a, b, idf.value)
            ok = dist <= eps + 1e-12
            near.append((x.ids[a[ok]], y.ids[b[ok]], dist[ok]))

        some, n = [], 0
        if left.num_rows and (right.num_rows or left.column("i")[0] == left.column("j")[0]):
            for a, b in _sharing(x, y, apart):
                some.append((a, b))
                n += len(a)
                if n >= PAIRS:
                    check(some)
                    some, n = [], 0
            if some:
                check(some)
        p, q, d = (np.concatenate(c) for c in zip(*near)) if near else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        day = pa.array([left.column("day")[0].as_py()] * len(p) if len(p) else [], pa.string())
        return pa.table([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q)), day, pa.array(d)],
                        names=["id_a", "id_b", "day", "dist"])

    packed = _packed(reps, idf, n_bands * bits, block_rows)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    wide = ["ids", "norms", "signs", "words"]
    # blocks i <= j of a day meet in one place; a block meets itself on one side only
    left = packed.select("day", F.col("block").alias("i"), F.explode(
        F.filter(every, lambda j: j >= F.col("block"))).alias("j"), *wide)
    right = packed.select(F.col("day").alias("d"), F.explode(F.filter(every, lambda i: i < F.col("block"))).alias("p"),
                          F.col("block").alias("q"), *[F.col(c).alias(c) for c in wide])   # columns of its own
    return left.groupBy("day", "i", "j").cogroup(right.groupBy("d", "p", "q")).applyInArrow(
        run, "id_a long, id_b long, day string, dist double")


def similar_texts(df: DataFrame, eps: float, text_col: str = "text", id_col: str = "article_id",
                  day_col: str = "datetime", recall: float = RECALL, bits: int = BITS) -> DataFrame:
    """``erase_similar``'s graph on TF-IDF vectors: (id, cluster_id, n_links)
    for every row; n_links counts the different vectors it is linked to.
    Rows with equal vectors are in one cluster, rows without words alone.
    Ids must be unique and not null."""
    counted = word_counts(df, text_col, id_col, day_col)
    idf = _idf(counted, N_FEATURES)
    reps, copies = collapse_equal(counted)
    edges = materialize(similar_vector_pairs(reps, idf, eps, recall, bits))
    comp = connected_components(edges, reps.select(F.col("id").alias("node")), src="id_a", dst="id_b")
    links = (edges.select(F.col("id_a").alias("id")).unionByName(edges.select(F.col("id_b").alias("id")))
             .groupBy("id").agg(F.count("*").alias("n_links")))
    own = (comp.select(F.col("node").alias("id"), F.col("component").alias("cluster_id")).join(links, "id", "left")
           .withColumn("n_links", F.coalesce("n_links", F.lit(0))))
    of_copies = copies.join(own.withColumnRenamed("id", "rep"), "rep").select("id", "cluster_id", "n_links")
    return own.unionByName(of_copies)
