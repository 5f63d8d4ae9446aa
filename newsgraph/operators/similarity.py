"""Same-day similarity self-join, exact.

Two vector kinds:

* **Shingle sets** (default for text).  A text is the set of its distinct
  lower-cased word 3-grams; the cosine of two binary sets is
  ``|A∩B| / sqrt(|A||B|)``.  Candidates come from an inverted index on a
  *prefix* of each set (rarest shingles of the day first): if two unit vectors have cosine ≥ t they share an element of their
  prefixes, where a prefix keeps elements until the rest has norm < t
  (Bayardo, Ma, Srikant, "Scaling up all pairs similarity search", WWW 2007).
  No pair is lost; every candidate is then checked exactly.  Identical sets
  in a day are collapsed to one representative before any pairing, so a
  group of copies costs one row, not a quadratic number of pairs.
* **Dense vectors** (an embedding table).  Exact cosine within a day by
  matrices: vectors packed into blocks of bounded size, pairs of blocks
  multiplied in the workers, blocks too far apart skipped by the triangle
  inequality of angles.
"""
from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import materialize, stage_table
from .common import bounded_broadcast, measured_broadcast

# executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def shingle_sets(df: DataFrame, text_col: str = "text", id_col: str = "article_id",
                 day_col: str = "datetime", k: int = 3) -> DataFrame:
    """(id, day, text, terms array<long>): the distinct word k-grams of
    ``text_col``, each as a 64-bit hash of the day and the k-gram (so equal
    terms mean the same day).  ``_with_shingles`` gives the k-grams themselves."""
    toks = df.select(F.col(id_col).alias("id"), F.col(day_col).alias("day"), F.col(text_col).alias("text"),
                     tx.word_tokens(text_col).alias("toks"))
    return toks.select("id", "day", "text", tx.shingle_hashes("toks", k, "day").alias("terms"))


def _with_shingles(rows: DataFrame, k: int) -> DataFrame:
    """(id, day, sh array<string>): the distinct k-grams of ``text``."""
    toks = rows.select("id", "day", tx.word_tokens("text").alias("toks"))
    return toks.select("id", "day", tx.shingles_of_tokens("toks", k).alias("sh"))


def _staged(sets: DataFrame) -> DataFrame:
    """(id, day, text, terms, n, sig): the sets written once, ``sig`` equal for
    equal non-empty sets."""
    # no filter here: a predicate on the sets would be pushed below the
    # projection (and the repartition) and recompute the shingles
    sig = F.when(F.size("terms") == 0, F.concat(F.lit("empty:"), F.col("id").cast("string"))) \
        .otherwise(F.sha2(F.array_join(F.sort_array("terms").cast("array<string>"), " "), 256))
    return stage_table(sets.select("id", "day", "text", "terms", F.size("terms").alias("n"), sig.alias("sig")),
                       "shingle_sets")


def collapse_copies(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Collapse identical non-empty sets of a day.

    Returns ``(reps, copies)``: ``reps(id, day, text, terms, n)`` one row per
    distinct set (id = smallest member; an empty set is always its own
    singleton, never merged or paired), ``copies(id, rep)`` for the other
    members.  The sets are staged once, as columns; the grouping is a partial
    aggregation over signatures, so a hot group of copies is combined
    map-side, and the sets themselves are not dealt again where the copies'
    ids can be broadcast."""
    s = _staged(sets)
    rep_ids = s.groupBy("day", "sig").agg(F.min("id").alias("rep"))
    copies = (s.select("id", "day", "sig").join(rep_ids, ["day", "sig"])
              .where(F.col("id") != F.col("rep")).select("id", "rep"))
    gone = copies.select("id").distinct().join(rep_ids.select(F.col("rep").alias("id")), "id", "left_anti")
    return s.drop("sig").join(measured_broadcast(gone), "id", "left_anti"), copies


def _prefixes(reps: DataFrame, t2: float) -> DataFrame:
    """(id, lo, hi, term, rest) for the prefix elements of every representative
    that others of its day have too.

    Candidates are verified on the real sets.  Elements are in the order (day's
    document frequency, term), rarest first; ``rest`` is the number of elements
    from this one on.  The prefix keeps elements until the remaining k satisfy
    k < t²·n (one extra element guards the ceil against float rounding).
    Elements that no other set has come first in that order and join nothing:
    they are dropped once counted, before anything is dealt by id, and ``rest``
    counts from the end.  ``lo`` and ``hi`` are the set's size; an id that
    stands on several rows has their smallest and largest, and ``rest`` over
    all of them, which only lets more candidates through."""
    flat = reps.where(F.col("day").isNotNull()).select("id", F.explode("terms").alias("term"))
    df = F.count("*").over(Window.partitionBy("term"))
    shared = flat.withColumn("df", df).where("df > 1")
    # position in the order within each set (a window per set: one set is one
    # source row, so no window partition is larger than a text)
    rest = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("df"), F.desc("term")))
    sizes = reps.groupBy("id").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    return (shared.withColumn("rest", rest).join(sizes, "id")
            .where(F.col("rest") >= F.ceil(F.col("lo") * F.lit(t2)) - 1)
            .select("id", "lo", "hi", "term", "rest"))


def _pair_candidates(pref: DataFrame, t: float) -> DataFrame:
    """Candidate pairs sharing a term (which names its day), by two exact filters.

    Size: cos ≥ t needs t²·n_a ≤ n_b ≤ n_a / t².  Position: no element before
    a pair's first common one is shared, so its overlap is at most the smaller
    of the two ``rest`` there; a pair that reaches the threshold passes at its
    first common term, and one whose sets differ too much before it never
    becomes a row."""
    a, b = pref.alias("a"), pref.alias("b")
    need = F.lit(t) * F.sqrt(F.col("a.lo").cast("double") * F.col("b.lo")) - F.lit(1e-9)
    cond = ((F.col("a.term") == F.col("b.term")) & (F.col("a.id") < F.col("b.id"))
            & (F.col("b.hi") >= F.col("a.lo") * (t * t)) & (F.col("a.hi") >= F.col("b.lo") * (t * t))
            & (F.least("a.rest", "b.rest") >= need))
    return a.join(b, cond).select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).distinct()


def _verify(cand: DataFrame, reps: DataFrame, t: float, k: int = 3) -> DataFrame:
    """Exact check of candidate pairs on their k-grams:
    ``overlap / sqrt(n_a * n_b) >= t``.  Only the candidates' texts are cut."""
    cand = materialize(cand)
    ids = cand.select(F.col("id_a").alias("id")).unionByName(cand.select(F.col("id_b").alias("id"))).distinct()
    near = reps.select("id", "day", "text").join(measured_broadcast(ids), "id", "left_semi")
    sets = materialize(_with_shingles(near, k))
    sa = sets.select(F.col("id").alias("id_a"), "day", F.col("sh").alias("sh_a"), F.size("sh").alias("n_a"))
    sb = sets.select(F.col("id").alias("id_b"), F.col("day").alias("day_b"), F.col("sh").alias("sh_b"),
                     F.size("sh").alias("n_b"))
    ov = F.size(F.array_intersect("sh_a", "sh_b"))
    sim = ov / F.sqrt(F.col("n_a").cast("double") * F.col("n_b"))
    return (cand.join(sa, "id_a").join(sb, "id_b").where(F.col("day") == F.col("day_b"))
            .select("id_a", "id_b", "day", sim.alias("sim"))
            .where(F.col("sim") >= F.lit(t)))


def set_pairs(reps: DataFrame, eps: float, k: int = 3) -> DataFrame:
    """All pairs of representatives with cosine distance ≤ eps (exact).

    ``reps(id, day, text, terms, n)`` of word k-grams; returns ``(id_a, id_b,
    day, sim)`` with ``id_a < id_b``.  Edge rule: ``overlap / sqrt(n_a * n_b)
    >= 1 - eps``.  Posting lists of any length go the same way."""
    t = 1.0 - eps
    if t <= 0:
        raise ValueError("eps must be < 1 for set similarity")
    pref = materialize(_prefixes(reps, t * t))   # read by both sides of the self-join
    return _verify(_pair_candidates(pref, t), reps, t, k)


def similar_text_pairs(df: DataFrame, eps: float = 0.35, text_col: str = "text",
                       id_col: str = "article_id", day_col: str = "datetime",
                       k: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shingle path end to end: ``(edges, copies, nodes)``.

    ``edges(id_a, id_b, day, sim)`` between representatives, ``copies(id,
    rep)`` linking every other copy to its representative, ``nodes(node)``
    every representative id (a text without words is its own singleton)."""
    sets = shingle_sets(df, text_col, id_col, day_col, k)
    reps, copies = collapse_copies(sets)
    return set_pairs(reps, eps, k), copies, reps.select(F.col("id").alias("node"))


def all_text_pairs(df: DataFrame, eps: float = 0.35, text_col: str = "text", id_col: str = "article_id",
                   day_col: str = "datetime", k: int = 3, tile_rows: int = 512) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair of rows of a day with cosine
    distance ≤ eps, copies with each other and with what their set is near to.

    Distinct sets are compared once (``set_pairs``); a near pair of sets then
    stands for all pairs of its rows.  Rows of a set are kept in lists of about
    ``tile_rows``, and a pair of lists is taken apart where it is written: only
    the pairs themselves grow as the square of a group."""
    s = (_staged(shingle_sets(df, text_col, id_col, day_col, k))
         .where(F.col("day").isNotNull() & (F.col("n") > 0) & F.col("id").isNotNull())
         .withColumn("set", F.xxhash64("day", "sig")).drop("sig"))
    groups = measured_broadcast(s.groupBy("set").agg(F.min("id").alias("rep"), F.count("*").alias("rows"))
                                .where("rows > 1"))
    gone = s.select("set", "id").join(groups, "set").where("id <> rep").select("set", "id").distinct()
    reps = s.join(measured_broadcast(gone), ["set", "id"], "left_anti").drop("id").withColumnRenamed("set", "id")
    # a row that stands twice is two rows of its set
    near = materialize(set_pairs(reps, eps, k).select("id_a", "id_b").distinct())

    sets = near.select(F.col("id_a").alias("set")).unionByName(near.select(F.col("id_b").alias("set")))
    used = measured_broadcast(sets.unionByName(groups.select("set")).distinct())
    tiles = F.ceil(F.coalesce("rows", F.lit(1)) / tile_rows).cast("int")
    lists = materialize(s.select("set", "id").join(used, "set", "left_semi").join(groups, "set", "left")
                        .select("set", "id", tiles.alias("tiles"))
                        .groupBy("set", "tiles", F.pmod(F.xxhash64("id"), "tiles").cast("int").alias("t"))
                        .agg(F.collect_list("id").alias("ids")))
    few = bounded_broadcast(lists)
    numbers = bounded_broadcast(lists.select("set", "tiles").distinct())
    every = F.sequence(F.lit(0), F.col("tiles") - 1)

    def side(x: str) -> DataFrame:
        return few.select(F.col("set").alias(f"id_{x}"), F.col("t").alias(f"t_{x}"), F.col("ids").alias(f"ids_{x}"))

    between = near
    for x in "ab":                                           # numbers only, until the lists are there
        between = (between.join(numbers.withColumnRenamed("set", f"id_{x}"), f"id_{x}")
                   .withColumn(f"t_{x}", F.explode(every)).drop("tiles"))
    between = (between.join(side("a"), ["id_a", "t_a"]).join(side("b"), ["id_b", "t_b"])
               .select(F.lit(False).alias("one"), "ids_a", "ids_b"))
    # two lists i <= j of a set meet in one place
    left = lists.where("tiles > 1 or size(ids) > 1").select("set", F.col("t").alias("i"), F.col("ids").alias(
        "ids_a"), F.explode(F.filter(every, lambda j: j >= F.col("t"))).alias("j"))
    right = lists.where("tiles > 1 or size(ids) > 1").select("set", F.col("t").alias("j"), F.col("ids").alias(
        "ids_b"), F.explode(F.filter(every, lambda i: i <= F.col("t"))).alias("i"))
    within = left.join(right, ["set", "i", "j"]).select((F.col("i") == F.col("j")).alias("one"), "ids_a", "ids_b")
    both = (between.unionByName(within).select("one", F.explode("ids_a").alias("x"), "ids_b")
            .select("one", "x", F.explode("ids_b").alias("y")))
    met = both.where(F.when(F.col("one"), F.col("x") < F.col("y")).otherwise(F.col("x") != F.col("y")))
    return met.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def _packed(vectors: DataFrame, id_col: str, day_col: str, vec_col: str, block_rows: int,
            cell_bits: int) -> DataFrame:
    """(day, block, n, center, radius, ids, matrix): unit vectors packed into
    matrices.

    Vectors with the same signs in ``cell_bits`` random directions share a
    cell, so a block's vectors lie close together; a cell with more than
    ``block_rows`` is cut by id hash.  ``center`` is the block's mean direction,
    ``radius`` its largest angle to it."""
    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}               # the same ones on every worker
        for batch in batches:
            keep, cells, rows = [], [], []
            for i, v in enumerate(batch.column(2)):
                v = np.array(v.as_py() or [], np.float64)    # a null element gives a null direction
                norm = math.sqrt(float(v @ v))
                if norm > 0:
                    if (d := directions.get(len(v))) is None:
                        d = directions[len(v)] = np.random.default_rng(len(v)).standard_normal((cell_bits, len(v)))
                    keep.append(i)
                    rows.append((v / norm).astype("<f8").tobytes())
                    cells.append(f"{len(v)}:" + "".join("01"[int(x)] for x in d @ v > 0))
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(cells, pa.string()),
                 pa.array(rows, pa.binary())], names=["id", "day", "cell", "u"])

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        u = np.vstack([np.frombuffer(x, "<f8") for x in group.column("u").to_pylist()])
        mean = u.sum(axis=0)
        norm = math.sqrt(float(mean @ mean))
        center = mean / norm if norm > 0 else u[0]
        radius = float(np.arccos(np.clip(u @ center, -1.0, 1.0)).max())
        ids = np.asarray(group.column("id"), dtype="<i8")
        day, cell, part = (x.as_py() for x in key)
        return pa.table({"day": pa.array([day], pa.string()), "block": pa.array([f"{cell}/{part}"]),
                         "n": pa.array([len(u)], pa.int64()), "center": pa.array([center.tolist()]),
                         "radius": pa.array([radius]), "ids": pa.array([ids.tobytes()], pa.binary()),
                         "matrix": pa.array([u.astype("<f8").tobytes()], pa.binary())})

    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(day_col).cast("string").alias("day"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    u = materialize(slim.mapInArrow(unit, "id long, day string, cell string, u binary"))
    parts = u.groupBy("day", "cell").agg(F.ceil(F.count("*") / F.lit(float(block_rows))).cast("int").alias("parts"))
    many = parts.where("parts > 1")
    cut = u.join(many, ["day", "cell"], "left").withColumn(
        "part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int"))
    # dealt by all three, so that the parts of a large cell do not meet in one task
    packed = cut.repartition("day", "cell", "part").groupBy("day", "cell", "part").applyInArrow(
        pack, "day string, block string, n long, center array<double>, radius double, ids binary, matrix binary")
    return materialize(packed)


def dense_pairs(vectors: DataFrame, eps: float, id_col: str = "article_id",
                day_col: str = "datetime", vec_col: str = "vec",
                tile_rows: int = 1024, cell_bits: int = 4) -> DataFrame:
    """Exact cosine-distance pairs (distance ≤ eps) within a day for dense vectors.

    Vectors are packed into matrices of about ``tile_rows`` rows (so a block is
    about ``tile_rows`` times the vector's bytes, whatever a day holds), and
    pairs of blocks are multiplied as matrices inside the workers: no pair of
    vectors is a row before it is known to be near.  By the triangle inequality
    of angles two blocks are skipped where the angle between their centers less
    both radii exceeds acos(1 - eps): nothing in them can be near.

    Zero vectors, null vectors and rows without a day are never linked; vectors
    of different length neither.  Returns ``(id_a, id_b, day, dist)`` with
    ``id_a < id_b``; equal ids are not linked to each other.
    """
    def pairs_of(x: str, y: str, ids_x: np.ndarray, ids_y: np.ndarray, dist: np.ndarray):
        i, j = np.nonzero(dist <= eps)
        p, q = ids_x[i], ids_y[j]
        ok = p < q if x == y else p != q
        p, q, d = p[ok], q[ok], dist[i[ok], j[ok]]
        return [np.minimum(p, q), np.maximum(p, q), d]

    return _block_products(vectors, eps, id_col, day_col, vec_col, tile_rows, cell_bits, pairs_of,
                           ["id_a long", "id_b long", "day string", "dist double"])


def dense_links(vectors: DataFrame, eps: float, id_col: str = "article_id", day_col: str = "datetime",
                vec_col: str = "vec", tile_rows: int = 1024, cell_bits: int = 4) -> DataFrame:
    """The graph of ``dense_pairs`` without its pairs: (id, to, day, n) for the
    vectors of each pair of blocks that have links there, n their number and
    ``to`` the smallest id that a vector hangs together with in that pair of
    blocks.  Rows grow with the blocks' vectors, not with a group's square;
    (id, to) connect what the pairs connect, and the sums of n are the degrees."""
    def links_of(x: str, y: str, ids_x: np.ndarray, ids_y: np.ndarray, dist: np.ndarray):
        linked = dist <= eps
        linked &= ids_x[:, None] != ids_y[None, :]
        if x == y:
            ids, counts, sides = ids_x, linked.sum(axis=1), [(linked, slice(None), slice(None))]
        else:
            n = len(ids_x)
            ids = np.concatenate([ids_x, ids_y])
            counts = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
            sides = [(linked, slice(0, n), slice(n, None)), (linked.T, slice(n, None), slice(0, n))]
        label, high = ids.copy(), np.iinfo(np.int64).max
        while True:                                      # smallest id along the links
            before = label.copy()
            for m, own, other in sides:
                least = np.where(m, label[other][None, :], high).min(axis=1, initial=high)
                label[own] = np.minimum(label[own], least)
            if (label == before).all():
                break
        ok = counts > 0
        return [ids[ok], label[ok], counts[ok]]

    return _block_products(vectors, eps, id_col, day_col, vec_col, tile_rows, cell_bits, links_of,
                           ["id long", "to long", "day string", "n long"])


def _block_products(vectors: DataFrame, eps: float, id_col: str, day_col: str, vec_col: str, tile_rows: int,
                    cell_bits: int, rows_of: Callable, fields: list[str]) -> DataFrame:
    """``rows_of(block x, block y, ids of x, ids of y, distances)`` for every
    pair of a day's blocks that may hold a near pair."""
    names = [f.split()[0] for f in fields]
    theta = math.acos(max(-1.0, min(1.0, 1.0 - eps))) + 1e-6    # acos magnifies rounding near 1
    blocks = _packed(vectors, id_col, day_col, vec_col, tile_rows, cell_bits)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for ca, ra, cb, rb in zip(*batch.columns[3:]):
                a, b = np.asarray(ca.values), np.asarray(cb.values)
                apart = len(a) != len(b) or math.acos(max(-1.0, min(1.0, float(a @ b)))) - ra.as_py() - rb.as_py() > theta
                keep.append(not apart)
            yield pa.RecordBatch.from_arrays(batch.columns[:3], names=["day", "x", "y"]).filter(pa.array(keep))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for day, x, y, ids_x, m_x, ids_y, m_y in zip(*batch.columns):
                ids_x, ids_y = np.frombuffer(ids_x.as_buffer(), "<i8"), np.frombuffer(ids_y.as_buffer(), "<i8")
                a = np.frombuffer(m_x.as_buffer(), "<f8").reshape(len(ids_x), -1)
                b = np.frombuffer(m_y.as_buffer(), "<f8").reshape(len(ids_y), -1)
                p, q, value = rows_of(x.as_py(), y.as_py(), ids_x, ids_y, 1.0 - a @ b.T)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p), pa.array(q), pa.array([day.as_py()] * len(p), pa.string()), pa.array(value)],
                    names=names)

    head = blocks.select("day", "block", "center", "radius")
    a = head.select("day", F.col("block").alias("x"), F.col("center").alias("ca"), F.col("radius").alias("ra"))
    b = head.select("day", F.col("block").alias("y"), F.col("center").alias("cb"), F.col("radius").alias("rb"))
    pairs = (a.join(b, "day").where("x <= y").select("day", "x", "y", "ca", "ra", "cb", "rb")
             .mapInArrow(near, "day string, x string, y string"))
    left = blocks.select("day", F.col("block").alias("x"), F.col("ids").alias("ids_x"), F.col("matrix").alias("m_x"))
    right = blocks.select("day", F.col("block").alias("y"), F.col("ids").alias("ids_y"), F.col("matrix").alias("m_y"))
    joined = pairs.join(left, ["day", "x"]).join(right, ["day", "y"])
    return joined.select("day", "x", "y", "ids_x", "m_x", "ids_y", "m_y").mapInArrow(
        multiply, ", ".join(fields))
