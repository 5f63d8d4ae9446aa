import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsgraph.operators import vectors
from newsgraph.sources import tables as tb

SF = "/root/testdata/sf0.001"


def brute_vectors(rows, n_features):
    """{id: {bucket: weight}} from (id, buckets)."""
    tf = {i: Counter(words) for i, words in rows}
    df = Counter(b for c in tf.values() for b in c)
    out = {}
    for i, c in tf.items():
        v = {b: n * (math.log((1 + len(tf)) / (1 + df[b])) + 1) for b, n in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out[i] = {b: x / norm for b, x in v.items()}
    return out


def brute_pairs(vec, day, eps):
    """Pairs by plain dot products of all rows of a day."""
    ids, out = defaultdict(list), set()
    for i, d in day.items():
        ids[d].append(i)
    for members in ids.values():
        for k, a in enumerate(sorted(members)):
            for b in sorted(members)[k + 1:]:
                small, large = sorted((vec[a], vec[b]), key=len)
                if small and 1 - sum(x * large.get(w, 0) for w, x in small.items()) <= eps:
                    out.add((a, b))
    return out


@pytest.fixture(scope="module")
def articles(spark):
    """All on one day, so that there are pairs."""
    return tb.articles(spark, SF).withColumn("datetime", F.lit("20240101"))


@pytest.fixture(scope="module")
def hashed(articles):
    rows = articles.select("article_id", "datetime", vectors.hashed_words("text").alias("w")).collect()
    return ({r["article_id"]: r["datetime"] for r in rows},
            brute_vectors([(r["article_id"], r["w"] or []) for r in rows], vectors.N_FEATURES))


def test_vectors_equal_brute_force(articles, hashed):
    got = {r["id"]: dict(zip(r["idx"], r["w"])) for r in vectors.tfidf_vectors(articles).collect()}
    _, want = hashed
    assert got.keys() == want.keys()
    for i, v in want.items():
        assert got[i].keys() == v.keys()
        assert all(got[i][b] == pytest.approx(x, rel=1e-5) for b, x in v.items())


def links(spark, df, eps, **how):
    counted = vectors.word_counts(df, **how)
    reps, copies = vectors.collapse_equal(counted)
    idf = vectors._idf(counted, vectors.N_FEATURES)
    rep = {r["id"]: r["rep"] for r in copies.collect()}
    pairs = {(r["id_a"], r["id_b"]) for r in vectors.similar_vector_pairs(reps, idf, eps).collect()}
    return pairs, rep


def test_recall_and_no_false_pair(spark, articles, hashed):
    day, vec = hashed
    for eps in (0.1, 0.25):
        got, rep = links(spark, articles, eps)
        want = brute_pairs(vec, day, eps)
        between = {(a, b) for a, b in want if a not in rep and b not in rep}
        assert got <= between and len(got) >= 0.9 * len(between)
        assert len(between) > 3
        assert all((r, i) in want for i, r in rep.items())


def test_clusters_hold_all_rows(spark, articles, hashed):
    out = {r["id"]: r for r in vectors.similar_texts(articles, 0.1).collect()}
    day, vec = hashed
    assert out.keys() == day.keys()
    want = brute_pairs(vec, day, 0.1)
    found = sum(out[a]["cluster_id"] == out[b]["cluster_id"] for a, b in want)
    assert found >= 0.9 * len(want)
    together = defaultdict(set)
    for i, r in out.items():
        together[r["cluster_id"]].add(i)
    for label, members in together.items():          # each cluster hangs together by real pairs
        reach, todo = {label}, [label]
        while todo:
            a = todo.pop()
            for b in members - reach:
                if (min(a, b), max(a, b)) in want:
                    reach.add(b)
                    todo.append(b)
        assert reach == members


def test_titles_and_odd_rows(spark):
    rows = [(1, "d", "Red fox jumps"), (2, "d", "red FOX, jumps!"), (3, "e", "red fox jumps"), (4, "d", None),
            (5, "d", ""), (6, "d", "?!"), (7, "d", "red fox jumps high"), (8, None, "red fox jumps"),
            (9, "d", "漢字 " * 40_000), (10, "d", "other words entirely")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "article_id long, datetime string, title string, day string, idx int")
    out = {r["id"]: (r["cluster_id"], r["n_links"]) for r in
           vectors.similar_texts(df, 0.5, text_col="title", recall=0.9999, bits=8).collect()}
    assert out.keys() == {r[0] for r in rows}
    assert out[1] == out[2] == (1, 1) and out[7] == (1, 1)
    assert all(out[i] == (i, 0) for i in (3, 4, 5, 6, 8, 9, 10))
    empty = df.limit(0)
    assert vectors.similar_texts(empty, 0.5, text_col="title").collect() == []


def test_tiles_meet_once(spark):
    bands = spark.range(40).select("id", F.array(F.lit(7).cast("long"), F.col("id") % 2).alias("bands"))
    for tile in (1, 7, 100):
        got = [tuple(r) for r in vectors._candidates(bands, tile).collect()]
        assert sorted(got) == [(a, b) for a in range(40) for b in range(a + 1, 40)]


def test_choose_bands():
    same = 1 - math.acos(0.9) / math.pi
    n = vectors.choose_bands(0.1, 0.95, 20)
    assert 1 - (1 - same ** 20) ** n >= 0.95 > 1 - (1 - same ** 20) ** (n - 1)
    signs = vectors.random_signs(np.arange(3000), 130)
    assert signs.shape == (3000, 130) and abs(signs.mean() - 0.5) < 0.01
    assert abs(np.corrcoef(signs[:, :60].T) - np.eye(60)).max() < 0.1
    assert re.fullmatch("[01]+", "".join(map(str, signs[0])))


def test_a_vector_is_sent_once_to_a_pair_of_homes(spark):
    """40 near copies have 780 links; what is dealt of their vectors is far less."""
    words = [f"w{k}" for k in range(60)]
    rows = [(i, "20240101", " ".join(words[:59] + [f"x{i}"])) for i in range(40)] + [(99, None, " ".join(words))]
    df = spark.createDataFrame(rows, "article_id long, datetime string, text string")
    counted = vectors.word_counts(df)
    idf = vectors._idf(counted, vectors.N_FEATURES)
    pairs = vectors.similar_vector_pairs(counted, idf, 0.9, recall=0.9999, bits=4)
    got = {(r.id_a, r.id_b) for r in pairs.collect()}
    assert got == {(a, b) for a in range(40) for b in range(a + 1, 40)}
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "idx_a" not in plan and "FlatMapCoGroupsInArrow" in plan
    # a repeated row links as often as it stands there
    twice = vectors.similar_vector_pairs(counted.unionByName(counted.where("id = 3")), idf, 0.9, recall=0.9999, bits=4)
    n = {(r.id_a, r.id_b): r["count"] for r in twice.groupBy("id_a", "id_b").count().collect()}
    assert n == {p: 2 if 3 in p else 1 for p in got}


def test_blocks_find_the_pairs_that_share_a_band(spark):
    """The rows' definition (a shared band, then the distance) against blocks of
    any size; few bands, so that near pairs are missed too."""
    rng = random.Random(3)
    rows = []
    for i in range(90):
        w = [f"g{i % 5}w{k}" for k in range(25)] + ["the"] * (300 if i == 7 else i % 3)
        for _ in range(rng.randrange(12)):
            w[rng.randrange(25)] = f"e{rng.randrange(30)}"
        rows.append((i, f"d{i % 2}", " ".join(w)))
    rows += [(200, None, rows[0][2]), (201, "d0", None), (202, "d0", "")] + rows[::11]     # some rows twice
    df = spark.createDataFrame(rows, "article_id long, datetime string, text string")
    counted = vectors.word_counts(df)
    idf = vectors._idf(counted, vectors.N_FEATURES)
    eps, recall, bits = 0.4, 0.4, 8
    bands = vectors.bands_of(counted, idf, vectors.choose_bands(eps, recall, bits), bits)
    shared = {tuple(r) for r in vectors._candidates(bands, 512).collect()}
    vec = {r.id: dict(zip(r.idx, r.w)) for r in vectors.tfidf_vectors(df).collect()}
    times, day = Counter(i for i, _, _ in rows), {i: d for i, d, _ in rows}
    near = brute_pairs(vec, {i: d for i, d in day.items() if d}, eps)
    want = {p: times[p[0]] * times[p[1]] for p in near & shared}
    assert 50 < len(want) < len(near) and len(shared - near) > 20
    for block_rows in (1 << 16, 20, 1):
        out = vectors.similar_vector_pairs(counted, idf, eps, recall, bits, block_rows).collect()
        assert Counter((r.id_a, r.id_b) for r in out) == want
        for r in out:
            dot = sum(x * vec[r.id_b].get(b, 0) for b, x in vec[r.id_a].items())
            assert r.day == day[r.id_a] and r.dist == pytest.approx(1 - dot, abs=1e-9)


def test_what_is_dealt_of_a_vector_is_small(spark):
    """Two to three bytes a word and the signs, each row once for every block of
    its day, however many candidates it has."""
    rng = random.Random(8)
    rows = [(i, "d", " ".join(f"w{rng.randrange(5000)}" for _ in range(400))) for i in range(300)]
    df = spark.createDataFrame(rows, "article_id long, datetime string, text string")
    counted = vectors.word_counts(df)
    idf = vectors._idf(counted, vectors.N_FEATURES)
    words = counted.select(F.sum(F.size("idx"))).first()[0]
    for block_rows, blocks in ((1000, 1), (100, 3)):
        packed = vectors._packed(counted, idf, 1300, block_rows)
        assert {r.blocks for r in packed.collect()} == {blocks}
        size = packed.select(F.sum(sum(F.octet_length(c) for c in ("ids", "norms", "signs", "words")))).first()[0]
        assert size < 2.5 * words + 300 * (1300 // 8 + 20)
    assert vectors.similar_vector_pairs(counted, idf, 0.1, block_rows=100).count() == 0


def test_signs_apart_bound_holds():
    n = 1300
    most, p = vectors.most_signs_apart(0.1, n), math.acos(0.9) / math.pi
    tail = sum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p)
                        + (n - k) * math.log(1 - p)) for k in range(most + 1, n + 1))
    assert p * n < most < n / 3 and tail <= 2.0 ** -64
    assert vectors.most_signs_apart(0.9, 16) == 16 and vectors.most_signs_apart(0.0, n) < 20


def test_collapse_keeps_rows_of_ids_that_stand_alone_too(spark):
    rows = [(1, "d", "a b"), (2, "d", "a b"), (3, "d", "A, b"), (3, "e", "c d"), (4, "d", None), (4, "d", "a b"),
            (5, None, "a b"), (None, "d", "x")]
    df = spark.createDataFrame(rows, "article_id long, datetime string, text string")
    reps, copies = vectors.collapse_equal(vectors.word_counts(df))
    assert sorted(tuple(r) for r in copies.collect()) == [(2, 1), (3, 1), (4, 1)]
    assert sorted(r.id for r in reps.collect()) == [1, 3, 3, 4, 4, 5]
    # the words are not dealt by id
    assert "Exchange hashpartitioning" not in reps._jdf.queryExecution().executedPlan().toString()
