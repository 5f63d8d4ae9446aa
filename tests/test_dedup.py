"""F1, F2, D7, E3, E4, J2 on hand-computed fixtures (FIXTURES F1, F4)."""
import math
import random

from pyspark.sql import functions as F

from newsgraph.operators import components, dedup, similarity


def _articles(spark):
    rows = [(0, "20200101", "A", "x"), (1, "20200101", "B", "y"), (2, "20200101", "A", "z"),
            (3, "20200102", "A", "w"), (4, "20200102", None, "p"), (5, "20200102", None, "q")]
    return spark.createDataFrame(rows, "article_id long, datetime string, title string, text string")


def test_title_dedup_keep_last(spark):
    out = dedup.dedup_title_keep_last(_articles(spark))
    assert sorted(r.article_id for r in out.collect()) == [1, 2, 3, 5]


def test_title_dedup_idempotent(spark):
    once = dedup.dedup_title_keep_last(_articles(spark))
    twice = dedup.dedup_title_keep_last(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def _vec(deg):
    r = math.radians(deg)
    return [math.cos(r), math.sin(r)]


def test_dense_chain_components(spark):
    rows = [(i, "d", _vec(a)) for i, a in enumerate([0, 40, 80, 180])]
    v = spark.createDataFrame(rows, "article_id long, datetime string, vec array<double>")
    edges = {(r.id_a, r.id_b) for r in similarity.dense_pairs(v, 0.35).collect()}
    assert edges == {(0, 1), (1, 2)}
    lab = {r.id: r.cluster_id for r in dedup.dense_component_labels(v, 0.35).collect()}
    assert lab == {0: 0, 1: 0, 2: 0, 3: 3}


def test_dense_tiles_match_single_tile(spark):
    rows = [(i, "d" if i % 3 else "e", _vec(i * 7 % 360)) for i in range(60)]
    v = spark.createDataFrame(rows, "article_id long, datetime string, vec array<double>")
    one = {(r.id_a, r.id_b) for r in similarity.dense_pairs(v, 0.05).collect()}
    many = {(r.id_a, r.id_b) for r in similarity.dense_pairs(v, 0.05, tile_rows=4).collect()}
    assert one == many and len(one) > 0


def test_dense_blocks_equal_brute_force(spark):
    rng = random.Random(4)
    rows, centers = [], [[rng.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    for i in range(300):
        c = rng.choice(centers)
        scale = rng.choice([0.5, 3.0])
        rows.append((i, f"d{i % 2}", [scale * (x + rng.gauss(0, 0.2)) for x in c]))
    unit = {i: (d, [x / math.hypot(*v) for x in v]) for i, d, v in rows}
    odd = [(900, "d0", [0.0] * 6), (901, "d0", None), (902, None, centers[0]), (903, "d0", [1.0, 2.0]),
           (904, "d0", [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (905, "d0", [])]
    v = spark.createDataFrame([(*r, "x") for r in rows + odd],
                              "article_id long, datetime string, vec array<double>, block string")
    for eps in (0.02, 0.3):
        want = {(a, b) for a, (da, x) in unit.items() for b, (db, y) in unit.items()
                if a < b and da == db and 1 - sum(p * q for p, q in zip(x, y)) <= eps}
        for how in ({}, {"tile_rows": 5, "cell_bits": 3}, {"cell_bits": 0, "tile_rows": 40}):
            out = similarity.dense_pairs(v, eps, **how).collect()
            assert {(r.id_a, r.id_b) for r in out} == want and len(out) == len(want)
            degree = {}
            for r in similarity.dense_links(v, eps, **how).collect():
                degree[r.id] = degree.get(r.id, 0) + r.n
            assert degree == {i: n for i in unit if (n := sum(i in p for p in want))}
        near = similarity.dense_pairs(v, eps)
        whole = {r.node: r.component for r in components.connected_components(
            near, v.select(F.col("article_id").alias("node")), src="id_a", dst="id_b").collect()}
        assert {r.id: r.cluster_id for r in dedup.dense_component_labels(v, eps).collect()} == whole
    assert similarity.dense_pairs(v.limit(0), 0.3).collect() == []


def test_components_invariant_under_relabel(spark):
    edges = [(1, 2), (2, 3), (10, 11), (4, 4), (20, 21), (21, 22), (22, 20)]
    e = spark.createDataFrame(edges, "src long, dst long")
    lab = {r.node: r.component for r in components.connected_components(e).collect()}
    assert lab[1] == lab[2] == lab[3] == 1
    assert lab[10] == lab[11] == 10 and lab[20] == lab[21] == lab[22] == 20
    # permuting ids keeps the partition of nodes into components
    perm = {1: 50, 2: 5, 3: 30, 10: 7, 11: 70, 4: 4, 20: 60, 21: 6, 22: 61}
    e2 = spark.createDataFrame([(perm[a], perm[b]) for a, b in edges], "src long, dst long")
    lab2 = {r.node: r.component for r in components.connected_components(e2).collect()}
    groups = lambda m: sorted(sorted(k for k in m if m[k] == c) for c in set(m.values()))
    assert groups({perm[k]: v for k, v in lab.items() if k in perm}) == groups(lab2)


def test_long_chain_converges(spark):
    n = 200
    e = spark.createDataFrame([(i, i + 1) for i in range(n)], "src long, dst long")
    lab = components.connected_components(e)
    assert lab.select(F.countDistinct("component")).first()[0] == 1
    assert lab.where("component <> 0").count() == 0


def _brute_pairs(texts, eps, k=3):
    import re
    def sh(t):
        toks = [w for w in re.split(r"[^\w]+", t.lower()) if w]
        if not toks:
            return set()
        if len(toks) < k:
            return {" ".join(toks)}
        return {" ".join(toks[i:i + k]) for i in range(len(toks) - k + 1)}
    sets = {i: sh(t) for i, (d, t) in texts.items()}
    out = set()
    for a in sets:
        for b in sets:
            if a < b and texts[a][0] == texts[b][0] and sets[a] and sets[b] and sets[a] != sets[b]:
                if len(sets[a] & sets[b]) / math.sqrt(len(sets[a]) * len(sets[b])) >= 1 - eps:
                    out.add((a, b))
    return out


def test_prefix_filter_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rnd.choice(words) for _ in range(30)) for _ in range(12)]
    texts = {}
    for i in range(60):
        b = base[i % 12].split()
        for _ in range(rnd.randint(0, 6)):
            b[rnd.randrange(len(b))] = rnd.choice(words)
        texts[i] = ("d1" if i % 2 else "d2", " ".join(b))
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in texts.items()],
                               "article_id long, datetime string, text string")
    for eps in (0.2, 0.35, 0.5):
        edges, copies, _ = similarity.similar_text_pairs(df, eps)
        got = {(r.id_a, r.id_b) for r in edges.collect()}
        # brute force over distinct sets: map each id to its copy representative
        rep = {r.id: r.rep for r in copies.collect()}
        want = {(a, b) for a, b in _brute_pairs(texts, eps) if a not in rep and b not in rep}
        assert got == want, eps


def test_erase_similar_keeps_first_of_cluster(spark):
    rows = [(0, "d", "t0", "alpha beta gamma delta"), (1, "d", "t1", "alpha beta gamma delta"),
            (2, "d", "t2", "alpha beta gamma delta epsilon"), (3, "d", "t3", "zeta eta theta iota"),
            (4, "e", "t4", "alpha beta gamma delta")]
    df = spark.createDataFrame(rows, "article_id long, datetime string, title string, text string")
    out = dedup.erase_similar(df, 0.35)
    assert sorted(r.article_id for r in out.collect()) == [0, 3, 4]
    lab = dedup.component_labels(df, 0.35)
    rep = dedup.cluster_report(df, lab).collect()
    assert {(r.cluster_id, r.article_id, r.is_representative) for r in rep} == \
        {(0, 0, True), (0, 1, False), (0, 2, False)}


def test_template_texts_below_the_threshold_stay_linear(spark):
    """Texts that share a template but not enough of it: no edge, and the
    candidate rows grow with the number of texts, not with its square."""
    from newsgraph.operators import similarity as sm

    def candidates(n):
        rows = [(i, "20200101", " ".join([f"t{k}" for k in range(22)] + [f"u{i}x{k}" for k in range(13)]))
                for i in range(n)]
        df = spark.createDataFrame(rows, "article_id long, datetime string, text string")
        reps, _ = sm.collapse_copies(sm.shingle_sets(df))
        pref = sm.materialize(sm._prefixes(reps, 0.65 ** 2))
        assert sm.set_pairs(reps, 0.35).count() == 0
        return sm._pair_candidates(pref, 0.65).count()

    assert candidates(100) <= 100 and candidates(400) <= 400


def test_labels_equal_full_pairing(spark):
    """Groups of near-copies: components equal those of all verified pairs."""
    import random
    rng = random.Random(9)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(60)}" for _ in range(50)]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(8)):
                w[rng.randrange(50)] = f"e{rng.randrange(40)}"
            rows.append((len(rows), "20200101", " ".join(w)))
    df = spark.createDataFrame(rows, "article_id long, datetime string, text string")
    sets = [{tuple(t.split()[i:i + 3]) for i in range(48)} for _, _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) / (len(sets[i]) * len(sets[j])) ** 0.5 >= 0.65:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    lab = {r.id: r.cluster_id for r in dedup.component_labels(df, 0.35).collect()}
    assert lab == {i: find(i) for i in range(len(rows))}


def test_dense_cells_match_brute_force(spark):
    """Clustered unit vectors in 8 dims over two days: the pivot-cell join
    returns exactly the brute-force pair set, for small and large eps and
    for small tiles."""
    import random
    rnd = random.Random(11)
    centers = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(240):
        c = centers[i % 6]
        rows.append((i, "d" if i % 2 else "e", [x + rnd.gauss(0, 0.35) for x in c]))
    rows.append((999, "d", [0.0] * 8))  # zero vector: never linked
    v = spark.createDataFrame(rows, "article_id long, datetime string, vec array<double>")

    def unit(x):
        n = math.sqrt(sum(t * t for t in x))
        return [t / n for t in x] if n > 0 else None
    us = {i: (d, unit(x)) for i, d, x in rows}
    for eps in (0.02, 0.1, 0.6):
        want = {(a, b) for a in us for b in us if a < b and us[a][0] == us[b][0]
                and us[a][1] and us[b][1] and 1 - sum(x * y for x, y in zip(us[a][1], us[b][1])) <= eps}
        got = {(r.id_a, r.id_b) for r in similarity.dense_pairs(v, eps, cell_bits=2, tile_rows=16).collect()}
        assert got == want, eps


def test_terms_are_joined_without_dealing_frequent_ones(spark):
    from newsgraph.operators.common import join_terms
    words = spark.createDataFrame([(i, w) for i in range(20) for w in ("a", "b", f"r{i}", "no")] + [(99, None)],
                                  "id long, term string")
    table = words.where("term <> 'no'").groupBy("term").agg(F.count("*").alias("df"))
    want = sorted(tuple(r) for r in words.join(table, "term").collect())
    for kw in ({}, {"max_bytes": 0, "n_frequent": 2}):
        got = join_terms(words, table, "term", "df", **kw)
        assert sorted(tuple(r) for r in got.collect()) == want
    whole = join_terms(words, table, "term", "df")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in whole


def test_summary_and_relevance_do_not_deal_tokens_by_term(spark):
    from newsgraph.operators import relevance, sentences
    df = spark.createDataFrame([(1, "One two. Three two."), (2, "Two three four."), (3, "")], "article_id long, text string")
    s = sentences.extractive_summary(sentences.split_sentences(df), k=1, min_words=1)
    model = relevance.fit_term_odds(df.withColumn("title", F.lit("t")).withColumn("label", F.col("article_id") % 2))
    scores = relevance.term_odds_scores(df.withColumn("title", F.lit("t")), model)
    for out in (s, scores):
        assert out.count() == 3
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(term" not in plan


def test_shingles_that_one_text_has_alone_are_not_dealt_by_id(spark):
    """Only shingles that another text of the day has too go on from the count:
    the rows that are ranked and joined do not grow with texts of their own."""
    near = " ".join(f"n{k}" for k in range(40))
    rows = [(0, "d", near), (1, "d", near + " more"), (2, "e", near)]
    rows += [(i, "d", " ".join(f"u{i}x{k}" for k in range(40))) for i in range(10, 60)]
    df = spark.createDataFrame(rows, "article_id long, datetime string, text string")
    reps, _ = similarity.collapse_copies(similarity.shingle_sets(df))
    assert reps.count() == 53
    pref = similarity._prefixes(reps, 0.65 ** 2)
    assert {r.id for r in pref.collect()} == {0, 1}
    assert [(r.id_a, r.id_b) for r in similarity.set_pairs(reps, 0.35).collect()] == [(0, 1)]
    # the sets themselves are not dealt to drop the copies' rows
    assert "Exchange hashpartitioning" not in reps._jdf.queryExecution().executedPlan().toString()


def test_pairs_with_null_days_null_texts_and_repeated_ids(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        w = [f"g{i % 6}w{k}" for k in range(30)]
        for _ in range(rng.randrange(6)):
            w[rng.randrange(30)] = f"e{rng.randrange(20)}"
        rows.append((i, f"d{i % 2}", " ".join(w)))
    near = rows[0][2]
    odd = [(100, None, near), (101, None, near + " x"), (102, "d0", None), (103, "d0", ""), (104, None, None),
           (105, "d0", "one two"), (106, "d0", "Two one"), (107, "d0", "one, two")]
    texts = {i: (d or f"none{i}", t or "") for i, d, t in rows + odd}
    # every row of some ids stands twice
    df = spark.createDataFrame(rows + odd + rows[::5], "article_id long, datetime string, text string")
    for eps in (0.2, 0.35):
        edges, copies, nodes = similarity.similar_text_pairs(df, eps)
        rep = {r.id: r.rep for r in copies.collect()}
        assert rep[107] == 105
        want = {(a, b) for a, b in _brute_pairs(texts, eps) if a not in rep and b not in rep}
        got = {(r.id_a, r.id_b) for r in edges.collect()}
        assert got == want and got
        assert {r.node for r in nodes.collect()} | set(rep) >= set(texts) - {104}


def test_all_pairs_hold_copies_too(spark):
    """Copies (texts of equal shingles under other titles) are paired with each
    other and with all that their set is near to; brute force over the rows."""
    rng = random.Random(6)
    rows = []
    for i in range(48):
        w = [f"g{i % 4}w{k}" for k in range(24)]
        for _ in range(rng.randrange(4)):
            w[rng.randrange(24)] = f"e{rng.randrange(9)}"
        rows.append((i, f"d{i % 2}", " ".join(w)))
    for i in range(48, 90):                      # copies, other signs and case
        _, d, t = rows[rng.randrange(12)]
        rows.append((i, d, rng.choice(["! ", " ", "?"]) + rng.choice([t, t.upper(), t.replace(" ", ", ")])))
    odd = [(100, None, rows[0][2]), (101, None, rows[0][2]), (102, "d0", None), (103, "d0", ""), (104, "d0", "?!"),
           (105, "d0", "one two"), (106, "d0", "Two one"), (107, "d0", "one, two"), (108, "d1", "one two")]
    again = rows[50:90:9]                        # a row that stands twice pairs twice
    df = spark.createDataFrame(rows + odd + again, "article_id long, datetime string, text string")

    def shingles(t):
        w = [x for x in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()]
        return {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set()

    sets = [(i, d, shingles(t)) for i, d, t in rows + odd + again if d and shingles(t)]
    for eps in (0.2, 0.35):
        want = sorted((a, b) for a, d, x in sets for b, e, y in sets
                      if a < b and d == e and len(x & y) / math.sqrt(len(x) * len(y)) >= 1 - eps)
        assert (105, 107) in want and len(want) > 300
        for tile in (512,) if eps == 0.2 else (3, 1):
            got = similarity.all_text_pairs(df, eps, tile_rows=tile).collect()
            assert sorted((r.id_a, r.id_b) for r in got) == want
    assert similarity.all_text_pairs(df.limit(0)).collect() == []


def test_near_dup_edges_leave_out_no_copy(spark, tmp_dir):
    from newsgraph.plans import registry
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(7, "A\n" + text), (14, "a!\n" + text), (21, "(A)\n" + text), (28, "B\n" + text + " more"),
            (8, "A\n" + text), (35, "other words of a text")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' lang", "'s' source").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {(r.id_a, r.id_b) for r in registry.q_near_dup_edges(spark, tmp_dir).collect()}
    assert got == {(7, 14), (7, 21), (14, 21), (7, 28), (14, 28), (21, 28)}
