import random

from newsgraph.llm import jaccard


def sets_of(text, n=5):
    w = (text or "").split()
    k = min(n, len(w))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute(rows, threshold=0.8):
    """(doc_id, class_id, n_links, n_copies), sorted, by all pairs of texts."""
    by_text = {}
    for doc_id, text in rows:
        by_text.setdefault(text or "", []).append(doc_id)
    texts = list(by_text)
    sets = [sets_of(t) for t in texts]
    root, links = list(range(len(texts))), [0] * len(texts)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = sets[i] == sets[j]
            if same or both and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(find(i), []).extend(x for x in by_text[t] if x is not None)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted(((x, min(groups[find(i)], default=None), links[i], len(by_text[t]))
                   for i, t in enumerate(texts) for x in by_text[t]), key=key)


def run(docs, **settings):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted((tuple(r) for r in jaccard.jaccard_join(docs, **settings).collect()), key=key)


def test_bands_reach_the_recall():
    for recall in (0.9, 0.999, 0.9999):
        bands, rows = jaccard.choose_bands(0.8, recall)
        assert 1 - (1 - 0.8 ** rows) ** bands >= recall
        assert bands * rows <= jaccard.MAX_HASHES


def near_copies(spark, n=150, seed=5):
    rng = random.Random(seed)
    base = [f"word{rng.randrange(400)}" for _ in range(160)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(7)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(50)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, rows[i][1]) for i in range(20)]  # exact copies
    rows += [(2000 + i, " ".join(f"other{rng.randrange(90)}" for _ in range(60))) for i in range(30)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_equals_brute_force_and_tiles_change_nothing(spark):
    rows, docs = near_copies(spark)
    want = brute(rows)
    assert run(docs) == want
    assert run(docs, block=16) == want  # every large bucket in many tiles


def test_pairs_never_become_rows(spark):
    rows, docs = near_copies(spark, n=120)
    bands, per = jaccard.choose_bands()
    classes = jaccard.classes_of(jaccard.sketches(docs, bands, per))
    assert jaccard.verified_links(docs, classes).count() <= bands * len(rows)


def test_odd_rows(odd_docs, no_docs):
    assert run(odd_docs) == brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert run(no_docs) == []


def test_keep_one(spark):
    rows, docs = near_copies(spark)
    kept = {r["doc_id"] for r in jaccard.keep_one(docs).collect()}
    assert kept == {c for _, c, _, _ in brute(rows)}


def test_keep_one_of_rows_with_equal_or_null_ids(spark, odd_docs):
    kept = jaccard.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.select("doc_id", "text").collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [1, 2, 4, 7, 8, 9, 10, 11]
    assert [r["text"] for r in rows if r["doc_id"] == 9] == ["same id, other text"]  # the other 9 copies 1
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    df = spark.createDataFrame([(5, a), (5, b), (5, b), (6, a), (7, b)], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.keep_one(df).collect())) == [(5, a), (5, b)]
