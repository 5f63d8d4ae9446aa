import hashlib
import math
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from newsgraph.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) % importance.N_BUCKETS
                        for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target):
    """(doc_id, n_features, weight, score) of every row, and the ranked ones."""
    def count(texts):
        out = [0] * importance.N_BUCKETS
        for t in texts:
            for b in plain_features(t)[1]:
                out[b] += 1
        return out

    s, t = count(x for _, x in docs), count(target)
    all_s, all_t = sum(s) + importance.N_BUCKETS, sum(t) + importance.N_BUCKETS
    gain = [math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s, t)]
    rows, fit = [], []
    for i, text in docs:
        n_words, f = plain_features(text)
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        rows.append((i, len(f), weight, score))
        if n_words >= 20:
            fit.append((-score, -math.inf if i is None else i))
    return rows, sorted(fit)[:5 * len(fit) // 100]


def check(docs, target):
    rows, drawn = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()],
                        [r["text"] for r in target.select("text").collect()])
    got = importance.op11(docs, target).collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted(rows, key=key)
    ranked = sorted((r["rank"], -r["score"], r["doc_id"]) for r in got if r["rank"] is not None)
    assert [(s, -math.inf if i is None else i) for _, s, i in ranked] == drawn
    assert [r for r, _, _ in ranked] == list(range(1, len(drawn) + 1))
    return got


def test_table_equals_brute_force(spark, docs):
    got = check(docs, spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))
    assert any(r["rank"] for r in got)


def test_odd_rows(spark, odd_docs):
    many = odd_docs
    for _ in range(4):                                   # repeated rows, so that some are drawn
        many = many.unionByName(many)
    check(many, spark.createDataFrame([(None,), ("",), ("Sentence number tells another story",)], "text string"))


def test_empty_tables(spark, no_docs, docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert importance.op11(no_docs, docs).collect() == []
    check(docs.limit(30), nothing)


def test_resample_keeps_whole_rows(spark, docs):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    drawn = importance.resample(docs, target)
    ranked = importance.op11(docs, target).where("rank is not null")
    assert drawn.columns == docs.columns
    assert {r["doc_id"] for r in drawn.collect()} == {r["doc_id"] for r in ranked.collect()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZ09é漢 ,\n'", max_size=30), min_size=1, max_size=5), st.integers(1, 4))
def test_features_of_small_blocks(texts, block):
    old, importance.BLOCK_WORDS = importance.BLOCK_WORDS, block
    try:
        data, starts, lengths, first = importance.split_words([t.encode() for t in texts])
        runs = importance.feature_buckets(data, starts, lengths)
        for i, t in enumerate(texts):
            a, b = int(first[i]), int(first[i + 1])
            assert (b - a, [int(x) for n, r in enumerate(runs) for x in r[a:max(a, b - n)]]) == plain_features(t)
    finally:
        importance.BLOCK_WORDS = old


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=300), min_size=1, max_size=6))
def test_crc_matrices(parts):
    data = np.frombuffer(b"".join(parts), np.uint8)
    lengths = np.array([len(p) for p in parts])
    starts = np.cumsum(lengths) - lengths
    assert importance.crc32_rows(data, starts, lengths).tolist() == [zlib.crc32(p) for p in parts]
