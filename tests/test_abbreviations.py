"""I4 with learned abbreviations, K2 counts in the row, E8 in long form."""
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsgraph.functions import text as tx
from newsgraph.operators import abbreviations as ab
from newsgraph.operators import relevance, uncertainty

WORDS = ["market", "river", "house", "council", "report", "street", "plan", "vote", "water", "school"]
NAMES = ["Smith", "Jones", "Miller"]


def _planted(n=60, seed=3):
    """Texts of plain sentences with planted "Dr.", "Gen." and "e.g."."""
    r = random.Random(seed)
    texts = []
    for _ in range(n):
        out = []
        for _ in range(8):
            ws = [r.choice(WORDS) for _ in range(r.randint(6, 9))]
            kind = r.random()
            if kind < 0.3:
                ws[3:3] = [r.choice(["Dr.", "Gen."]), r.choice(NAMES)]
            elif kind < 0.4:
                ws[3:3] = ["e.g."]
            s = " ".join(ws)
            out.append(s[0].upper() + s[1:] + ".")
        texts.append(" ".join(out))
    return texts


def _frame(spark, texts):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)],
                                 "article_id long, text string, type string")


def _brute(texts):
    dot, plain = Counter(), Counter()
    for t in texts:
        for tok in (t or "").split():
            b = re.sub(r"[^\w.]+$", "", re.sub(r"^[\"'(\[]+", "", tok))
            ty = re.sub(r"\.$", "", b.lower())
            if re.search(r"[^\W\d_]", ty):
                (dot if b.endswith(".") else plain)[ty] += 1
    p = (sum(dot.values()) + 1) / (sum(dot.values()) + sum(plain.values()) + 2)
    found = {}
    for ty, n in dot.items():
        k = len(ty.replace(".", ""))
        ratio = -2 * (n * (math.log(p) - math.log(.99)) + plain[ty] * (math.log(1 - p) - math.log(1 - .99)))
        score = ratio * math.exp(-k) * (len(ty) - k + 1) * k ** -plain[ty]
        if score >= 0.3:
            found[ty] = score
    return found


def test_planted_abbreviations_are_found_and_not_cut(spark):
    texts = _planted()
    df = _frame(spark, texts)
    counts = ab.type_counts(df).cache()
    got = {r["type"]: r["score"] for r in ab.abbreviations(counts).collect()}
    assert {"dr", "gen", "e.g"} <= set(got) and not set(WORDS) & set(got)
    assert got == pytest.approx(_brute(texts))
    cut = ab.split_sentences_learned(df, ab.abbreviations(counts).select("type"), ab.starters(counts))
    assert cut.columns == ["article_id", "text", "type", "split_text"]
    for r in cut.collect():
        assert len(r["split_text"]) == 8 and " ".join(r["split_text"]) == r["text"]
    counts.unpersist()


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_cuts_by_hand_in_the_row_and_by_join(spark, max_bytes):
    texts = ["He met Dr. Smith today. Then he left.", "Apples, pears etc. The rest follows.", "Prices etc. rose again.",
             "Dr.", "Dr. Dr. Smith", "(Dr. Smith) came! Dr. who?", "", None, "No period", "   \n ", "One.  Two.\nThree"]
    abbrevs = spark.createDataFrame([("dr",), ("etc",)], "type string")
    starts = spark.createDataFrame([("the",), ("then",)], "type string")
    got = {r["article_id"]: r["split_text"] for r in ab.split_sentences_learned(
        _frame(spark, texts), abbrevs, starts, max_bytes=max_bytes).collect()}
    assert got == {
        0: ["He met Dr. Smith today.", "Then he left."], 1: ["Apples, pears etc.", "The rest follows."],
        2: ["Prices etc. rose again."], 3: ["Dr."], 4: ["Dr. Dr. Smith"], 5: ["(Dr. Smith) came!", "Dr. who?"],
        6: [], 7: None, 8: ["No period"], 9: [], 10: ["One.", "Two.", "Three"]}


def test_empty_table_finds_nothing_and_cuts_plainly(spark):
    assert spark.sql("SELECT cast(null AS array<string>) AS t").select(tx.term_counts("t")).first()[0] is None
    none = _frame(spark, ["x"]).limit(0)
    counts = ab.type_counts(none)
    assert ab.abbreviations(counts).count() == 0 and ab.starters(counts).count() == 0
    cut = ab.split_sentences_learned(_frame(spark, ["Dr. Who. B"]), ab.abbreviations(counts), ab.starters(counts))
    assert cut.first()["split_text"] == ["Dr.", "Who.", "B"]


def test_a_long_text_is_read_once_also_below_an_explode(spark):
    text = "Dr. Smith met the council. Then they left. " * 3000
    df = _frame(spark, [text])
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "type string")
    cut = ab.split_sentences_learned(df, words("dr"), words("then"))
    assert cut.select(F.explode("split_text")).count() == 6000
    counts = df.select(F.explode(tx.term_counts(tx.word_tokens("text"))).alias("c"))
    assert counts.agg(F.sum("c.n")).first()[0] == 8 * 3000


def test_counting_shuffles_distinct_tokens_only(spark):
    plan = ab.type_counts(_frame(spark, _planted(4)))._jdf.queryExecution().executedPlan().toString()
    # distinct tokens, then types: both behind a partial count or sum
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_count" in plan and "partial_sum" in plan


def test_term_counts_equal_a_counter(spark):
    texts = ["a b a", "", "z", "b b b a c c", " ".join(random.Random(1).choices("abcdefg", k=5000))]
    df = _frame(spark, texts)
    got = df.select("article_id", tx.term_counts(tx.word_tokens("text")).alias("c"))
    for r in got.collect():
        assert {c["term"]: c["n"] for c in r["c"]} == Counter(texts[r["article_id"]].split())


def test_relevance_scores_are_those_of_the_fitted_counts(spark):
    rows = [(1, "T", "good good news", 1), (2, None, "bad news", 0), (3, "x", "good bad bad bad", None), (4, None, None, None)]
    df = spark.createDataFrame(rows, "article_id long, title string, text string, label int")
    w, docs = Counter(), [("t good good news".split(), 1), ("bad news".split(), 0)]
    pos, neg = Counter(docs[0][0]), Counter(docs[1][0])
    v = len(set(pos) | set(neg))
    w = {t: math.log((pos[t] + 1) / (pos.total() + v)) - math.log((neg[t] + 1) / (neg.total() + v))
         for t in set(pos) | set(neg)}
    got = {r["article_id"]: r["score"] for r in relevance.term_odds_scores(df, relevance.fit_term_odds(df)).collect()}
    want = {i: sum(w.get(t, 0) for t in f"{a or ''} {b or ''}".lower().split()) for i, a, b, _ in rows}
    assert got == pytest.approx(want)


def test_long_entropy_equals_the_array_form(spark):
    r = random.Random(5)
    steps = [(i, s, [r.uniform(-300, 300) if s % 2 else r.gauss(0, 2) for _ in range(50)]) for i in range(4) for s in range(6)]
    steps += [(9, 0, [7.0]), (9, 1, [2.0, 2.0, -1.0]), (9, 2, [-1e6, 1e6]), (9, 3, [64.0, 63.9, 64.1])]
    df = spark.createDataFrame(steps, "article_id long, step int, logits array<double>")
    long_df = df.select("article_id", "step", F.posexplode("logits").alias("token_id", "logit")).repartition(5)
    want = {(x.article_id, x.step): (x.entropy, x.argmax) for x in uncertainty.step_entropy(df).collect()}
    got = {(x.article_id, x.step): (x.entropy, x.argmax) for x in uncertainty.step_entropy_long(long_df).collect()}
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0], abs=1e-9) and got[k][1] == want[k][1]


def test_long_entropy_of_masked_and_null_logits(spark):
    inf = float("inf")
    rows = [(1, 0, 0, 1.0), (1, 0, 1, 1.0), (1, 0, 2, -inf), (1, 0, 3, None), (1, 1, 0, -inf), (1, 2, 0, float("nan"))]
    df = spark.createDataFrame(rows, "article_id long, step int, token_id int, logit double")
    got = {x.step: x.entropy for x in uncertainty.step_entropy_long(df, argmax=False).collect()}
    assert got[0] == pytest.approx(math.log(2)) and got[1] is None and math.isnan(got[2])
    plan = uncertainty.step_entropy_long(df, argmax=False)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SortAggregate" not in plan
