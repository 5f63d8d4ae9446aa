import random
import re

from newsgraph.llm import licenses

WORD = re.compile(licenses.WORD)
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute_base(text):
    ws, starts, labels = words(text), [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        found = [i for i in range(len(ws)) if ws[i:i + len(p)] == p]
        starts += found
        labels |= {label} if found else set()
    return (len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def test_base_equals_brute_force(docs, odd_docs):
    for table in (docs, odd_docs):
        got = licenses.op4(table).collect()
        base = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                       for r in got), key=str)
        assert base == sorted(((r["doc_id"], *brute_base(r["text"])) for r in table.collect()), key=str)


def scan(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in licenses.op4(df).collect()}


def test_every_template_is_found_and_survives_edits(spark):
    rng = random.Random(1)
    texts, want = [], []
    for phrase, label in licenses.TEMPLATES.items():
        ws = phrase.split()
        texts.append("Some words before it. " + phrase.upper() + ". And behind.")
        want.append(label)
        if len(ws) >= 20:  # one word replaced, one inserted, one lost
            for edit in ("swap", "add", "drop"):
                at = rng.randrange(6, len(ws) - 6)
                new = {"swap": [*ws[:at], "zzz", *ws[at + 1:]], "add": [*ws[:at], "zzz", *ws[at:]],
                       "drop": ws[:at] + ws[at + 1:]}[edit]
                texts.append("before " + " ".join(new) + " behind")
                want.append(label)
    got = scan(spark, *texts)
    for i, label in enumerate(want):
        assert label in got[i]["labels"].split(","), texts[i]
        assert got[i]["score"] >= licenses.MIN_COVER


def test_places_and_labels(spark):
    got = scan(spark, "The MIT License, mit license and MIT-License.", "Under CC BY-NC 4.0", "an apache of license",
               "permission is hereby granted to read", "gnu general public\nlicense!", None, "")
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["last_word"]) == (3, 1, 6)
    assert (got[1]["base_labels"], got[1]["labels"]) == ("cc-by", "cc-by,cc-by-nc")
    assert [got[i]["labels"] for i in (2, 3, 5, 6)] == [""] * 4
    assert got[4]["base_labels"] == "gpl" and got[4]["score"] == 1.0


def test_empty_table(no_docs):
    assert licenses.op4(no_docs).collect() == []
