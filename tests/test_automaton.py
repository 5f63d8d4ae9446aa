import random

from hypothesis import given, settings
from hypothesis import strategies as st

from newsgraph.operators import automaton, entities, sentences

TOKEN = st.sampled_from(["a", "b", "c", "", "ab", "é", "漢"])
RUN = st.lists(TOKEN, min_size=1, max_size=3).map(" ".join)


def brute(phrases, text):
    """At each token the longest phrase, left to right."""
    tokens, out, i = text.split(" "), [], 0
    wanted = {tuple(p.split(" ")) for p in phrases}
    while i < len(tokens):
        n = max((k for k in range(1, 5) if tuple(tokens[i:i + k]) in wanted and i + k <= len(tokens)), default=0)
        if n:
            out.append((i, " ".join(tokens[i:i + n])))
        i += n or 1
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(RUN, max_size=6), st.lists(TOKEN, max_size=12).map(" ".join))
def test_find_equals_brute_force(phrases, text):
    found = automaton.find(automaton.build(phrases), text)
    assert found == brute(phrases, text)
    values = {p: f"<{p}>" for p in phrases}
    tokens, want, at = text.split(" "), [], 0
    for pos, p in found:
        want += tokens[at:pos] + [values[p]]
        at = pos + len(p.split(" "))
    assert automaton.replace(tokens, found, values) == " ".join(want + tokens[at:])


def _texts(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["of", "the", "in", "and", "X", ""], k=rng.randrange(40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "of the"), (103, "the of the of the of"), (104, "x " * 60_000 + "in the"),
             (105, "of the"), (None, "in the")]
    return rows, spark.createDataFrame([(*r, 0, "x") for r in rows],
                                       "article_id long, text string, pos int, word string")


PHRASES = [("of the", "A"), ("the of", "B"), ("of the of", "C"), ("in", "D"), ("in the", "E"), ("the", "G"), ("the", "F"),
           (None, "Z"), ("and", None)]


def test_gazetteer_by_automaton_equals_join_and_brute_force(spark):
    rows, df = _texts(spark)
    g = spark.createDataFrame(PHRASES, "phrase string, entity_group string")
    key = lambda r: (str(r[0]), *r[1:])
    group = {"of the": "A", "the of": "B", "of the of": "C", "in": "D", "in the": "E", "the": "F"}
    want = sorted(((i, p, w, group[w]) for i, t in rows if t is not None for p, w in brute(group, t)), key=key)
    fast = entities.gazetteer_mentions(df, g)
    slow = entities.gazetteer_mentions(df.where("article_id is not null"), g,
                                       max_bytes=0)
    assert sorted(map(tuple, fast.collect()), key=key) == want
    assert sorted(map(tuple, slow.collect()), key=key) == [w for w in want if w[0] is not None]
    assert entities.gazetteer_mentions(df, g.limit(0)).collect() == []
    assert entities.gazetteer_mentions(df.limit(0), g).collect() == []


def test_glossary_of_several_words(spark):
    lists = [(1, ["De la maison", "la la DE LA", ""]), (2, []), (3, None), (4, ["x  de   la", None, "de"]),
             (5, ["que de la que", "QUE"])]
    df = spark.createDataFrame(lists, "article_id long, split_text array<string>")
    pairs = [("de la", "of the"), ("la", "the"), ("que", "that"), ("que", "which"), ("de la que", "of that")]
    want = {1: ["of the maison", "the the of the", ""], 2: [], 3: [], 4: ["x  de   the", "", "de"],
            5: ["that of that", "that"]}
    g = spark.createDataFrame(pairs + [(None, "z"), ("x", None)], "src string, dst string")
    for how in ({}, {"max_bytes": 0}):
        out = sentences.glossary_map(df, g, **how)
        assert out.columns == ["article_id", "split_text", "translated_text"]
        assert {r["article_id"]: r["translated_text"] for r in out.collect()} == want


def test_translation_holds_few_rows_as_objects(spark):
    """The list column stays in Arrow; null lists and sentences as before."""
    rows = [(i, None if i % 5 == 0 else [f"le chat {i}", None, "ok"]) for i in range(3 * automaton.ROWS_AT_ONCE)]
    df = spark.createDataFrame(rows, "article_id long, split_text array<string>").coalesce(1)
    out = df.withColumn("t", automaton.translated("split_text", {"le": "the"}))
    assert {r.article_id: r.t for r in out.collect()} == {
        i: [] if i % 5 == 0 else [f"the chat {i}", "", "ok"] for i in range(len(rows))}
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()
    assert "pandas" not in open(automaton.__file__).read()
