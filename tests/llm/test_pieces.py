import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsgraph.llm import pieces
from newsgraph.llm.queries import PIECES

SEGMENTER = pieces.Segmenter(PIECES)
TEXTS = st.text(alphabet=st.sampled_from(list("abthe  ,.\n▁漢é")) | st.characters(codec="utf-8"), max_size=12)


def brute(text):
    """Scores of all segmentations, best first."""
    word, ends = " " + text, {}
    for i, j, s, ids in SEGMENTER.edges(word):
        ends.setdefault(i, []).append((j, s, ids))
    out = []

    def go(at, score, ids):
        if at == len(word):
            out.append((score, ids))
        for j, s, more in ends.get(at, ()):
            go(j, score + s, ids + more)

    go(0, 0, ())
    return sorted((s * pieces.UNIT for s, _ in out), reverse=True), {ids for _, ids in out}


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_n_best_equal_brute_force_and_decode(text):
    got = SEGMENTER.encode(text)
    if not text:
        assert got == [(0.0, b"")]
        return
    scores, paths = brute(text)
    assert [s for s, _ in got] == pytest.approx(scores[:pieces.N_BEST])
    assert len({ids for _, ids in got}) == len(got)
    for _, ids in got:
        assert SEGMENTER.decode(ids) == text
        assert tuple(pieces.array("I", ids)) in paths


def test_search_pops_paths_in_order():
    into = [[], [(0, -10, "a")], [(1, -10, "b"), (0, -25, "c")], [(2, -10, "d"), (1, -12, "e")]]
    assert pieces.search(4, into, [0, -10, -20, -22], 9) == [
        (-22, ("a", "e")), (-30, ("a", "b", "d")), (-35, ("c", "d"))]


def test_table_round_trip(docs, odd_docs):
    for table in (docs, odd_docs):
        out = pieces.encode_nbest(table, PIECES, with_ids=True)
        assert out.where("not text_ok").count() == 0
        texts = pieces.decode(out.select("doc_id", F.col("paths")[0]["ids"].alias("ids")), PIECES)
        key = lambda r: (str(r[0]), r[1])
        assert sorted(map(tuple, texts.collect()), key=key) == sorted(
            ((r["doc_id"], r["text"] or "") for r in table.collect()), key=key)


def test_empty_table(no_docs):
    assert pieces.op3(no_docs, PIECES).collect() == []


def test_ties_do_not_grow_the_search():
    for text in ("x" * 3000, "漢字" * 500, "ab " * 2000, "\n" * 2000):
        got = SEGMENTER.encode(text)
        assert len({ids for _, ids in got}) == len(got) and ("x" not in text or len(got) == pieces.N_BEST)
        assert all(SEGMENTER.decode(ids) == text for _, ids in got)
