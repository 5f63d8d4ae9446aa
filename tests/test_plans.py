"""Plan-shape guards for the headline queries (scale regressions)."""
import contextlib
import io

import pytest

from newsgraph.plans import registry

SF = "/root/testdata/sf0.001"
HEADLINE = ["title_dedup_keep_last", "near_dup_edges", "extractive_summary", "glossary_translate",
            "uncertain_tokens", "best_relation", "catch_up_days", "dense_near_dup_edges", "coref_rewrite"]


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", HEADLINE)
def test_no_pair_explosion_operators(spark, name):
    plan = _plan(registry.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_title_dedup_prunes_columns(spark):
    plan = _plan(registry.QUERIES["title_dedup_keep_last"](spark, SF))
    schemas = [l for l in plan.splitlines() if l.startswith("ReadSchema")]
    assert schemas and all("lang" not in s and "source" not in s for s in schemas)


def test_dictionary_operators_shuffle_no_tokens(spark):
    """One pass by the automaton: nothing is exchanged by a key (the scan may be
    dealt round-robin)."""
    for name in ("gazetteer_mentions", "glossary_translate"):
        plan = _plan(registry.QUERIES[name](spark, SF))
        assert "hashpartitioning" not in plan and "Join" not in plan


def test_dense_pairs_make_no_row_per_pair(spark):
    plan = _plan(registry.QUERIES["dense_near_dup_edges"](spark, SF))
    assert "zip_with" not in plan and "MapInArrow" in plan
