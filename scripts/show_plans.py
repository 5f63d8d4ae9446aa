"""Print the formatted physical plan of registered queries with a summary
of shuffles, join strategies and scan pruning.

    python scripts/show_plans.py [sf_dir] [name ...] > plans.txt
"""
from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newsgraph.plans import registry  # noqa: E402
from newsgraph.session import ensure_checkpoint_dir, get_session  # noqa: E402

DEFAULT = ["title_dedup_keep_last", "near_dup_edges", "extractive_summary", "glossary_translate",
           "step_entropy", "best_relation", "catch_up_days"]


def summarize(plan: str) -> dict:
    head = plan.split("\n\n(")[0]
    return {
        "Exchange": len(re.findall(r"\bExchange\b", head)) - len(re.findall(r"BroadcastExchange", head)),
        "BroadcastHashJoin": head.count("BroadcastHashJoin"),
        "SortMergeJoin": head.count("SortMergeJoin"),
        "HashAggregate": head.count("HashAggregate"),
        "SortAggregate": head.count("SortAggregate"),
        "ReadSchema": sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", plan))),
        "PushedFilters": sorted(set(re.findall(r"PushedFilters: (\[[^\n]*\])", plan))),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = get_session("local[8]", shuffle_partitions=8)
    ensure_checkpoint_dir(spark)
    for name in names:
        df = registry.QUERIES[name](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plan = buf.getvalue()
        print(f"=== {name}")
        for k, v in summarize(plan).items():
            print(f"  {k}: {v}")
        print(plan)


if __name__ == "__main__":
    main()
