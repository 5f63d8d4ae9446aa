"""Headline-query benchmark.

Runs the flagship queries over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line.
Each query is fully computed through Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver).
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsgraph.plans import registry  # noqa: E402
from newsgraph.session import ensure_checkpoint_dir, get_session  # noqa: E402

HEADLINE = [
    "near_dup_survivors",    # J2 erase_similar: F1 + D7 + E3 + F2
    "triplets",              # J6 relation extraction record
    "extractive_summary",    # I14
    "step_entropy",          # E8
    "uncertain_tokens",      # F4 + F5
    "title_dedup_keep_last", # F1
    "glossary_translate",    # D10 / J3
    "sentence_split",        # I4
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", "newsgraph-bench", shuffle_partitions=cpus)
    ensure_checkpoint_dir(spark)
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed
    times = {}
    for name in names:
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
