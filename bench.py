"""Benchmark: run the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]`` and print
one JSON line. Each query runs to completion through the ``noop`` sink (every row computed,
nothing collected); the time includes planning and any driver-side model step.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--all] [names...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "class_word_prob", "clean_text", "strip_markup", "tokens", "tfidf", "char_tf", "doc_vector_avg",
    "wcp_features", "pattern_flags", "read_mixed", "latest_cells", "collection_scan", "transactions",
    "frequent_itemsets", "assign_ids", "legacy_scores", "metrics_overall", "similar_topk",
    "lr_predict_tfidf", "stream_score",
]


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from wordloom.plans.catalog import queries
    from wordloom.session import get_session

    spark = get_session(f"local[{cpus}]", int(cpus))
    qs = queries()
    names = [a for a in argv if not a.startswith("--")]
    if "--all" in argv:
        names = sorted(qs)
    names = names or HEADLINE
    # JVM warm-up (class loading, JIT), not timed: the flagship on the smallest tables.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        qs["class_word_prob"](spark, small).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for n in names:
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
        print(f"# {n}: {times[n]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main(sys.argv[1:])
