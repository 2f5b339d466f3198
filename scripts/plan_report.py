"""Print a markdown table of the physical-plan shape of every lazy registered
query (shuffles, broadcasts, joins, scans, Python nodes) at a scale factor,
read from the adaptive final plan after running the query.

    python scripts/plan_report.py [/root/testdata/sf0.1]

The iterative k-means queries (Q15, Q16, Q20, Q22) run passes while they are
built and are left out; their per-pass plan is Q14's.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from murmuration import queries, queries_kmeans  # noqa: E402
from murmuration.plans import plan_summary  # noqa: E402
from murmuration.session import build_session  # noqa: E402

LAZY_KMEANS = ("q14_kmeans_step", "q18_kmeans_seeds_sample", "q19_kmeans_seeds_uniform")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    fns = dict(queries.SOCIAL_QUERIES)
    fns.update({n: queries_kmeans.KMEANS_QUERIES[n] for n in LAZY_KMEANS})
    cols = ["shuffles", "broadcasts", "sort_merge_joins", "broadcast_hash_joins", "scans",
            "python_nodes"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for name, fn in fns.items():
        s = plan_summary(fn(spark, sf), execute=True)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
