"""Write PLANS.md: operator counts of every suite statement's plan as it is
at a size at which only the small fixed dimensions are broadcast.

Usage: python tests/plan_report.py [sf_dir]  (default /root/testdata/sf0.1)
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aisle.plans.runs import PLAN_NODES, plan_summary, select_queries  # noqa: E402
from aisle.session import local_session  # noqa: E402

THRESHOLD = 128 << 10


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    # at sf0.1 this lets the calendar and the outlets pass, and neither items
    # nor customers; plans are taken as built, without run-time statistics
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(THRESHOLD))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    rows = [plan_summary(spark, k, sf_dir, run=False) for k in select_queries()]
    cols = ["query"] + PLAN_NODES
    short = {"Exchange": "shuffle", "BroadcastExchange": "bcast", "ReusedExchange": "reused",
             "SortMergeJoin": "SMJ", "BroadcastHashJoin": "BHJ", "ShuffledHashJoin": "SHJ",
             "BroadcastNestedLoopJoin": "BNLJ", "TakeOrderedAndProject": "topk", "WindowGroupLimit": "grp-limit",
             "Window": "window", "Expand": "expand", "HashAggregate": "hash-agg"}
    out = ["# Physical plans of the suite", "",
           f"Operator counts in the physical plan of each statement on `{sf_dir}`, with broadcasts limited to "
           f"{THRESHOLD >> 10} KiB and adaptive execution off, so that items, customers and facts meet as they do at "
           "scale. `shuffle` counts shuffle exchanges, `bcast` broadcast exchanges, `reused` shuffles or "
           "broadcasts computed once and reused; joins by strategy; `topk` = ORDER BY + LIMIT without a full "
           "sort; `grp-limit` = per-group limit before the shuffle; `expand` = ROLLUP; `hash-agg` counts partial "
           "and final aggregation nodes. Generated by `tests/plan_report.py`.", "",
           "| " + " | ".join(short.get(c, c) for c in cols) + " |", "|" + "---|" * len(cols)]
    for r in rows:
        out.append("| " + " | ".join(str(r[c]) for c in cols) + " |")
    tot = {c: sum(r[c] for r in rows) for c in PLAN_NODES}
    out.append("| **total** | " + " | ".join(str(tot[c]) for c in PLAN_NODES) + " |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print(tot)


if __name__ == "__main__":
    main()
