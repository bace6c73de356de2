"""Print the formatted physical plan of registered queries.

    python tools/explain_plans.py [sf_dir] [name ...]

Checks to read off the output: PushedFilters / ReadSchema on the scans,
BroadcastHashJoin only for size-checked sides, no Window without a partition
key above the facts, TakeOrderedAndProject for top-k, dynamicpruning on the
cleansed store scan.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from rankflow.plans.queries import QUERIES
    from rankflow.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    for name in sys.argv[2:] or ["trajectories", "movers", "merge_teams", "union_seasons"]:
        print(f"===== {name}")
        QUERIES[name](spark, sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
