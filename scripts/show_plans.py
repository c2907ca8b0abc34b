"""Print the formatted physical plan of registered queries.

Usage: python scripts/show_plans.py [sf_dir] [name ...]
For each plan it also lists the operators worth checking at scale: scans
with their ReadSchema/PushedFilters, exchanges, joins and window limits.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans.registry import queries  # noqa: E402
from quarry.session import local_session  # noqa: E402

DEFAULT = ["top_ngrams", "top_tokens_per_group", "value_histogram", "series_covariance",
           "center_update", "linreg_ablation"]
KEYS = re.compile(r"(ReadSchema|PushedFilters|Exchange|BroadcastHashJoin|SortMergeJoin|"
                  r"BroadcastNestedLoopJoin|CartesianProduct|WindowGroupLimit|MapInPandas|"
                  r"FlatMapGroupsInPandas|HashAggregate|ObjectHashAggregate|Generate)")


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if a != sf_dir] or DEFAULT
    spark = local_session(2)
    qs = queries()
    for name in names:
        buf = io.StringIO()
        with redirect_stdout(buf):
            qs[name](spark, sf_dir).explain("formatted")
        plan = buf.getvalue()
        print(f"===== {name}")
        print(plan.split("\n\n")[0])
        found = [ln.strip() for ln in plan.splitlines() if KEYS.search(ln) and ":" in ln]
        for ln in found:
            print("   ", ln[:200])


if __name__ == "__main__":
    main()
