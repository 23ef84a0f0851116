"""Write PLANS.md: trimmed physical plans of the headline queries (evidence for
pushdown, pruning, broadcast and shuffle choices).  usage: python tools/plans.py [sf_dir]"""

from __future__ import annotations

import io
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, ".")
from citymotion.plans import registry as R  # noqa: E402
from citymotion.session import local_session  # noqa: E402

HEADLINE = ["panel_enriched", "congestion_buckets_15m", "route_metrics_p95", "nearest_route_snap", "civic_days", "event_day_summary", "trailing_windows"]
KEEP = re.compile(r"^(\s*[:+\- |]*(\w+ ?)+\(\d+\)\s*$)|PushedFilters|ReadSchema|Join type|Arguments: HashedRelationBroadcastMode|PartitionFilters")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = ["# Physical plans (generated by tools/plans.py)", "", f"Data: `{sf}`.  Plans of queries reading shared tables start at the written Parquet table.", ""]
    for name in HEADLINE:
        if name == "panel_enriched":
            df = R.build_panel_df(spark, sf)  # the build, not the read of the written table
        elif name == "nearest_route_snap":
            from citymotion.operators.spatial import nearest_routes
            from citymotion.plans import adapters as A

            df = nearest_routes(A.snap_points(spark, sf), R.vertices(spark, sf))
        else:
            df = R.QUERIES[name](spark, sf)
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        lines = [ln for ln in buf.getvalue().splitlines() if KEEP.search(ln)]
        out += [f"## {name}", "", "```", *lines[:80], "```", ""]
    with open("PLANS.md", "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
