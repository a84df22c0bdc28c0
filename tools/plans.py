"""Write PLANS.md: the executed physical plans of the headline queries (after AQE), as evidence of
push-down, pruning, broadcast decisions and partial dedup. usage: python tools/plans.py [sf_dir]"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from stratum.plans import catalog  # noqa: E402
from stratum.session import local_session  # noqa: E402

KEYS = ["dedup_latest", "scd1_merge", "campaign_performance", "left_join_current_dim", "point_in_time_join",
        "in_subquery_having", "json_array_flatten"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    out = ["# Physical plans of headline queries", "",
           f"Generated by `tools/plans.py` on `{sf}` (local[8], AQE on). These are the final adaptive plans "
           "after execution; snapshot inputs appear as parquet scans of the session's checkpoint folder.", ""]
    for k in KEYS:
        df = catalog.QUERIES[k](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln[:220] for ln in plan.splitlines()]
        out += [f"## `{k}`", "", "```", *lines, "```", ""]
    with open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
