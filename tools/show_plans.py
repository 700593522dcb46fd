"""Print the physical plans of the stored-path jobs (for PLANS.md).

Builds Bronze and Silver from the sf directory's raw log, then shows the plan
of each layer job as it reads its stored predecessor, plus two marts.
Usage: python tools/show_plans.py [/root/testdata/sf0.01]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from incidentlake.config import local_session  # noqa: E402
from incidentlake.operators import marts  # noqa: E402
from incidentlake.operators.bronze import land  # noqa: E402
from incidentlake.operators.gold import to_gold  # noqa: E402
from incidentlake.operators.silver import to_silver  # noqa: E402
from incidentlake.sinks import write_csv, write_layer  # noqa: E402
from incidentlake.sources import raw_log, read_bronze, read_layer, read_raw_csv  # noqa: E402


def tree(df, width: int = 150) -> str:
    """Physical plan tree, one line per operator, long attribute lists cut."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if "== Initial Plan ==" in line:
            break
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        out.append(line if len(line) <= width else line[: width - 3] + "...")
    return "\n".join(out)


def scans(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = []
    for line in dict.fromkeys(plan.splitlines()):
        if "FileScan" in line:
            pushed = re.search(r"PushedFilters: (\[.*?\]), ReadSchema", line)
            schema = re.search(r"ReadSchema: (struct<[^>]*>?)", line)
            found.append(f"PushedFilters {pushed.group(1) if pushed else '-'}; "
                         f"ReadSchema {re.sub(r'#\d+', '', schema.group(1)) if schema else '-'}")
    return found


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    root = tempfile.mkdtemp(prefix="incidentlake-plans-")
    spark = local_session("incidentlake-plans", extra={"spark.checkpoint.dir": f"{root}/ckpt"})
    write_csv(raw_log(spark, sf), f"{root}/raw")
    jobs = {}
    jobs["bronze (CSV -> Bronze)"] = land(read_raw_csv(spark, f"{root}/raw"))
    write_layer(jobs["bronze (CSV -> Bronze)"], f"{root}/bronze")
    jobs["silver (Bronze -> Silver)"] = to_silver(read_bronze(spark, f"{root}/bronze"))
    write_layer(jobs["silver (Bronze -> Silver)"], f"{root}/silver")
    jobs["gold (Silver -> Gold)"] = to_gold(read_layer(spark, f"{root}/silver"))
    write_layer(jobs["gold (Silver -> Gold)"], f"{root}/gold")
    gold = marts.filter_gold(read_layer(spark, f"{root}/gold"), ["HIGH", "CRITICAL"])
    jobs["mart: kpis (filtered Gold)"] = marts.kpis(gold)
    jobs["mart: severity_share"] = marts.severity_share(gold)
    for name, df in jobs.items():
        df.collect()  # final adaptive plan
        print(f"### {name}\n")
        for s in scans(df):
            print(f"* {s}")
        print("\n```\n" + tree(df) + "\n```\n")


if __name__ == "__main__":
    main()
