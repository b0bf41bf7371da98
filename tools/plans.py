"""Write the physical plans of selected registered queries (formatted, trimmed) to PLANS.md.

usage: python tools/plans.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from simtrail.plans.queries import REGISTRY  # noqa: E402
from simtrail.session import local_session  # noqa: E402

KEYS = ["batch_similarity", "ticket_base", "ticket_keywords", "sync_diff", "sync_apply", "embed_unique"]


def tree(df) -> str:
    # the operator tree only (the first block of the formatted plan)
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    head = plan.split("\n\n")[0]
    scans = re.findall(r"\(\d+\) Scan parquet.*?\n(?:.*\n)*?ReadSchema: .*", plan)
    detail = [s for s in scans]
    return head + "\n\n" + "\n\n".join(detail)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = local_session()
    parts = ["# Physical plans of selected queries\n",
             f"Generated by `tools/plans.py` on `{sf}` (local session, AQE on; the final plan is chosen at run time).\n"]
    for k in KEYS:
        parts.append(f"## {k}\n\n```\n{tree(REGISTRY[k](spark, sf))}\n```\n")
    with open(out, "w", encoding="utf-8") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
