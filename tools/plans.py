"""Write the final (post-AQE) physical plan tree of the headline queries to PLANS.md.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from qualia.plans import QUERIES  # noqa: E402
from qualia.session import local_session  # noqa: E402


def final_tree(df) -> str:
    executed = df._jdf.queryExecution().executedPlan()
    executed.execute().count()  # run this plan itself, so the adaptive plan is final
    plan = executed.toString().split("+- == Initial Plan ==")[0]
    # keep operator names, drop expression ids and long argument lists
    lines = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        if len(line) > 150:
            line = line[:147] + "..."
        lines.append(line)
    return "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    out = [
        "# Final physical plans (after adaptive execution)",
        "",
        f"Generated by `python tools/plans.py {sf_dir}` on local[8], default `spark.sql.codegen.maxFields`.",
        "`*(n)` marks whole-stage code generation; `Exchange` is a shuffle; `BroadcastExchange` a broadcast.",
        "",
    ]
    for name in HEADLINE:
        out += [f"## {name}", "", "```", final_tree(QUERIES[name](spark, sf_dir)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
