"""Write PLANS.md: the executed physical plan of each headline query (AQE's
final plan after a full run, operator lines only) with shuffle / broadcast /
reuse counts.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from tickspan.plans import catalog  # noqa: E402
from tickspan.session import get_session  # noqa: E402

def final_only(plan: str) -> list[str]:
    """The plan with every AQE ``== Initial Plan ==`` block (top level and
    inside subqueries) removed, keeping the final plans."""
    out, skip_at = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :|+-"))
        if skip_at is not None:
            if line.strip() and indent <= skip_at:
                skip_at = None
            else:
                continue
        if "== Initial Plan ==" in line:
            skip_at = line.index("==") - 3 if line.index("==") >= 3 else 0
            continue
        if not line.strip() or line.startswith("== ") or "== Final Plan ==" in line:
            continue
        out.append(line.rstrip())
    return out


def trimmed(lines: list[str]) -> list[str]:
    return [re.sub(r"\[[^\[\]]*\]", "[…]", l)[:160] for l in lines]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    parts = ["# Physical plans of the headline queries", "",
             f"Generated by `tools/explain_plans.py` on `{sf_dir}`: AQE's final plans after each query ran "
             "in full. `Exchange` = shuffle; `ReusedExchange` / `ReusedSubquery` = computed once, read again. "
             "Subquery plans (period anchors, benchmark choice) are listed once each.", ""]
    for name in HEADLINE + ["indicators_year_buckets"]:
        df = catalog.QUERIES[name](spark, sf_dir)
        df.collect()  # run this query execution so the plan below is the final one
        qe = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        plan = df._jdf.queryExecution().explainString(qe)
        kept = final_only(plan)
        final = "\n".join(kept)
        tree = trimmed(kept)
        shuffles = len(re.findall(r"\+- Exchange hashpartitioning|\+- Exchange rangepartitioning|\+- Exchange SinglePartition", final))
        bcasts = final.count("BroadcastExchange")
        reused = final.count("ReusedExchange") + final.count("ReusedSubquery")
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^,]*(?:,[^>]*)?>)", final)))
        parts += [f"## {name}", "",
                  f"shuffle exchanges: {shuffles}, broadcast exchanges: {bcasts}, reused: {reused}", "", "```"]
        parts += tree + ["```", ""]
        if schemas:
            parts += ["Scans read only:", ""] + [f"* `{s}`" for s in schemas] + [""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main()
