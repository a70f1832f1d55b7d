"""Write PLANS.md: the physical plans of the main stages (operator lines only), at sf0.01.

Usage: python tests/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = re.compile(r"Exchange|Join|Scan|Aggregate|Window|Sort|Broadcast|Expand|Project|Filter|Union|Generate|TakeOrdered")


def operators(df) -> str:
    df.collect()  # run it, so the adaptive plan is final
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("+- == Initial Plan ==")[0]
    lines = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: <shared folder>", line)
            lines.append(line[:180])
    return "\n".join(lines)


def main() -> None:
    from tidemark.operators import engine as E
    from tidemark.operators import marts as M
    from tidemark.plans import checks
    from tidemark.plans import queries as Q
    from tidemark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    f = Q.flow(spark, sf)
    sections = []
    checked = E.annotate(f.processed("orders"), checks.orders_rules())
    sections.append(("Annotate orders (10 rules; side frames already written and measured)",
                     operators(checked.annotated)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    sections.append(("Join as planned beyond the broadcast threshold (AQE on)", operators(
        M.join_orders(f.valid("orders"), f.valid("customers"), f.valid("delivery_performance")))))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 20))
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    sections.append(("KPI summary: one pass over the joined table", operators(M.kpi_summary(f.joined))))
    sections.append(("Segment analysis", operators(M.segment_analysis(f.joined))))
    sections.append(("Customer ranking (skew-safe rank; local ranks already written)",
                     operators(M.customer_ranking(f.joined))))
    events = spark.read.parquet(f"{sf}/events.parquet")
    sections.append(("Freshness with a given current time (window pushed to the scan)", operators(
        E.freshness_report(events, "ts", 60, 1, 24, curr_timestamp="2024-01-30 12:00:00"))))
    out = ["# Physical plans", "", "Generated by `python tests/show_plans.py` at "
           f"`{os.path.basename(sf)}` (operator lines only).", ""]
    for title, text in sections:
        out += [f"## {title}", "", "```", text, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
