"""Physical-plan audit of every registered query: ``python -m vistasieve.plans.audit [sf_dir] > PLANS.md``.

Each query is executed into the ``noop`` sink, then its final adaptive plan is
scanned for the operators that matter at scale: shuffles, join strategies,
window limits, Python stages, and any nested-loop or Cartesian join (there
should be none). Preparatory jobs a query runs while being built (range
ranking, per-source writes) are separate plans and are not counted here.
"""

from __future__ import annotations

import re
import sys

PATTERNS = {
    "Exchange": r"\bExchange\b",
    "BroadcastHashJoin": r"BroadcastHashJoin",
    "SortMergeJoin": r"SortMergeJoin",
    "ShuffledHashJoin": r"ShuffledHashJoin",
    "NestedLoop/Cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "WindowGroupLimit": r"WindowGroupLimit",
    "Window": r"\bWindow \(",
    "HashAggregate": r"HashAggregate|ObjectHashAggregate|SortAggregate",
    "Python": r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas",
    "TakeOrdered": r"TakeOrderedAndProject",
}


def audit(spark, sf_dir: str, name: str) -> dict:
    from vistasieve.plans.queries import QUERIES

    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    tree = formatted.split("\n\n")[0]  # the operator tree (details follow it)
    row = {k: len(re.findall(p, tree)) for k, p in PATTERNS.items()}
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", formatted)) - {"[]"})
    row["pushed_filters"] = "; ".join(pushed)
    return row


def main(argv):
    from vistasieve.plans.queries import QUERIES
    from vistasieve.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    cols = list(PATTERNS)
    print(f"# Physical plans of the registered queries ({sf_dir})\n")
    print("Counts are operators in the final adaptive plan of the query's result. Generated by "
          "`python -m vistasieve.plans.audit`.\n")
    print("| query | " + " | ".join(cols) + " | pushed filters |")
    print("|---|" + "---|" * (len(cols) + 1))
    for name in QUERIES:
        r = audit(spark, sf_dir, name)
        print(f"| {name} | " + " | ".join(str(r[c]) for c in cols) + f" | {r['pushed_filters']} |", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
