"""Report plan features that do not scale: nested-loop joins, single-partition exchanges, row Python.

usage: python tools/plan_audit.py [sf] [name ...]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from threadloom.plans.registry import QUERIES  # noqa: E402
from threadloom.session import get_spark  # noqa: E402

WATCHED = ["CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition", "BatchEvalPython",
           "BroadcastExchange", "WindowGroupLimit", "Window ", "TakeOrderedAndProject", "ArrowEvalPython"]


def main() -> None:
    spark = get_spark("plans", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    for name, query in QUERIES.items():
        if wanted and name not in wanted:
            continue
        df = query(spark, f"/root/testdata/sf{sf}")
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {w: len(re.findall(re.escape(w), plan)) for w in WATCHED}
        exchanges = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin", plan))
        print(name, "exchanges", exchanges, {k: v for k, v in counts.items() if v})
        if wanted:
            df.explain("formatted")


if __name__ == "__main__":
    main()
