"""Summarise the physical plan of every registered query (writes PLANS.md).

Usage: python tools/plan_report.py [sf_dir] [--out PLANS.md]

Each query is run once and its final adaptive plan is summarised, with
``spark.sql.autoBroadcastJoinThreshold=-1``, i.e. as a large cluster would
see it: tables that grow with the data are never broadcast because they
happen to be small here; only the explicit, size-bounded broadcasts
remain.  Model queries run jobs while they are built (fitting), so they are
listed without a plan.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from popstats import plans  # noqa: E402
from popstats.session import get_session  # noqa: E402

MODEL_KEYS = {"classify_eval", "classify_eval_gender", "classify_eval_name", "classify_topk"}


def nodes(plan, jvm, seen: set[int]):
    """The operators that really run: final stages, subqueries once, nothing below a reused exchange."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan(), jvm, seen)
        return
    if name.endswith("QueryStageExec"):
        yield from nodes(plan.plan(), jvm, seen)
        return
    yield name, plan
    below = [] if name.startswith("Reused") else [plan.children().apply(i) for i in range(plan.children().size())]
    subqueries = plan.subqueries()
    below += [subqueries.apply(i) for i in range(subqueries.size())]
    for child in below:
        identity = jvm.java.lang.System.identityHashCode(child)
        if child.getClass().getSimpleName().startswith("Subquery"):
            if identity in seen:
                continue
            seen.add(identity)
        yield from nodes(child, jvm, seen)


def summarise(plan, jvm) -> dict[str, str]:
    found = list(nodes(plan, jvm, set()))
    count = lambda *names: str(sum(n in names for n, _ in found))
    single = sum(n == "ShuffleExchangeExec" and p.outputPartitioning().toString() == "SinglePartition" for n, p in found)
    scans: dict[str, int] = {}
    for n, p in found:
        if n == "FileSourceScanExec":
            t = p.relation().location().rootPaths().apply(0).getName().removesuffix(".parquet")
            scans[t] = scans.get(t, 0) + 1
    return {
        "shuffles": count("ShuffleExchangeExec"),
        "of which to one partition": str(single),
        "reused exchanges": count("ReusedExchangeExec"),
        "broadcasts": count("BroadcastExchangeExec"),
        "SMJ": count("SortMergeJoinExec"),
        "BHJ": count("BroadcastHashJoinExec"),
        "partial WindowGroupLimit": str(sum(n == "WindowGroupLimitExec" and p.mode().toString() == "Partial" for n, p in found)),
        "TakeOrdered": count("TakeOrderedAndProjectExec"),
        "python": count("BatchEvalPythonExec", "ArrowEvalPythonExec"),
        "scans per table": "; ".join(f"{t} x{c}" for t, c in sorted(scans.items())),
    }


def main() -> None:
    args = sys.argv[1:]
    out = "PLANS.md"
    if "--out" in args:
        i = args.index("--out")
        out = args[i + 1]
        del args[i:i + 2]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = get_session(shuffle_partitions=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = []
    for key, fn in plans.queries().items():
        if key in MODEL_KEYS:
            rows.append((key, None))
            continue
        group = f"build-{key}"
        spark.sparkContext.setJobGroup(group, group)
        df = fn(spark, sf_dir)
        built = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup("run", "run")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        rows.append((key, {"jobs while built": str(built)} | summarise(plan, spark._jvm)))
    cols = list(next(s for _, s in rows if s).keys())
    lines = [
        "# Physical plans of the registered queries",
        "",
        "Generated by `python tools/plan_report.py` at sf0.01: each query is run",
        "once and its *final* adaptive plan is summarised, with size-based broadcast",
        "disabled (`spark.sql.autoBroadcastJoinThreshold=-1`) so only explicit,",
        "size-bounded broadcasts appear -- the shape a large cluster would run.",
        "Counts are plan nodes.  A reused exchange is a shuffle or broadcast read",
        "again without recomputing it; `scans per table` counts the file scans that",
        "really run (one `people` pass scans orders, customer, nation twice and part).",
        "`partial WindowGroupLimit` counts rank limits applied before the shuffle.",
        "Subqueries are counted with their query.  `jobs while built` counts Spark jobs",
        "that ran before the result was asked for (parquet footers count as one job per",
        "table; `string_index` also writes its range partitioning to the checkpoint",
        "folder).  Model keys fit models while being built and are not listed.",
        "",
        "| key | " + " | ".join(cols) + " |",
        "| --- | " + " | ".join("---" for _ in cols) + " |",
    ]
    for key, s in rows:
        if s is None:
            lines.append(f"| {key} | " + " | ".join("model" if i == 0 else "" for i in range(len(cols))) + " |")
        else:
            lines.append(f"| {key} | " + " | ".join(s[c] for c in cols) + " |")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(f"wrote {out} ({len(rows)} keys)")


if __name__ == "__main__":
    main()
