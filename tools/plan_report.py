"""Write PLANS.md: the physical operators of every registered query.

usage: python tools/plan_report.py [sf_dir]

For each query the executed (pre-AQE) physical plan is scanned for the
operators that matter at scale: exchanges, join strategies, partial group
limits, generators, Python operators and single-partition steps.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from swipeflow.plans.registry import REGISTRY  # noqa: E402
from swipeflow.session import build_session  # noqa: E402

# queries that run a stream or train a model while being built
SKIP = {"gbt_scores", "gbt_weighted", "random_forest_scores", "feature_importance", "model_run", "embedding_search", "pipeline_layers", "managed_table"}
PATTERNS = [
    ("hash exchange", "Exchange hashpartitioning"),
    ("range exchange", "Exchange rangepartitioning"),
    ("single-partition", "SinglePartition"),
    ("broadcast hash join", "BroadcastHashJoin"),
    ("sort-merge join", "SortMergeJoin"),
    ("nested-loop join", "BroadcastNestedLoopJoin"),
    ("cartesian", "CartesianProduct"),
    ("partial group limit", "WindowGroupLimit"),
    ("top-k", "TakeOrderedAndProject"),
    ("numpy over Arrow", "InArrow"),
    ("mapInPandas", "MapInPandas"),
    ("python UDF", "PythonUDF"),
]


SCAN_DETAIL = ["daily_txn_summary", "customer_360_sql", "yoy_volume", "vector_topk", "amount_outliers"]


def _scan_lines(plan: str) -> list[str]:
    """Table, pushed filters and read schema of every parquet scan."""
    out = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        table = line.split("Location: InMemoryFileIndex(1 paths)[")[-1].split("]")[0].rsplit("/", 1)[-1]
        pushed = line.split("PushedFilters: ")[-1].split(", ReadSchema")[0] if "PushedFilters" in line else "[]"
        schema = line.split("ReadSchema: ")[-1] if "ReadSchema" in line else ""
        out.append(f"{table}: PushedFilters {pushed}; ReadSchema {schema}")
    return sorted(set(out))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=16)
    lines = [
        "# Physical plans",
        "",
        f"Generated by `tools/plan_report.py` on `{sf_dir}` (plans before AQE re-optimisation; at runtime AQE",
        "coalesces partitions, converts small sort-merge joins to broadcast joins and splits skewed ones).",
        "Counts are operator occurrences in the plan, including Bronze/Silver lineage each query rebuilds.",
        "",
        "| query | " + " | ".join(p[0] for p in PATTERNS) + " |",
        "| --- | " + " | ".join("---" for _ in PATTERNS) + " |",
    ]
    scans = []
    for name, fn in REGISTRY.items():
        if name in SKIP or name.startswith("stream_"):
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = [str(plan.count(pat)) if plan.count(pat) else "" for _, pat in PATTERNS]
        lines.append(f"| {name} | " + " | ".join(counts) + " |")
        if name in SCAN_DETAIL:
            scans.append((name, _scan_lines(plan)))
    lines += [
        "",
        "Reading the table:",
        "* no cartesian product anywhere; the one nested-loop join is the substring match against the",
        "  fixed 5-row root-cause rule table (`root_cause_lookup`);",
        "* every dedup / per-group top-k shows `WindowGroupLimit` twice: a partial limit before the",
        "  hash exchange and the final one after it, so at most k rows per key and map task are shuffled;",
        "* single-partition steps are the final merge of global aggregates (one partial row per task) or",
        "  windows over already-limited top-k outputs (at most 20 rows);",
        "* broadcast hash joins are dimension joins under the measured-size threshold; at scale the same",
        "  joins plan as sort-merge joins with AQE skew splitting;",
        "* Python appears in `vector_topk` (one matrix product an Arrow batch) and `vector_topk_lsh` (one a pair of",
        "  blocks); reports that read Silver many times show scans of its checkpoint, not of the given tables.",
    ]
    lines += ["", "## Scans (column pruning and pushed filters)", ""]
    for name, items in scans:
        lines.append(f"**{name}**")
        lines.append("")
        lines += [f"* `{x}`" for x in items]
        lines.append("")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()
    print(out)


if __name__ == "__main__":
    main()
