"""Regenerates the tables of PLANS.md from each registered query's own
executed (post-AQE) plan at $BENCH_SF_DIR; prints Markdown to stdout.

Usage: ``python plans_report.py`` prints the tables; ``--write`` replaces
everything after the prose header of PLANS.md with them."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cityair import build_session  # noqa: E402
from cityair.catalog import QUERIES, world  # noqa: E402

FULL = ("city_daily_avg", "bbox_match", "tagged_stations")


def final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own query, so AQE finalises its plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in plan:
        plan = plan[plan.index("== Final Plan =="):plan.index("== Initial Plan ==")]
    return plan


def shape(name: str, plan: str) -> str:
    def c(p):
        return len(re.findall(p, plan))
    shuffles = sum(c(p) for p in (r"Exchange hashpartitioning", r"Exchange rangepartitioning",
                                  r"Exchange SinglePartition"))
    joins = [f"{lab}×{c(k)}" for k, lab in (("BroadcastHashJoin", "BHJ"), ("SortMergeJoin", "SMJ"),
                                             ("ShuffledHashJoin", "SHJ"),
                                             ("BroadcastNestedLoopJoin", "BNLJ")) if c(k)]
    aggs = [f"{lab}×{c(k + r'\(')}" for k, lab in (("HashAggregate", "hash"),
                                                    ("SortAggregate", "sort"),
                                                    ("ObjectHashAggregate", "object"))
            if c(k + r"\(")]
    other = [x.strip() for x in ("WindowGroupLimit", "Window ", "TakeOrderedAndProject",
                                 "Generate", "Expand") if x in plan]
    scans = re.findall(r"FileScan parquet [^\n]*?Location: InMemoryFileIndex\(\d+ paths\)"
                       r"\[file:([^\],]*)", plan)
    tables = sorted({re.sub(r".*/(?:cityair/)?", "", s).split("-")[0] for s in scans})
    pruned = "yes" if re.search(r"PartitionFilters: \[[^\]]+\]", plan) else ""
    return (f"| `{name}` | {shuffles} | {' '.join(joins)} | {' '.join(aggs)} | "
            f"{', '.join(other)} | {', '.join(tables)} | {pruned} |")


def main() -> None:
    if "--write" in sys.argv:
        import contextlib
        import io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            report()
        path = os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md")
        text = open(path).read()
        head = text[:text.index("| query | shuffles |")]
        with open(path, "w") as f:
            f.write(head + buf.getvalue())
    else:
        report()


def report() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("local[8]")
    w = world(spark, sf_dir)
    w.land()
    w.build_models()
    print("| query | shuffles | joins | aggregates | other | scans | partition pruning |")
    print("|---|---|---|---|---|---|---|")
    plans = {}
    for name, q in QUERIES.items():
        plans[name] = final_plan(q(spark, sf_dir))
        print(shape(name, plans[name]))
    print("\n## Three final plans in full\n\nExpression ids and scratch paths removed; "
          "long lines cut.")
    for name in FULL:
        text = re.sub(r"#\d+L?", "", re.sub(r"file:/[^\]]*/(cityair/)?", "", plans[name]))
        print(f"\n### `{name}` (after AQE)\n\n```")
        print("\n".join(line[:170] for line in text.splitlines() if line.strip(" +-")))
        print("```")
    spark.stop()


if __name__ == "__main__":
    main()
