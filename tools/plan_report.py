"""Final (AQE) physical plan shape of the headline queries -> PLANS.md.

    python tools/plan_report.py [sf_dir]

Each query is executed once so that ``explain`` shows the adaptive plan
that actually ran; the report counts shuffles, join strategies and
aggregates of the final plan only and lists the Parquet scans with their
pushed filters.  Tables written while a query is being built
(``materialize``) are counted beside it, with the operators of their plans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from vaultmart.plans.queries import QUERIES  # noqa: E402
from vaultmart.session import get_spark  # noqa: E402

COUNTED = ("ShuffleExchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin",
           "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window", "FlatMapGroupsInPandas")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> dict:
    # formatted plans list each operator once in the numbered section
    final = re.search(r"== Final Plan ==(.*?)== Initial Plan ==", text, flags=re.S)
    ran = set(re.findall(r"\((\d+)\)", final[1])) if final else None
    ops = [(i, n) for i, n in re.findall(r"^\((\d+)\) (\w+)", text, flags=re.M) if ran is None or i in ran]
    names = [n if n != "Exchange" else "ShuffleExchange" for _, n in ops]
    counts = {k: names.count(k) for k in COUNTED}
    scans = re.findall(r"^\(\d+\) Scan parquet.*?\n(?:.*\n)*?PushedFilters: (\[.*?\])", text, flags=re.M)
    return {"counts": counts, "pushed": scans}


def recorded(found: list):
    """Let every module's ``materialize`` note the plan of what it writes."""
    import vaultmart.session as session

    def note(spark, df, name):
        found.append(summarize(plan_text(df))["counts"])
        return real(spark, df, name)

    real = session.materialize
    for module in list(sys.modules.values()):
        if getattr(module, "materialize", None) is real:
            module.materialize = note


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    lines = ["# Physical plans of the headline queries", "",
             f"Final adaptive plans after one execution at `{sf_dir}` (`tools/plan_report.py`). "
             "Counts are operators in the executed plan; a broadcast here was chosen by AQE from measured "
             "sizes unless the side is a fixed literal table.", "",
             "| query | " + " | ".join(COUNTED) + " | tables written first (their shuffles) |", "|---|" + "---|" * (len(COUNTED) + 1)]
    pushed, written = [], []
    recorded(written)
    for name in HEADLINE:
        written.clear()
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        s = summarize(plan_text(df))
        lines.append(f"| {name} | " + " | ".join(str(s["counts"][k]) for k in COUNTED)
                     + f" | {len(written)} ({sum(w['ShuffleExchange'] for w in written)}) |")
        for p in s["pushed"]:
            if p != "[]":
                pushed.append(f"* `{name}`: {p}")
    lines += ["", "## Filters pushed into Parquet scans", ""] + sorted(set(pushed))
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    print("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
