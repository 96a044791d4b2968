"""Summarise the physical plan of every relational / streaming-free proof.

Usage: python tools/plan_stats.py [sf_dir] > docs/PLANS.md

Counts per query: file scans, shuffles (Exchange), broadcasts, join
strategies, pre-shuffle window limits, sorts and aggregates — read from
``explain("formatted")`` before execution (AQE may still turn a shuffle join
into a broadcast at runtime).
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridlake.plans.registry import load_all  # noqa: E402
from gridlake.session import local_session  # noqa: E402

COLS = [
    ("scans", r"^\(\d+\) Scan parquet"),
    ("shuffles", r"^\(\d+\) Exchange$"),
    ("broadcasts", r"^\(\d+\) BroadcastExchange"),
    ("bhj", r"^\(\d+\) BroadcastHashJoin"),
    ("smj", r"^\(\d+\) SortMergeJoin"),
    ("nlj", r"^\(\d+\) BroadcastNestedLoopJoin"),
    ("wgl", r"^\(\d+\) WindowGroupLimit"),
    ("window", r"^\(\d+\) Window$"),
    ("hash_agg", r"^\(\d+\) HashAggregate"),
    ("sort_agg", r"^\(\d+\) SortAggregate"),
    ("top_k", r"^\(\d+\) TakeOrderedAndProject"),
]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    rows = []
    for name, p in load_all().items():
        if not p.fn.__module__.endswith("proofs_relational"):
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            p.fn(spark, sf).explain(mode="formatted")
        text = buf.getvalue()
        counts = [len(re.findall(rx, text, re.M)) for _, rx in COLS]
        rows.append((name, ",".join(p.ids), counts))
    print("# Physical plans of the relational proofs\n")
    print(f"Generated by `tools/plan_stats.py` at `{sf}` from `explain(\"formatted\")` (before adaptive re-planning).")
    print("`wgl` = WindowGroupLimit (top-1 per key before/after the shuffle); `nlj` = nested-loop join.\n")
    print("| query | ids | " + " | ".join(c for c, _ in COLS) + " |")
    print("|---|---|" + "---|" * len(COLS))
    for name, ids, counts in rows:
        print(f"| `{name}` | {ids} | " + " | ".join(str(c) for c in counts) + " |")


if __name__ == "__main__":
    main()
