"""Summarise the physical plan of every batch query: exchanges, partial limits/aggregates, joins, scans.

Usage: python tools/plan_report.py [sf_dir]   (prints a markdown table)
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


def summarise(p: str) -> dict[str, str]:
    ex = re.findall(r"Exchange (\w+)", p)
    kinds = {}
    for e in ex:
        kinds[e] = kinds.get(e, 0) + 1
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)[^,]*, [^,]*, (\w+)", p)))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", p)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", p)
    return {
        "exchanges": ", ".join(f"{v}× {k}" for k, v in sorted(kinds.items())) or "none",
        "partial limit": str(p.count(", Partial")),
        "partial agg": str(len(re.findall(r"functions=\[partial_", p))),
        "joins": ", ".join(f"{a} {b}" for a, b in joins) or "–",
        "scan cols": "; ".join(str(len(s.split(","))) for s in scans),
        "pushed": "yes" if any(x.strip() for x in pushed) else "–",
    }


def main(argv):
    from stationlake import get_session
    from stationlake.plans.queries import queries
    from stationlake.plans.stored import STORED_QUERIES
    from stationlake.plans.streams import STREAM_QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 16)
    names = [n for n in queries() if n not in STREAM_QUERIES and n not in STORED_QUERIES]
    cols = ["exchanges", "partial limit", "partial agg", "joins", "scan cols", "pushed"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for n in names:
        s = summarise(plan_text(queries()[n](spark, sf_dir)))
        print(f"| `{n}` | " + " | ".join(s[c] for c in cols) + " |")


if __name__ == "__main__":
    main(sys.argv[1:])
