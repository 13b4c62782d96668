"""Summarise physical plans: shuffles, broadcasts, join strategies, scans.

``python -m shopwright.plans.explain <sf_dir> [table-or-query ...]`` prints
one block per name: counts of shuffle exchanges, broadcast exchanges, join
operators, single-partition exchanges, and each Parquet scan's columns and
pushed filters.  Warehouse tables are shown as their own build step,
catalogue queries as they run; both read the materialised upstream layers.
"""

from __future__ import annotations

import re
import sys

from . import catalog
from .warehouse import RAW


def summarize(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scans = []
    for line in lines:
        if "FileScan" in line:
            table = re.search(r"Location: [^\[]*\[([^\]]*)\]", line)
            rs = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            pf = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            scans.append(((table.group(1).rsplit("/", 1)[-1] if table else "?"),
                          rs.group(1) if rs else "", pf.group(1) if pf else ""))
    return {
        "shuffles": sum(1 for x in lines if re.search(r"Exchange (hash|range|round)", x)),
        "single_partition": sum(1 for x in lines if "Exchange SinglePartition" in x),
        "broadcasts": sum(1 for x in lines if "BroadcastExchange" in x),
        "joins": sorted({m for x in lines for m in re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                                              r"BroadcastNestedLoopJoin|CartesianProduct)", x)}),
        "scans": scans,
    }


def main(argv: list[str]) -> int:
    from ..session import get_spark
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_spark()
    w = catalog.warehouse(spark, sf_dir)
    for n in names:
        if n in catalog.REGISTRY:
            df = catalog.run(n, spark, sf_dir)
        else:  # the table's own step, reading its (materialised) inputs
            builder = RAW.get(n)
            df = builder(w.src) if builder else getattr(w, f"_build_{n}")()
        s = summarize(df)
        print(f"## {n}\nshuffles={s['shuffles']} single_partition={s['single_partition']} "
              f"broadcasts={s['broadcasts']} joins={','.join(s['joins']) or '-'}")
        seen: dict[tuple, int] = {}
        for sc in s["scans"]:
            seen[sc] = seen.get(sc, 0) + 1
        for (t, rs, pf), k in seen.items():
            print(f"  scan {t} x{k}: {rs} pushed={pf}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
