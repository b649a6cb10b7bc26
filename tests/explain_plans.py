"""Summarise the physical plan of every registered query.

    python tests/explain_plans.py [sf_dir] [name ...]

For each query: the number of exchanges (shuffles / broadcasts), the
aggregate operators (hash vs sort based), generators, and each Parquet scan
with its pushed filters and read schema.  ``--full`` prints the formatted
plans instead.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(plan: str) -> dict:
    lines = plan.splitlines()
    ops = [re.sub(r"^[\s:+\-|]*(\*\(\d+\)\s*)?", "", ln).split("(")[0].split(" ")[0]
           for ln in lines]
    scans = []
    for ln in lines:
        if "FileScan parquet" in ln:
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", ln)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", ln)
            scans.append({"pushed": pushed.group(1) if pushed else None,
                          "schema": schema.group(1) if schema else None})
    return {
        "exchanges": sum(1 for o in ops if o in ("Exchange", "BroadcastExchange")),
        "broadcasts": sum(1 for o in ops if o == "BroadcastExchange"),
        "aggregates": sorted({o for o in ops if o.endswith("Aggregate")}),
        "generators": sum(1 for o in ops if o == "Generate"),
        "scans": scans,
    }


def main(argv):
    import __spark_entry__ as ent
    from tokenledger.session import get_session

    full = "--full" in argv
    args = [a for a in argv[1:] if a != "--full"]
    sf_dir = args[0] if args else "/root/testdata/sf0.001"
    names = args[1:] or list(ent.queries())
    spark = get_session("local[4]", shuffle_partitions=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    for name in names:
        df = ent.queries()[name](spark, sf_dir)
        if full:
            print(f"===== {name}")
            df.explain("formatted")
        else:
            plan = df._jdf.queryExecution().executedPlan().toString()
            print(name, summary(plan), flush=True)


if __name__ == "__main__":
    main(sys.argv)
