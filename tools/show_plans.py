"""Summarise the physical plan of every registered query (writes PLANS.md).

Usage: python tools/show_plans.py [sf_dir] [--full name ...]
Per query: shuffles (Exchange), broadcasts, raw-table scans, aggregate and join
operators, Python evaluation (must be none), and whether filters reach the scan.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loadcast import queries as Q  # noqa: E402
from loadcast.session import build_session  # noqa: E402

# Queries that run jobs while being built (model fits, writes); their returned frame is
# a read of the written result, so its plan says little.
EAGER = {"rf_train", "model_roundtrip", "score_batch", "score_stream", "feature_table",
         "long_history_feature_table", "feature_table_train_fit", "rf_metrics", "csv_roundtrip", "csv_glob",
         "json_roundtrip", "hourly_stats", "daily_stats", "stats_merge", "stats_two_months", "unparsed_times"}


TREES = ["five_min_rollup", "hourly_peak", "lag_calendar", "long_history_features", "score_features"]


def formatted(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def summary(p: str) -> dict:
    tree = p.split("\n\n")[0]
    nodes = Counter(re.sub(r"\s*\(\d+\)$", "", re.sub(r"^[\s:|+\-*]*", "", l)).strip() for l in tree.splitlines()[1:])
    raw = re.findall(r"Location: InMemoryFileIndex \[file:([^\]]+)\]", p)
    return {
        "exchanges": nodes.get("Exchange", 0),
        "broadcasts": nodes.get("BroadcastExchange", 0),
        "scans": ", ".join(sorted(re.sub(r"-[0-9a-f]{12}$", " (staged)", os.path.basename(x).replace(".parquet", "")) for x in raw)),
        "ops": ", ".join(sorted(k for k in nodes if re.search(r"Aggregate|Join|Window|Generate|Expand", k))),
        "python": "yes" if re.search(r"EvalPython|PythonUDF|FlatMapGroupsInPandas", p) else "no",
        "pushed": "yes" if re.search(r"PushedFilters: \[[^\]]+\]|PartitionFilters: \[[^\]]+\]", p) else "",
    }


def main():
    args = sys.argv[1:]
    sf = args[0] if args and not args[0].startswith("--") else "/root/testdata/sf0.01"
    full = set(args[args.index("--full") + 1:]) if "--full" in args else set()
    spark = build_session("local[8]", shuffle_partitions=8)
    rows = []
    for name, fn in Q.queries().items():
        if name in EAGER:
            continue
        p = formatted(spark, fn(spark, sf))
        if name in full:
            print(f"==== {name}\n{p}")
        rows.append((name, summary(p)))
    out = ["# Physical plans", "",
           "Generated by `python tools/show_plans.py` (sf0.01, local[8], AQE initial plans). "
           "Queries that fit models or write and re-read a table while being built are left out; "
           "their stages are the plans of the queries they are made of.", "",
           "| query | shuffles | broadcasts | raw scans | operators | Python | pushed filters |",
           "| --- | --- | --- | --- | --- | --- | --- |"]
    for name, s in rows:
        out.append(f"| {name} | {s['exchanges']} | {s['broadcasts']} | {s['scans']} | {s['ops']} | "
                   f"{s['python']} | {s['pushed']} |")
    out += ["", "## Plan trees of the key queries", "",
            "`long_history_features` is the training feature build (rollup, hourly arg-max, daily "
            "and rolling means, lags, calendar); its two exchanges are the rollup's and the one "
            "on server.", ""]
    for name in TREES:
        p = formatted(spark, Q.queries()[name](spark, sf))
        out += [f"### {name}", "", "```", p.split("\n\n")[0].strip(), "```", ""]
    text = "\n".join(out) + "\n"
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write(text)
    print(text)


if __name__ == "__main__":
    main()
