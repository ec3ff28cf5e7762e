"""Physical-plan shape of every registered batch query, as a Markdown table.

``python -m devmetrics.plans.summary [sf_dir] > PLANS.md``. Plans are taken with AQE off and size-based broadcasts
off (``autoBroadcastJoinThreshold=-1``), i.e. as they would plan when every table is large. The plan text isn't
truncated, and aggregates are given by kind.
"""

from __future__ import annotations

import re
import sys

EAGER = {"stream_ingest", "stream_dedup", "stream_window_count", "stream_ack_timeout", "stream_csv_ingest", "stream_csv_to_store",
         "stream_stats", "stream_open_deliveries", "stream_first_copies"}


def shape(plan: str) -> dict[str, str]:
    scans = re.findall(r"Location: \w+\(\d+ paths\)\[file:[^\],]*/([\w.-]+?)(?:\.parquet)?[\],]", plan)
    scans = [re.sub(r"-[0-9a-f]{12}$", " (staged)", x) for x in scans]
    pushed = re.findall(r"PushedFilters: \[[^\]]*(?:GreaterThan|LessThan)[^\]]*\]", plan)
    hashx = len(re.findall(r"Exchange hashpartitioning", plan))
    rangex = len(re.findall(r"Exchange rangepartitioning", plan))
    single = len(re.findall(r"Exchange SinglePartition", plan))
    bcast = len(re.findall(r"BroadcastExchange", plan))
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                       r"[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti|FullOuter|RightOuter)", plan)
    windows = len(re.findall(r"\bWindow \[", plan))
    kinds = re.findall(r"(ObjectHash|Hash|Sort)Aggregate\(keys?=", plan)
    return {
        "scans": ", ".join(sorted(set(scans))) + (f" (x{len(scans)})" if len(scans) > 1 else ""),
        "pushed": "yes" if pushed else "",
        "shuffles": " ".join(x for x in [f"hash {hashx}" if hashx else "", f"range {rangex}" if rangex else "",
                                         f"single {single}" if single else ""] if x) or "none",
        "broadcast": str(bcast) if bcast else "",
        "joins": ", ".join(f"{j[0].replace('Join', '')} {j[1]}" for j in joins),
        "windows": str(windows) if windows else "",
        "aggregates": " ".join(f"{k.lower()} {kinds.count(k)}" for k in ("Hash", "ObjectHash", "Sort") if k in kinds),
    }


def main(argv: list[str]) -> None:
    from devmetrics.plans.catalog import QUERIES
    from devmetrics.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    cols = ["scans", "pushed", "shuffles", "broadcast", "joins", "windows", "aggregates"]
    print("# PLANS\n")
    print("Physical-plan shape of every registered batch query (generated by `python -m devmetrics.plans.summary`),")
    print("planned as if every table were large: AQE off, size-based broadcasts off. `single` counts exchanges into one")
    print("partition: the final step of a global aggregate (one partial row per task) or the prefix sum over per-day")
    print("totals (see README). Aggregates count partial and final")
    print("steps by kind (`sort`: buffers that a hash aggregate can't hold, with a sort before it). Streaming queries are left out (micro-batch plans); queries that stage data show the staged table.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in QUERIES.items():
        if name in EAGER:
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        print(f"| `{name}` | " + " | ".join(s[c] for c in cols) + " |")


if __name__ == "__main__":
    main(sys.argv)
