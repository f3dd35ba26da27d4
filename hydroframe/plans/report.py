"""Plan report: shuffles, join strategies and scan pruning of every registered query.

``python -m hydroframe.plans.report [sf_dir]`` executes each query (``noop`` sink) and reads
its final adaptive plan, so the counts are what actually ran, after AQE's re-planning.
"""

from __future__ import annotations

import re
import sys


def final_plan(df) -> str:
    """Execute ``df`` through the noop sink and return its final physical plan text."""
    qe = df._jdf.queryExecution()
    df.write.mode("overwrite").format("noop").save()
    return qe.executedPlan().toString()


def summarize(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|"
                                   r"\bExchange RoundRobinPartitioning|\bExchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "nested_loop": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)),
        "scans": len(re.findall(r"FileScan parquet", plan)),
        "read_cols": sorted(set(re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan))),
    }


def stage_times(event_dir: str) -> list[dict]:
    """Stage durations and task counts from Spark event logs written to ``event_dir``
    (``spark.eventLog.dir``; plain or zstd-compressed, rolling or single files)."""
    import glob
    import io
    import json
    import os
    files = [f for f in glob.glob(os.path.join(event_dir, "**", "*"), recursive=True)
             if os.path.isfile(f) and os.path.basename(f).startswith(("events_", "local-", "app-"))]
    out = []
    desc: dict[int, str] = {}
    for path in sorted(files):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") == "SparkListenerStageSubmitted":
                props = e.get("Properties") or {}
                desc[e["Stage Info"]["Stage ID"]] = props.get("spark.job.description", "")
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                out.append({"stage": si["Stage ID"], "name": si.get("Stage Name", ""),
                            "query": desc.get(si["Stage ID"], ""),
                            "tasks": si["Number of Tasks"],
                            "ms": si.get("Completion Time", 0) - si.get("Submission Time", 0)})
    return out


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from hydroframe.plans import queries as Q
    from hydroframe.session import get_spark
    spark = get_spark()
    rows = []
    for name, fn in Q.queries().items():
        s = summarize(final_plan(fn(spark, sf_dir)))
        rows.append((name, s))
    print("| query | shuffles | broadcasts | SMJ | BHJ | nested loop | python | scans |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, s in rows:
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | "
              f"{s['nested_loop']} | {s['python']} | {s['scans']} |")


if __name__ == "__main__":
    if sys.argv[1:2] == ["--events"]:
        stages = stage_times(sys.argv[2])
        print(f"{len(stages)} stages, {sum(s['ms'] for s in stages)} ms in total; slowest:")
        for st in sorted(stages, key=lambda x: -x["ms"])[:10]:
            print(f"  stage {st['stage']:4d} {st['tasks']:5d} tasks {st['ms']:7d} ms  "
                  f"{st['query'][:28]:28s} {st['name'][:40]}")
        per_query: dict[str, int] = {}
        for st in stages:
            per_query[st["query"]] = per_query.get(st["query"], 0) + st["ms"]
        print("stage time per query (ms):", dict(sorted(per_query.items(), key=lambda kv: -kv[1])[:12]))
    else:
        main(*sys.argv[1:])
