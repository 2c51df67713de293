"""

Inputs (CSV data files, command files, a ledger) are staged by Spark from
the driver tables before timing.  Each workload runs once to warm up, then
$BENCH_REPEAT times; the median is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tallyload.operators import (  # noqa: E402
    command_parse,
    ledger_latest,
    queue_depth,
    registry_resolve,
    state_summary,
)
from tallyload.plans import bench_inputs as B  # noqa: E402
from tallyload.plans import scenario as S  # noqa: E402
from tallyload.plans.batch import Layout, run_batch  # noqa: E402
from tallyload.session import get_session, scratch_dir  # noqa: E402
from tallyload.sources.commands import command_scan  # noqa: E402
from tallyload.streaming import stream_commands, stream_load  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def main() -> None:
    spark = get_session(master=f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2, app="tallyload-bench")
    root = scratch_dir(spark, "bench")
    li_cmds = B.stage_lineitem_monthly(spark, SF_DIR, f"{root}/p1")
    li_bad_cmds = B.stage_lineitem_monthly(spark, SF_DIR, f"{root}/p3", malformed_pct=1)
    ev_cmds = B.stage_event_commands(spark, SF_DIR, f"{root}/p2")
    doc_cmds = S.stage_documents(spark, SF_DIR, f"{root}/p4")
    many_cmds = B.stage_orders_many(spark, SF_DIR, f"{root}/p6")
    S.events_ledger(spark, SF_DIR).write.mode("overwrite").partitionBy("batch_id", "step").parquet(f"{root}/p5/ledger")
    run_no = [0]

    def fresh(name):
        run_no[0] += 1
        return Layout(f"{root}/{name}/run{run_no[0]}")

    def p1():
        run_batch(spark, command_scan(spark, li_cmds, S.STAGED_COMMAND_REGEX, positions=False), B.lineitem_registry(spark),
                  fresh("p1"), 0, profile="quoted")

    def p2():
        cmds = command_parse(command_scan(spark, ev_cmds, S.STAGED_COMMAND_REGEX, positions=False), fraction="decimal")
        registry_resolve(cmds, S.events_registry(spark, SF_DIR)).write.format("noop").mode("overwrite").save()

    def p3():
        run_batch(spark, command_scan(spark, li_bad_cmds, S.STAGED_COMMAND_REGEX, positions=False), B.lineitem_registry(spark),
                  fresh("p3"), 0, profile="external")

    def p4():
        run_batch(spark, command_scan(spark, doc_cmds, S.STAGED_COMMAND_REGEX, positions=False), S.documents_registry(spark),
                  fresh("p4"), 0, profile="continued")

    def p5():
        latest = ledger_latest(spark.read.parquet(f"{root}/p5/ledger")).persist()
        waiting = registry_resolve(latest.filter(F.col("state") == 0).drop("dest_table"), S.events_registry(spark, SF_DIR))
        queue_depth(waiting).write.format("noop").mode("overwrite").save()
        state_summary(latest).write.format("noop").mode("overwrite").save()
        latest.unpersist()

    def p6():
        layout = fresh("p6")
        lines = stream_commands(spark, many_cmds, S.STAGED_COMMAND_REGEX, max_files_per_trigger=25)
        q = stream_load(lines, lambda: S.orders_registry(spark), layout, f"{layout.root}/checkpoint",
                        available_now=True)
        q.awaitTermination()

    work = {"p1_load_lineitem_monthly": p1, "p2_event_commands": p2, "p3_load_with_rejects": p3,
            "p4_continued_documents": p4, "p5_ledger_monitoring": p5, "p6_stream_100_files": p6}
    only = [w for w in os.environ.get("BENCH_ONLY", "").split(",") if w]
    out = {}
    for name, fn in work.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        fn()  # warm-up
        times = []
        for _ in range(REPEAT):
            t = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t)
        out[name] = round(statistics.median(times), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum of median workload seconds (P1-P6)",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "spark": spark.version,
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
