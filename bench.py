"""Headline timings; prints one JSON line.

Histories are first written as Parquet tables (the form a job reads), then each operator and both
whole jobs run on these tables. A few registered queries run end to end from the raw tables.
Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_REPEAT.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from chronofold.operators.change import backfilled_state, classify_changes
from chronofold.operators.checks import verdict
from chronofold.operators.overlap import expand_history, overlap_rows
from chronofold.plans.catalogue import all_queries
from chronofold.plans.jobs import run_merge, run_overwrite
from chronofold.plans.pairs import PAIRS
from chronofold.session import local_session, work_folder
from chronofold.sinks.publish import RunStore
from chronofold.spec import JoinTuning

END_TO_END = ("backfill_inner_f1", "backfill_preserve_f3", "merge_backfill_f1",
              "check_verdict_f1", "key_summary_f1", "modular_filter_list")
ANY_CHECK = ("row_count", "date_gaps", "date_overlaps", "active_flags")


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cores, "chronofold-bench")
    folder = work_folder(spark)
    seconds: dict[str, float] = {}

    def timed(name: str, run, times: int = repeat) -> None:
        took = []
        for _ in range(times):
            began = time.perf_counter()
            run()
            took.append(time.perf_counter() - began)
        seconds[name] = round(median(took), 3)

    consume(all_queries()["backfill_inner_f1"](spark, sf_dir))

    tables = {}
    for f in ("f1", "f3", "f4"):
        pair = PAIRS[f]

        def write():
            pair.target(spark, sf_dir).write.parquet(f"{folder}/{f}/target")
            pair.source(spark, sf_dir).write.parquet(f"{folder}/{f}/source")

        timed(f"prepare_{f}", write, times=1)
        tables[f] = (spark.read.parquet(f"{folder}/{f}/target"),
                     spark.read.parquet(f"{folder}/{f}/source"), pair.spec)

    for f, (t, s, spec) in tables.items():
        for mode in ("inner", "left", "preserve"):
            timed(f"expand_{mode}_{f}", lambda: consume(expand_history(t, s, spec, mode)))
        for strategy in ("plain", "broadcast", "salted"):
            tuning = JoinTuning(strategy, salt_buckets=8)
            timed(f"expand_inner_{strategy}_{f}",
                  lambda: consume(expand_history(t, s, spec, "inner", tuning)))

    for f, (t, s, spec) in tables.items():
        left = overlap_rows(t, s, spec, "left")
        timed(f"classify_{f}", lambda: consume(classify_changes(left, t, spec)))
        timed(f"merge_state_{f}", lambda: consume(backfilled_state(left, t, spec)))
        timed(f"verdict_{f}", lambda: consume(verdict(t, t, s, spec)))
        store = RunStore(spark, work_folder(spark))
        timed(f"overwrite_job_{f}",
              lambda: run_overwrite(t, s, spec, store, "inner", ignore=ANY_CHECK))
        timed(f"merge_job_{f}", lambda: run_merge(t, s, spec, store, ignore=ANY_CHECK))

    for name in END_TO_END:
        timed(f"query_{name}", lambda: consume(all_queries()[name](spark, sf_dir)))

    spark.stop()
    print(json.dumps({
        "metric": "scd2 history back-fill, operators and whole jobs",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cores": cores}))


if __name__ == "__main__":
    main()
