"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``, as one JSON line."""

from __future__ import annotations

import json
import os
import time

from runledger.plans.registry import REGISTRY
from runledger.session import session_builder, ship_package

HEADLINE = (
    "run_sql",
    "agg_group",
    "agg_count_distinct",
    "cube",
    "join_inner",
    "join_theta",
    "win_rank",
    "topk",
    "f_json",
    "udf_scalar",
    "classify_statement",
    "row_text",
    "write_result_text",
    "ctas",
    "state_flags",
    "current_state",
    "reconcile_state",
    "final_outcome",
    "failure_reason",
    "progress_ratio",
    "running_progress",
    "throttled_report",
    "current_state_stream",
    "running_progress_stream",
    "throttled_report_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        session_builder(
            "runledger-bench",
            conf={
                "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
                "spark.driver.memory": "8g",
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
            },
        )
        .master(f"local[{cpus}]")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    seconds = {}
    for name in HEADLINE:
        times = []
        # The first run also pays for class loading and code generation.
        for _ in range(2):
            begin = time.perf_counter()
            REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
