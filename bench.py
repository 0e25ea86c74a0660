"""Time the reports: one JSON line with the seconds per report.

Inputs are derived from the star-schema files and written once (`stage_sec`; `with_stage` adds it to the total); every
report and operator query is then run from the written tables and its whole result is produced, the best of three runs
(one for queries that store tables themselves).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelpay.plans.registry import REPORTS  # noqa: E402
from parcelpay.session import local_session  # noqa: E402
from parcelpay.sources.schemas import SCHEMAS  # noqa: E402
from parcelpay.sources.star import CHECKPOINT_KEY, star_tables  # noqa: E402

HEADLINE = [
    "weight_con_level", "shipment_con_level", "combined_con_level", "con_level_with_logs", "weight_detailed",
    "shipment_detailed", "combined_detailed", "combined_summary", "biker_con_level", "biker_detailed",
    "biker_summary", "vehicle_detailed", "vehicle_detailed_weight_hvdi", "vehicle_summary",
    "vehicle_summary_weight_hvdi", "hygiene_incentive_biker", "hygiene_incentive_vehicle", "sla_detailed",
    "sla_summary", "sla_vehicle_total", "sla_vehicle", "vendor_summary", "assignment_check",
]
#: All registered names; the total counts the reports alone, so that rounds compare.
OPERATORS = [name for name in REPORTS if name not in HEADLINE]
#: Queries that store tables before they read them run once.
STORING = [name for name in OPERATORS if name.endswith(("_refreshed", "_published", "_co_located"))]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE + OPERATORS
    spark = local_session(cores, "parcelpay-bench", shuffle_partitions=int(cores) if cores.isdigit() else 8)
    start = time.perf_counter()
    shared = spark.conf.get(CHECKPOINT_KEY, None) or tempfile.mkdtemp(prefix="parcelpay-bench-")
    tables = star_tables(spark, folder, shared)
    for name in SCHEMAS:
        tables[name]
    stage = time.perf_counter() - start

    seconds: dict[str, float] = {}
    for name in wanted:
        best = None
        for _ in range(1 if name in STORING else runs):
            start = time.perf_counter()
            REPORTS[name](tables).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "all_reports_seconds",
                "value": round(sum(t for n, t in seconds.items() if n in HEADLINE) or sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "stage_sec": round(stage, 3),
                "with_stage": round(stage + sum(seconds.values()), 3),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
