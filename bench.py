"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Each query runs twice to
a no-op sink and the faster run counts, so that code generation is not what is measured.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bindings.queries import QUERIES  # noqa: E402
from marketframe import get_spark  # noqa: E402

HEADLINE = (
    "snapshot_projection",
    "history_clean",
    "quality_gate",
    "quality_report",
    "latest_per_key",
    "price_anomalies",
    "large_moves",
    "missing_dates",
    "recent_gaps_top20",
    "pipeline_health",
    "fact_upsert",
    "fact_upsert_keep_nulls",
    "dim_upsert",
    "description_update",
    "constraint_violations",
    "backfill_selection",
    "daily_job",
    "backfill_job",
)


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {
        name: round(min(seconds(QUERIES[name], spark, sf_dir) for _ in range(2)), 3)
        for name in HEADLINE
    }
    spark.stop()
    result = {
        "metric": "total seconds of headline queries, faster of two runs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rpartition("sf")[2],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
