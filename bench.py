"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from turnstile import registry, session  # noqa: E402

HEADLINE = [
    "m01_int_sales_transactions",
    "m02_fact_ticket_sales",
    "i05_incremental_fact",
    "i03_incremental_staging",
    "i04_upsert",
    "i04_upsert_versioned_table",
    "j01_event_by_name",
    "j05_effective_commission",
    "j07_orphan_counts",
    "w01_latest_version",
    "q02_not_null",
    "q13_source_report",
    "i10_load_files",
    "r01_weekly_by_channel",
    "r02_february_comparison",
    "r05_popular_by_region",
    "r07_top_events",
    "r08_top_customers",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.session(
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    runs = registry.queries()
    spark.read.parquet(f"{folder}/nation.parquet").count()  # start the executors
    seconds, planning, cold = {}, {}, {}
    for name in chosen:
        # The first run compiles code and warms caches; the second one counts.
        for _ in range(2):
            start = time.perf_counter()
            df = runs[name](spark, folder)
            planned = time.perf_counter()
            # Runs the whole plan and throws the rows away.
            df.write.format("noop").mode("overwrite").save()
            done = time.perf_counter()
            cold.setdefault(name, round(done - start, 3))
        seconds[name], planning[name] = round(done - start, 3), round(planned - start, 3)
    line = {
        "metric": "headline queries, total wall time, second run of each",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "building": planning,
        "cold": cold,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
