"""Time the headline queries; prints one JSON line.

Each query is planned and run in full, its rows going nowhere. One run warms up, the median of
the others counts; all of them are printed too. Of a query of over a minute, the first run counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from stocktrail.catalogue import QUERIES

#: Seconds after which one run is enough.
LONG = 60

HEADLINE = [
    "house_price_model",
    "user_counts_table",
    "inventory_per_day",
    "purchase_order_lines",
    "supplier_fill_history",
    "training_set",
    "trailing_fill_rate",
    "oldest_open_order_per_day",
    "run_table",
    "dataset_access_per_day",
    "all_that_a_part_is_made_from",
    "starts_paired_with_ends",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stocktrail-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, list[float]] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(round(time.perf_counter() - start, 3))
            if taken[0] > LONG:
                break
        times[name] = taken[1:] or taken
    medians = {name: round(statistics.median(t), 3) for name, t in times.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "runs": times,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
