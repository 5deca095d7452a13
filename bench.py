"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
The derived day tables are written before the clock starts; that time is ``setup_sec``. Each
query runs BENCH_RUNS times (default 3) into Spark's noop sink, and its median counts.
"""

from __future__ import annotations

import atexit
import json
import os
import re
import shutil
import statistics
import tempfile
import time

from gridmargin.schemas import DATASETS
from gridmargin.session import get_session
from workload import layers
from workload.queries import queries


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    shared = tempfile.mkdtemp(prefix="bench-")
    atexit.register(shutil.rmtree, shared, ignore_errors=True)
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": shared,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    for table in ("region", "fuel"):
        layers.bulk(spark, sf_dir, table)
    for name in DATASETS:
        layers.curated(spark, sf_dir, name)
    layers.raw_tables(spark, sf_dir)
    layers.raw_tables(spark, sf_dir, trade=True)
    setup = time.perf_counter() - start

    seconds = {}
    for name, query in queries().items():
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    scale = re.search(r"sf([\d.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "cpus": int(cpus),
                "setup_sec": round(setup, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
