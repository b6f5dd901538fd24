"""Whole-job timings: the ten analyses as one config-driven job, by input format and caching.

Writes the sf crash tables once as CSV (upper-case headers, all strings, as
the crash files ship) and as Parquet into a fresh scratch folder, then times
``run_job`` for: CSV read directly, CSV staged once as Parquet, CSV with the
inputs persisted, and Parquet inputs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadlens.plans.job import run_job  # noqa: E402
from roadlens.session import build_session  # noqa: E402
from roadlens.sources.files import write_result  # noqa: E402
from roadlens.sources.fixtures import crash_tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    root = tempfile.mkdtemp(prefix="roadlens-jobbench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    spark = build_session(f"local[{cpus}]", app_name="roadlens-job-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "8g"})
    if not spark.sparkContext.getCheckpointDir():  # a cluster names its own shared folder
        spark.sparkContext.setCheckpointDir(f"{root}/checkpoints")
    inputs = {"csv": {}, "parquet": {}}
    for name, df in crash_tables(spark, sf_dir).as_dict().items():
        inputs["csv"][name] = f"{root}/csv/{name}"
        write_result(df.toDF(*[c.upper() for c in df.columns]), inputs["csv"][name])
        inputs["parquet"][name] = f"{root}/parquet/{name}"
        write_result(df, inputs["parquet"][name], fmt="parquet")
    variants = {
        "csv_direct": {"input_format": "csv", "stage": False},
        "csv_staged": {"input_format": "csv", "stage": True},
        "csv_persisted": {"input_format": "csv", "stage": False, "persist": True},
        "parquet": {"input_format": "parquet"},
        "parquet_parallel4": {"input_format": "parquet", "parallel": 4},
    }
    times = {}
    for label, extra in variants.items():
        runs = []
        for i in range(2):
            fmt = extra["input_format"]
            config = {"input_locations": inputs[fmt],
                      "output_locations": {f"output_{n}": f"{root}/out/{label}/{i}/{n}" for n in range(1, 11)},
                      **extra}
            t0 = time.perf_counter()
            run_job(spark, config)
            runs.append(time.perf_counter() - t0)
        times[label] = round(min(runs), 3)
    spark.stop()
    print(json.dumps({"metric": "ten-analysis job, best of 2", "unit": "sec", "jobs": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus}))


if __name__ == "__main__":
    main()
