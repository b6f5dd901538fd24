"""Run crash queries on tables where one crash holds a third of all rows; report per-task shuffle reads.

Usage: ``python tests/skew_probe.py [--hot=copies|distinct|null] <sf_dir> <scratch_dir> key [key ...]``; prints one
JSON line.  ``copies`` (default): one crash holds a third of the rows; ``distinct``: likewise, with a unit
number and a zip code of its own for every row; ``null``: a third of the rows have a NULL crash_id.

Broadcast joins and partition coalescing are switched off so every key join is a shuffle join, the
shape the plans have when the key lists are far too large to broadcast.  The
hot crash is made of copies of one real crash's rows.  Spark's event log,
written to the scratch folder, gives the records each task read from shuffles.
"""

from __future__ import annotations

import glob
import json
import math
import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadlens.plans.analyses import ANALYSES  # noqa: E402
from roadlens.plans.variants import VARIANTS  # noqa: E402
from roadlens.session import build_session  # noqa: E402
from roadlens.sources.fixtures import crash_tables  # noqa: E402


def with_hot_crash(spark, tables, folder: str, share: float = 1 / 3, files: int = 8, distinct: bool = False):
    """Tables where one crash (present in persons, units and charges) holds ``share`` of the rows.

    Written to Parquet (``files`` files each) and read back, so the scans hold
    the hot rows as stored data and the optimizer cannot move joins below the
    step that made the copies.
    """
    hot_id = (tables.units.filter("crash_id IS NOT NULL").select("crash_id")
              .join(tables.charges.select("crash_id"), "crash_id", "left_semi")
              .join(tables.primary_person.select("crash_id"), "crash_id", "left_semi")
              .orderBy("crash_id").first()[0])

    def heat(name, df):
        if name != "damages":
            total = df.count()
            hot = df.filter(F.col("crash_id") == hot_id)
            copies = math.ceil(share * total / (1 - share) / max(hot.count(), 1))
            more = hot.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
            if distinct:
                more = more.withColumn("unit_nbr", F.concat("unit_nbr", F.lit("-"), F.col("_copy").cast("string")))
                if "drvr_zip" in df.columns:  # and a zip code of its own
                    more = more.withColumn("drvr_zip", F.concat(F.lit("z"), "_copy", "unit_nbr"))
            df = df.unionAll(more.drop("_copy"))
        path = f"{folder}/{name}"
        df.repartition(files).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return tables.map(heat)


def with_null_crash(spark, tables, folder: str, files: int = 8):
    """A third of the persons, units and charges rows lose their crash_id (NULL keys hash to one partition)."""
    def heat(name, df):
        if name != "damages":
            cols = [F.when(F.abs(F.hash(*df.columns)) % 3 == 0, F.lit(None).cast("string")).otherwise(F.col(c))
                    .alias(c) if c == "crash_id" else F.col(c) for c in df.columns]
            df = df.select(*cols)
        path = f"{folder}/{name}"
        df.repartition(files).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return tables.map(heat)


def main(argv: list[str]) -> None:
    mode = "copies"
    if argv and argv[0].startswith("--hot="):
        mode = argv.pop(0).split("=", 1)[1]
    sf_dir, scratch, keys = argv[0], argv[1], argv[2:]
    spark = build_session("local[4]", app_name="roadlens-skew", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": scratch,
        "spark.eventLog.compress": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "false",
        # keep the 16 hash partitions as they are, so one task's share shows the key spread
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
    fns = {**ANALYSES, **VARIANTS}
    if mode == "null":
        tables = with_null_crash(spark, crash_tables(spark, sf_dir), f"{scratch}/tables")
    else:
        tables = with_hot_crash(spark, crash_tables(spark, sf_dir), f"{scratch}/tables", distinct=mode == "distinct")
    sizes = {name: df.count() for name, df in tables.as_dict().items()}
    for key in keys:
        spark.sparkContext.setJobGroup(key, key)
        fns[key](tables).write.format("noop").mode("overwrite").save()
    app = spark.sparkContext.applicationId
    spark.stop()
    log = [f for f in glob.glob(f"{scratch}/**", recursive=True) if app in f and os.path.isfile(f)]
    stage_group, max_read = {}, {}
    for path in log:
        for line in open(path):
            ev = json.loads(line)
            if ev["Event"] == "SparkListenerJobStart":
                group = ev.get("Properties", {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif ev["Event"] == "SparkListenerTaskEnd":
                metrics = ev.get("Task Metrics") or {}
                read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                group = stage_group.get(ev["Stage ID"])
                if group:
                    max_read[group] = max(max_read.get(group, 0), read)
    print(json.dumps({"hot": mode, "sizes": sizes, "hot_share": 1 / 3, "max_task_shuffle_records": max_read}))


if __name__ == "__main__":
    main(sys.argv[1:])
