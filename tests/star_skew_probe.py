"""Star-table queries with one key holding a third of its table's rows: busiest task per query.

Usage: ``python tests/star_skew_probe.py <sf_dir> <scratch_dir> on|off``; prints one JSON line.

For each query one table is rewritten so that a third of its rows carry the
same key (moved rows, written as 8 Parquet files: AQE splits a skewed
partition along map-output blocks).  AQE's skew thresholds are lowered to
this data size (on large inputs the defaults, 256 MB and 5x the median, are
met by a hot key on their own); ``off`` disables the skew split, to compare.
"""

from __future__ import annotations

import glob
import json
import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadlens.plans.star import STAR  # noqa: E402
from roadlens.session import build_session  # noqa: E402

# query -> (table, columns set to one value on a third of its rows)
HOT = {
    "s_topk": ("lineitem", ["l_partkey"]),
    "s_entities": ("lineitem", ["l_partkey"]),
    "s_topn": ("lineitem", ["l_suppkey"]),
    "s_having": ("lineitem", ["l_orderkey"]),
    "s_except": ("lineitem", ["l_orderkey"]),
    "s_except@left": ("orders", ["o_orderkey"]),
    "s_first": ("events", ["user_id", "event_type"]),
    "s_semi": ("orders", ["o_custkey"]),
    "s_anti": ("orders", ["o_custkey"]),
    "s_band": ("customer", ["c_nationkey"]),
    "s_top1": ("orders", ["o_orderstatus", "o_orderpriority"]),
}


def main(argv: list[str]) -> None:
    sf_dir, scratch, mode = argv[0], argv[1], argv[2]
    spark = build_session("local[4]", app_name="roadlens-star-skew", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": scratch,
        "spark.eventLog.compress": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true" if mode == "on" else "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16384",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16384",
    })

    def raw(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    heated, hot_rows = {}, {}
    for table, cols in sorted(set((t, tuple(c)) for t, c in HOT.values())):
        df = raw(table)
        first = df.select(*cols).orderBy(*cols).first()
        selected = F.abs(F.hash(*df.columns)) % 3 == 0
        out = df.select(*[F.when(selected, F.lit(first[c])).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                          for c in df.columns])
        path = f"{scratch}/{table}-{'-'.join(cols)}"
        out.repartition(8).write.parquet(path)
        heated[(table, cols)] = spark.read.parquet(path)
        hot_rows[(table, cols)] = heated[(table, cols)].filter(
            F.expr(" AND ".join(f"`{c}` <=> {repr(first[c])}" for c in cols))).count()

    for key, (table, cols) in HOT.items():
        spark.sparkContext.setJobGroup(key, key)

        def tbl(name, table=table, cols=tuple(cols)):
            return heated[(table, cols)] if name == table else raw(name)

        STAR[key.split("@")[0]](tbl).write.format("noop").mode("overwrite").save()
    app = spark.sparkContext.applicationId
    spark.stop()
    stage_group, max_read = {}, {}
    for path in [f for f in glob.glob(f"{scratch}/**", recursive=True) if app in f and os.path.isfile(f)]:
        for line in open(path):
            ev = json.loads(line)
            if ev["Event"] == "SparkListenerJobStart":
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = ev.get("Properties", {}).get("spark.jobGroup.id")
            elif ev["Event"] == "SparkListenerTaskEnd":
                read = ((ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                group = stage_group.get(ev["Stage ID"])
                if group:
                    max_read[group] = max(max_read.get(group, 0), read)
    print(json.dumps({
        "skew_split": mode,
        "queries": {k: {"hot_table": t, "hot_rows": hot_rows[(t, tuple(c))], "max_task_shuffle_records": max_read.get(k, 0)}
                    for k, (t, c) in HOT.items()},
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
