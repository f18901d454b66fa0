"""Write docs/PLANS.md: the executed physical plans of the analyses and
ingest steps at sf0.01 (after AQE), so the shapes claimed in the README can
be read from Spark itself.

    python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from devicelens import fixtures as fx  # noqa: E402
from devicelens import registry as reg  # noqa: E402
from devicelens.operators import bucket_stats, device_type_stats, recent_data, recent_device  # noqa: E402
from devicelens.operators.dedup import hourly_distinct_readings  # noqa: E402
from devicelens.session import build_session  # noqa: E402
from devicelens.sources import parse_device_messages, read_hours  # noqa: E402
from devicelens.streaming import write_hourly_readings_batch  # noqa: E402


def executed(df) -> str:
    """Formatted plan of the query after it ran (AQE's final plan)."""
    df.collect()
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    ev = fx.event_readings(spark, sf_dir)
    scratch = tempfile.mkdtemp(prefix="devicelens-plans-")
    reg._messages(ev).write.json(f"{scratch}/messages")
    copies = ev.withColumn("ingest_ts", F.col("ts").cast("timestamp"))
    write_hourly_readings_batch(hourly_distinct_readings(copies, "ingest_ts"), f"{scratch}/hours")
    stored = read_hours(spark, f"{scratch}/hours", reg.E - 86_400_000, reg.E)
    # one device holding a third of all readings, mostly copies (the skew case)
    n = ev.count()
    hot = spark.range(n // 2).select(
        F.lit(7).cast("bigint").alias("tenant_id"), F.lit("click").alias("device_type"),
        F.lit("hot").alias("device_id"), (F.col("id") % 7).cast("double").alias("value"),
        F.lit(reg.E - 1000).alias("time_stamp"), F.timestamp_millis(F.lit(reg.E - 1000)).alias("ts"),
    )
    skewed = ev.unionByName(hot)
    cases = [
        ("bucket_stats: static bound, statistics broadcast in the same plan",
         lambda: bucket_stats(ev, reg.S, reg.E, reg.PARTS)),
        ("device_type_stats: measured statistics, broadcast",
         lambda: device_type_stats(ev, reg.S, reg.E)),
        ("device_type_stats: split strategy; no device is hot here, so one shuffled join",
         lambda: device_type_stats(ev, reg.S, reg.E, max_broadcast_rows=0)),
        ("device_type_stats: split strategy with a hot device (hot broadcast, cold anti-joined and shuffled)",
         lambda: device_type_stats(skewed, reg.S, reg.E, max_broadcast_rows=0)),
        ("recent_data over stored hours: partition pruning + pushdown",
         lambda: recent_data(stored, reg.E, 1)),
        ("recent_device: distinct devices in pass 1",
         lambda: recent_device(ev, reg.E, 7)),
        ("parse_device_messages: one typed parse per message",
         lambda: parse_device_messages(spark.read.schema("value string, ingest_ts timestamp")
                                       .json(f"{scratch}/messages"), keep=("ingest_ts",))),
        ("hourly_distinct_readings: copies combined map-side",
         lambda: hourly_distinct_readings(copies.unionByName(copies), "ingest_ts")),
    ]
    out = ["# Executed physical plans (sf0.01, local[8], after AQE)", "",
           "Generated by `scripts/show_plans.py`. Statistics frames that were materialized appear as",
           "`Scan ExistingRDD` (the checkpoint).", ""]
    for title, build in cases:
        out += [f"## {title}", "", "```", executed(build()).rstrip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
