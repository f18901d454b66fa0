"""Scaling check: the analyses over lineitem readings at 1x and at 10x.

The 10x input is the same readings repeated 10 times by Spark, each copy with
its own device ids (so the device groups grow with the data), written once as
Parquet to a fresh folder under the machine's temp dir (local runs only).

    python scripts/scale_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from devicelens import fixtures as fx  # noqa: E402
from devicelens import registry as reg  # noqa: E402
from devicelens.operators import bucket_stats, device_type_stats, recent_data, recent_device  # noqa: E402
from devicelens.session import build_session  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = build_session("local[8]")
    li = fx.lineitem_readings(spark, sf_dir)
    out = tempfile.mkdtemp(prefix="devicelens-scale-") + "/big"
    k = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("k")
    big = li.select("*", k).select(
        "tenant_id", "device_type", F.concat("device_id", F.lit("-"), F.col("k").cast("string")).alias("device_id"),
        "value", "time_stamp", "ts",
    )
    big.repartition(3 * copies).write.parquet(out)
    sources = [("1x", li), (f"{copies}x", spark.read.parquet(out))]
    cases = [
        ("bucket_stats", lambda s: bucket_stats(s, reg.LI_S, reg.LI_E, reg.LI_PARTS)),
        ("device_type_stats", lambda s: device_type_stats(s, reg.LI_S, reg.LI_E)),
        ("recent_data", lambda s: recent_data(s, reg.LI_E, 365)),
        ("recent_device", lambda s: recent_device(s, reg.LI_E, 365)),
    ]
    for label, src in sources:
        for name, build in cases:
            run(build(src))  # warm
            t0 = time.perf_counter()
            run(build(src))
            print(f"{label:>4} {name:20s} {time.perf_counter() - t0:6.2f} s")


if __name__ == "__main__":
    main()
