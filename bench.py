"""Headline timings: prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced through a no-op sink (full execution, nothing
collected), once cold and three times warm; ``value`` is the total of the warm
medians and the cold times are reported beside it.  The four analyses run over
readings mapped from ``events`` and from the 6x larger ``lineitem``.  The ingest
entries read device messages (JSON lines, every reading 10 times) and comma text
(every reading 50 times) written once, before timing, from ``events`` into a fresh
scratch folder, as the reference reads topic records and text files; the hourly
de-duplication runs over two copies of every reading.
``stream_ingest_batch`` is one micro-batch of the streaming ingest (parse,
stateful hourly dedup, Parquet by hour) holding every message of ``events``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from devicelens import fixtures as fx  # noqa: E402
from devicelens import registry as reg  # noqa: E402
from devicelens.operators import bucket_stats, device_type_stats, recent_data, recent_device  # noqa: E402
from devicelens.operators.dedup import hourly_distinct_readings  # noqa: E402
from devicelens.operators.report import bucket_report, device_report  # noqa: E402
from devicelens.session import build_session  # noqa: E402
from devicelens.sources.messages import message_file_stream, message_records  # noqa: E402
from devicelens.streaming import run_ingest  # noqa: E402
from devicelens.sources import format_reading_lines, parse_device_messages, read_reading_lines  # noqa: E402


MESSAGE_COPIES, LINE_COPIES, WARM_RUNS = 10, 50, 3


def scale_factor(sf_dir: str):
    name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(name)
    except ValueError:
        return name


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app="devicelens-bench")
    ev = fx.event_readings(spark, sf_dir)
    li = fx.lineitem_readings(spark, sf_dir)
    ev_copies = ev.withColumn("ingest_ts", F.col("ts").cast("timestamp"))
    li_end = reg.LI_E
    scratch = tempfile.mkdtemp(prefix="devicelens-bench-")
    # Inputs as several part files, as topic partitions and the reference's text output are.
    times = lambda df, n: df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_copy")
    times(reg._messages(ev), MESSAGE_COPIES).repartition(cpus).write.json(f"{scratch}/messages")
    times(format_reading_lines(ev), LINE_COPIES).repartition(cpus).write.text(f"{scratch}/lines")
    messages = lambda: spark.read.schema("value string, ingest_ts timestamp").json(f"{scratch}/messages")
    # One micro-batch of the stream: every message arrives within the same 5 minutes.
    batch_ts = F.timestamp_millis(F.lit(reg.E + 60_000))
    reg._messages(ev).withColumn("ingest_ts", batch_ts).repartition(cpus).write.json(f"{scratch}/stream")
    runs = iter(range(1_000_000))

    def stream_batch():
        n = next(runs)
        records = message_records(message_file_stream(spark, f"{scratch}/stream"), "value", "ingest_ts")
        q = run_ingest(records, f"{scratch}/out{n}", f"{scratch}/ckpt{n}", trigger={"availableNow": True},
                       state_partitions=cpus)
        q.awaitTermination()
    cases = {
        "bucket_stats": lambda: bucket_stats(ev, reg.S, reg.E, reg.PARTS),
        "device_type_stats": lambda: device_type_stats(ev, reg.S, reg.E),
        "recent_data": lambda: recent_data(ev, reg.E, 1),
        "recent_device": lambda: recent_device(ev, reg.E, 7),
        "bucket_report": lambda: bucket_report(bucket_stats(ev, reg.S, reg.E, reg.PARTS)),
        "device_report": lambda: device_report(device_type_stats(ev, reg.S, reg.E)),
        "parse_device_messages": lambda: parse_device_messages(messages(), keep=("ingest_ts",)),
        "read_reading_lines": lambda: read_reading_lines(spark, f"{scratch}/lines"),
        "hourly_distinct_readings": lambda: hourly_distinct_readings(ev_copies.unionByName(ev_copies), "ingest_ts"),
        "bucket_stats_lineitem": lambda: bucket_stats(li, reg.LI_S, reg.LI_E, reg.LI_PARTS),
        "device_type_stats_lineitem": lambda: device_type_stats(li, reg.LI_S, reg.LI_E),
        # the path statistics too large to broadcast take: hot broadcast, cold shuffled
        "device_type_stats_lineitem_split": lambda: device_type_stats(li, reg.LI_S, reg.LI_E, max_broadcast_rows=0),
        "recent_data_lineitem": lambda: recent_data(li, li_end, 365),
        "recent_device_lineitem": lambda: recent_device(li, li_end, 365),
    }
    actions = {name: (lambda b=build: run(b())) for name, build in cases.items()}
    actions["stream_ingest_batch"] = stream_batch
    # Each query runs cold (first run: JIT, codegen, file listing) and then warm
    # (steady state, as in a long-running service), of which the median counts.
    def timed(act):
        t0 = time.perf_counter()
        act()
        return round(time.perf_counter() - t0, 3)

    cold, warm = {}, {}
    for name, act in actions.items():
        cold[name] = timed(act)
        warm[name] = median(timed(act) for _ in range(WARM_RUNS))
    print(json.dumps({"metric": "total_query_seconds_warm", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold_total": round(sum(cold.values()), 3), "cold_queries": cold,
                      "sf": scale_factor(sf_dir), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
