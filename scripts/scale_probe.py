"""Scale probe: time key queries on N stacked copies of the sf0.1 events.

usage: python scripts/scale_probe.py N [N ...]
Copy k shifts event_id by k*10^7 and user_id by k*10^5 (new sources, same
timeline) and is written as 8 Parquet files, so scans run in parallel.  The
copies live in the checkpoint folder; only timings are printed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from netpulse.plans import queries as q  # noqa: E402
from netpulse.session import build_session, scratch_path  # noqa: E402

SRC = "/root/testdata/sf0.1"
PROBE = ["avg_by_key", "sum_by_key_hour", "first_write_wins", "lag_feature", "tail_n_per_key", "trend_fit",
         "series_collect", "series_explode", "forecast_table", "forecast_job", "forecast_merge", "stream_avg_by_key",
         "pseudonymize", "index_by_frequency"]


def stacked(spark, n: int) -> str:
    ev = spark.read.parquet(f"{SRC}/events.parquet")
    big = ev.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))).select(
        (F.col("event_id") + F.col("k") * 10_000_000).alias("event_id"), "ts",
        (F.col("user_id") + F.col("k") * 100_000).alias("user_id"), "event_type", "value", "props")
    out = scratch_path(spark, f"scale{n}")
    big.repartition(8).write.parquet(f"{out}/events.parquet")
    spark.read.parquet(f"{SRC}/customer.parquet").write.parquet(f"{out}/customer.parquet")
    return out


def main() -> None:
    mem = os.environ.get("PROBE_DRIVER_MEMORY", "16g")
    spark = build_session("local[8]", "netpulse-scale", shuffle_partitions=16,
                          extra={"spark.driver.memory": mem})
    res = {}
    for n in [int(a) for a in sys.argv[1:]] or [10]:
        d = stacked(spark, n)
        q.QUERIES["avg_by_key"](spark, d).write.format("noop").mode("overwrite").save()  # warm-up
        times = {}
        for name in (os.environ.get("PROBE_QUERIES", "").split(",") if os.environ.get("PROBE_QUERIES") else PROBE):
            t0 = time.perf_counter()
            q.QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 2)
            print(f"  {name}: {times[name]}", file=sys.stderr, flush=True)
        res[n] = times
        print(json.dumps({"copies": n, "events": 100_000 * n, "seconds": times}), flush=True)


if __name__ == "__main__":
    main()
