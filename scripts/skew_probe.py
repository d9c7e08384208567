"""Skew probe: one source holds a third of all events.

usage: python scripts/skew_probe.py [copies]
Builds `copies` stacked copies of the sf0.1 events (as scale_probe.py), then a
skewed variant where every third event belongs to one source, and times key
queries on both.  Also reports the largest window partition of the lag: by
source alone, by (source, day), and with the adaptive buckets.
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

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from scale_probe import stacked  # noqa: E402

PROBE = ["avg_by_key", "sum_by_key_hour", "first_write_wins", "lag_feature", "tail_n_per_key", "series_collect",
         "forecast_job", "pseudonymize", "stream_avg_by_key"]


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    spark = build_session("local[8]", "netpulse-skew", shuffle_partitions=16,
                          extra={"spark.driver.memory": "16g"})
    base = stacked(spark, n)
    skew = scratch_path(spark, f"skew{n}")
    ev = spark.read.parquet(f"{base}/events.parquet")
    ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id"))) \
        .repartition(8).write.parquet(f"{skew}/events.parquet")
    spark.read.parquet(f"{base}/customer.parquet").write.parquet(f"{skew}/customer.parquet")
    out = {}
    for label, d in [("uniform", base), ("skewed", skew)]:
        q.QUERIES["avg_by_key"](spark, d).write.format("noop").mode("overwrite").save()
        times = {}
        for name in PROBE:
            t0 = time.perf_counter()
            q.QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 2)
        out[label] = times
        print(json.dumps({label: times}), flush=True)
    logs = q._logs(spark, skew)
    day = F.floor(F.unix_seconds(F.col("timestamp").cast("timestamp")) / 86400)
    by_key = logs.groupBy("src_ip").count().agg(F.max("count")).first()[0]
    by_day = logs.groupBy("src_ip", day).count().agg(F.max("count")).first()[0]
    minute = F.floor(F.unix_seconds(F.col("timestamp").cast("timestamp")) / 60)
    by_min = logs.groupBy("src_ip", minute).count().agg(F.max("count")).first()[0]
    print(json.dumps({"largest_window_partition": {"by_source": by_key, "by_source_day": by_day,
                                                   "by_source_minute": by_min}}), flush=True)


if __name__ == "__main__":
    main()
