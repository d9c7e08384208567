"""Composed jobs: one processor cycle, Kafka record projection."""

import json

from pyspark.sql import functions as F

from netpulse.operators.reshape import to_series
from netpulse.plans.jobs import processor_run
from netpulse.session import scratch_path
from netpulse.sinks.files import kafka_records
from netpulse.sources.tables import read_logs

from conftest import SF_SMALL


END = "2024-01-20 00:00:00"


def _before_end():
    return F.col("ds") <= F.lit(END).cast("timestamp_ntz")


def test_processor_cycle_is_idempotent_and_retains_after_dump(spark):
    series = to_series(read_logs(spark, SF_SMALL))
    history = scratch_path(spark, "history")
    first = processor_run(spark, series, END, training_date="2024-01-20", history_path=history)
    dump1 = spark.read.parquet(first["dump"])
    retained = spark.read.parquet(first["series"])
    # only the dumped metric loses samples, and those are all in the dump
    own = F.col("data_type") == "unq_dst_ip"
    assert retained.where(own & _before_end()).count() == 0
    assert dump1.count() == series.where(own & _before_end()).count()
    assert retained.where(~own).count() == series.where(~own).count()
    assert dump1.count() + retained.count() == series.count()
    # the same snapshot dumped again adds nothing
    again = processor_run(spark, series, END, prior_dump=dump1, training_date="2024-01-20")
    assert spark.read.parquet(again["dump"]).count() == 0
    # the next cycle over the retained series merges into the first forecast
    nxt = processor_run(spark, retained, "2024-02-01 00:00:00", history_path=history,
                        prior_forecast=spark.read.parquet(first["forecast"]), training_date="2024-01-31")
    fc = spark.read.parquet(nxt["forecast"])
    flags = spark.read.parquet(nxt["anomalies"])
    assert flags.where("side NOT IN ('high', 'low')").count() == 0
    assert flags.count() <= fc.where("y > yhat_upper OR y < yhat_lower").count()
    assert set(fc.select("training_date").distinct().toPandas()["training_date"].astype(str)) == \
        {"2024-01-20", "2024-01-31"}
    # both cycles appended their part of the history, and each saved its model
    assert spark.read.parquet(history).count() == series.where(own).count()
    assert spark.read.parquet(first["model"]).where("data_type = 'unq_dst_ip'").count() > 0


def test_dump_of_byte_counters_beyond_int(spark):
    import datetime as dt
    rows = [("a", "bytesout", dt.datetime(2024, 1, 1, h), 3.0e9 + h) for h in range(5)] + \
        [("a", "bytesin", dt.datetime(2024, 1, 1, h), 1.0) for h in range(5)]
    series = spark.createDataFrame(rows, "ip string, data_type string, ds timestamp_ntz, value double")
    paths = processor_run(spark, series, END, metric="bytesout")
    assert sorted(r.bytesout for r in spark.read.parquet(paths["dump"]).collect()) == [3_000_000_000 + h for h in range(5)]
    assert {r.data_type for r in spark.read.parquet(paths["series"]).collect()} == {"bytesin"}


def test_seasonal_job_differs_from_the_trend_and_fits_better(spark):
    import __spark_entry__ as entry
    seasonal = entry.queries()["forecast_job_seasonal"](spark, SF_SMALL)
    assert seasonal.columns == ["ds", "ip", "y", "yhat", "yhat_upper", "yhat_lower", "training_date"]
    spread = seasonal.where("y IS NOT NULL").selectExpr("stddev(y - yhat) AS rest", "stddev(y) AS whole").first()
    assert spread.rest < 0.7 * spread.whole


def test_kafka_records_carry_partition_and_json(spark):
    logs = read_logs(spark, SF_SMALL).select("event_id", "src_ip", "unq_dst_ip").withColumn("p", F.lit(2))
    recs = kafka_records(logs, "src_ip", "p")
    assert recs.columns == ["key", "value", "partition"]
    row = recs.first()
    doc = json.loads(row.value)
    assert set(doc) == {"event_id", "src_ip", "unq_dst_ip"} and row.partition == 2 and row.key == doc["src_ip"]


def test_stream_average_job_on_files(spark):
    from netpulse.operators.aggregates import avg_by_key
    from netpulse.plans.jobs import stream_average_job
    from netpulse.session import scratch_path
    from netpulse.streaming.jobs import await_done, latest_by_key
    from netpulse.sources.tables import payload_from_logs
    logs = read_logs(spark, SF_SMALL)
    folder = scratch_path(spark, "topic")
    payload_from_logs(logs).repartition(3).write.parquet(folder)
    table = scratch_path(spark, "out")
    q = stream_average_job(spark, scratch_path(spark, "ckpt"), source="parquet", path=folder, out_table=table,
                           trigger={"availableNow": True})
    await_done(q)
    got = {r.src_ip: r.avg_unq_dst_ip for r in latest_by_key(spark.read.parquet(table)).collect()}
    assert got == {r.src_ip: r.avg_unq_dst_ip for r in avg_by_key(logs).collect()}


def test_per_key_applies_to_every_group(spark):
    from netpulse.operators.per_key import SUMMARY_SCHEMA, per_key, series_summary
    from netpulse.operators.aggregates import sum_by_key_hour
    train = sum_by_key_hour(read_logs(spark, SF_SMALL))
    assert per_key(train, ["ip"], series_summary, SUMMARY_SCHEMA).count() == train.select("ip").distinct().count()
