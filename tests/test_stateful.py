"""Stream operators with state of their own: lag, first write wins, re-keyed averages."""

import datetime as dt
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netpulse.operators.ml import add_lag_feature
from netpulse.session import scratch_path
from netpulse.sources.stream import read_log_stream
from netpulse.streaming import jobs as sj
from netpulse.streaming import stateful as sf

DAY = dt.datetime(2024, 1, 1)
LOG = "event_id long, src_ip string, timestamp timestamp_ntz, unq_dst_ip int"


def arrive(spark, schema, portions, build, out=None, checkpoint=None, combine=False):
    """Each portion arrives as files; the query runs until it has read them, and is started anew for the next."""
    folder = scratch_path(spark, "arrived")
    out, checkpoint = out or scratch_path(spark, "out"), checkpoint or scratch_path(spark, "ckpt")
    for rows in portions:
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(folder)
        stream = read_log_stream(sj.stream_session(spark), "parquet", path=folder, schema=spark.read.parquet(folder).schema)
        sj.await_done(sj.run_to_files(build(stream), out, checkpoint, state_partitions=2))
    return spark.read.parquet(out)


def test_lag_of_rows_out_of_order_and_over_restarts(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice("abc"), DAY + dt.timedelta(minutes=rnd.randrange(600), microseconds=rnd.randrange(3) * 400),
             rnd.choice([None, 1, 2, 3])) for i in range(300)]
    rows.sort(key=lambda r: r[2].replace(microsecond=0) + dt.timedelta(minutes=rnd.randrange(-50, 50)))  # late by up to 100 minutes
    portions = [rows[:120], rows[120:121], rows[121:], [(-1, None, DAY + dt.timedelta(days=900), None)]]
    got = arrive(spark, LOG, portions, lambda s: sf.lag_stream(s, delay="100 minutes"))
    want = add_lag_feature(spark.createDataFrame(rows, LOG))
    assert sorted(map(str, got.where("event_id != -1").collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_rows_without_a_time_leave_at_once(spark):
    got = arrive(spark, LOG, [[(1, "a", None, 5), (2, "a", DAY, 6), (3, "a", DAY + dt.timedelta(hours=1), 7)], [(-1, None, DAY + dt.timedelta(days=9), None)]],
                 sf.lag_stream)
    assert sorted((r.event_id, r.prev_unq_dst_ip) for r in got.where("event_id != -1").collect()) == [(1, None), (2, None), (3, 6)]


@given(st.lists(st.integers(-20, 20)))
def test_cells_merge(cells):
    starts, ends, seen = [], [], set()
    for c in cells:
        assert sf.add_cells(starts, ends, [c]) == ([] if c in seen else [c])
        seen.add(c)
        held = {x for a, b in zip(starts, ends, strict=True) for x in range(a, b)}
        assert held == seen and all(a < b for a, b in zip(starts, ends, strict=True))
        assert all(b < a for b, a in zip(ends, starts[1:], strict=False))  # merged: never adjacent


def test_first_write_state_grows_with_gaps_not_records(spark):
    """Ten sources, 20 days of hours in any order, every record up to three times; one source misses two hours."""
    rnd = random.Random(2)
    rows, n = [], 0
    for s in range(10):
        for h in range(480):
            if not (s == 3 and h in (100, 300)):
                rows += [(f"s{s}", DAY + dt.timedelta(hours=h, minutes=rnd.randrange(60)), float(k)) for k in range(rnd.randrange(1, 4))]
    rnd.shuffle(rows)
    rows = [(i, *r) for i, r in enumerate(rows)]
    portions = [rows[i::4] for i in range(4)]
    portions = [sorted(p) for p in portions]
    checkpoint = scratch_path(spark, "ckpt")
    got = arrive(spark, "event_id long, src_ip string, timestamp timestamp_ntz, m double", portions,
                 lambda s: sf.first_write_stream(s, metrics=["m"]), checkpoint=checkpoint)
    assert got.count() == got.select("ip", "ds").distinct().count() == 10 * 480 - 2
    # the kept record is the smallest arrival of the portion that brought the cell first
    first = {}
    for p in portions:
        new = {}
        for i, s, t, m in p:
            new.setdefault((s, t.replace(minute=0)), (i, m))
        first = new | first
    assert {(r.ip, r.ds): (r.arrival, r.m) for r in got.collect()} == first
    state = spark.read.format("statestore").option("stateVarName", "seen").load(checkpoint)
    sizes = {r.ip: r.n for r in state.select("key.ip", F.size("value.starts").alias("n")).collect()}
    assert sizes == {f"s{s}": 3 if s == 3 else 1 for s in range(10)}


def test_average_goes_on_with_more_partitions(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([*"abcdefgh", None]), DAY, rnd.choice([None, 1, 5, 9])) for i in range(400)]
    first, second, table = scratch_path(spark, "ckpt"), scratch_path(spark, "ckpt"), scratch_path(spark, "changelog")
    folders = [scratch_path(spark, "arrived") for _ in range(2)]
    schema = spark.createDataFrame(rows[:1], LOG).schema

    def stream(i):
        return read_log_stream(sj.stream_session(spark), "parquet", path=folders[i], schema=schema)

    for i, part in enumerate((rows[:150], rows[150:])):
        spark.createDataFrame(part, LOG).write.parquet(folders[i])
    sj.await_done(sj.start_changelog(sj.running_average_typed(stream(0)), f"{table}/a", first, state_partitions=2))
    held = sf.read_state(spark, first)
    want = spark.createDataFrame(rows[:150], LOG).groupBy("src_ip").agg(F.sum("unq_dst_ip").cast("double").alias("total"), F.count("unq_dst_ip").alias("n"))
    assert sorted(map(str, held.select("src_ip", F.when(F.col("n") > 0, F.col("total")).alias("total"), "n").collect())) == sorted(map(str, want.collect()))
    for _ in range(2):  # the second start reads nothing new and keeps the state of its own checkpoint
        s = stream(1)
        sj.await_done(sj.start_changelog(sf.running_average_from(s, sf.read_state(s.sparkSession, first)), f"{table}/b", second, state_partitions=5))
    got = {r.src_ip: r.avg_unq_dst_ip for r in sj.latest_by_key(spark.read.parquet(f"{table}/b")).collect()}
    assert got == {r.src_ip: r.a for r in spark.createDataFrame(rows, LOG).groupBy("src_ip").agg(F.avg("unq_dst_ip").alias("a")).collect()}
    assert spark.read.format("state-metadata").load(second).first().numPartitions == 5
