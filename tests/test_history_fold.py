"""History in versions with compaction, and the per-key hooks for groups of any size."""

import datetime as dt
import random

import pandas as pd
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netpulse.operators.per_key import SUMMARY_FOLD, SUMMARY_SCHEMA, Fold, per_key_batches, per_key_fold
from netpulse.session import scratch_path
from netpulse.sinks import history

ROW = "ip string, ds timestamp_ntz, y double"
DAY = dt.datetime(2024, 1, 1)


def rows_of(run, days=3, n=40):
    rnd = random.Random(run)
    return [(rnd.choice("abc"), DAY + dt.timedelta(days=rnd.randrange(days), minutes=rnd.randrange(1440)), float(run)) for _ in range(n)]


def test_twenty_appends_become_one_file_a_day(spark):
    root, every = scratch_path(spark, "history"), []
    for run in range(20):
        every += rows_of(run)
        history.append(spark.createDataFrame(rows_of(run), ROW), root, "m")
    history.append(spark.createDataFrame(rows_of(99, days=1), ROW), root, "other")
    before = history.files(spark, root)
    old_reader = history.read(spark, root, "m")
    assert history.compact(spark, root) == 21
    after = history.files(spark, root)
    assert len([f for f in before if f["data_type"] == "m"]) >= 60
    assert sorted((f["data_type"], f["day"]) for f in after) == [("m", f"2024-01-0{d}") for d in (1, 2, 3)] + [("other", "2024-01-01")]
    want = sorted(every)
    assert sorted((r.ip, r.ds, r.y) for r in history.read(spark, root, "m").collect()) == want
    assert sorted((r.ip, r.ds, r.y) for r in old_reader.collect()) == want  # its version is still there
    assert sorted((r.ip, r.ds, r.y) for r in history.read(spark, root, "m", version=20).collect()) == want
    assert history.compact(spark, root) is None
    assert history.expire(spark, root) >= 60 and history.versions(spark, root) == [21]
    assert sorted((r.ip, r.ds, r.y) for r in history.read(spark, root, "m").collect()) == want
    one_day = history.read(spark, root, "m", "2024-01-02", "2024-01-02")
    assert len(one_day.inputFiles()) == 1 and one_day.count() == sum(r[1].day == 2 for r in every)
    path = [f["path"] for f in history.files(spark, root) if f["data_type"] == "m"][0]
    held = [(r.ip, r.ds) for r in spark.read.schema(history.ROWS).parquet(path).collect()]
    assert held == sorted(held)


def test_target_size_bounds_a_file(spark):
    root = scratch_path(spark, "history")
    for run in range(8):
        history.append(spark.createDataFrame(rows_of(run, days=1, n=200), ROW), root, "m")
    before = [f["bytes"] for f in history.files(spark, root)]
    target = 3 * max(before)
    history.compact(spark, root, target)
    after = history.files(spark, root)
    assert len(after) <= -(-sum(before) // target) + 1 and history.read(spark, root).count() == 1600


def test_a_lost_writer_leaves_the_table(spark, monkeypatch):
    root = scratch_path(spark, "history")
    for run in range(3):
        history.append(spark.createDataFrame(rows_of(run), ROW), root, "m")
    with monkeypatch.context() as m:
        m.setattr(history, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            history.compact(spark, root)
        except RuntimeError:
            pass
    assert history.read(spark, root).count() == 120 and history.compact(spark, root) == 3
    assert history.read(spark, root).count() == 120 and history.read(spark, root, "none").count() == 0


@given(st.lists(st.integers(1, 100), max_size=60), st.integers(50, 150))
def test_bins_hold_every_file_once(sizes, target):
    bins = history.pack_files(sizes, target)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    loads = [sum(sizes[i] for i in b) for b in bins]
    assert all(load <= target or len(b) == 1 for load, b in zip(loads, bins, strict=True))
    assert sum(2 * load <= target for load in loads) <= 1  # two bins at most half full would have been one


# ---------------------------------------------------------------- per-key hooks

def test_batches_of_a_large_group_stay_small(spark):
    rows = spark.range(400_000).select(F.when(F.col("id") % 100 == 0, F.lit("small")).otherwise(F.lit("hot")).alias("k"), "id")

    def total(key, batches):
        n = largest = s = 0
        for pdf in batches:
            n, largest, s = n + len(pdf), max(largest, len(pdf)), s + int(pdf["id"].sum())
        yield pd.DataFrame({"k": [key[0]], "n": [n], "largest": [largest], "s": [s]})

    got = {r.k: r for r in per_key_batches(rows, ["k"], total, "k string, n long, largest long, s long").collect()}
    assert got["hot"].n == 396_000 and got["hot"].largest <= 10_000 and got["small"].n == 4_000
    assert got["hot"].s + got["small"].s == 400_000 * 399_999 // 2


def test_fold_equals_the_aggregate(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), DAY + dt.timedelta(hours=rnd.randrange(99)), rnd.choice([None, 1.5, 2.0, float(rnd.randrange(50))])) for _ in range(900)]
    train = spark.createDataFrame(rows, ROW).repartition(7)
    got = per_key_fold(train, ["ip"], SUMMARY_FOLD, SUMMARY_SCHEMA)
    want = train.groupBy("ip").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y_sum"), F.max("y").alias("y_max"),
                                   F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert per_key_fold(train.limit(0), ["ip"], SUMMARY_FOLD, SUMMARY_SCHEMA).count() == 0


def test_only_states_of_a_hot_key_meet(spark):
    """A million rows of one key: one state per input partition reaches the task that merges them."""
    fold = Fold(start=lambda: [0, 1], add=lambda s, pdf: [s[0] + len(pdf), s[1]], merge=lambda a, b: [a[0] + b[0], a[1] + b[1]],
                finish=lambda key, s: pd.DataFrame({"k": [key[0]], "rows": [s[0]], "states": [s[1]]}))
    rows = spark.range(0, 1_000_000, 1, 9).select(F.lit(7).cast("long").alias("k"), "id")
    assert [tuple(r) for r in per_key_fold(rows, ["k"], fold, "k long, rows long, states long").collect()] == [(7, 1_000_000, 9)]


def test_rows_of_rare_keys_are_added_together(spark):
    """Of 3,000 keys with 4 rows each, one add per key, not one per row; frequent keys are folded where they are."""
    fold = Fold(start=lambda: [0, 0, 0], add=lambda s, pdf: [s[0] + len(pdf), s[1] + 1, s[2] + int(pdf["id"].sum())],
                merge=lambda a, b: [x + y for x, y in zip(a, b)],
                finish=lambda key, s: pd.DataFrame({"k": pd.Series([key[0]], dtype=object), "rows": [s[0]], "adds": [s[1]], "s": [s[2]]}))
    big = 1 << 60  # a whole number that a fraction cannot hold
    rows = spark.range(0, 12_000, 1, 4).select((F.col("id") + big).alias("id"), F.when(F.col("id") % 3000 != 7, F.col("id") % 3000).alias("k"))
    rows = rows.unionByName(spark.range(0, 50_000, 1, 2).select("id", F.lit(9).cast("long").alias("k")))
    got = {r.k: r for r in per_key_fold(rows, ["k"], fold, "k long, rows long, adds long, s long").collect()}
    want = {r.k: r for r in rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("id") % big).alias("s")).collect()}
    assert {k: r.rows for k, r in got.items()} == {k: r.n for k, r in want.items()} and len(got) == 3000
    assert sum(r.adds for r in got.values()) < 3000 + 200  # 12,000 and more with an add per row of a rare key
    assert all((r.s - r.rows * big if k != 9 else r.s - 4 * big) == want[k].s for k, r in got.items())
