"""Keys, ordinals, joins and windows against plain formulations."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from netpulse.functions.keys import dense_index
from netpulse.operators import joins, windows
from netpulse.sources.tables import customer_registry, read_logs

from conftest import SF_MID, SF_SMALL
from helpers import plan_text


def test_pseudonyms_are_a_bijection(spark):
    logs = read_logs(spark, SF_MID).select("event_id", "src_ip")
    m = joins.pseudonym_map(logs, "src_ip", "s")
    assert m.count() == m.select("pseudo").distinct().count() == logs.select("src_ip").distinct().count()
    out = joins.replace_keys(logs, m)
    assert out.count() == logs.count()
    assert all(len(p.split(".")) == 4 for (p,) in out.select("src_ip").distinct().collect())


def test_collisions_are_resolved(spark):
    # one octet: 256 codes for 150 keys forces collisions and re-salting rounds
    logs = read_logs(spark, SF_MID).select("src_ip")
    m = joins.pseudonym_map(logs, "src_ip", "s", max_rounds=200, octets=1)
    assert m.count() == m.select("pseudo").distinct().count() == 150


def test_missing_key_is_an_error(spark):
    logs = read_logs(spark, SF_SMALL).select("event_id", "src_ip")
    m = joins.pseudonym_map(logs, "src_ip", "s").limit(1)
    with pytest.raises(KeyError):
        joins.replace_keys(logs, m)


def test_dense_index_matches_row_number(spark):
    df = read_logs(spark, SF_MID).groupBy("src_ip").agg(F.count(F.lit(1)).alias("n")).repartition(5)
    got = dense_index(df, [F.col("n").desc(), F.col("src_ip")], "i")
    want = df.withColumn("i", F.row_number().over(Window.orderBy(F.col("n").desc(), "src_ip")) - 1)
    assert sorted(got.collect()) == sorted(want.select("src_ip", "n", "i").collect())
    assert [r.i for r in got.orderBy("i").collect()] == list(range(df.count()))


@pytest.mark.parametrize("bucket", [600, 3600, 86400])
def test_bucketed_lag_equals_plain_lag(spark, bucket):
    logs = read_logs(spark, SF_MID).select("event_id", "src_ip", "timestamp", "unq_dst_ip")
    got = windows.lag_by_key(logs, "src_ip", ["timestamp", "event_id"], "unq_dst_ip", "prev", bucket)
    w = Window.partitionBy("src_ip").orderBy("timestamp", "event_id")
    want = logs.withColumn("prev", F.lag("unq_dst_ip").over(w))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_first_write_wins_keeps_earliest(spark):
    df = spark.createDataFrame([("a", 1, 3, 10.0), ("a", 1, 1, 20.0), ("a", 2, 2, 30.0), ("b", 1, 5, 40.0)],
                               "ip string, ds int, arrival int, value double")
    got = sorted(windows.first_write_wins(df, ["ip", "ds"], "arrival").collect())
    assert [(r.ip, r.ds, r.value) for r in got] == [("a", 1, 20.0), ("a", 2, 30.0), ("b", 1, 40.0)]


def test_routing_splits_rows(spark):
    logs = read_logs(spark, SF_MID)
    reg = customer_registry(spark, SF_MID)
    pmap = joins.partition_map(joins.filter_allowlist(logs, reg))
    routed, unrouted = joins.route_to_partition(logs, pmap), joins.unrouted_rows(logs, pmap)
    assert routed.count() + unrouted.count() == logs.count()
    assert routed.join(unrouted, "event_id").count() == 0
    parts = sorted(r.partition for r in pmap.collect())
    assert parts == list(range(len(parts)))


def test_bounded_broadcast_respects_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = spark.range(10)
        hinted = spark.range(100).join(joins.bounded_broadcast(small, 100), "id")
        assert "BroadcastHashJoin" in plan_text(hinted)
        over = spark.range(100).join(joins.bounded_broadcast(small, 5), "id")
        assert "BroadcastHashJoin" not in plan_text(over)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_buckets_split_finer_and_stay_exact(spark):
    logs = read_logs(spark, SF_MID).select("event_id", "src_ip", "timestamp", "unq_dst_ip")
    # one source holds a third of all rows
    hot = logs.withColumn("src_ip", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("src_ip")))
    got = windows.lag_by_key(hot, "src_ip", ["timestamp", "event_id"], "unq_dst_ip", "prev",
                             bucket_seconds=86400, fine_seconds=600, max_bucket_rows=20)
    w = Window.partitionBy("src_ip").orderBy("timestamp", "event_id")
    want = hot.withColumn("prev", F.lag("unq_dst_ip").over(w))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hash_partition_map(spark):
    logs = read_logs(spark, SF_MID)
    m = joins.partition_map(logs, method="hash", num_partitions=7)
    parts = [r.partition for r in m.collect()]
    assert m.count() == 150 and set(parts) <= set(range(7)) and len(set(parts)) == 7


def test_lag_null_key_spans_buckets(spark):
    logs = read_logs(spark, SF_SMALL).select("event_id", "src_ip", "timestamp", "unq_dst_ip")
    nulls = logs.withColumn("src_ip", F.when(F.col("event_id") % 4 == 0, F.lit(None)).otherwise(F.col("src_ip")))
    got = windows.lag_by_key(nulls, "src_ip", ["timestamp", "event_id"], "unq_dst_ip", "prev")
    w = Window.partitionBy("src_ip").orderBy("timestamp", "event_id")
    want = nulls.withColumn("prev", F.lag("unq_dst_ip").over(w))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_wide_collect_equals_per_metric_collect(spark):
    from netpulse.operators import reshape
    logs = read_logs(spark, SF_SMALL)
    a = reshape.series_collect(reshape.to_series(logs))
    b = reshape.series_collect_wide(reshape.hourly_samples(logs))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
