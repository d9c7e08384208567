"""Sources, the MLlib path and plan properties."""

import json
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from netpulse.plans.queries import QUERIES
from netpulse.functions.payload import decode_payload, tolerant_number
from netpulse.operators import ml
from netpulse.schema import LOG_STREAM_SCHEMA
from netpulse.session import scratch_path
from netpulse.sinks import files as sinks
from netpulse.sources.files import read_json_documents, read_typed_csv
from netpulse.sources.stream import read_log_stream
from netpulse.sources.tables import payload_from_logs, read_logs

from conftest import SF_MID, SF_SMALL
from helpers import plan_text


def test_json_documents_one_per_file_pretty_printed(spark):
    logs = read_logs(spark, SF_SMALL).orderBy("event_id").limit(20)
    wire = decode_payload(payload_from_logs(logs)).drop("key").collect()
    folder = scratch_path(spark, "docs").replace("file:", "")
    os.makedirs(folder)
    for i, row in enumerate(wire):
        doc = row.asDict()
        with open(f"{folder}/{i}.json", "w") as f:
            f.write(json.dumps(doc, indent=2) if i % 4 == 0 else json.dumps(doc))
    docs = read_json_documents(spark, folder, LOG_STREAM_SCHEMA)
    assert docs.count() == 20
    assert docs.where("src_ip IS NULL").count() == 0
    per_line = read_json_documents(spark, folder, LOG_STREAM_SCHEMA, multiline=False)
    assert per_line.count() > 20  # pretty-printed documents break into many bad lines


def test_csv_uses_24_hour_clock(spark):
    folder = scratch_path(spark, "csv").replace("file:", "")
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w") as f:
        f.write("src_ip,unq_dst_ip,allow,drop,frequency,pkts_sent,pkts_received,bytesin,bytesout,unq_dst_port,"
                "timestamp\n")
        f.write("1.2.3.4,3,17,0,17,133,114,18543,68942,2,2022-01-03 13:00:00\n")
        f.write("1.2.3.4,3,17,0,17,133,114,18543,3000000000,2,2022-01-03 12:00:00\n")
    rows = read_typed_csv(spark, folder).orderBy("timestamp").collect()
    assert [r.timestamp.hour for r in rows] == [12, 13]
    assert rows[0].bytesout == 3_000_000_000  # beyond int range


def test_bad_number_text_is_null_not_failure(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "v string")
    assert [r.d for r in df.select(tolerant_number("v").alias("d")).collect()] == [12.0, None, None]


def test_unknown_stream_source(spark):
    with pytest.raises(ValueError):
        read_log_stream(spark, "socket", path="/nowhere")


def test_kafka_source_needs_connector(spark):
    try:
        read_log_stream(spark, "kafka", servers="localhost:1", topic="t")
    except Exception as e:  # noqa: BLE001 - the connector jar is not in this image
        assert "kafka" in str(e).lower()


def test_index_by_frequency_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    logs = read_logs(spark, SF_MID)
    labels = StringIndexer(inputCol="src_ip", outputCol="i").fit(logs).labelsArray[0]
    got = [r.src_ip for r in ml.index_by_frequency(logs, "src_ip").orderBy("index").collect()]
    assert got == list(labels)


def test_key_encoding_matches_string_indexer_one_hot(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    logs = read_logs(spark, SF_MID)
    train = logs.where("timestamp < TIMESTAMP_NTZ'2024-01-15 00:00:00'")
    test = logs.where("timestamp >= TIMESTAMP_NTZ'2024-01-15 00:00:00'").unionByName(
        logs.limit(5).withColumn("src_ip", F.lit("never-seen")))
    ref = Pipeline(stages=[StringIndexer(inputCol="src_ip", outputCol="ip_num", handleInvalid="keep"),
                           OneHotEncoder(inputCol="ip_num", outputCol="v")]).fit(train).transform(test)
    index = ml.fit_key_index(train)
    n = index.count()
    enc = OneHotEncoder(inputCol="ip_num", outputCol="v", handleInvalid="keep").fit(ml.encode_key(train, index, n))
    ours = enc.transform(ml.encode_key(test, index, n))
    a = sorted((r.event_id, r.src_ip, tuple(r.v.toArray())) for r in ref.select("event_id", "src_ip", "v").collect())
    b = sorted((r.event_id, r.src_ip, tuple(r.v.toArray())) for r in ours.select("event_id", "src_ip", "v").collect())
    assert a == b


def test_pipeline_save_load_and_one_hot(spark):
    logs = read_logs(spark, SF_SMALL)
    path = scratch_path(spark, "model")
    model, pred = ml.fit_and_predict(logs, "2024-01-23 00:00:00", model_path=path, max_iter=3)
    loaded = ml.KeyedRegressionModel.load(spark, path)
    _, test = ml.time_split(ml.add_lag_feature(logs), "2024-01-23 00:00:00")
    a = sorted((r.event_id, r.prediction) for r in model.transform(test).collect())
    b = sorted((r.event_id, r.prediction) for r in loaded.transform(test).collect())
    assert a == b
    n_keys = logs.where("timestamp < TIMESTAMP_NTZ'2024-01-23 00:00:00'").select("src_ip").distinct().count()
    vec = pred.select("ip_vec").first().ip_vec
    assert vec.size == n_keys  # n keys + 1 unseen slot, last category dropped
    metrics = ml.evaluate(pred)
    assert metrics["rmse"] >= metrics["mae"] > 0


def test_assembler_skips_first_row_of_each_key(spark):
    logs = read_logs(spark, SF_SMALL)
    kept = ml.complete_feature_rows(ml.add_lag_feature(logs))
    assert kept.count() == logs.count() - logs.select("src_ip").distinct().count()


PY_OK = {"forecast_job", "forecast_job_seasonal", "per_key_apply", "per_key_fold"}


@pytest.fixture
def written_plans(monkeypatch):
    """Plans of every frame that a query writes or checkpoints, also inside a stream's batches."""
    from pyspark.sql import DataFrame, DataFrameWriter
    plans = []

    def noting(cls, name, frame):
        plain = getattr(cls, name)

        def wrapped(self, *args, **kw):
            plans.append(plan_text(frame(self)))
            return plain(self, *args, **kw)

        monkeypatch.setattr(cls, name, wrapped)

    import pyspark.sql.classic.dataframe as classic
    for name in ("parquet", "csv", "json"):
        noting(DataFrameWriter, name, lambda w: w._df)
    noting(classic.DataFrame, "checkpoint", lambda df: df)
    assert issubclass(classic.DataFrame, DataFrame)
    return plans


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"gbt_predict"}))
def test_no_row_at_a_time_python(spark, name, written_plans):
    for plan in [plan_text(QUERIES[name](spark, SF_SMALL)), *written_plans]:
        assert "BatchEvalPython" not in plan
        if name not in PY_OK:
            assert "ArrowEvalPython" not in plan and "MapInPandas" not in plan and "FlatMapGroupsInPandas" not in plan


def test_stream_plans_have_no_python(spark):
    from netpulse.plans import queries as q
    from netpulse.streaming import jobs as sj
    streams = [sj.running_average_typed(q._log_stream(spark, SF_SMALL)), sj.running_average(q._record_stream(spark, SF_SMALL)),
               sj.drop_repeats(q._log_stream(spark, SF_SMALL)), sj.route_records(q._record_stream(spark, SF_SMALL), q._pmap(spark, SF_SMALL))]
    for stream in streams:
        plan = plan_text(stream)
        assert "StreamingRelation" in plan or "StreamingExecutionRelation" in plan
        assert "Python" not in plan and "MapInPandas" not in plan


def test_size_check_gathers_no_rows_in_one_task(spark):
    from netpulse.operators import joins
    logs = read_logs(spark, SF_SMALL)
    plan = plan_text(joins.bounded_broadcast(logs.select("src_ip").distinct()))
    assert "SinglePartition" not in plan and "Limit" not in plan


def test_scan_prunes_columns(spark):
    plan = plan_text(entry.queries()["avg_by_key"](spark, SF_SMALL))
    assert "ReadSchema: struct<user_id:bigint,props:string>" in plan


def test_partition_pruning_on_series_range(spark):
    plan = plan_text(entry.queries()["series_range"](spark, SF_SMALL))
    part = [ln for ln in plan.splitlines() if "PartitionFilters" in ln][0]
    assert "data_type" in part and "unq_dst_ip" in part and "day" in part
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln][0]
    assert "ds" in pushed


def test_routing_broadcasts_bounded_map(spark):
    plan = plan_text(entry.queries()["route_to_partition"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_top_n_limits_before_shuffle(spark):
    plan = plan_text(entry.queries()["tail_n_per_key"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_quarantine_splits_malformed_records(spark):
    from netpulse.functions.payload import split_malformed
    logs = read_logs(spark, SF_SMALL)
    records = payload_from_logs(logs, malformed_every=50)
    good, bad = split_malformed(records)
    n_bad = logs.where("event_id % 50 = 0").count()
    assert bad.count() == n_bad and good.count() == logs.count() - n_bad
    assert good.where("src_ip IS NULL").count() == 0
    assert set(r.value for r in bad.collect()) == {"not json"}


def test_prior_forecast_csv_roundtrip(spark):
    from netpulse.operators.aggregates import sum_by_key_hour
    from netpulse.operators.forecast import forecast
    from netpulse.schema import FORECAST_SCHEMA
    from netpulse.sinks.files import write_csv
    fc = forecast(sum_by_key_hour(read_logs(spark, SF_SMALL)), seasonality=False, training_date="2024-01-31")
    path = write_csv(fc.select(*FORECAST_SCHEMA.fieldNames()), scratch_path(spark, "fc_csv"))
    back = read_typed_csv(spark, path, FORECAST_SCHEMA)
    assert back.count() == fc.count()
    assert back.where("y IS NULL").count() == fc.where("y IS NULL").count()
    a = sorted((r.ip, r.ds, r.training_date) for r in back.collect())
    b = sorted((r.ip, r.ds, r.training_date) for r in fc.collect())
    assert a == b


def test_hash_split_is_stable(spark):
    logs = read_logs(spark, SF_SMALL)
    a_train, a_test = ml.hash_split(logs, "event_id")
    b_train, b_test = ml.hash_split(logs.repartition(7), "event_id")
    ids = lambda df: sorted(r.event_id for r in df.select("event_id").collect())
    assert ids(a_train) == ids(b_train) and ids(a_test) == ids(b_test)
    n = logs.count()
    assert len(ids(a_train)) + len(ids(a_test)) == n and 0.65 < len(ids(a_train)) / n < 0.85


def test_index_key_encoding_has_fixed_width(spark):
    logs = read_logs(spark, SF_SMALL)
    model, pred = ml.fit_and_predict(logs, "2024-01-23 00:00:00", max_iter=3, key_encoding="index")
    assert pred.select("features").first().features.size == 1 + 1 + len(ml.NUMERIC_FEATURES)
    assert pred.count() > 0


def test_lag_deals_raw_rows_once(spark):
    """Without broadcasts, raw rows cross one exchange; every other one carries partial aggregates or bucket rows."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        logs = read_logs(spark, SF_SMALL).select("event_id", "src_ip", "timestamp", "unq_dst_ip")
        df = ml.add_lag_feature(logs)
        df.collect()  # the adaptive plan is final after execution
        plan = plan_text(df, "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = [ln.strip(" :+-") for ln in plan.split("== Initial Plan ==")[0].splitlines()]
    below = [lines[i + 1] for i, ln in enumerate(lines) if ln.startswith("Exchange hashpartitioning")]
    raw = [ln for ln in below if "Aggregate" not in ln and "_prev" not in ln and "_last" not in ln]
    assert len(raw) == 1, below


def test_json_documents_are_pretty_arrays_of_bounded_size(spark):
    rows = read_logs(spark, SF_SMALL).select("src_ip", F.date_trunc("second", "timestamp").cast("timestamp_ntz").alias("timestamp"),
                                             "unq_dst_ip", "event_id") \
        .withColumn("src_ip", F.when(F.col("event_id") % 5 != 0, F.concat("src_ip", F.lit('"\n[ü,'))))
    for df in (rows, rows.limit(0)):
        path = sinks.write_json_documents(df, scratch_path(spark, "docs"), docs_per_file=100)
        files = [f for f in os.listdir(path.replace("file:", "")) if f.startswith("part-")]
        assert len(files) == max(1, -(-df.count() // 100))
        for f in files:
            with open(f"{path.replace('file:', '')}/{f}") as text:
                assert len(json.loads(text.read() or "[]")) <= 120  # an empty plan writes an empty file
        back = read_json_documents(spark, path, rows.schema)
        assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_bounded_keys_share_a_place_and_lose_no_row(spark, tmp_path):
    logs = read_logs(spark, SF_SMALL)
    train, test = ml.time_split(ml.add_lag_feature(logs), "2024-01-23 00:00:00")
    index = ml.fit_key_index(train)
    n = index.count()
    assert n > 5 and ml.bound_key_index(index, n)[1] == ml.bound_key_index(index, None)[1] == n
    cut, places = ml.bound_key_index(index, 5)
    full = {r.event_id: r.ip_num for r in ml.encode_key(test, index, n).collect()}
    ours = {r.event_id: r.ip_num for r in ml.encode_key(test, cut, places).collect()}
    assert places == 5 == cut.count() and ours == {e: min(x, 5) for e, x in full.items()}
    path = f"file:{tmp_path}/model"
    model, pred = ml.fit_and_predict(logs, "2024-01-23 00:00:00", model_path=path, max_iter=3, max_keys=5)
    assert pred.select("features").first().features.size == 6 + 1 + len(ml.NUMERIC_FEATURES)
    assert pred.count() == test.dropna(subset=["prev_unq_dst_ip", *ml.NUMERIC_FEATURES]).count()
    again = {r.event_id: r.prediction for r in ml.KeyedRegressionModel.load(spark, path).transform(test).collect()}
    assert again == {r.event_id: r.prediction for r in pred.collect()}
    # keys that share the place and agree in all other features have equal predictions
    alike = pred.where("ip_num = 5").groupBy("features").agg(F.countDistinct("prediction").alias("n"))
    assert alike.where("n > 1").count() == 0


def test_trees_on_the_keys_that_win_are_those_of_the_whole_vector(spark, monkeypatch):
    """Sources with levels of their own, and one without any: the slice gives the predictions of all one-hot features."""
    rows = [(i, str(i % 40), f"2024-01-{1 + i // 40:02d} 00:00:00", (i * 7919 % 11) + 90 * (i % 40 in (3, 17)) + 40 * (i % 40 == 29))
            + tuple((i * p) % 101 for p in (3, 5, 7, 11, 13, 17, 19, 23)) for i in range(1200)]
    cols = ", ".join(f"{m} int" for m in ml.NUMERIC_FEATURES)
    logs = spark.createDataFrame(rows, f"event_id long, src_ip string, timestamp string, unq_dst_ip int, {cols}") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).repartition(3, "event_id")
    train, test = ml.time_split(ml.add_lag_feature(logs), "2024-01-23 00:00:00")
    index = ml.fit_key_index(train)
    train, test = ml.encode_key(train, index, 40), ml.encode_key(test, index, 40)
    calls, found = [], ml.missed_keys
    monkeypatch.setattr(ml, "missed_keys", lambda *a: calls.append(len(a[3])) or found(*a))
    whole = ml.fit_pipeline(ml.regression_pipeline(max_iter=4), train, whole_keys=40)
    assert not calls
    ours = ml.fit_pipeline(ml.regression_pipeline(max_iter=4), train, whole_keys=0)
    assert calls[0] == 1 + len(ml.NUMERIC_FEATURES) < calls[-1] <= 40 + calls[0]
    a = {r.event_id: r.prediction for r in whole.transform(test).collect()}
    b = {r.event_id: r.prediction for r in ours.transform(test).collect()}
    assert a.keys() == b.keys() and len(a) > 200 and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    assert any(n.get("feature", 40) < 40 for nodes in ml.tree_nodes(whole.stages[-1]) for n in nodes)  # keys do win


def test_many_sources_leave_the_trees_few_features(spark):
    """More sources than are given to the trees at once, none of which tells more than the numeric fields."""
    rows = [(i, str(i % 300), f"2024-01-{1 + i // 300:02d} 00:00:00", i % 5) + (i % 5,) * 8 for i in range(7500)]
    cols = ", ".join(f"{m} int" for m in ml.NUMERIC_FEATURES)
    logs = spark.createDataFrame(rows, f"event_id long, src_ip string, timestamp string, unq_dst_ip int, {cols}") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    model, pred = ml.fit_and_predict(logs, "2024-01-23 00:00:00", max_iter=2)
    assert model.pipeline.stages[-1].numFeatures == 1 + len(ml.NUMERIC_FEATURES)
    got = pred.select("ip_vec", "features", "unq_dst_ip", "prediction").collect()
    assert len(got) == 900 and {r.ip_vec.size for r in got} == {300} and {r.features.size for r in got} == {309}
    assert all(abs(r.unq_dst_ip - r.prediction) < 1e-9 for r in got)
