"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables (``events`` through the log adapter,
``customer`` for the registry and allow-list) over their whole extent.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import series_key, series_labels
from ..functions.payload import decode_payload, tolerant_number, type_payload
from ..functions.timefmt import add_hours, from_epoch, run_stamp, to_epoch
from ..operators import aggregates as agg
from ..operators import bends
from ..operators import forecast as fc
from ..operators import joins, merge, ml, reshape, windows
from ..operators.per_key import SUMMARY_FOLD, SUMMARY_SCHEMA, per_key, per_key_fold, series_summary
from ..schema import FORECAST_SCHEMA, LOG_SCHEMA, LOG_STREAM_SCHEMA, METRICS, TIMESTAMP_FORMAT
from ..session import configure, scratch_path
from ..sinks import files as sinks
from ..sinks import history, keyed
from ..sources.files import read_json_documents, read_json_lines, read_typed_csv
from ..sources.series import range_scan, write_series
from ..sources.stream import RECORD_SCHEMA, read_log_stream
from ..sources.tables import (customer_allowlist, customer_registry, logs_from_events, payload_from_logs, read_logs,
                              table_path)
from ..streaming import jobs as sj
from ..streaming import stateful as sf
from .jobs import forecast_job, processor_run

# Fixed query parameters.
CUTOFF = "2024-01-20 00:00:00"          # old / new boundary (merge, dump, retention, history)
OLD_TRAINING_DATE = "2024-01-20"
NEW_TRAINING_DATE = "2024-01-31"
SPLIT_CUTOFF = "2024-01-23 00:00:00"    # train / test boundary of the regression
MAX_ONEHOT_KEYS = 32                    # keys with a place of their own in the bounded encoding
RANGE_START, RANGE_END = "2024-01-05 00:00:00", "2024-01-25 00:00:00"
SALT = "netpulse"
MALFORMED_EVERY = 50
HORIZON = 8
LONG_HORIZON = 24                       # more hours than a business day has
TAIL_N = 8

LOG_COLS = ["event_id", *[f.name for f in LOG_SCHEMA.fields]]


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return read_logs(spark, sf_dir)


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _train(spark, sf_dir, before: str | None = None) -> DataFrame:
    logs = _logs(spark, sf_dir)
    if before:
        logs = logs.where(F.col("timestamp") < _ts(before))
    return agg.sum_by_key_hour(logs)


def _series(spark, sf_dir) -> DataFrame:
    return reshape.to_series(_logs(spark, sf_dir))


def _pmap(spark, sf_dir) -> DataFrame:
    logs = _logs(spark, sf_dir)
    registered = joins.filter_allowlist(logs, customer_registry(spark, sf_dir))
    return joins.partition_map(registered)


def _trend_forecast(spark, sf_dir, before: str | None, training_date: str, roll_mode="repredict",
                    horizon: int = HORIZON) -> DataFrame:
    return fc.forecast(_train(spark, sf_dir, before), horizon=horizon, roll_mode=roll_mode,
                       seasonality=False, training_date=training_date)


def _train_of(spark, sf_dir, metric: str) -> DataFrame:
    return agg.sum_by_key_hour(_logs(spark, sf_dir), metric)


# ------------------------------------------------------------------ sources

def q_decode_json_payload(spark, sf_dir):
    records = payload_from_logs(_logs(spark, sf_dir), MALFORMED_EVERY)
    return decode_payload(records)


def q_avg_tolerant(spark, sf_dir):
    records = payload_from_logs(_logs(spark, sf_dir), MALFORMED_EVERY)
    decoded = decode_payload(records, fields=["src_ip", "unq_dst_ip"], keep=[])
    return agg.avg_by_key(decoded, "src_ip", tolerant_number("unq_dst_ip"))


def q_csv_typed_roundtrip(spark, sf_dir):
    schema = T.StructType([*LOG_SCHEMA.fields, T.StructField("event_id", T.LongType())])
    logs = _logs(spark, sf_dir).select(*schema.fieldNames())  # header order = schema order
    path = sinks.write_csv(logs, scratch_path(spark, "csv"))
    return read_typed_csv(spark, path, schema).select(*LOG_COLS)


def q_json_documents(spark, sf_dir):
    """Typed logs as pretty-printed documents over many lines, read back."""
    schema = T.StructType([*LOG_SCHEMA.fields, T.StructField("event_id", T.LongType())])
    path = sinks.write_json_documents(_logs(spark, sf_dir).select(*schema.fieldNames()), scratch_path(spark, "documents"))
    return read_json_documents(spark, path, schema).select(*LOG_COLS)


def q_rows_to_json(spark, sf_dir):
    logs = _logs(spark, sf_dir)
    wire = decode_payload(payload_from_logs(logs))  # key + string fields
    path = sinks.rows_to_json(wire, scratch_path(spark, "json"))
    back = read_json_lines(spark, path, T.StructType([T.StructField("key", T.StringType()), *LOG_STREAM_SCHEMA.fields]))
    typed = type_payload(back)
    return typed.select(F.col("key").cast("bigint").alias("event_id"), *[f.name for f in LOG_SCHEMA.fields])


def q_series_range(spark, sf_dir):
    path = write_series(_series(spark, sf_dir), scratch_path(spark, "series"))
    return range_scan(spark, path, "unq_dst_ip", RANGE_START, RANGE_END)


# ------------------------------------------------------------------ sinks

def q_append_new_only(spark, sf_dir):
    # only the dumped metric is built, so the scan reads only its columns
    s = reshape.to_series(_logs(spark, sf_dir), metrics=["unq_dst_ip"])
    dump = s.select("ip", F.unix_seconds(F.col("ds").cast("timestamp")).alias("ds"),
                    F.col("value").cast("bigint").alias("unq_dst_ip"))
    existing = dump.where(F.col("ds") < F.unix_seconds(_ts(CUTOFF).cast("timestamp")))
    return merge.append_new_only(existing, dump)


def q_history_append(spark, sf_dir):
    train = _train(spark, sf_dir)
    old = train.where(F.col("ds") < _ts(CUTOFF))
    new = train.where(F.col("ds") >= _ts(CUTOFF)).select("y", "ds", "ip")
    path = sinks.write_history(old, scratch_path(spark, "history"), "unq_dst_ip")
    sinks.write_history(new, path, "unq_dst_ip")
    return spark.read.parquet(path).select("ip", "ds", "y")


def q_history_cycle(spark, sf_dir):
    """Three runs append their days; the table of another metric beside it stays apart."""
    path = scratch_path(spark, "history")
    train = _train(spark, sf_dir)
    for lo, hi in ((None, RANGE_START), (RANGE_START, CUTOFF), (CUTOFF, None)):
        part = train if lo is None else train.where(F.col("ds") >= _ts(lo))
        sinks.write_history(part if hi is None else part.where(F.col("ds") < _ts(hi)), path, "unq_dst_ip")
    sinks.write_history(_train_of(spark, sf_dir, "bytesin"), path, "bytesin")
    return spark.read.parquet(path).where("data_type = 'unq_dst_ip'").select("ip", "ds", "y")


def q_history_compacted(spark, sf_dir):
    """Three runs append their days to the history, which is then packed into files of a target size."""
    root = scratch_path(spark, "history")
    train = _train(spark, sf_dir)
    for lo, hi in ((None, RANGE_START), (RANGE_START, CUTOFF), (CUTOFF, None)):
        part = train if lo is None else train.where(F.col("ds") >= _ts(lo))
        history.append(part if hi is None else part.where(F.col("ds") < _ts(hi)), root, "unq_dst_ip")
    history.append(_train_of(spark, sf_dir, "bytesin"), root, "bytesin")
    history.compact(spark, root)
    history.expire(spark, root)
    return history.read(spark, root, "unq_dst_ip").select("ip", "ds", "y")


def _processor(spark, sf_dir) -> dict[str, str]:
    return processor_run(spark, _series(spark, sf_dir), CUTOFF, training_date=OLD_TRAINING_DATE, seasonality=False)


def q_processor_retained(spark, sf_dir):
    """What a cycle dumped together with what it retained: every sample of every metric."""
    paths = _processor(spark, sf_dir)
    dump = spark.read.parquet(paths["dump"]).select(
        "ip", F.lit("unq_dst_ip").alias("data_type"), F.timestamp_seconds("ds").cast("timestamp_ntz").alias("ds"),
        F.col("unq_dst_ip").cast("double").alias("value"))
    return dump.unionByName(spark.read.parquet(paths["series"]).select("ip", "data_type", "ds", "value"))


def q_series_range_after_retention(spark, sf_dir):
    """Range scans of the store a cycle left: the dumped metric from the cutoff, another one whole."""
    path = _processor(spark, sf_dir)["series"]
    return range_scan(spark, path, "unq_dst_ip", RANGE_START, RANGE_END) \
        .unionByName(range_scan(spark, path, "bytesin", RANGE_START, RANGE_END))


def q_route_to_partition(spark, sf_dir):
    routed = joins.route_to_partition(_logs(spark, sf_dir), _pmap(spark, sf_dir))
    return routed.select("event_id", "src_ip", "partition")


def q_unrouted_rows(spark, sf_dir):
    return joins.unrouted_rows(_logs(spark, sf_dir), _pmap(spark, sf_dir)).select("event_id", "src_ip")


def q_series_retain(spark, sf_dir):
    return merge.series_retain(_series(spark, sf_dir), CUTOFF).select("ip", "data_type", "ds", "value")


# ------------------------------------------------------------------ projections / scalar

def q_filter_allowlist(spark, sf_dir):
    kept = joins.filter_allowlist(_logs(spark, sf_dir), customer_allowlist(spark, sf_dir))
    return kept.select("event_id", "src_ip", "unq_dst_ip")


def q_pseudonymize(spark, sf_dir):
    logs = _logs(spark, sf_dir).select("event_id", "src_ip")
    mapping = joins.pseudonym_map(logs, "src_ip", SALT)
    return joins.replace_keys(logs, mapping, "src_ip", "pseudo")


def q_series_key(spark, sf_dir):
    keys = reshape.unpivot_metrics(_logs(spark, sf_dir)).select(F.col("src_ip").alias("ip"), "data_type").distinct()
    labelled = keys.select(series_key("data_type", "ip").alias("series_key"),
                           series_labels("data_type", "ip").alias("labels"))
    return labelled.select("series_key", F.col("labels")["srcIP"].alias("label_srcIP"),
                           F.col("labels")["dataType"].alias("label_dataType"))


def q_unpivot_metrics(spark, sf_dir):
    return reshape.unpivot_metrics(_logs(spark, sf_dir))


def q_series_collect(spark, sf_dir):
    nested = reshape.series_collect_wide(reshape.hourly_samples(_logs(spark, sf_dir)))
    return nested.select("ip", "data_type", "chunk_start",
                         F.size("samples").cast("bigint").alias("n_samples"),
                         F.col("samples")[0]["ds"].alias("first_ds"),
                         F.element_at("samples", -1)["value"].alias("last_value"))


def q_series_explode(spark, sf_dir):
    return reshape.series_explode(reshape.series_collect_wide(reshape.hourly_samples(_logs(spark, sf_dir))))


def q_to_epoch(spark, sf_dir):
    text = F.date_format("timestamp", TIMESTAMP_FORMAT)
    return _logs(spark, sf_dir).select("event_id", text.alias("ts_text"), to_epoch(text).alias("epoch"))


def q_from_epoch(spark, sf_dir):
    e = to_epoch(F.date_format("timestamp", TIMESTAMP_FORMAT))
    return _logs(spark, sf_dir).select("event_id", from_epoch(e).alias("ds"))


def q_add_hours(spark, sf_dir):
    return _logs(spark, sf_dir).select("event_id", add_hours("timestamp", HORIZON).alias("ds"))


def q_run_stamp(spark, sf_dir):
    return _logs(spark, sf_dir).select("event_id", run_stamp("timestamp").alias("stamp"))


def q_future_grid(spark, sf_dir):
    return reshape.future_grid(_train(spark, sf_dir), HORIZON)


def q_business_hours_roll(spark, sf_dir):
    grid = reshape.grid_with_history(_train(spark, sf_dir), HORIZON).where(F.col("is_future")) \
        .withColumn("base_ds", F.col("ds"))
    rolled = fc.business_hours_roll(grid, "ip", HORIZON)
    return rolled.select("ip", "base_ds", "ds", F.hour("ds").alias("hour"))


# ------------------------------------------------------------------ aggregates

def q_avg_by_key(spark, sf_dir):
    return agg.avg_by_key(_logs(spark, sf_dir))


def q_sum_by_key_hour(spark, sf_dir):
    return _train(spark, sf_dir).orderBy("ip", "ds")


def q_distinct_keys(spark, sf_dir):
    return agg.distinct_keys(_logs(spark, sf_dir))


def q_forecast_count_by_key(spark, sf_dir):
    return agg.count_by_key(_trend_forecast(spark, sf_dir, None, NEW_TRAINING_DATE))


def q_regression_metrics(spark, sf_dir):
    # one row per source and hour: a plain window per source is bounded by the time grid
    lagged = _train(spark, sf_dir).withColumn("y_prev", F.lag("y").over(Window.partitionBy("ip").orderBy("ds")))
    return agg.regression_metrics(lagged, "y", "y_prev", by="ip")


def q_trend_fit(spark, sf_dir):
    return fc.trend_params(fc.trend_stats(fc.materialize(_train(spark, sf_dir))))


def q_trend_fit_bytesout(spark, sf_dir):
    """The fit on sums of billions, to six significant places of each value."""
    fitted = fc.trend_params(fc.trend_stats(fc.materialize(_train_of(spark, sf_dir, "bytesout"))))
    return fitted.select("ip", "n", F.round("mean_t", 6).alias("mean_t"), F.round("mean_y", 3).alias("mean_y"),
                         F.round("ols_slope", 3).alias("ols_slope"), "trend_kept", F.round("sigma", 2).alias("sigma"), "status")


def q_seasonal_sums(spark, sf_dir):
    """Normal equations of two daily harmonics on the trend's ratio, rounded to 6 places."""
    train = fc.materialize(_train(spark, sf_dir))
    sums = fc.seasonal_sums(train, fc.trend_params(fc.trend_stats(train)), order=2)
    return sums.select("ip", "nr", *[F.round(c, 6).alias(c) for c in sums.columns if c not in ("ip", "nr")])


def q_seasonal_index(spark, sf_dir):
    return fc.seasonal_index(_train(spark, sf_dir))


# ------------------------------------------------------------------ windows / ordering

def q_lag_feature(spark, sf_dir):
    logs = _logs(spark, sf_dir).select("event_id", "src_ip", "timestamp", "unq_dst_ip")
    return ml.add_lag_feature(logs)


def q_tail_n_per_key(spark, sf_dir):
    return windows.tail_n_per_key(_train(spark, sf_dir), "ip", ["ds"], TAIL_N)


def q_first_write_wins(spark, sf_dir):
    return _series(spark, sf_dir)


def q_partition_ordinal(spark, sf_dir):
    return _pmap(spark, sf_dir)


def q_preview_top50(spark, sf_dir):
    logs = _logs(spark, sf_dir).select("event_id", "src_ip", "timestamp", "unq_dst_ip")
    return windows.preview_top(logs, ["src_ip", "timestamp", "event_id"], 50)


def q_registered_only(spark, sf_dir):
    return joins.registered_only(_series(spark, sf_dir), customer_registry(spark, sf_dir)) \
        .select("ip", "data_type", "ds", "value")


# ------------------------------------------------------------------ forecast

def q_forecast_table(spark, sf_dir):
    return _trend_forecast(spark, sf_dir, None, NEW_TRAINING_DATE)


def q_forecast_relabel(spark, sf_dir):
    """Parity roll: values of the plain next hours under business-hour labels."""
    return _trend_forecast(spark, sf_dir, None, NEW_TRAINING_DATE, roll_mode="relabel")


def q_forecast_long_horizon(spark, sf_dir):
    """A day ahead: the business hours of the next mornings."""
    return _trend_forecast(spark, sf_dir, None, NEW_TRAINING_DATE, horizon=LONG_HORIZON)


def q_forecast_from_stored_model(spark, sf_dir):
    """Fit, save, load, predict: the same rows as a forecast in one go."""
    train = fc.materialize(_train(spark, sf_dir))
    path = fc.save_model(fc.fit(train, seasonality=False), scratch_path(spark, "model"), "unq_dst_ip")
    return fc.forecast(train, HORIZON, training_date=NEW_TRAINING_DATE, model=fc.load_model(spark, path, "unq_dst_ip"))


def q_forecast_seasonal_fixed(spark, sf_dir):
    """Trend times daily harmonics from a stored parameter table, on the whole grid, rounded to 6 places."""
    train = _train(spark, sf_dir)
    k = F.col("ip").cast("bigint")
    beta = [((k % (i + 3)) - 1) / F.lit(10.0 * (i + 1)) for i in range(2 * fc.DAILY_ORDER)]
    model = train.select("ip").distinct().select(
        "ip", F.lit(float(fc.ORIGIN_HOUR)).alias("mean_t"), (50 + k % 7).cast("double").alias("mean_y"),
        ((k % 5) / F.lit(100.0)).alias("slope"), (1 + k % 3).cast("double").alias("sigma"),
        *[b.alias(f"beta_{i}") for i, b in enumerate(beta)], F.lit("ok").alias("status"))
    grid = fc.business_hours_roll(reshape.grid_with_history(train, HORIZON), "ip", HORIZON)
    out = fc.predict(grid, model)
    return out.select("ip", "ds", "y", *[F.round(c, 6).alias(c) for c in ("yhat", "yhat_upper", "yhat_lower")])


def q_forecast_moments(spark, sf_dir):
    """Moments of the one-pass fit with one daily harmonic, per source and day, rounded to 6 places."""
    moments = bends.segment_moments(_train(spark, sf_dir), order=1)
    exact = ("ip", "segment", "first_t", "last_t")
    return moments.select(*exact, *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in moments.columns if c not in exact])


def q_forecast_changepoint_fixed(spark, sf_dir):
    """A trend with two bends times a daily harmonic from a stored parameter table; the band widens from day 25 on."""
    train = _train(spark, sf_dir)
    k = F.col("ip").cast("bigint")
    origin = float(fc.ORIGIN_HOUR)
    model = train.select("ip").distinct().select(
        "ip", F.lit(origin).alias("mean_t"), (50 + k % 7).cast("double").alias("mean_y"),
        ((k % 5) / F.lit(100.0)).alias("slope"), (1 + k % 3).cast("double").alias("sigma"),
        F.array(origin + 24 * (5 + k % 4), origin + 24 * (15 + k % 5)).alias("cp_t"),
        F.array((k % 3 - 1) / F.lit(20.0), (k % 4 - 2) / F.lit(25.0)).alias("cp_delta"),
        F.lit(25 / 744.0).alias("bend_rate"), ((k % 6) / F.lit(200.0)).alias("bend_scale"), F.lit(origin + 600).alias("last_t"),
        ((k % 4) / F.lit(20.0)).alias("beta_0"), ((k % 3) / F.lit(-10.0)).alias("beta_1"), F.lit("ok").alias("status"))
    grid = fc.business_hours_roll(reshape.grid_with_history(train, HORIZON), "ip", HORIZON)
    out = fc.predict(grid, model, order=1)
    return out.select("ip", "ds", "y", *[F.round(c, 6).alias(c) for c in ("yhat", "yhat_upper", "yhat_lower")])


def q_forecast_job_seasonal(spark, sf_dir):
    """The whole job on a metric with a daily rhythm, so that sources keep seasonal terms."""
    logs = _logs(spark, sf_dir)
    rhythm = 1 + 0.5 * F.sin(F.lit(2 * math.pi / 24) * F.hour("timestamp"))
    return forecast_job(logs.withColumn("unq_dst_ip", 1000 * rhythm + F.col("unq_dst_ip")), training_date=NEW_TRAINING_DATE)


def q_forecast_pending(spark, sf_dir):
    return merge.forecast_pending(_trend_forecast(spark, sf_dir, None, NEW_TRAINING_DATE))


def q_forecast_merge(spark, sf_dir):
    old = _trend_forecast(spark, sf_dir, CUTOFF, OLD_TRAINING_DATE)
    new = _trend_forecast(spark, sf_dir, None, NEW_TRAINING_DATE)
    return merge.forecast_merge(old, new)


def q_forecast_merge_rerun(spark, sf_dir):
    """The same run merged twice leaves the table as after once."""
    old = _trend_forecast(spark, sf_dir, CUTOFF, OLD_TRAINING_DATE)
    new = _trend_forecast(spark, sf_dir, None, NEW_TRAINING_DATE)
    once = fc.materialize(merge.forecast_merge(old, new))
    return merge.forecast_merge(once, new)


def q_forecast_csv_merge(spark, sf_dir):
    """The earlier forecast comes from a CSV file with a header."""
    old = _trend_forecast(spark, sf_dir, CUTOFF, OLD_TRAINING_DATE).select(*FORECAST_SCHEMA.fieldNames())
    path = sinks.write_csv(old, scratch_path(spark, "forecast_csv"))
    new = _trend_forecast(spark, sf_dir, None, NEW_TRAINING_DATE)
    return merge.forecast_merge(read_typed_csv(spark, path, FORECAST_SCHEMA), new)


def q_anomaly_flags_bytesout(spark, sf_dir):
    """Flags on sums of billions; distances rounded to hundredths."""
    table = fc.forecast(_train_of(spark, sf_dir, "bytesout"), seasonality=False, training_date=NEW_TRAINING_DATE)
    return fc.anomaly_flags(table).select("ip", "ds", "y", "side", F.round("excess", 2).alias("excess"))


def q_anomaly_flags(spark, sf_dir):
    return fc.anomaly_flags(_trend_forecast(spark, sf_dir, None, NEW_TRAINING_DATE))


def q_forecast_job(spark, sf_dir):
    return forecast_job(_logs(spark, sf_dir), training_date=NEW_TRAINING_DATE)


def q_per_key_apply(spark, sf_dir):
    return per_key(_train(spark, sf_dir), ["ip"], series_summary, SUMMARY_SCHEMA)


def q_per_key_fold(spark, sf_dir):
    """The same summaries folded where the rows are: only states meet per source."""
    return per_key_fold(_train(spark, sf_dir), ["ip"], SUMMARY_FOLD, SUMMARY_SCHEMA)


# ------------------------------------------------------------------ MLlib

def q_index_by_frequency(spark, sf_dir):
    return ml.index_by_frequency(_logs(spark, sf_dir), "src_ip")


def q_complete_feature_rows(spark, sf_dir):
    kept = ml.complete_feature_rows(ml.add_lag_feature(_logs(spark, sf_dir)))
    return agg.count_by_key(kept, "src_ip", "n_rows")


def q_gbt_predict(spark, sf_dir):
    _, pred = ml.fit_and_predict(_logs(spark, sf_dir), SPLIT_CUTOFF, max_iter=20)
    return pred.select("event_id", "src_ip", "unq_dst_ip", "prediction")


def q_encoded_features(spark, sf_dir):
    """Complete feature rows with the position of the key in its one-hot vector."""
    lagged = ml.add_lag_feature(_logs(spark, sf_dir))
    index = ml.fit_key_index(lagged)
    rows = ml.encode_key(ml.complete_feature_rows(lagged), index, index.count())
    return rows.select("event_id", "src_ip", "ip_num", "prev_unq_dst_ip")


def q_encoded_features_bounded(spark, sf_dir):
    """As ``encoded_features``, with places for the most frequent keys only; all others share the next one."""
    lagged = ml.add_lag_feature(_logs(spark, sf_dir))
    index, n_keys = ml.bound_key_index(ml.fit_key_index(lagged), MAX_ONEHOT_KEYS)
    rows = ml.encode_key(ml.complete_feature_rows(lagged), index, n_keys)
    return rows.select("event_id", "src_ip", "ip_num", "prev_unq_dst_ip")


def q_stable_split(spark, sf_dir):
    return _logs(spark, sf_dir).select("event_id", ml.split_label("timestamp", SPLIT_CUTOFF).alias("split"))


# ------------------------------------------------------------------ streaming

def _log_stream(spark, sf_dir) -> DataFrame:
    """The events table itself as a file stream of typed logs, on a session of its own."""
    path = table_path(sf_dir, "events")
    schema = spark.read.parquet(path).schema
    # as a glob, since a plain path would have to be a folder and the table may be one file
    stream = read_log_stream(sj.stream_session(spark), "parquet", path=f"{path[:-1]}[{path[-1]}]", schema=schema)
    return logs_from_events(stream)


def _record_stream(spark, sf_dir) -> DataFrame:
    return payload_from_logs(_log_stream(spark, sf_dir))


def _run_changelog(spark, agg_stream: DataFrame) -> DataFrame:
    table = scratch_path(spark, "changelog")
    sj.await_done(sj.start_changelog(agg_stream, table, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(table)


def q_stream_avg_by_key(spark, sf_dir):
    _logs(spark, sf_dir)
    return sj.latest_by_key(_run_changelog(spark, sj.running_average_typed(_log_stream(spark, sf_dir))))


def q_stream_latest_by_key(spark, sf_dir):
    _logs(spark, sf_dir)
    return sj.latest_by_key(_run_changelog(spark, sj.running_average(_record_stream(spark, sf_dir))))


def q_stream_changelog_kv(spark, sf_dir):
    return sj.changelog_kv(q_stream_latest_by_key(spark, sf_dir))


def q_stream_restart_avg(spark, sf_dir):
    """Half of the log arrives, the query ends; the rest arrives, the query goes on from its checkpoint."""
    logs = _logs(spark, sf_dir)
    folder, table, checkpoint = (scratch_path(spark, x) for x in ("arrived", "changelog", "checkpoint"))
    for part in (F.col("timestamp") < _ts(CUTOFF), F.col("timestamp") >= _ts(CUTOFF)):
        logs.where(part).write.mode("append").parquet(folder)
        stream = read_log_stream(sj.stream_session(spark), "parquet", path=folder, schema=logs.schema)
        sj.await_done(sj.start_changelog(sj.running_average_typed(stream), table, checkpoint))
    latest = sj.compact_changelog(spark, table, scratch_path(spark, "compacted"))
    return spark.read.parquet(latest).drop("batch_id")


def q_stream_route_to_partition(spark, sf_dir):
    """Records routed as they arrive: stream-static join with the partition map."""
    pmap = _pmap(spark, sf_dir)
    out = scratch_path(spark, "routed")
    routed = sj.route_records(_record_stream(spark, sf_dir), pmap)
    sj.await_done(sj.run_to_files(routed, out, scratch_path(spark, "checkpoint")))
    return spark.read.parquet(out).select(F.col("record_key").cast("bigint").alias("event_id"), "src_ip", "partition")


def q_stream_dedup(spark, sf_dir):
    """Every record twice, the copies in two triggers with the late half last; each comes out once."""
    logs = _logs(spark, sf_dir).select("event_id", "src_ip", "timestamp", "unq_dst_ip")
    folder, out, checkpoint = (scratch_path(spark, x) for x in ("arrived", "dedup", "checkpoint"))
    late = F.col("timestamp") < _ts(CUTOFF)
    for part in (logs.where(~late), logs):
        part.write.mode("append").parquet(folder)
        stream = read_log_stream(sj.stream_session(spark), "parquet", path=folder, schema=logs.schema)
        sj.await_done(sj.run_to_files(sj.drop_repeats(stream), out, checkpoint))
    return spark.read.schema(logs.schema).parquet(out)


def _arriving(spark, logs: DataFrame, parts: list, query: Callable[[DataFrame, int], None]) -> None:
    """The rows of each part arrive in a folder; a stream over the folder runs until it has read them."""
    folder = scratch_path(spark, "arrived")
    for at, part in enumerate(parts):
        part.select(*logs.columns).write.mode("append").parquet(folder)
        query(read_log_stream(sj.stream_session(spark), "parquet", path=folder, schema=logs.schema), at)


def q_stream_lag_feature(spark, sf_dir):
    """The lag feature on a stream that is stopped and restarted; a last record of no source lets the rest pass."""
    logs = _logs(spark, sf_dir).select("event_id", "src_ip", "timestamp", "unq_dst_ip")
    closing = spark.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit(None).cast("string").alias("src_ip"),
                                    _ts("2100-01-01 00:00:00").alias("timestamp"), F.lit(None).cast("int").alias("unq_dst_ip"))
    early = F.col("timestamp") < _ts(CUTOFF)
    out, checkpoint = scratch_path(spark, "lagged"), scratch_path(spark, "checkpoint")
    _arriving(spark, logs, [logs.where(early), logs.where(~early).unionByName(closing)],
              lambda stream, at: sj.await_done(sj.run_to_files(sf.lag_stream(stream), out, checkpoint)))
    return spark.read.schema(T.StructType([*logs.schema.fields, T.StructField("prev_unq_dst_ip", logs.schema["unq_dst_ip"].dataType)])) \
        .parquet(out).where(F.col("event_id") != -1)


def q_stream_first_write_wins(spark, sf_dir):
    """Every record arrives twice, the late half of the log first; one sample per source and hour comes out."""
    logs = _logs(spark, sf_dir)
    late = F.col("timestamp") < _ts(CUTOFF)
    out, checkpoint = scratch_path(spark, "first"), scratch_path(spark, "checkpoint")
    _arriving(spark, logs, [logs.where(~late), logs],
              lambda stream, at: sj.await_done(sj.run_to_files(sf.first_write_stream(stream), out, checkpoint)))
    samples = spark.read.parquet(out)
    return samples.unpivot(["ip", "ds", "arrival"], METRICS, "data_type", "value").select("ip", "data_type", "ds", "value", "arrival")


def q_stream_upsert_latest(spark, sf_dir):
    """The running average kept as a table of current values, through a restart and an expired history."""
    logs = _logs(spark, sf_dir)
    root, checkpoint = scratch_path(spark, "current"), scratch_path(spark, "checkpoint")
    early = F.col("timestamp") < _ts(CUTOFF)
    _arriving(spark, logs, [logs.where(early), logs.where(~early)],
              lambda stream, at: sj.await_done(keyed.start_upsert(sj.running_average_typed(stream), root, checkpoint, "src_ip")))
    keyed.expire(spark, root)
    return keyed.read_current(spark, root)


def q_filter_allowlist_bloom(spark, sf_dir):
    """The allow-list as a list too long to broadcast: a Bloom filter first, then a shuffle join of what passes."""
    kept = joins.filter_allowlist(_logs(spark, sf_dir), customer_allowlist(spark, sf_dir), max_rows=0)
    return kept.select("event_id", "src_ip", "unq_dst_ip")


def q_stream_state_audit(spark, sf_dir):
    """The means of a stopped stream, read from the state it left."""
    _logs(spark, sf_dir)
    checkpoint = scratch_path(spark, "checkpoint")
    sj.await_done(sj.start_changelog(sj.running_average_typed(_log_stream(spark, sf_dir)), scratch_path(spark, "changelog"), checkpoint))
    return sf.read_state(spark, checkpoint).select("src_ip", (F.col("total") / F.col("n")).alias("avg_unq_dst_ip"))


def q_stream_rekeyed_avg(spark, sf_dir):
    """Half of the log through 4 state partitions, the rest through 16 of a new query that starts from their sums."""
    logs = _logs(spark, sf_dir)
    table, first, second = scratch_path(spark, "changelog"), scratch_path(spark, "checkpoint"), scratch_path(spark, "checkpoint")
    early = F.col("timestamp") < _ts(CUTOFF)
    for at, part in enumerate((logs.where(early), logs.where(~early))):
        folder = scratch_path(spark, "arrived")
        part.write.parquet(folder)
        stream = read_log_stream(sj.stream_session(spark), "parquet", path=folder, schema=logs.schema)
        if at:
            agg_stream = sf.running_average_from(stream, sf.read_state(stream.sparkSession, first))
            sj.await_done(sj.start_changelog(agg_stream, f"{table}/after", second, state_partitions=16))
        else:
            sj.await_done(sj.start_changelog(sj.running_average_typed(stream), f"{table}/before", first, state_partitions=4))
    # batches of the second query come after those of the first
    later = spark.read.parquet(f"{table}/after").withColumn("batch_id", F.col("batch_id") + (1 << 40))
    return sj.latest_by_key(spark.read.parquet(f"{table}/before").unionByName(later))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
