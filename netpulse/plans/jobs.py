"""End-to-end jobs composed from the operators.

* ``forecast_job``: hourly sums -> per-source fit -> forecast table.
* ``regression_job``: lag feature -> time split -> MLlib pipeline -> metrics.
* ``processor_run``: one batch cycle of the series store: snapshot, fit (the
  model is saved), forecast, merge into the earlier forecast, anomaly flags,
  history append, idempotent dump, then retention of the dumped metric - each
  output written to a new version path, retention only after the dump.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import sum_by_key_hour
from ..operators.forecast import DAILY_ORDER, anomaly_flags, fit, forecast, load_model, materialize, save_model
from ..operators.merge import append_new_only, forecast_merge, series_retain
from ..operators.ml import evaluate, fit_and_predict
from ..session import scratch_path
from ..sinks.files import write_history, write_table
from ..sources.series import write_series


def forecast_job(logs: DataFrame, metric: str = "unq_dst_ip", horizon: int = 8, roll_mode: str = "repredict",
                 seasonality: bool | str = "auto", training_date=None, order: int = DAILY_ORDER, ridge: float = 1.0,
                 trend: str = "auto", weekly_order: int = 0, clamp_min: float | None = None,
                 method: str = "moments") -> DataFrame:
    """Forecast table of every source for ``metric``.

    The trend may bend and the fit reads the hourly rows once (``method="moments"``, see
    ``operators.bends``); ``"sums"`` fits straight trends.  Empty input gives an empty
    table of the forecast schema (no error).
    """
    train = sum_by_key_hour(logs, metric)
    return forecast(train, horizon=horizon, roll_mode=roll_mode, seasonality=seasonality,
                    order=order, ridge=ridge, training_date=training_date, trend=trend,
                    weekly_order=weekly_order, clamp_min=clamp_min, method=method)


def regression_job(logs: DataFrame, cutoff: str, model_path: str | None = None, seed: int = 42,
                   max_iter: int = 20):
    model, pred = fit_and_predict(logs, cutoff, model_path, seed, max_iter)
    return model, pred, evaluate(pred)


def processor_run(spark: SparkSession, series: DataFrame, snapshot_end: str, metric: str = "unq_dst_ip",
                  prior_forecast: DataFrame | None = None, prior_dump: DataFrame | None = None,
                  training_date=None, root: str | None = None, history_path: str | None = None,
                  seasonality: bool | str = "auto") -> dict[str, str]:
    """One cycle over the long series table; returns the written paths.

    ``history_path`` is the history table that all cycles append to.  Only ``metric``
    is forecast and dumped, so only its samples are retained by age; the other
    metrics go to the new series version whole.
    """
    root = root or scratch_path(spark, "processor")
    end = F.lit(snapshot_end).cast("timestamp_ntz")
    snap = series.where((F.col("data_type") == metric) & (F.col("ds") <= end))
    train = materialize(snap.select("ip", "ds", F.col("value").alias("y")))
    paths = {"model": save_model(fit(train, seasonality), f"{root}/model", metric)}
    paths["history"] = write_history(train, history_path or f"{root}/history", metric)
    fc = forecast(train, training_date=training_date, model=load_model(spark, paths["model"], metric))
    if prior_forecast is not None:
        fc = forecast_merge(prior_forecast, fc)
    paths["forecast"] = write_table(fc, f"{root}/forecast", ["training_date"])  # by run, so that a merge reads one
    # observations outside the band, read back from the written forecast
    paths["anomalies"] = write_table(anomaly_flags(spark.read.parquet(paths["forecast"])), f"{root}/anomalies")
    dump = train.select("ip", F.unix_seconds(F.col("ds").cast("timestamp")).alias("ds"),
                        F.col("y").cast("bigint").alias(metric))
    if prior_dump is not None:
        dump = append_new_only(prior_dump, dump)
    paths["dump"] = write_table(dump, f"{root}/dump")
    # retention runs only after the dump above has been written
    paths["series"] = write_series(series_retain(series, end, [metric]), f"{root}/series")
    return paths


def stream_average_job(spark: SparkSession, checkpoint: str, *, source: str = "kafka", servers: str | None = None,
                       topic: str | None = None, path: str | None = None, out_topic: str | None = None,
                       out_table: str | None = None, trigger: dict | None = None,
                       state_partitions: int | None = None, metric: str = "unq_dst_ip"):
    """The streaming job: records -> decoded fields -> all-time mean per source,
    emitted in update mode (changed sources only) every trigger.

    With ``out_topic`` the changes go to Kafka as ``key`` (source) /
    ``value`` (mean as text) records; with ``out_table`` they are appended to a
    Parquet changelog keyed by micro-batch.  Returns the running query.
    """
    from ..sources.stream import RECORD_SCHEMA, read_log_stream
    from ..streaming.jobs import _start, changelog_kv, running_average, start_changelog

    trigger = trigger or {"processingTime": "10 minutes"}
    records = read_log_stream(spark, source, servers=servers, topic=topic, path=path, schema=RECORD_SCHEMA)
    agg = running_average(records, metric)
    if out_topic:
        w = (changelog_kv(agg).writeStream.format("kafka").outputMode("update")
             .option("kafka.bootstrap.servers", servers).option("topic", out_topic)
             .option("checkpointLocation", checkpoint).trigger(**trigger))
        return _start(w, spark, state_partitions)
    if not out_table:
        raise ValueError("give out_topic or out_table")
    return start_changelog(agg, out_table, checkpoint, trigger, state_partitions=state_partitions)
