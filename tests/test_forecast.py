"""Forecast rules: roll, merge, fit recovery, band, model store, edge cases."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netpulse.operators import forecast as fc
from netpulse.operators.merge import forecast_merge
from netpulse.plans.jobs import forecast_job
from netpulse.schema import FORECAST_SCHEMA
from netpulse.session import scratch_path
from netpulse.sources.tables import read_logs

from conftest import SF_SMALL

H = dt.timedelta(hours=1)


def business_slots(minute):
    """Every business hour of ten days in order: 08 to 18 o'clock at that minute."""
    return [(day, dt.time(hour, minute)) for day in range(10) for hour in range(8, 19)]


def expected_roll(future):
    """Rows up to the last business hour stay; the others take the business hours of the following days, in order."""
    stay = [d for d in future if all(e.hour <= 18 for e in future if e <= d)]
    moved = len(future) - len(stay)
    if not moved:
        return stay
    morning = future[len(stay)].date() + dt.timedelta(days=1)
    slots = business_slots(future[0].minute)[:moved]
    return stay + [dt.datetime.combine(morning + dt.timedelta(days=day), at) for day, at in slots]


GRID_SCHEMA = T.StructType([T.StructField("ip", T.StringType()), T.StructField("ds", T.TimestampNTZType()),
                            T.StructField("y", T.DoubleType()), T.StructField("is_future", T.BooleanType())])


def test_roll_golden(spark):
    base = dt.datetime(2022, 1, 7, 13, 0)
    rows = [("a", base, 1.0, False)] + [("a", base + k * H, None, True) for k in range(1, 9)]
    got = fc.business_hours_roll(spark.createDataFrame(rows, GRID_SCHEMA), "ip", 8)
    hours = [r.ds for r in got.where("is_future").orderBy("ds").collect()]
    assert [h.hour for h in hours] == [14, 15, 16, 17, 18, 8, 9, 10]
    assert [h.day for h in hours] == [7] * 5 + [8] * 3


def test_roll_closed_form_equals_listed_slots(spark):
    rows, expected = [], {}
    case = 0
    for hour in range(24):
        for minute in (0, 17, 45):
            for interval in (*range(1, 13), 24, 30):
                key = f"c{case}"
                case += 1
                last = dt.datetime(2022, 1, 3, hour, minute)
                fut = [last + k * H for k in range(1, interval + 1)]
                rows.append((key, last, 1.0, False))
                rows += [(key, d, None, True) for d in fut]
                expected[key] = expected_roll(fut)
    got = fc.business_hours_roll(spark.createDataFrame(rows, GRID_SCHEMA), "ip", 8).where("is_future").toPandas()
    for key, grp in got.groupby("ip"):
        assert sorted(list(grp["ds"])) == sorted(expected[key]), key
    assert case == 24 * 3 * 14


def test_long_horizon_goes_over_several_mornings(spark):
    base = dt.datetime(2022, 1, 7, 17, 30)
    rows = [("a", base, 1.0, False)] + [("a", base + k * H, None, True) for k in range(1, 25)]
    got = fc.business_hours_roll(spark.createDataFrame(rows, GRID_SCHEMA), "ip", 24)
    at = [(r.ds.day, r.ds.hour, r.ds.minute) for r in got.where("is_future").orderBy("ds").collect()]
    assert at == [(7, 18, 30)] + [(8, h, 30) for h in range(8, 19)] + [(9, h, 30) for h in range(8, 19)] + [(10, 8, 30)]


@pytest.mark.parametrize("level", [123456.789, 3e12, 0.0, -5.5])
def test_constant_series_is_flat_and_unflagged(spark, level):
    rows = [("a", dt.datetime(2024, 1, 1) + k * H, level) for k in range(720)]
    train = spark.createDataFrame(rows, "ip string, ds timestamp_ntz, y double")
    p = fc.trend_params(fc.trend_stats(train)).first()
    assert not p.trend_kept and p.slope == 0.0 and p.sse == 0.0 and abs(p.mean_y - level) <= 1e-12 * abs(level)
    assert fc.anomaly_flags(fc.forecast(train, seasonality=False)).count() == 0


def test_large_mean_does_not_cancel_the_spread(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    y = 4e11 + 3.0 * np.arange(720) + rng.normal(0, 50, 720)
    rows = [("a", dt.datetime(2024, 1, 1) + k * H, float(v)) for k, v in enumerate(y)]
    p = fc.trend_params(fc.trend_stats(spark.createDataFrame(rows, "ip string, ds timestamp_ntz, y double"))).first()
    t = np.arange(720) - 359.5
    slope = (t * (y - y.mean())).sum() / (t * t).sum()
    rest = y - y.mean() - slope * t
    assert p.trend_kept and abs(p.slope - slope) < 1e-6
    assert abs(p.sigma - np.sqrt((rest ** 2).sum() / 718)) < 1e-3


def test_source_with_one_point_keeps_its_rows(spark):
    rows = [("a", dt.datetime(2024, 1, 1), 5.0)] + [("b", dt.datetime(2024, 1, 1) + k * H, float(k)) for k in range(30)]
    out = fc.forecast(spark.createDataFrame(rows, "ip string, ds timestamp_ntz, y double"), seasonality=False)
    a = out.where("ip = 'a'").collect()
    assert len(a) == 9 and all(r.yhat is None for r in a) and [r.y for r in a if r.y is not None] == [5.0]


def test_merge_fills_nan_and_a_rerun_adds_nothing(spark):
    schema = "ip string, ds timestamp_ntz, y double, yhat double, training_date string"
    old = spark.createDataFrame([("a", _t(1), float("nan"), 1.0, "r1"), ("a", _t(2), None, 2.0, "r1")], schema)
    new = spark.createDataFrame([("a", _t(1), 9.0, 7.0, "r2"), ("a", _t(2), None, 8.0, "r2"), ("a", _t(3), float("nan"), 8.5, "r2")], schema)
    once = forecast_merge(old, new)
    assert sorted((r.ds, r.yhat) for r in once.where("y = 9.0").collect()) == [(_t(1), 1.0)]
    assert once.count() == 4
    twice = forecast_merge(once, new)
    assert sorted((r.ds, r.yhat, str(r.y)) for r in twice.collect()) == sorted((r.ds, r.yhat, str(r.y)) for r in once.collect())


def test_import_refuses_a_bent_trend(spark):
    row = {"ip": "a", "start": 0, "t_scale": 1.0, "y_scale": 1.0, "k": 0.0, "m": 1.0, "beta": [], "delta": [0.0, 0.2]}
    with pytest.raises(ValueError):
        fc.import_scaled_model(spark, [row])
    assert fc.import_scaled_model(spark, [{**row, "delta": [1e-9]}]).count() == 1


MERGE_SCHEMA = T.StructType([T.StructField("ip", T.StringType()), T.StructField("ds", T.TimestampNTZType()),
                             T.StructField("y", T.DoubleType()), T.StructField("yhat", T.DoubleType())])


def _t(i):
    return dt.datetime(2024, 1, 1) + i * H


def test_merge_golden(spark):
    old = spark.createDataFrame([("a", _t(1), None, 1.0), ("a", _t(2), 5.0, 2.0), ("a", _t(3), None, 3.0)],
                                MERGE_SCHEMA)
    new = spark.createDataFrame([("a", _t(1), 9.0, 7.0), ("a", _t(2), 6.0, 7.0), ("a", _t(4), None, 8.0)],
                                MERGE_SCHEMA)
    got = sorted((r.ds, r.y, r.yhat) for r in forecast_merge(old, new).collect())
    assert got == [(_t(1), 9.0, 1.0), (_t(2), 5.0, 2.0), (_t(3), None, 3.0), (_t(4), None, 8.0)]


def test_merge_never_changes_observed_y(spark):
    import random
    rnd = random.Random(7)
    old = [("k%d" % (i % 5), _t(i), (None if rnd.random() < .5 else float(i)), 0.0) for i in range(200)]
    new = [("k%d" % (i % 5), _t(i), (None if rnd.random() < .3 else float(1000 + i)), 1.0) for i in range(100, 300)]
    merged = forecast_merge(spark.createDataFrame(old, MERGE_SCHEMA), spark.createDataFrame(new, MERGE_SCHEMA))
    got = {(r.ip, r.ds, r.yhat): r.y for r in merged.collect()}
    for ip, ds, y, _ in old:
        if y is not None:
            assert got[(ip, ds, 0.0)] == y
    assert merged.where("yhat = 1.0 AND y IS NOT NULL").count() == 0


def _synthetic(spark, n_keys=40, days=30, noise=1.0, seed=3):
    hours = days * 24
    base = spark.range(n_keys * hours).select(
        (F.col("id") % n_keys).cast("string").alias("ip"),
        (F.col("id") / n_keys).cast("long").alias("h"))
    ds = (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("h")))
    d = F.col("h") / 24.0
    level = 50.0 + F.col("ip").cast("double") + 0.05 * F.col("h")
    season = 1.0 + 0.3 * F.sin(2 * 3.141592653589793 * d) + 0.1 * F.cos(4 * 3.141592653589793 * d)
    y = level * season + noise * F.randn(seed)
    return base.select("ip", ds.alias("ds"), y.alias("y"))


def test_fit_recovers_trend_and_seasonality(spark):
    train = _synthetic(spark).checkpoint()
    model = fc.fit(train, seasonality=True, order=4, ridge=1.0)
    hist = train.select("ip", "ds", "y", F.lit(False).alias("is_future"))
    pred = fc.predict(hist, model, 4)
    stats = pred.select(
        F.sqrt(F.avg((F.col("y") - F.col("yhat")) ** 2)).alias("rmse"),
        F.avg(((F.col("y") >= F.col("yhat_lower")) & (F.col("y") <= F.col("yhat_upper"))).cast("double"))
        .alias("coverage")).first()
    assert stats.rmse < 1.2
    assert 0.92 < stats.coverage < 0.98
    slopes = [r.slope for r in model.select("slope").collect()]
    assert all(abs(s - 0.05) < 0.01 for s in slopes)


def test_trend_only_exact_line(spark):
    rows = [("a", _t(i), 5.0 + 2.0 * i) for i in range(10)]
    train = spark.createDataFrame(rows, "ip string, ds timestamp_ntz, y double")
    p = fc.trend_params(fc.trend_stats(train)).first()
    assert p.slope == pytest.approx(2.0)
    assert p.sigma == pytest.approx(0.0, abs=1e-6)


def test_insufficient_history_gives_status_not_failure(spark):
    rows = [("a", _t(i), float(i)) for i in range(5)] + [("lonely", _t(0), 3.0)]
    train = spark.createDataFrame(rows, "ip string, ds timestamp_ntz, y double")
    model = fc.fit(train, seasonality=False)
    status = {r.ip: r.status for r in model.collect()}
    assert status == {"a": "ok", "lonely": "insufficient_history"}
    out = fc.forecast(train, seasonality=False, training_date="2024-01-31")
    assert {r.ip for r in out.where("yhat IS NOT NULL").collect()} == {"a"}
    assert [r.y for r in out.where("ip = 'lonely' AND y IS NOT NULL").collect()] == [3.0]


def test_empty_input_gives_empty_table(spark):
    logs = read_logs(spark, SF_SMALL).limit(0)
    out = forecast_job(logs, training_date="2024-01-31")
    assert out.count() == 0
    assert out.columns == FORECAST_SCHEMA.fieldNames()


def test_model_store_roundtrip(spark):
    train = _synthetic(spark, n_keys=5, days=5).checkpoint()
    model = fc.fit(train, seasonality=True)
    path = scratch_path(spark, "model")
    fc.save_model(model, path, "unq_dst_ip")
    loaded = fc.load_model(spark, path, "unq_dst_ip")
    a = fc.forecast(train, model=model, training_date="2024-02-01").orderBy("ip", "ds").toPandas()
    b = fc.forecast(train, model=loaded, training_date="2024-02-01").orderBy("ip", "ds").toPandas()
    pd.testing.assert_frame_equal(a, b)


def test_relabel_moves_labels_only(spark):
    logs = read_logs(spark, SF_SMALL)
    from netpulse.operators.aggregates import sum_by_key_hour
    train = sum_by_key_hour(logs)
    plain = fc.forecast(train, roll_mode="none", seasonality=False, training_date="2024-01-31")
    moved = fc.forecast(train, roll_mode="relabel", seasonality=False, training_date="2024-01-31")
    a = plain.where("y IS NULL").groupBy("ip").agg(F.sort_array(F.collect_list("yhat")).alias("v"))
    b = moved.where("y IS NULL").groupBy("ip").agg(F.sort_array(F.collect_list("yhat")).alias("v"))
    assert a.exceptAll(b).count() == 0
    # rows before the first breach have hour <= 18 by definition, and at most 11
    # rows moved to 08:00 end by 18:00: no future row is left after hours
    assert moved.where("y IS NULL AND hour(ds) > 18").count() == 0
    assert plain.where("y IS NULL AND hour(ds) > 18").count() > 0


def test_auto_selection_keeps_real_structure_and_drops_noise(spark):
    seasonal = _synthetic(spark, n_keys=10, days=10).checkpoint()
    m = fc.fit(seasonal, "auto", trend="auto").collect()
    assert all(r.season_kept and r.trend_kept for r in m)
    noise = seasonal.select("ip", "ds", (F.randn(11) * 5 + 50).alias("y"))
    m = fc.fit(noise, "auto", trend="auto").collect()
    assert sum(r.season_kept for r in m) <= 2 and sum(r.trend_kept for r in m) <= 2


def test_weekly_terms_recover_weekly_pattern(spark):
    hours = 28 * 24
    base = spark.range(6 * hours).select((F.col("id") % 6).cast("string").alias("ip"),
                                         (F.col("id") / 6).cast("long").alias("h"))
    ds = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("h"))
    wk = 1.0 + 0.4 * F.sin(2 * 3.141592653589793 * F.col("h") / (24.0 * 7))
    train = base.select("ip", ds.alias("ds"), (100.0 * wk + F.randn(5)).alias("y")).checkpoint()
    hist = train.select("ip", "ds", "y", F.lit(False).alias("is_future"))

    def rmse(weekly):
        model = fc.fit(train, True, order=4, weekly_order=weekly)
        pred = fc.predict(hist, model, 4, weekly_order=weekly)
        return pred.select(F.sqrt(F.avg((F.col("y") - F.col("yhat")) ** 2))).first()[0]

    assert rmse(3) < 1.2 < rmse(0)


def test_avg_with_dedup_counts_repeats_once(spark):
    from netpulse.operators.aggregates import avg_by_key
    logs = read_logs(spark, SF_SMALL)
    late_copies = logs.where("event_id % 2 = 0").withColumn("unq_dst_ip", F.lit(10_000)) \
        .withColumn("event_id", F.col("event_id") + 1_000_000)  # repeats arrive after the originals
    twice = logs.unionByName(late_copies)
    a = {r.src_ip: r.avg_unq_dst_ip for r in avg_by_key(logs).collect()}
    b = {r.src_ip: r.avg_unq_dst_ip for r in avg_by_key(twice, dedup_on=["src_ip", "timestamp"]).collect()}
    assert a == b


def test_clamp_floors_prediction_and_band(spark):
    rows = [("a", _t(i), float(50 - 6 * i)) for i in range(10)]  # falling to negative values
    train = spark.createDataFrame(rows, "ip string, ds timestamp_ntz, y double")
    out = fc.forecast(train, seasonality=False, trend="linear", roll_mode="none", clamp_min=0.0,
                      training_date="2024-01-31")
    low = out.agg(F.min("yhat"), F.min("yhat_lower")).first()
    assert low[0] == 0.0 and low[1] == 0.0


def test_holdout_evaluation(spark):
    data = _synthetic(spark, n_keys=8, days=20).checkpoint()
    cut = F.lit(dt.datetime(2024, 1, 16)).cast("timestamp_ntz")
    model = fc.fit(data.where(F.col("ds") < cut), True)
    scores = fc.evaluate_forecast(model, data.where(F.col("ds") >= cut))
    overall = scores.where(F.col("ip").isNull()).first()
    assert overall.n == 8 * 5 * 24  # 16-20 January
    assert overall.rmse < 2.0 and 0.85 < overall.coverage <= 1.0
    assert scores.where(F.col("ip").isNotNull()).count() == 8


def test_repredict_beats_relabel_on_business_hours_data(spark):
    # hourly series observed 08:00-18:00 only, level 50 with a daily shape
    days, rows = 14, []
    import math as _m
    import random as _r
    rnd = _r.Random(3)
    for d in range(days):
        for h in range(8, 19):
            shape = 1 + 0.4 * _m.sin(2 * _m.pi * (h - 8) / 24)
            rows.append(("a", dt.datetime(2024, 1, 1 + d, h), 50 * shape + rnd.gauss(0, 1)))
    train = spark.createDataFrame(rows, "ip string, ds timestamp_ntz, y double")

    def truth(ts):
        return 50 * (1 + 0.4 * _m.sin(2 * _m.pi * (ts.hour - 8) / 24))

    def err(mode):
        out = fc.forecast(train, seasonality=True, roll_mode=mode, training_date="2024-01-15").where("y IS NULL")
        return max(abs(r.yhat - truth(r.ds)) for r in out.collect())

    # the last observation is 18:00, so every future hour is rolled to the next morning
    assert err("repredict") < 5 < err("relabel")
