"""Golden: predictions from stored scaled parameters of a linear-trend x daily-Fourier model."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from netpulse.operators import forecast as fc

# Stored parameters of the model for source 46.39.79.251 (metric unq_dst_ip):
# start (epoch s), t_scale (s), y_scale, k, m, the eight daily Fourier weights and sigma_obs.
STORED = {
    "ip": "46.39.79.251", "start": 1641484800.0, "t_scale": 75600.0, "y_scale": 7.0,
    "k": -0.241024, "m": 2.91727,
    "beta": [3.50467, 0.418785, 3.82347, -1.53787, 1.89794, -1.83023, 0.351254, -0.784236],
    "sigma_obs": 0.129426,
}
# Its predictions at 2022-01-07 14:00-18:00, then 19:00-21:00 (which the
# business-hours roll relabels as 2022-01-08 08:00-10:00).
IN_HOURS = [4.2091, 3.6624, 1.7258, 1.8687, 2.6930]
AFTER_HOURS = [-5.6301, -33.4622, -77.2334]


def _train(spark):
    last = dt.datetime(2022, 1, 7, 13, 0)
    rows = [(STORED["ip"], last - dt.timedelta(hours=i), 1.0) for i in range(3)]
    return spark.createDataFrame(rows, "ip string, ds timestamp_ntz, y double")


def test_stored_parameter_predictions(spark):
    model = fc.import_scaled_model(spark, [STORED])
    out = fc.forecast(_train(spark), model=model, roll_mode="none", training_date="2022-01-07")
    fut = [r.yhat for r in out.where("y IS NULL").orderBy("ds").collect()]
    assert fut == pytest.approx(IN_HOURS + AFTER_HOURS, abs=5e-4)


def test_relabel_moves_after_hours_values_to_next_morning(spark):
    model = fc.import_scaled_model(spark, [STORED])
    out = fc.forecast(_train(spark), model=model, roll_mode="relabel", training_date="2022-01-07")
    fut = {r.ds: r.yhat for r in out.where("y IS NULL").collect()}
    morning = [fut[dt.datetime(2022, 1, 8, h)] for h in (8, 9, 10)]
    assert morning == pytest.approx(AFTER_HOURS, abs=5e-4)
    assert [fut[dt.datetime(2022, 1, 7, h)] for h in range(14, 19)] == pytest.approx(IN_HOURS, abs=5e-4)


def test_repredict_predicts_at_the_business_hours(spark):
    model = fc.import_scaled_model(spark, [STORED])
    out = fc.forecast(_train(spark), model=model, roll_mode="repredict", training_date="2022-01-07")
    fut = out.where("y IS NULL").orderBy("ds")
    assert fut.where(F.hour("ds") > 18).count() == 0
    assert fut.count() == 8
