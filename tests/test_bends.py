"""The one-pass fit from moments: bends, seasonality, band; against fits over the rows."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from netpulse.operators import bends
from netpulse.operators import forecast as fc
from netpulse.operators.aggregates import sum_by_key_hour
from netpulse.sources.tables import read_logs
from helpers import plan_text

from conftest import SF_SMALL

START = dt.datetime(2024, 1, 1, 5)
SCHEMA = "ip string, ds timestamp_ntz, y double"


def frame(spark, series):
    """One key per series of hourly values; None leaves an hour out."""
    rows = [(k, START + dt.timedelta(hours=i), float(y)) for k, ys in series.items() for i, y in enumerate(ys) if y is not None]
    return spark.createDataFrame(rows, SCHEMA)


def terms_at(hours, order=4, weekly=0):
    out = []
    for period, o in ((24, order), (168, weekly)):
        for k in range(1, o + 1):
            a = 2 * math.pi * k * (hours + 5) / period  # 2024-01-01 is a Monday, the epoch a Thursday
            a = a + (2 * math.pi * k * 96 / 168 if period == 168 else 0)
            out += [np.sin(a), np.cos(a)]
    return np.stack(out, 1)


def by_rows(t, y, trend_cols, order, weekly=0, ridge=1.0, rounds=400):
    """The same model fitted over the rows: trend and seasonal weights in turn until they stand still."""
    x, beta = terms_at(t, order, weekly), np.zeros(2 * (order + weekly))
    for _ in range(rounds):
        f = 1 + x @ beta
        theta = np.linalg.lstsq(trend_cols * f[:, None], y, rcond=None)[0]
        g = trend_cols @ theta
        gx = x * g[:, None]
        beta = np.linalg.solve(gx.T @ gx + ridge * (y * y).mean() * np.eye(x.shape[1]), gx.T @ (y - g))
    return theta, beta, ((y - g * (1 + x @ beta)) ** 2).sum()


def test_products_of_terms():
    order, weekly = 3, 2
    hours = np.linspace(0, 168, 50)
    angle = 2 * math.pi * hours / 168
    wave = lambda kind, f: np.cos(f * angle) if kind == "cos" else np.sin(f * angle)
    hs = np.stack([wave(*h) for h in bends.harmonics(order, weekly)])
    xs = np.stack([wave(*x) for x in bends.terms(order, weekly)])
    assert np.allclose(np.einsum("ijh,ht->ijt", bends.products(order, weekly), hs), xs[:, None] * xs[None])


@pytest.mark.parametrize("order,weekly,segment", [(4, 0, 24), (2, 2, 36), (1, 0, 7)])
def test_fit_equals_the_limit_over_the_rows(spark, order, weekly, segment):
    rng = np.random.default_rng(order)
    t = np.arange(24.0 * 20)
    series, cols = {}, np.stack([np.ones_like(t), t], 1)
    for k in range(6):
        season = terms_at(t, order, weekly) @ rng.normal(0, 0.2, 2 * (order + weekly))
        series[f"k{k}"] = (50 + 10 * k + 0.3 * t) * (1 + season) + rng.normal(0, 3, len(t))
        series[f"k{k}"] = [None if rng.random() < 0.1 else y for y in series[f"k{k}"]]
    model = bends.fit(frame(spark, series), True, order, trend="linear", weekly_order=weekly, segment_hours=segment)
    for r in model.collect():
        at = np.array([i for i, y in enumerate(series[r.ip]) if y is not None])
        y = np.array([series[r.ip][i] for i in at], float)
        theta, beta, sse = by_rows(t[at], y, cols[at], order, weekly)
        first = 473352 + 5 + at[0]
        assert r.n == len(at) and r.mean_t == first and not r.cp_t
        assert r.slope == pytest.approx(theta[1], rel=1e-6) and r.mean_y == pytest.approx(theta[0] + theta[1] * at[0], rel=1e-6)
        assert np.allclose([r[f"beta_{i}"] for i in range(len(beta))], beta, rtol=1e-6, atol=1e-7)
        assert r.sse == pytest.approx(sse, rel=1e-6)


def test_exact_product_is_recovered(spark):
    t = np.arange(24.0 * 30)
    beta = np.array([0.3, -0.2, 0.1, 0.05, 0, 0, -0.08, 0.02])
    y = (80 + 0.25 * t) * (1 + terms_at(t) @ beta)
    r = bends.fit(frame(spark, {"a": y}), ridge=1e-9).first()
    assert r.slope == pytest.approx(0.25, abs=1e-6) and np.allclose([r[f"beta_{i}"] for i in range(8)], beta, atol=1e-6)
    assert r.season_kept and r.trend_kept and r.sigma < 1e-4


def bent(t, points, delta, base=200.0, slope=0.2):
    return base + slope * t + sum(d * np.maximum(t - p, 0) for p, d in zip(points, delta, strict=True))


def test_bends_are_recovered_within_noise(spark):
    rng = np.random.default_rng(1)
    t = np.arange(24.0 * 40)
    truth = {"up": bent(t, [19 + 24 * 12], [1.5]), "peak": bent(t, [19 + 24 * 9, 19 + 24 * 22], [1.0, -2.0]), "straight": bent(t, [], [])}
    season = 1 + terms_at(t) @ np.array([0.2, 0.1, 0, 0, 0, 0, 0, 0])
    data = frame(spark, {k: v * season + rng.normal(0, 6, len(t)) for k, v in truth.items()})
    model = fc.materialize(bends.fit(data))
    got = {r.ip: r for r in model.collect()}
    assert got["up"].cp_t and got["peak"].cp_t and not got["straight"].cp_t
    assert all(r.season_kept and r.sigma == pytest.approx(6, rel=0.12) for r in got.values())
    end = {k: v[-1] - v[-2] for k, v in truth.items()}
    for k, r in got.items():
        assert r.slope + sum(r.cp_delta) == pytest.approx(end[k], abs=0.06)
        line = r.mean_y + r.slope * (t + 473357 - r.mean_t) + sum(d * np.maximum(t + 473357 - p, 0) for p, d in zip(r.cp_t, r.cp_delta, strict=True))
        assert np.abs(line - truth[k]).max() < 8
    # a straight line through the same rows misses the bends by far
    straight = {r.ip: r.sigma for r in bends.fit(data, trend="straight").collect()}
    assert straight["up"] > 4 * got["up"].sigma


def test_noise_and_constants_keep_the_mean(spark):
    rng = np.random.default_rng(2)
    series = {f"n{i}": 1000 + rng.normal(0, 30, 24 * 25) for i in range(20)} | {"c": [7.0] * 100, "z": [0.0] * 60}
    rows = bends.fit(frame(spark, series)).collect()
    kept = [r.ip for r in rows if r.cp_t or r.trend_kept or r.season_kept]
    assert len(kept) <= 2 and not {"c", "z"} & set(kept)
    flat = {r.ip: r for r in rows}
    assert flat["c"].sigma == 0 and flat["c"].mean_y == pytest.approx(7.0)


def test_short_histories(spark):
    got = {r.ip: r for r in bends.fit(frame(spark, {"one": [3.0], "two": [3.0, 5.0], "none": [None, float("nan")]})).collect()}
    assert got["one"].status == "insufficient_history" and got["two"].status == "ok" and "none" not in got
    assert bends.fit(frame(spark, {"a": [1.0]}).limit(0)).count() == 0


def test_large_mean_does_not_cancel_the_spread(spark):
    rng = np.random.default_rng(3)
    t = np.arange(24.0 * 20)
    noise = rng.normal(0, 2, len(t))
    rows = {r.ip: r for r in bends.fit(frame(spark, {"low": 100 + noise, "high": 1e9 + 100 + noise}), False, trend="flat").collect()}
    assert rows["high"].sigma == pytest.approx(rows["low"].sigma, rel=1e-5)


def test_same_model_however_the_rows_are_dealt(spark):
    rng = np.random.default_rng(4)
    t = np.arange(24.0 * 30)
    data = frame(spark, {f"k{i}": bent(t, [19 + 24 * 10], [0.5 * i]) + rng.normal(0, 5, len(t)) for i in range(6)})
    a, b = ({r.ip: r for r in bends.fit(data.repartition(n)).collect()} for n in (1, 13))
    for k in a:
        assert a[k].cp_t == b[k].cp_t and a[k].sigma == pytest.approx(b[k].sigma, rel=1e-7)
        assert a[k].cp_delta == pytest.approx(b[k].cp_delta, rel=1e-4, abs=1e-6)


def test_rows_are_read_once(spark):
    train = sum_by_key_hour(read_logs(spark, SF_SMALL))
    plan = plan_text(bends.fit(train))
    assert plan.count("Scan parquet") == 2  # its place in the tree and its description
    assert "MapInArrow" in plan and "Join" not in plan


def test_model_store_and_forecast_with_bends(spark, tmp_path):
    t = np.arange(24.0 * 30)
    data = frame(spark, {"a": bent(t, [19 + 24 * 15], [2.0]) + np.random.default_rng(5).normal(0, 3, len(t))})
    model = bends.fit(data)
    fc.save_model(model, str(tmp_path), "m")
    back = fc.load_model(spark, str(tmp_path), "m")
    one = fc.forecast(data, 8, training_date="2024-02-01", model=back).where("y IS NULL").orderBy("ds").collect()
    two = fc.forecast(data, 8, training_date="2024-02-01", method="moments").where("y IS NULL").orderBy("ds").collect()
    assert [r.yhat for r in one] == pytest.approx([r.yhat for r in two]) and len(one) == 8
    widths = [r.yhat_upper - r.yhat_lower for r in one]
    assert all(a < b for a, b in zip(widths, widths[1:], strict=False))


def test_band_covers_futures_that_bend(spark):
    """Futures drawn from the fitted rate and size of bends lie in the band 92 to 98 times of a hundred."""
    rng = np.random.default_rng(6)
    rate, scale, sigma, last = 25 / 720, 0.05, 1.0, 473352.0 + 720
    model = spark.createDataFrame([("a", 473352.0, 100.0, 0.1, sigma, [473352.0 + 240], [0.05], rate, scale, last, "ok")],
                                  "ip string, mean_t double, mean_y double, slope double, sigma double, cp_t array<double>, "
                                  "cp_delta array<double>, bend_rate double, bend_scale double, last_t double, status string")
    grid = spark.range(1, 721).select(F.lit("a").alias("ip"), F.expr("timestamp_ntz'2024-01-31 00:00:00' + make_dt_interval(0, int(id))").alias("ds"),
                                      F.lit(None).cast("double").alias("y"), F.lit(True).alias("is_future"))
    got = fc.predict(grid, model, order=0).orderBy("ds").collect()
    h = np.arange(1, 721.0)
    inside = np.zeros(720)
    draws = 3000
    for _ in range(draws):
        at = rng.uniform(0, 720, rng.poisson(rate * 720))
        path = (rng.laplace(0, scale, len(at))[:, None] * np.maximum(h[None] - at[:, None], 0)).sum(0) + rng.normal(0, sigma, 720)
        inside += np.abs(path) <= np.array([r.yhat_upper - r.yhat for r in got])
    cover = inside / draws
    assert cover.min() > 0.92 and cover.max() < 0.98
    assert got[719].yhat_upper - got[719].yhat > 10 * (got[0].yhat_upper - got[0].yhat)


def test_import_takes_changes_of_slope(spark):
    row = {"ip": "a", "start": 473352 * 3600.0, "t_scale": 100 * 3600.0, "y_scale": 50.0, "k": 0.4, "m": 0.2, "beta": [0.3, -0.1],
           "delta": [0.5, -0.9], "changepoints_t": [0.25, 0.6], "sigma_obs": 0.02}
    grid = spark.range(0, 150).select(F.lit("a").alias("ip"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, int(id))").alias("ds"),
                                      F.lit(None).cast("double").alias("y"), (F.col("id") > 100).alias("is_future"))
    got = [(r.yhat, r.yhat_upper - r.yhat) for r in fc.predict(grid, fc.import_scaled_model(spark, [row], order=1), order=1).orderBy("ds").collect()]
    s = np.arange(150) / 100
    # the scaled form: slope and offset change together at each point, so that the line does not jump
    slope = 0.4 + 0.5 * (s >= 0.25) - 0.9 * (s >= 0.6)
    offset = 0.2 - 0.5 * 0.25 * (s >= 0.25) + 0.9 * 0.6 * (s >= 0.6)
    f = 1 + 0.3 * np.sin(2 * np.pi * s * 100 / 24) - 0.1 * np.cos(2 * np.pi * s * 100 / 24)
    assert [g[0] for g in got] == pytest.approx(list((slope * s + offset) * 50 * f), abs=1e-8)
    assert got[50][1] == pytest.approx(1.959963984540054 * 0.02 * 50) and got[149][1] > 3 * got[50][1]
