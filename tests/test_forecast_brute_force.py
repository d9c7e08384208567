"""The distributed fit equals a direct per-source numpy fit on a small fixture."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from netpulse.operators import forecast as fc
from netpulse.operators.aggregates import sum_by_key_hour
from netpulse.sources.tables import read_logs

from conftest import SF_SMALL

ORDER, RIDGE = 4, 1.0


def features(ds_seconds, order=ORDER):
    d = ds_seconds / 86400.0
    cols = []
    for k in range(1, order + 1):
        cols += [np.sin(d * (2 * math.pi * k)), np.cos(d * (2 * math.pi * k))]
    return np.stack(cols, axis=1)


def trend_fit(t, y, mode):
    n = len(t)
    mt, my = t.mean(), y.mean()
    den = ((t - mt) ** 2).sum()
    slope = ((t - mt) * (y - my)).sum() / den if den > 0 else 0.0
    sse_flat = ((y - my) ** 2).sum()
    sse_line = ((y - my - slope * (t - mt)) ** 2).sum()
    if mode == "linear":
        keep = n >= 2
    elif n <= 2:
        keep = False
    elif sse_line <= 1e-9 * max(sse_flat, 1.0):
        keep = True
    else:
        keep = n * math.log(sse_flat / sse_line) > math.log(n)
    return mt, my, (slope if keep else 0.0), keep


def seasonal_fit(t, y, ds, mt, my, slope, select):
    g = my + slope * (t - mt)
    ok = np.abs(g) > 1e-9
    x, r = features(ds[ok]), y[ok] / g[ok] - 1
    a, b = x.T @ x, x.T @ r
    beta = np.linalg.solve(a + RIDGE * np.eye(a.shape[0]), b)
    if select:
        nr, rr = len(r), (r * r).sum()
        sse = rr - 2 * beta @ b + beta @ a @ beta
        keep = nr > 2 * ORDER + 2 and (sse <= 0 or nr * math.log(rr / sse) > 2 * ORDER * math.log(nr))
        if not keep:
            beta = np.zeros_like(beta)
    return beta


def brute_force(pdf, seasonality, trend_mode, refine=2):
    out = {}
    for ip, g in pdf.groupby("ip"):
        ds = g["ds"].astype("int64").to_numpy() / 1e9 if hasattr(g["ds"], "dt") else g["ds"].to_numpy()
        t = np.floor(ds / 3600)
        y = g["y"].to_numpy(dtype=float)
        if len(y) < 2:
            continue
        mt, my, slope, _ = trend_fit(t, y, trend_mode)
        beta = np.zeros(2 * ORDER)
        if seasonality is not False:
            beta = seasonal_fit(t, y, ds, mt, my, slope, seasonality == "auto")
            for _ in range(refine):
                if not np.any(beta):
                    break
                s = 1 + features(ds) @ beta
                mt, my, slope, _ = trend_fit(t, y / s, trend_mode)
                beta = seasonal_fit(t, y, ds, mt, my, slope, seasonality == "auto")
        out[ip] = (mt, my, slope, beta)
    return out


@pytest.mark.parametrize("seasonality,trend_mode", [(True, "linear"), ("auto", "auto"), (False, "auto")])
def test_distributed_fit_equals_numpy(spark, seasonality, trend_mode):
    train = fc.materialize(sum_by_key_hour(read_logs(spark, SF_SMALL)))
    pdf = train.select("ip", F.unix_seconds(F.col("ds").cast("timestamp")).alias("ds"), "y").toPandas()
    want = brute_force(pdf, seasonality, trend_mode)
    model = fc.fit(train, seasonality, ORDER, RIDGE, trend=trend_mode).where("status = 'ok'").collect()
    assert {r.ip for r in model} == set(want)
    for r in model:
        mt, my, slope, beta = want[r.ip]
        assert r.mean_y == pytest.approx(my, rel=1e-9, abs=1e-9)
        assert r.slope == pytest.approx(slope, rel=1e-6, abs=1e-9)
        got_beta = np.array([r[f"beta_{i}"] for i in range(2 * ORDER)])
        assert np.allclose(got_beta, beta, rtol=1e-6, atol=1e-9), r.ip
