"""Per-source forecast: linear trend x (1 + daily / weekly seasonality), 95 % band.

The fit never gathers a source's rows in one place.  The trend comes from
per-key sufficient statistics (n, sum t, sum t^2, sum y, sum t*y, sum y^2) -
one decomposable aggregation, so a hot source costs one partial row per input
partition.  The multiplicative seasonality is a ridge regression of the trend
ratio ``y/g - 1`` on Fourier terms of the time of day; its normal equations
are again per-key sums, and only the one-row-per-key table of sums reaches
numpy, in a batched solve inside ``mapInPandas``.  Back-fitting rounds refine
trend and ratio in turn, and an information criterion decides per key whether
the slope and the seasonal terms are kept.  Prediction is a join of the
per-key parameters onto the time grid plus column arithmetic.

Time axis: whole hours since the epoch.  The sums are taken around a fixed recent
hour and around each key's own level (a whole number near its mean), so they stay
small: integer values sum exactly, and a large mean does not cancel the spread.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import add_hours, epoch_hours
from ..session import checkpoint_root
from .merge import is_missing
from .reshape import grid_with_history

log = logging.getLogger(__name__)

# Fixed value: two-sided 95 % quantile of the standard normal distribution.
Z95 = 1.959963984540054

# Business-hours roll defaults (start hour, last hour, largest interval).
START_HOUR = 8
LAST_HOUR = 18

# Fixed value: the hour the time axis is centred on, 2024-01-01 00:00 UTC in hours since the epoch.
ORIGIN_HOUR = 473352

# A sum of squared residuals is rounding, not spread, below this share of the squares it is the difference of,
# and where its root mean square is below this share of the mean.
ROUNDING, MEAN_ROUNDING = 1e-12, 1e-15
BAND_ROUNDING = 1e-9

# Seasonal Fourier orders (daily order 4; weekly order 3, off unless asked for).
DAILY_ORDER = 4
WEEKLY_ORDER = 3


def _dec(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def trend_stats(train: DataFrame, key: str = "ip") -> DataFrame:
    """Per-key sufficient statistics of the trend regression of ``y`` on hours.

    ``t`` counts from ``ORIGIN_HOUR`` and ``y`` from the key's ``level``, the whole
    number below its mean.  ``train`` is read twice, for the levels and the sums.
    """
    t = epoch_hours("ds") - ORIGIN_HOUR
    observed = train.where(~is_missing("y")).select(key, t.alias("t"), "y")
    levels = observed.groupBy(key).agg(F.floor(F.avg("y")).cast("double").alias("level"))
    return (observed.join(levels, key)
            .select(key, "level", "t", (F.col("y") - F.col("level")).alias("y"))
            .groupBy(key)
            .agg(F.first("level").alias("level"),
                 F.count(F.lit(1)).alias("n"),
                 F.sum("t").alias("st"),
                 F.sum(F.col("t") * F.col("t")).alias("stt"),
                 F.sum("y").alias("sy"),
                 F.sum(F.col("t") * F.col("y")).alias("sty"),
                 F.sum(F.col("y") * F.col("y")).alias("syy")))


def trend_params(stats: DataFrame, trend: str = "auto") -> DataFrame:
    """Slope, means and residual scale from the sums.

    ``yhat(t) = mean_y + slope * (t - mean_t)``.  ``trend``: ``"linear"``
    keeps the least-squares slope; ``"flat"`` uses the mean; ``"auto"`` keeps
    the slope only where it pays for its parameter by the Bayesian information
    criterion, ``n * ln(SSE_flat / SSE_line) > ln(n)`` - a slope fitted to
    noise and extrapolated adds error, and on a tie the mean is enough.  A spread
    within rounding of the level counts as none.  ``sigma`` is the residual standard
    deviation of the chosen line.  Fewer than two points give
    ``status = 'insufficient_history'``.
    """
    n, st, stt, sy, sty, syy = (F.col(c) for c in ("n", "st", "stt", "sy", "sty", "syy"))
    den = (_dec(n) * _dec(stt) - _dec(st) * _dec(st)).cast("double")
    num = n * sty - st * sy
    ols = F.when(den > 0, num / den).otherwise(F.lit(0.0))
    base = stats.select("*", (F.lit(ORIGIN_HOUR) + st / n).alias("mean_t"), (F.col("level") + sy / n).alias("mean_y"),
                        ols.alias("ols_slope")) \
        .withColumn("_none", F.lit(ROUNDING) * syy + n * F.pow(F.lit(MEAN_ROUNDING) * F.col("mean_y"), 2)) \
        .withColumn("sse_flat", (n * syy - sy * sy) / n) \
        .withColumn("sse_line", F.col("sse_flat") - F.col("ols_slope") * num / n) \
        .withColumn("sse_flat", F.when(F.col("sse_flat") <= F.col("_none"), F.lit(0.0)).otherwise(F.col("sse_flat"))) \
        .withColumn("sse_line", F.when(F.col("sse_line") <= F.col("_none"), F.lit(0.0)).otherwise(F.col("sse_line")))
    if trend == "linear":
        keep = n >= 2
    elif trend == "flat":
        keep = F.lit(False)
    else:
        keep = F.when((n <= 2) | (F.col("sse_flat") <= 0), F.lit(False)).when(F.col("sse_line") <= 0, F.lit(True)) \
            .otherwise(n * F.log(F.col("sse_flat") / F.col("sse_line")) > F.log(n))
    out = base.withColumn("trend_kept", keep)
    kept = F.col("trend_kept")
    sse = F.when(kept, F.col("sse_line")).otherwise(F.col("sse_flat"))
    dof = F.when(kept, n - 2).otherwise(n - 1)
    sums = ("level", "n", "st", "stt", "sy", "sty", "syy")
    return out.select(
        *[c for c in stats.columns if c not in sums],
        *sums, "mean_t", "mean_y", "ols_slope", "trend_kept",
        F.when(kept, F.col("ols_slope")).otherwise(F.lit(0.0)).alias("slope"),
        sse.alias("sse"),
        F.when(dof > 0, F.sqrt(F.greatest(sse, F.lit(0.0)) / dof)).alias("sigma"),
        F.when(n < 2, F.lit("insufficient_history")).otherwise(F.lit("ok")).alias("status"),
    )


def trend_value(t: Column) -> Column:
    return F.col("mean_y") + F.col("slope") * (t - F.col("mean_t"))


def seasonal_index(train: DataFrame, key: str = "ip") -> DataFrame:
    """Hour-of-day index: mean ``y`` at that hour over the key's mean, minus 1.

    A ratio-to-mean index (the SQL-checkable form of the daily seasonality).
    """
    by_hour = train.groupBy(key, F.hour("ds").alias("hour")) \
        .agg(F.sum("y").alias("sy_h"), F.count(F.lit(1)).alias("n_h"))
    # the key totals come from the 24 hour rows, not from another pass over the input
    overall = by_hour.groupBy(key).agg(F.sum("sy_h").alias("sy"), F.sum("n_h").alias("n"))
    j = by_hour.join(overall, key)
    idx = F.when(F.col("sy") != 0, (F.col("sy_h") / F.col("n_h")) / (F.col("sy") / F.col("n")) - 1)
    return j.select(key, "hour", "n_h", idx.alias("index"))


# ---------------------------------------------------------------- seasonality

def fourier_terms(ds: Column, order: int, period_days: float = 1.0) -> list[Column]:
    """``sin, cos(2 pi k d / period)`` for k = 1..order, d = days since the epoch."""
    d = F.unix_seconds(ds.cast("timestamp")) / F.lit(86400.0)
    out = []
    for k in range(1, order + 1):
        arg = d * F.lit(2.0 * math.pi * k / period_days)
        out += [F.sin(arg), F.cos(arg)]
    return out


def seasonal_terms(ds: Column, order: int, weekly_order: int = 0) -> list[Column]:
    """Daily terms (period 1 day) then weekly terms (period 7 days)."""
    return fourier_terms(ds, order, 1.0) + fourier_terms(ds, weekly_order, 7.0)


def _solve_batch(m: int, ridge: float, select: bool):
    pairs = [(i, j) for i in range(m) for j in range(i, m)]
    beta_cols = [f"beta_{i}" for i in range(m)]

    def solve(batches):
        for pdf in batches:
            if pdf.empty:
                yield pd.DataFrame({"ip": pd.Series(dtype=str), **{c: pd.Series(dtype=float) for c in beta_cols},
                                    "season_kept": pd.Series(dtype=bool)})
                continue
            k = len(pdf)
            a = np.zeros((k, m, m))
            for (i, j) in pairs:
                v = pdf[f"xx_{i}_{j}"].to_numpy(dtype=float)
                a[:, i, j] = v
                a[:, j, i] = v
            b = np.stack([pdf[f"xr_{i}"].to_numpy(dtype=float) for i in range(m)], axis=1)
            beta = np.linalg.solve(a + ridge * np.eye(m)[None, :, :], b[:, :, None])[:, :, 0]
            kept = np.ones(k, dtype=bool)
            if select:
                # keep the terms only where they pay for their m parameters (BIC)
                rr = pdf["rr"].to_numpy(dtype=float)
                nr = pdf["nr"].to_numpy(dtype=float)
                sse = rr - 2 * np.einsum("ki,ki->k", beta, b) + np.einsum("ki,kij,kj->k", beta, a, beta)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = nr * np.log(rr / sse)
                kept = (nr > m + 2) & ((sse <= 0) | (gain > m * np.log(np.maximum(nr, 1.0))))
                beta = np.where(kept[:, None], beta, 0.0)
            out = pd.DataFrame(beta, columns=beta_cols)
            out.insert(0, "ip", pdf["ip"].to_numpy())
            out["season_kept"] = kept
            yield out

    schema = T.StructType([T.StructField("ip", T.StringType())]
                          + [T.StructField(c, T.DoubleType()) for c in beta_cols]
                          + [T.StructField("season_kept", T.BooleanType())])
    return solve, schema, pairs


def seasonal_params(train: DataFrame, trend: DataFrame, order: int = DAILY_ORDER, ridge: float = 1.0,
                    min_trend: float = 1e-9, key: str = "ip", select: bool = True,
                    weekly_order: int = 0) -> DataFrame:
    """Ridge fit of ``y/g - 1`` on the Fourier terms, per key.

    The normal equations are per-key sums (``xx_i_j``, ``xr_i``); the table
    handed to numpy has one row per key.
    """
    solve, schema, _ = _solve_batch(2 * (order + weekly_order), ridge, select)
    return seasonal_sums(train, trend, order, min_trend, key, weekly_order).mapInPandas(solve, schema)


def seasonal_sums(train: DataFrame, trend: DataFrame, order: int = DAILY_ORDER, min_trend: float = 1e-9,
                  key: str = "ip", weekly_order: int = 0) -> DataFrame:
    """Normal equations of the seasonal ratio, one row per key: ``xx_i_j``, ``xr_i``, ``rr``, ``nr``."""
    m = 2 * (order + weekly_order)
    pairs = [(i, j) for i in range(m) for j in range(i, m)]
    g = trend_value(epoch_hours("ds").cast("double"))
    joined = train.where(~is_missing("y")).join(
        trend.where(F.col("status") == "ok").select(key, "mean_t", "mean_y", "slope"), key)
    x = seasonal_terms(F.col("ds"), order, weekly_order)
    rows = joined.select(key, g.alias("g"), F.col("y"), *[c.alias(f"x_{i}") for i, c in enumerate(x)]) \
        .where(F.abs(F.col("g")) > min_trend) \
        .withColumn("r", F.col("y") / F.col("g") - 1)
    aggs = [F.sum(F.col(f"x_{i}") * F.col(f"x_{j}")).alias(f"xx_{i}_{j}") for (i, j) in pairs]
    aggs += [F.sum(F.col(f"x_{i}") * F.col("r")).alias(f"xr_{i}") for i in range(m)]
    aggs += [F.sum(F.col("r") * F.col("r")).alias("rr"), F.count(F.lit(1)).alias("nr")]
    return rows.groupBy(key).agg(*aggs)


# ---------------------------------------------------------------- prediction

def business_hours_roll(grid: DataFrame, key: str = "ip", interval: int = 8, start_hour: int = START_HOUR,
                        last_hour: int = LAST_HOUR) -> DataFrame:
    """Move future rows past the last business hour to the next mornings.

    Over the ``interval`` future rows of a key: the first row whose hour is
    after ``last_hour`` goes to ``start_hour`` of the next day and every later
    row follows it hour by hour; earlier rows stay.  A business day has
    ``last_hour - start_hour + 1`` rows; beyond them the rows go on at
    ``start_hour`` of the day after, so any horizon fits.  For consecutive hourly
    rows this is a shift in closed form: the k-th row from the first breach gets
    the breach's shift, and the hours of the night for each full business day in k.
    Only the future rows (``interval`` per key) enter the window.
    """
    day = last_hour - start_hour + 1
    fut = grid.where(F.col("is_future"))
    breach = F.min(F.when(F.hour("ds") > last_hour, F.col("ds"))).over(Window.partitionBy(key))
    k = ((F.unix_seconds(F.col("ds").cast("timestamp")) - F.unix_seconds(F.col("_fb").cast("timestamp"))) / 3600).cast("int")
    shift = F.lit(24 + start_hour) - F.hour("_fb") + (24 - day) * F.floor(k / day).cast("int")
    rolled = fut.withColumn("_fb", breach) \
        .withColumn("ds", F.when(F.col("ds") >= F.col("_fb"), add_hours("ds", shift)).otherwise(F.col("ds"))) \
        .drop("_fb")
    return grid.where(~F.col("is_future")).unionByName(rolled)


def _season_factor(order: int, weekly_order: int) -> Column:
    """``1 + X beta`` at ``ds`` from joined ``beta_i`` columns."""
    xb = F.lit(0.0)
    for i, c in enumerate(seasonal_terms(F.col("ds"), order, weekly_order)):
        xb = xb + c * F.col(f"beta_{i}")
    return F.lit(1.0) + xb


def fit(train: DataFrame, seasonality: bool | str = "auto", order: int = DAILY_ORDER, ridge: float = 1.0,
        key: str = "ip", trend: str = "auto", weekly_order: int = 0, refine: int = 2) -> DataFrame:
    """Model table: one row per key with the trend, the Fourier weights
    (``beta_i``, zero without seasonality), ``sigma`` and ``status``.

    ``seasonality``: ``True`` always fits the daily terms, ``False`` never,
    ``"auto"`` keeps them per key only where they pass the information
    criterion.  ``order`` and ``weekly_order`` are the Fourier orders of the
    daily and weekly terms (weekly off by default; two weeks of history are
    needed to identify it).  ``trend``: see ``trend_params``.

    The multiplicative model is fitted by back-fitting: trend, then the
    seasonal ratio, then up to ``refine`` more rounds of the trend on the
    de-seasonalised ``y`` and the ratio on the new trend, for the sources
    that keep seasonal terms only.  Every round is two per-key aggregations
    over those sources' hourly rows; the model table between rounds is
    checkpointed (one row per key).  The table is the stored form
    of the model (see ``save_model``).
    """
    tp = trend_params(trend_stats(train, key), trend)
    m = 2 * (order + weekly_order)
    orders = [F.lit(order).alias("order"), F.lit(weekly_order).alias("weekly_order")]
    if seasonality is False:
        return tp.select("*", *[F.lit(0.0).alias(f"beta_{i}") for i in range(m)],
                         F.lit(False).alias("season_kept"), *orders)

    def combine(tp_, rows):
        seas = seasonal_params(rows, tp_, order, ridge, key=key, select=(seasonality == "auto"),
                               weekly_order=weekly_order)
        return tp_.join(seas, key, "left") \
            .select(*tp_.columns,
                    *[F.coalesce(F.col(f"beta_{i}"), F.lit(0.0)).alias(f"beta_{i}") for i in range(m)],
                    F.coalesce(F.col("season_kept"), F.lit(False)).alias("season_kept"), *orders)

    model = materialize(combine(tp, train))
    seasonal = model.where(F.col("season_kept")).select(key)
    if seasonal.isEmpty():
        return model  # every source is its trend alone, whose residual scale is known from the sums
    for at in range(refine):
        model = materialize(model) if at else model
        kept = model.where(F.col("season_kept")).select(key)
        if kept.limit(1).count() == 0:
            break  # no source kept seasonal terms: every trend is already final
        # only sources with seasonal terms are refitted; the others carry over unchanged
        rows = train.join(kept, key, "left_semi")
        betas = model.join(kept, key, "left_semi").select(key, *[f"beta_{i}" for i in range(m)])
        factor = _season_factor(order, weekly_order)
        adjusted = rows.where(~is_missing("y")).join(betas, key) \
            .select(key, "ds", F.when(F.abs(factor) > 1e-9, F.col("y") / factor).alias("y"))
        refitted = combine(trend_params(trend_stats(adjusted, key), trend), rows)
        model = model.join(kept, key, "left_anti").unionByName(refitted)
    # only sources that had seasonal terms need a pass over their hours for the residual scale
    hist = train.join(seasonal, key, "left_semi").where(~is_missing("y")).select(key, "ds", "y", F.lit(False).alias("is_future"))
    fitted = predict(hist, model.withColumn("sigma", F.lit(None).cast("double")), order, key=key,
                     weekly_order=weekly_order)
    dof = F.lit(1) + F.col("trend_kept").cast("int") + F.when(F.col("season_kept"), F.lit(m)).otherwise(0)
    sig = residual_sigma(fitted.join(model.select(key, dof.alias("_dof")), key), key)
    scale = seasonal.join(sig.withColumnRenamed("sigma", "_s"), key, "left").withColumn("_seasonal", F.lit(True))
    return model.join(scale, key, "left").withColumn(
        "sigma", F.when(F.col("_seasonal"), F.col("_s")).otherwise(F.col("sigma"))).drop("_s", "_seasonal")


def bends_value(t: Column) -> Column:
    """What the bends before ``t`` add to the line: each changes the slope by ``cp_delta`` from ``cp_t`` on."""
    parts = F.zip_with("cp_t", "cp_delta", lambda at, delta: delta * F.greatest(t - at, F.lit(0.0)))
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)


def future_bends_variance(t: Column) -> Column:
    """Variance that unknown bends after the history add to the trend at ``t``.

    Bends are taken to go on as they came: ``bend_rate`` an hour, each a change of
    slope with Laplace scale ``bend_scale``.  A change at u adds its size times
    ``t - u``; over a horizon of h hours the variances add up to
    ``rate * 2 scale^2 * h^3 / 3``.
    """
    h = F.greatest(t - F.col("last_t"), F.lit(0.0))
    return F.col("bend_rate") * 2 * F.col("bend_scale") * F.col("bend_scale") * h * h * h / 3


def predict(grid: DataFrame, model: DataFrame, order: int = DAILY_ORDER, z: float = Z95, key: str = "ip",
            weekly_order: int = 0, clamp_min: float | None = None) -> DataFrame:
    """``yhat`` and the band on every grid row; null where the key has no fitted model.

    A model table with bends (``cp_t``, see ``bends.fit``) bends the trend, and its band
    widens with the horizon.  ``clamp_min`` floors ``yhat`` and both band edges (0 for counts, which a
    multiplicative seasonal term can push below zero outside the observed hours).
    """
    m = 2 * (order + weekly_order)
    bent = ["cp_t", "cp_delta", "bend_rate", "bend_scale", "last_t"] if "cp_t" in model.columns else []
    p = model.where(F.col("status") == "ok") \
        .select(key, "mean_t", "mean_y", "slope", "sigma", *bent, *[f"beta_{i}" for i in range(m)])
    j = grid.join(p, key, "left")
    t = epoch_hours("ds").cast("double")
    yhat = trend_value(t) + bends_value(t) if bent else trend_value(t)
    factor = None
    if m > 0:
        xb = None
        for i, c in enumerate(seasonal_terms(F.col("ds"), order, weekly_order)):
            term = c * F.col(f"beta_{i}")
            xb = term if xb is None else xb + term
        factor = F.lit(1.0) + xb
        yhat = yhat * factor
    if bent:
        swing = future_bends_variance(t) if factor is None else future_bends_variance(t) * factor * factor
        band = F.lit(z) * F.sqrt(F.col("sigma") * F.col("sigma") + swing)
    else:
        band = F.lit(z) * F.col("sigma")
    out = j.withColumn("yhat", yhat)
    cols = [F.col("yhat"), F.col("yhat") + band, F.col("yhat") - band]
    if clamp_min is not None:
        cols = [F.greatest(c, F.lit(float(clamp_min))) for c in cols]
    return out.select(*grid.columns, cols[0].alias("yhat"), cols[1].alias("yhat_upper"),
                      cols[2].alias("yhat_lower"))


def residual_sigma(fitted: DataFrame, key: str = "ip") -> DataFrame:
    """Residual standard deviation of fitted values; ``_dof`` (if present) is
    the number of fitted parameters per key, else 2."""
    p = F.col("_dof") if "_dof" in fitted.columns else F.lit(2)
    r = fitted.where(~is_missing("y") & F.col("yhat").isNotNull()).select(key, (F.col("y") - F.col("yhat")).alias("e"), p.alias("_p"))
    n = F.count(F.lit(1))
    return r.groupBy(key).agg(
        F.when(n > F.max("_p"), F.sqrt(F.sum(F.col("e") * F.col("e")) / (n - F.max("_p")))).alias("sigma"))


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there.

    Used for the hourly training frame and the model table, which several
    later steps read: the raw events are scanned once, and a lost executor
    re-reads the checkpoint instead of recomputing from the events.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def forecast(train: DataFrame, horizon: int = 8, roll_mode: str = "repredict", seasonality: bool | str = "auto",
             order: int = DAILY_ORDER, ridge: float = 1.0, training_date: Column | str | None = None,
             key: str = "ip", model: DataFrame | None = None, trend: str = "auto",
             weekly_order: int = 0, clamp_min: float | None = None, method: str = "sums") -> DataFrame:
    """Forecast table ``(ds, ip, y, yhat, yhat_upper, yhat_lower, training_date)``.

    ``roll_mode``: ``"repredict"`` moves the future grid into business hours and
    predicts there; ``"relabel"`` predicts at the plain next hours and then moves
    only the labels (the values stay those of the unmoved hours); ``"none"``
    leaves the grid as is.  ``method``: ``"sums"`` fits by ``fit``, ``"moments"`` by
    ``bends.fit`` (one pass, a trend that may bend, a band that widens).  A stored
    ``model`` skips the fit.  A source with too little history keeps its rows, with null ``yhat``.
    """
    train = materialize(train)
    if train.isEmpty():  # reads one row of the checkpoint
        log.warning("no training rows: empty forecast")
        return _empty_forecast(train)
    if model is None:
        from . import bends
        fitted = bends.fit if method == "moments" else fit
        model = materialize(fitted(train, seasonality, order, ridge, key, trend, weekly_order))
    grid = grid_with_history(train, horizon, key)
    if roll_mode == "repredict":
        grid = business_hours_roll(grid, key, horizon)
    out = predict(grid, model, order, key=key, weekly_order=weekly_order, clamp_min=clamp_min)
    if roll_mode == "relabel":
        out = business_hours_roll(out, key, horizon)
    td = training_date if training_date is not None else F.current_date()
    td = F.to_date(F.lit(td)) if isinstance(td, str) else td
    return out.select("ds", key, "y", "yhat", "yhat_upper", "yhat_lower", td.alias("training_date"))


def save_model(model: DataFrame, path: str, data_type: str) -> str:
    """Store a model table under ``path``, partition ``data_type`` (replaced as a whole)."""
    (model.withColumn("data_type", F.lit(data_type)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("data_type").parquet(path))
    return path


def import_scaled_model(spark, rows: list[dict], order: int = DAILY_ORDER, weekly_order: int = 0) -> DataFrame:
    """Model table from externally fitted scaled parameters, one dict per key.

    Each dict holds ``ip``, ``start`` (epoch seconds), ``t_scale`` (seconds),
    ``y_scale``, ``k``, ``m``, ``beta`` (Fourier weights, sin/cos per order)
    and optionally ``sigma_obs`` - a linear trend ``y_scale * (k * (t - start) /
    t_scale + m)`` times ``1 + X beta`` - and the changes of slope ``delta`` at the
    scaled times ``changepoints_t`` (as many of both; ``ValueError`` if not).  Shifts
    of 1e-6 and less in size are rounding of the solver that wrote them and are left
    out unless the times are given.  The parameters map exactly onto the model table: slope per
    hour ``y_scale * k * 3600 / t_scale``, ``mean_t`` the start in hours,
    ``mean_y = y_scale * m``, ``sigma = sigma_obs * y_scale``, a change of slope like
    the slope, at the start plus its scaled time; bends to come are as many per hour and
    as large as the given ones, from the scaled time 1 on.  Parameter
    tables are small (one row per key); they are created from the driver.
    """
    m = 2 * (order + weekly_order)
    out = []
    for r in rows:
        per_hour = 3600.0 / r["t_scale"]
        delta, at = list(r.get("delta") or []), list(r.get("changepoints_t") or [])
        if not at and all(abs(d) <= 1e-6 for d in delta):
            delta = []
        if len(delta) != len(at):
            raise ValueError(f"{r['ip']}: {len(delta)} changes of slope at {len(at)} times")
        start = r["start"] / 3600.0
        beta = list(r["beta"]) + [0.0] * (m - len(r["beta"]))
        size = sum(map(abs, delta)) / len(delta) if delta else 0.0
        out.append((r["ip"], start, r["y_scale"] * r["m"], r["y_scale"] * r["k"] * per_hour,
                    (r.get("sigma_obs") or 0.0) * r["y_scale"], [start + s / per_hour for s in at],
                    [r["y_scale"] * d * per_hour for d in delta], len(delta) * per_hour, r["y_scale"] * size * per_hour,
                    start + 1 / per_hour, *[float(b) for b in beta[:m]]))
    schema = T.StructType([T.StructField("ip", T.StringType())]
                          + [T.StructField(c, T.DoubleType()) for c in ("mean_t", "mean_y", "slope", "sigma")]
                          + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("cp_t", "cp_delta")]
                          + [T.StructField(c, T.DoubleType()) for c in ("bend_rate", "bend_scale", "last_t")]
                          + [T.StructField(f"beta_{i}", T.DoubleType()) for i in range(m)])
    return spark.createDataFrame(out, schema).select(
        "*", F.lit("ok").alias("status"), F.lit(True).alias("trend_kept"), F.lit(True).alias("season_kept"),
        F.lit(order).alias("order"), F.lit(weekly_order).alias("weekly_order"))


def load_model(spark, path: str, data_type: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("data_type") == data_type).drop("data_type")


def _empty_forecast(train: DataFrame) -> DataFrame:
    from ..schema import FORECAST_SCHEMA
    return train.sparkSession.createDataFrame([], FORECAST_SCHEMA)


def evaluate_forecast(model: DataFrame, holdout: DataFrame, order: int = DAILY_ORDER, weekly_order: int = 0,
                      key: str = "ip") -> DataFrame:
    """Score a fitted model on observed ``(ip, ds, y)`` rows it was not fitted on.

    Per key and overall (``ip`` null on the rollup row): rows, RMSE, MAE and
    the share of observations inside the band.  One join and one aggregate.
    """
    grid = holdout.where(~is_missing("y")).select(key, "ds", "y", F.lit(False).alias("is_future"))
    pred = predict(grid, model, order, key=key, weekly_order=weekly_order)
    e = F.col("y") - F.col("yhat")
    inside = ((F.col("y") >= F.col("yhat_lower")) & (F.col("y") <= F.col("yhat_upper"))).cast("double")
    return pred.rollup(key).agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"),
                                F.avg(F.abs(e)).alias("mae"), F.avg(inside).alias("coverage"))


def anomaly_flags(fc: DataFrame) -> DataFrame:
    """Observed rows outside the band: side and distance beyond the band.

    A distance within rounding of the forecast is none, so a constant series, whose
    band has no width, is not flagged.
    """
    obs = fc.where(~is_missing("y") & F.col("yhat_upper").isNotNull())
    slack = F.lit(BAND_ROUNDING) * F.greatest(F.abs("yhat"), F.lit(1.0))
    side = F.when(F.col("y") - F.col("yhat_upper") > slack, F.lit("high")) \
        .when(F.col("yhat_lower") - F.col("y") > slack, F.lit("low"))
    excess = F.when(F.col("y") > F.col("yhat_upper"), F.col("y") - F.col("yhat_upper")) \
        .when(F.col("y") < F.col("yhat_lower"), F.col("yhat_lower") - F.col("y"))
    return obs.select("ip", "ds", "y", "yhat_lower", "yhat_upper",
                      side.alias("side"), excess.alias("excess")).where(F.col("side").isNotNull())
