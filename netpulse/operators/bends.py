"""One-pass fit of a bent trend times seasonality, from a table of moments.

Model per key: ``y = g(t) (1 + X beta)`` with ``g`` a line that may bend at candidate
points and ``X`` the daily (and weekly) Fourier terms.  Nothing in the fit reads rows
again: time is cut into fixed segments, and one aggregate takes per (key, segment) the
sums of ``{1, t, t^2}`` times the harmonics and of ``{1, t}`` times the Fourier terms
times ``y``.  Products of two Fourier terms are sums of harmonics, so these moments hold
every Gram matrix that the fit needs, whatever the bends and the seasonal weights are:
candidate points lie on segment borders, and ``g`` is a line inside a segment.

The moments of many keys go through numpy together.  The fit alternates: with the
seasonal weights fixed the trend is a regression on hinges, solved by coordinate descent
under a Laplace prior on the changes of slope; with the trend fixed the weights are a
ridge regression.  Whether a key keeps a slope, bends and seasonal terms is decided by
the Bayesian information criterion.  Segments hold sums, so a hot key costs one partial
row per segment and input partition, and a key's row grows with its history in segments.

Sums of ``y`` are taken around each key's own mean after the aggregate, and squares come
from each segment's variance, so a large mean does not cancel the spread.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import epoch_hours
from .forecast import DAILY_ORDER, MEAN_ROUNDING, ORIGIN_HOUR, ROUNDING
from .merge import is_missing

#: Length of a segment; candidate points lie on segment borders.
SEGMENT_HOURS = 24
#: Candidate points per key, over the first part of its history, and the scale of the prior on a
#: change of slope (``y`` in units of its largest value, time in units of the history).
CANDIDATES, CANDIDATE_RANGE, PRIOR_SCALE = 25, 0.8, 0.05
#: Segments solved together in numpy.
SEGMENTS_AT_ONCE = 20_000
MAX_ROUNDS, TOLERANCE = 200, 1e-10

WEEK = 168


# ---------------------------------------------------------------- harmonics and moments

def frequencies(order: int, weekly_order: int = 0) -> list[int]:
    """Frequencies of the Fourier terms in cycles a week: the daily ones, then the weekly ones."""
    return [7 * k for k in range(1, order + 1)] + list(range(1, weekly_order + 1))


def harmonics(order: int, weekly_order: int = 0) -> list[tuple[str, int]]:
    """The harmonics that products of two Fourier terms (or one and 1) are sums of; the first is 1."""
    fs = [0, *frequencies(order, weekly_order)]
    every = sorted({abs(f - g) for f in fs for g in fs} | {f + g for f in fs for g in fs})
    return [("cos", 0)] + [(kind, f) for f in every if f for kind in ("cos", "sin")]


def terms(order: int, weekly_order: int = 0) -> list[tuple[str, int]]:
    """1 and the Fourier terms, in the order of the model table's ``beta_i``."""
    return [("cos", 0)] + [(kind, f) for f in frequencies(order, weekly_order) for kind in ("sin", "cos")]


def products(order: int, weekly_order: int = 0) -> np.ndarray:
    """``[i, j, h]``: the weight of harmonic h in the product of terms i and j."""
    at = {h: i for i, h in enumerate(harmonics(order, weekly_order))}
    xs = terms(order, weekly_order)
    out = np.zeros((len(xs), len(xs), len(at)))
    for i, (a, f) in enumerate(xs):
        for j, (b, g) in enumerate(xs):
            if a == b:
                out[i, j, at["cos", abs(f - g)]] += 0.5
                out[i, j, at["cos", f + g]] += 0.5 if a == "cos" else -0.5
            else:
                s, c = (f, g) if a == "sin" else (g, f)
                out[i, j, at["sin", s + c]] += 0.5
                if s != c:
                    out[i, j, at["sin", abs(s - c)]] += 0.5 if s > c else -0.5
    return out


def _wave(kind: str, f: int, ds: Column) -> Column:
    angle = (F.unix_seconds(ds.cast("timestamp")) % (WEEK * 3600)) * F.lit(2 * math.pi * f / (WEEK * 3600))
    return F.cos(angle) if kind == "cos" else F.sin(angle)


def segment_moments(train: DataFrame, order: int = DAILY_ORDER, weekly_order: int = 0, segment_hours: int = SEGMENT_HOURS,
                    key: str = "ip") -> DataFrame:
    """Moments of the hourly rows ``(key, ds, y)``, one row per key and segment, in one aggregate.

    ``segment`` counts from ``ORIGIN_HOUR``, ``t`` in hours from the segment's start.
    ``s{p}_{h}`` is the sum of ``t^p`` times harmonic h (``s0_0`` the number of rows),
    ``r{p}_{i}`` that of ``t^p`` times Fourier term i times ``y``; ``spread`` the sum of
    squares of ``y`` around the segment's mean, ``top`` its largest size, ``first_t``
    and ``last_t`` its first and last hour since the epoch.  Rows without ``y`` are left out.
    """
    hour = epoch_hours("ds")
    hs, xs = harmonics(order, weekly_order), terms(order, weekly_order)
    rows = train.where(~is_missing("y") & F.col("ds").isNotNull()).select(
        key, F.floor((hour - ORIGIN_HOUR) / segment_hours).alias("segment"), hour.alias("hour"),
        F.pmod(hour - ORIGIN_HOUR, F.lit(segment_hours)).cast("double").alias("t"), F.col("y").cast("double").alias("y"),
        *[_wave(kind, f, F.col("ds")).alias(f"h_{i}") for i, (kind, f) in enumerate(hs) if i])
    at = {h: F.col(f"h_{i}") if i else F.lit(1.0) for i, h in enumerate(hs)}
    t = [F.lit(1.0), F.col("t"), F.col("t") * F.col("t")]
    aggs = [F.sum(t[p] * at[h]).alias(f"s{p}_{i}") for p in range(3) for i, h in enumerate(hs)]
    aggs += [F.sum(t[p] * at[x] * F.col("y")).alias(f"r{p}_{i}") for p in range(2) for i, x in enumerate(xs)]
    return rows.groupBy(key, "segment").agg(
        *aggs, (F.var_pop("y") * F.count("y")).alias("spread"), F.max(F.abs("y")).alias("top"),
        F.min("hour").alias("first_t"), F.max("hour").alias("last_t"))


# ---------------------------------------------------------------- the fit in numpy

class _Moments:
    """The moments of a batch of keys, segments padded with zeros: ``[key, segment, ...]``."""

    def __init__(self, segments: list[np.ndarray], values: list[np.ndarray], order: int, weekly_order: int, segment_hours: int,
                 candidates: int, candidate_range: float):
        n_keys, n_seg = len(segments), max(map(len, segments))
        hs, xs = harmonics(order, weekly_order), terms(order, weekly_order)
        m = np.zeros((n_keys, n_seg, values[0].shape[1]))
        start = np.zeros((n_keys, n_seg))
        for k, (s, v) in enumerate(zip(segments, values, strict=True)):
            m[k, :len(s)], start[k, :len(s)] = v, s * float(segment_hours)
        nh, nx = len(hs), len(xs)
        self.s = m[:, :, :3 * nh].reshape(n_keys, n_seg, 3, nh)
        r = m[:, :, 3 * nh:3 * nh + 2 * nx].reshape(n_keys, n_seg, 2, nx)
        spread, top, first, last = np.moveaxis(m[:, :, 3 * nh + 2 * nx:], 2, 0)
        here = self.s[:, :, 0, 0] > 0
        self.n = self.s[:, :, 0, 0].sum(1)
        self.first = np.where(here, first, np.inf).min(1) - ORIGIN_HOUR
        self.last = np.where(here, last, -np.inf).max(1) - ORIGIN_HOUR
        self.span = np.maximum(self.last - self.first, 1.0)
        self.scale = np.where(top.max(1) > 0, top.max(1), 1.0)
        self.level = r[:, :, 0, 0].sum(1) / self.n
        by_term = self.s[:, :, :2][..., [hs.index(x) for x in xs]]
        self.r = (r - self.level[:, None, None, None] * by_term) / self.scale[:, None, None, None]
        mean = np.divide(r[:, :, 0, 0], self.s[:, :, 0, 0], out=np.zeros_like(start), where=here)
        square = spread + np.where(here, self.s[:, :, 0, 0] * (mean - self.level[:, None]) ** 2, 0.0)
        self.yy = square.sum(1) / self.scale ** 2
        self.lift = self.level / self.scale
        self.x_at = [hs.index(x) for x in xs]
        self.products = products(order, weekly_order)
        # candidate points: segment starts inside the first part of the history, evenly chosen
        self.points = np.full((n_keys, candidates), np.inf)
        self.n_points = np.zeros(n_keys, int)
        for k, s in enumerate(segments):
            at = np.arange(s.min(), s.max() + 1) * float(segment_hours)
            at = at[(at > self.first[k]) & (at <= self.first[k] + candidate_range * self.span[k])]
            if len(at) > candidates:
                at = at[np.round(np.linspace(0, len(at) - 1, candidates)).astype(int)]
            self.points[k, :len(at)] = at
            self.n_points[k] = len(at)
        # the trend's basis (1, t, hinges; t from 0 to 1 over the history) is a + b t inside a segment
        unit = (1 / self.span)[:, None, None]
        past = np.maximum(start[:, :, None] - np.where(np.isinf(self.points), 0, self.points)[:, None, :], 0)
        open_ = (self.points[:, None, :] <= start[:, :, None]) & here[:, :, None]
        one = here[:, :, None].astype(float)
        self.a = np.concatenate([one, (start - self.first[:, None])[:, :, None] * unit * one, np.where(open_, past * unit, 0)], 2)
        self.b = np.concatenate([0 * one, unit * one, np.where(open_, unit, 0)], 2)

    def take(self, keys: np.ndarray) -> _Moments:
        """The moments of some of the keys."""
        part = copy.copy(self)
        for name, v in vars(self).items():
            if isinstance(v, np.ndarray) and name != "products":
                setattr(part, name, v[keys])
        return part

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """``[key, segment, p]``: sums of t^p times the harmonics with these weights ``[key, harmonic]``."""
        k, s, p, h = self.s.shape
        return (self.s.reshape(k, s * p, h) @ weights[:, :, None]).reshape(k, s, p)

    def with_y(self, f: np.ndarray) -> np.ndarray:
        """``[key, segment, p]``: sums of t^p times ``y`` times a combination ``[key, term]`` of the terms."""
        k, s, p, j = self.r.shape
        return (self.r.reshape(k, s * p, j) @ f[:, :, None]).reshape(k, s, p)

    def squares(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Harmonic weights of the product of two combinations ``[key, term]`` of the terms."""
        return (u[:, :, None] * v[:, None, :]).reshape(len(u), -1) @ self.products.reshape(-1, self.products.shape[2])


def _factor(m: _Moments, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The seasonal factor and the factor less 1, as combinations of the terms."""
    swing = np.concatenate([np.zeros((len(m.n), 1)), beta], 1)
    one = np.zeros_like(swing)
    one[:, 0] = 1
    return one + swing, swing


def _line(m: _Moments, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trend around the mean as ``a + b t`` inside each segment."""
    return (m.a @ theta[:, :, None])[:, :, 0], (m.b @ theta[:, :, None])[:, :, 0]


def _residual(m: _Moments, theta: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Sum of squared residuals."""
    f, f1 = _factor(m, beta)
    (a, b), lift = _line(m, theta), m.lift[:, None]
    ff, ff1, f11 = (m.sums(m.squares(u, v)) for u, v in ((f, f), (f, f1), (f1, f1)))
    fy, f1y = m.with_y(f), m.with_y(f1)
    vy = (a * fy[:, :, 0] + b * fy[:, :, 1] + lift * f1y[:, :, 0]).sum(1)
    vv = (a ** 2 * ff[:, :, 0] + 2 * a * b * ff[:, :, 1] + b ** 2 * ff[:, :, 2]
          + 2 * lift * (a * ff1[:, :, 0] + b * ff1[:, :, 1]) + lift ** 2 * f11[:, :, 0]).sum(1)
    return np.maximum(m.yy - 2 * vy + vv, 0.0)


def _trend_equations(m: _Moments, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normal equations of the trend with the seasonal weights fixed."""
    f, f1 = _factor(m, beta)
    q, u = m.sums(m.squares(f, f)), m.sums(m.squares(f, f1))
    fy = m.with_y(f) - m.lift[:, None, None] * u[:, :, :2]
    at, bt = np.swapaxes(m.a, 1, 2), np.swapaxes(m.b, 1, 2)
    gram = at @ (m.a * q[:, :, :1] + m.b * q[:, :, 1:2]) + bt @ (m.a * q[:, :, 1:2] + m.b * q[:, :, 2:])
    return gram, (at @ fy[:, :, :1] + bt @ fy[:, :, 1:2])[:, :, 0]


def _straight(gram: np.ndarray, rhs: np.ndarray, used: int) -> np.ndarray:
    """The trend from its first ``used`` functions alone."""
    out = np.zeros_like(rhs)
    damped = gram[:, :used, :used] + 1e-13 * np.eye(used) * gram[:, :1, :1]
    out[:, :used] = np.linalg.solve(damped, rhs[:, :used, None])[:, :, 0]
    return out


def _without_line(gram: np.ndarray, rhs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equations of the hinges once mean and slope are solved for; and the solution for those two."""
    base, c = gram[:, :2, :2] + 1e-13 * np.eye(2) * gram[:, :1, :1], gram.shape[1] - 2
    to_base = np.linalg.solve(base, np.concatenate([gram[:, :2, 2:], rhs[:, :2, None]], 2))
    cross = np.swapaxes(gram[:, :2, 2:], 1, 2)
    return gram[:, 2:, 2:] - cross @ to_base[:, :, :c], rhs[:, 2:] - (cross @ to_base[:, :, c:])[:, :, 0], to_base


def _shrink(gram: np.ndarray, rhs: np.ndarray, penalty: np.ndarray, start: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """Coordinate descent for ``theta' G theta / 2 - rhs' theta + penalty sum |theta_2..|`` of every key at once.

    A round of the alternation goes on where the last one stopped, so few sweeps a round are enough.
    """
    c = gram.shape[1] - 2
    left, want, to_base = _without_line(gram, rhs)
    size = np.einsum("kcc->ck", left).copy()
    usable = size > 1e-12 * np.maximum(np.einsum("kcc->ck", gram[:, 2:, 2:]), 1e-300)
    size = np.where(usable, size, 1.0)
    left, want = np.ascontiguousarray(left.transpose(1, 2, 0)), np.ascontiguousarray(want.T)  # the keys side by side
    delta = np.where(usable, start[:, 2:].T, 0.0)
    for _ in range(sweeps):
        moved = 0.0
        for i in range(c):
            rho = want[i] - (left[i] * delta).sum(0) + size[i] * delta[i]
            new = np.where(usable[i], np.sign(rho) * np.maximum(np.abs(rho) - penalty, 0) / size[i], 0.0)
            moved = max(moved, float(np.abs(new - delta[i]).max()))
            delta[i] = new
        if moved <= 1e-8 * (1 + np.abs(delta).max()):
            break
    delta = delta.T
    return np.concatenate([to_base[:, :, c] - (to_base[:, :, :c] @ delta[:, :, None])[:, :, 0], delta], 1)


def _weights(m: _Moments, theta: np.ndarray, ridge: float) -> np.ndarray:
    """The seasonal weights with the trend fixed."""
    (a, b), lift = _line(m, theta), m.lift[:, None]
    g = a + lift
    h = ((g ** 2)[:, None] @ m.s[:, :, 0] + (2 * g * b)[:, None] @ m.s[:, :, 1] + (b ** 2)[:, None] @ m.s[:, :, 2])[:, 0]
    xx = (h @ m.products.reshape(-1, h.shape[1]).T).reshape(len(h), *m.products.shape[:2])[:, 1:, 1:]
    gg = ((g * a)[:, None] @ m.s[:, :, 0] + (b * (g + a))[:, None] @ m.s[:, :, 1] + (b ** 2)[:, None] @ m.s[:, :, 2])[:, 0]
    xr = (g[:, None] @ m.r[:, :, 0] + b[:, None] @ m.r[:, :, 1])[:, 0] - gg[:, m.x_at]
    damp = np.maximum(ridge * (m.yy / m.n + m.lift ** 2), 1e-12)[:, None, None] * np.eye(xx.shape[1])
    return np.linalg.solve(xx + damp, xr[:, 1:, None])[:, :, 0]


def _alternate(whole: _Moments, kind: str, seasonal: bool, ridge: float, prior: float, theta: np.ndarray | None = None,
               beta: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trend weights, seasonal weights and sum of squared residuals of one form of the model, in scaled ``y``.

    Starts from ``theta`` and ``beta`` if given.  Keys that stand still leave the work.
    """
    n_keys, tolerance = len(whole.n), TOLERANCE if kind != "bent" else 1e-7
    theta = np.zeros((n_keys, whole.a.shape[2])) if theta is None else theta.copy()
    beta = np.zeros((n_keys, len(whole.x_at) - 1)) if beta is None else beta.copy()
    m, active = whole, np.arange(n_keys)
    for _ in range(MAX_ROUNDS):
        th, be = theta[active], beta[active]
        gram, rhs = _trend_equations(m, be)
        if kind == "bent":
            new = _shrink(gram, rhs, _residual(m, th, be) / m.n / prior, th)
        else:
            new = _straight(gram, rhs, {"flat": 1, "line": 2}[kind])
        weights = _weights(m, new, ridge) if seasonal else be
        moved = np.maximum(np.abs(new - th).max(1), np.abs(weights - be).max(1, initial=0))
        theta[active], beta[active] = new, weights
        goes_on = moved > tolerance
        if not (seasonal or kind == "bent") or not goes_on.any():
            break
        if goes_on.mean() < 0.8:
            m, active = m.take(goes_on), active[goes_on]
    return theta, beta, _residual(whole, theta, beta)


def _may_bend(m: _Moments, beta: np.ndarray, sse: np.ndarray, prior: float) -> np.ndarray:
    """Keys whose straight fit is not already the solution with bends.

    It is where no hinge's pull on the residuals exceeds the penalty: the optimality
    condition of the penalised fit at no bends.
    """
    _, want, _ = _without_line(*_trend_equations(m, beta))
    return np.abs(want).max(1, initial=0) > sse / m.n / prior


def _fit_batch(m: _Moments, trend: str, seasonality: bool | str, ridge: float, prior: float) -> dict[str, np.ndarray]:
    kinds = {"auto": ["flat", "line", "bent"], "linear": ["line"], "flat": ["flat"], "bent": ["line", "bent"],
             "straight": ["flat", "line"]}[trend]
    n_keys, n_beta = len(m.n), len(m.x_at) - 1
    best: dict[str, np.ndarray] = {}
    none = ROUNDING * m.yy + m.n * (MEAN_ROUNDING * m.lift) ** 2
    lines: dict[bool, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    forms = [(kind, seasonal) for kind in kinds for seasonal in ([False, True] if seasonality == "auto" else [bool(seasonality)])]
    for kind, seasonal in forms:  # the simpler forms first
        if kind == "bent":  # only where bends can enter, from the straight fit on
            theta, beta, sse = (x.copy() for x in lines[seasonal])
            may = _may_bend(m, beta, sse, prior)
            if not seasonal and best:  # a key with a rhythm is not bent without it
                may &= ~best["season"]
            keys = np.flatnonzero(may)
            if len(keys):
                theta[keys], beta[keys], sse[keys] = _alternate(m.take(keys), kind, seasonal, ridge, prior, theta[keys], beta[keys])
        else:
            theta, beta, sse = lines[seasonal] = _alternate(m, kind, seasonal, ridge, prior)
        if trend == "bent" and kind == "line":
            continue
        sse = np.where(sse <= none, 0.0, sse)
        # a bend has a place and a size
        p = (1 if kind == "flat" else 2) + 2 * (theta[:, 2:] != 0).sum(1) + n_beta * seasonal
        with np.errstate(divide="ignore"):
            cost = m.n * np.log(np.maximum(sse, np.maximum(none, 1e-300)) / m.n) + p * np.log(m.n)
        if best:  # more weights than points can carry never win over a simpler form
            cost = np.where((p + 2 >= m.n) & (p > 1), np.inf, cost)
        this = {"theta": theta, "beta": beta, "sse": sse, "p": p, "cost": cost, "season": np.full(n_keys, seasonal),
                "slope": np.full(n_keys, kind != "flat")}
        if not best:
            best = this
        else:
            wins = cost < best["cost"] - 1e-9
            best = {c: np.where(wins.reshape(-1, *[1] * (v.ndim - 1)), this[c], v) for c, v in best.items()}
    return best


def fit(train: DataFrame, seasonality: bool | str = "auto", order: int = DAILY_ORDER, ridge: float = 1.0, key: str = "ip",
        trend: str = "auto", weekly_order: int = 0, segment_hours: int = SEGMENT_HOURS, candidates: int = CANDIDATES,
        candidate_range: float = CANDIDATE_RANGE, prior_scale: float = PRIOR_SCALE) -> DataFrame:
    """Model table of a bent trend times seasonality; ``train`` is read once.

    ``trend``: ``"auto"`` chooses per key between the mean, a line and a line with
    bends, ``"straight"`` between the first two; ``"flat"``, ``"linear"`` and ``"bent"``
    take one.  ``seasonality`` as in ``forecast.fit``; ``ridge`` counts in rows of the
    mean square of ``y``.  Candidate points are the segment borders in the first
    ``candidate_range`` of a key's history, at most ``candidates`` of them.

    Columns are those of ``forecast.fit`` and the bends: ``cp_t`` (hours since the
    epoch) and ``cp_delta`` (change of slope per hour); ``bend_rate`` (candidate points
    per hour) and ``bend_scale`` (mean size of a change over all candidates), from which
    ``forecast.predict`` widens the band beyond ``last_t``.  Fewer than two points give
    ``status = 'insufficient_history'``.
    """
    moments = segment_moments(train, order, weekly_order, segment_hours, key)
    names = [c for c in moments.columns if c not in (key, "segment")]
    nested = moments.groupBy(key).agg(F.sort_array(F.collect_list(
        F.struct("segment", F.array(*[F.col(c).cast("double") for c in names]).alias("m")))).alias("segments"))
    m_beta = 2 * (order + weekly_order)
    schema = T.StructType(
        [T.StructField(key, train.schema[key].dataType), T.StructField("n", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in ("mean_t", "mean_y", "slope", "sse", "sigma")]
        + [T.StructField(f"beta_{i}", T.DoubleType()) for i in range(m_beta)]
        + [T.StructField("trend_kept", T.BooleanType()), T.StructField("season_kept", T.BooleanType()), T.StructField("status", T.StringType()),
           T.StructField("cp_t", T.ArrayType(T.DoubleType())), T.StructField("cp_delta", T.ArrayType(T.DoubleType()))]
        + [T.StructField(c, T.DoubleType()) for c in ("bend_rate", "bend_scale", "last_t")])
    width = len(names)

    def rows(keys: pa.Array, segments: list[np.ndarray], values: list[np.ndarray]) -> pa.RecordBatch:
        m = _Moments(segments, values, order, weekly_order, segment_hours, candidates, candidate_range)
        best = _fit_batch(m, trend, seasonality, ridge, prior_scale)
        delta = best["theta"][:, 2:] * (m.scale / m.span)[:, None]
        bent = (delta != 0).any(1)
        dof = m.n - best["p"]
        sigma = np.where(dof > 0, np.sqrt(best["sse"] / np.maximum(dof, 1)) * m.scale, np.nan)
        data = {
            key: keys, "n": m.n.astype(np.int64), "mean_t": m.first + ORIGIN_HOUR, "mean_y": m.level + best["theta"][:, 0] * m.scale,
            "slope": best["theta"][:, 1] * m.scale / m.span, "sse": best["sse"] * m.scale ** 2,
            "sigma": pa.array(sigma, pa.float64(), mask=np.isnan(sigma)), **{f"beta_{i}": best["beta"][:, i] for i in range(m_beta)},
            "trend_kept": best["slope"], "season_kept": best["season"], "status": np.where(m.n < 2, "insufficient_history", "ok"),
            "cp_t": [(m.points[k][delta[k] != 0] + ORIGIN_HOUR).tolist() for k in range(len(m.n))],
            "cp_delta": [delta[k][delta[k] != 0].tolist() for k in range(len(m.n))],
            "bend_rate": np.where(bent, m.n_points / m.span, 0.0),
            "bend_scale": np.abs(delta).sum(1) / np.maximum(m.n_points, 1), "last_t": m.last + ORIGIN_HOUR}
        return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, to_arrow_type(schema[c].dataType))
                                           for c, v in data.items()], names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            parts = lists.flatten()
            cuts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            segment = parts.field(0).to_numpy()
            values = parts.field(1).flatten().to_numpy().reshape(-1, width)
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + SEGMENTS_AT_ONCE, side="right")) - 1)
                yield rows(b.column(0).slice(lo, hi - lo), [segment[cuts[k]:cuts[k + 1]] for k in range(lo, hi)],
                           [values[cuts[k]:cuts[k + 1]] for k in range(lo, hi)])
                lo = hi

    return nested.mapInArrow(solve, schema).select("*", F.lit(order).alias("order"), F.lit(weekly_order).alias("weekly_order"))
