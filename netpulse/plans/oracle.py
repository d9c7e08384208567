"""Reference SQL for the registered queries (DuckDB dialect, over the driver's
tables).  Each string must give the same rows as the Spark query of the same
name.  Streaming, model-fitting and sampling queries whose result is not a
SQL expression (``forecast_job``, ``gbt_predict``) have none.
"""

from __future__ import annotations

import math

from ..operators.forecast import MEAN_ROUNDING, ORIGIN_HOUR, ROUNDING
from ..schema import METRICS
from .queries import (CUTOFF, HORIZON, LONG_HORIZON, MALFORMED_EVERY, NEW_TRAINING_DATE, OLD_TRAINING_DATE, RANGE_END,
                      MAX_ONEHOT_KEYS, RANGE_START, SALT, SPLIT_CUTOFF, TAIL_N)

Z95 = "1.959963984540054"

LOGS = """
ev AS (
  SELECT event_id, user_id, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS a,
         CAST(round(value * 100) AS BIGINT) AS bin
  FROM events),
logs AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS src_ip, k AS unq_dst_ip, a AS allow, 1 - a AS "drop",
         a + (1 - a) AS frequency, k + a AS pkts_sent, k + (1 - a) AS pkts_received,
         bin AS bytesin, bin * (k + 1) AS bytesout, k % 5 AS unq_dst_port, ts AS "timestamp"
  FROM ev)"""

METRIC_COLS = ['"drop"' if m == "drop" else m for m in METRICS]  # drop is a keyword

LONG = """
long AS (
  SELECT event_id, src_ip, "timestamp", data_type, value FROM (
    SELECT event_id, src_ip, "timestamp", {casts} FROM logs)
  UNPIVOT (value FOR data_type IN ({names}))),
series AS (
  SELECT src_ip AS ip, data_type, date_trunc('hour', "timestamp") AS ds,
         arg_min(value, event_id) AS value, min(event_id) AS arrival
  FROM long GROUP BY 1, 2, 3)""".format(
    casts=", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in METRIC_COLS),
    names=", ".join(METRIC_COLS))

REGISTRY = """
registry AS (SELECT CAST(c_custkey AS VARCHAR) AS src_ip FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')"""

PMAP = REGISTRY + """,
pmap AS (
  SELECT src_ip, CAST(row_number() OVER (ORDER BY first_id, src_ip) - 1 AS INTEGER) AS "partition"
  FROM (SELECT src_ip, min(event_id) AS first_id FROM logs
        WHERE src_ip IN (SELECT src_ip FROM registry) GROUP BY src_ip))"""


def _train(before: str | None = None, name: str = "train", metric: str = "unq_dst_ip") -> str:
    where = f"""WHERE "timestamp" < TIMESTAMP '{before}'""" if before else ""
    return f"""
{name} AS (
  SELECT src_ip AS ip, date_trunc('hour', "timestamp") AS ds, CAST(sum({metric}) AS DOUBLE) AS y
  FROM logs {where} GROUP BY 1, 2)"""


def _trend(train: str = "train", p: str = "") -> str:
    """Trend parameters ``{p}params`` from ``train``."""
    return f"""
{p}levels AS (SELECT ip, floor(avg(y)) AS level FROM {train} WHERE y IS NOT NULL GROUP BY ip),
{p}stats AS (
  SELECT ip, any_value(level) AS level, count(*) AS n, CAST(sum(t) AS BIGINT) AS st, CAST(sum(t * t) AS BIGINT) AS stt,
         sum(y) AS sy, sum(t * y) AS sty, sum(y * y) AS syy
  FROM (SELECT ip, level, y - level AS y, CAST(floor(epoch(ds) / 3600) AS BIGINT) - {ORIGIN_HOUR} AS t
        FROM {train} JOIN {p}levels USING (ip) WHERE y IS NOT NULL)
  GROUP BY ip),
{p}p0 AS (
  SELECT *, CAST(CAST(n AS HUGEINT) * stt - CAST(st AS HUGEINT) * st AS DOUBLE) AS den,
         n * sty - st * sy AS num
  FROM {p}stats),
{p}p1 AS (
  SELECT *, {ORIGIN_HOUR} + st / n AS mean_t, level + sy / n AS mean_y, CASE WHEN den > 0 THEN num / den ELSE 0.0 END AS ols_slope
  FROM {p}p0),
{p}p2 AS (SELECT *, (n * syy - sy * sy) / n AS flat0, {ROUNDING} * syy + n * pow({MEAN_ROUNDING} * mean_y, 2) AS none FROM {p}p1),
{p}p3 AS (
  SELECT *, CASE WHEN flat0 <= none THEN 0.0 ELSE flat0 END AS sse_flat,
         CASE WHEN flat0 - ols_slope * num / n <= none THEN 0.0 ELSE flat0 - ols_slope * num / n END AS sse_line
  FROM {p}p2),
{p}p4 AS (
  SELECT *, CASE WHEN n <= 2 OR sse_flat <= 0 THEN false WHEN sse_line <= 0 THEN true
                 ELSE n * ln(sse_flat / sse_line) > ln(n) END AS trend_kept
  FROM {p}p3),
{p}p5 AS (
  SELECT *, CASE WHEN trend_kept THEN sse_line ELSE sse_flat END AS sse,
         CASE WHEN trend_kept THEN n - 2 ELSE n - 1 END AS dof
  FROM {p}p4),
{p}params AS (
  SELECT ip, level, n, st, stt, sy, sty, syy, mean_t, mean_y, ols_slope, trend_kept,
         CASE WHEN trend_kept THEN ols_slope ELSE 0.0 END AS slope, sse,
         CASE WHEN dof > 0 THEN sqrt(greatest(sse, 0.0) / dof) END AS sigma,
         CASE WHEN n < 2 THEN 'insufficient_history' ELSE 'ok' END AS status
  FROM {p}p5)"""


def _grid(train: str = "train", p: str = "", horizon: int = HORIZON) -> str:
    """History plus the business-hours-rolled future grid ``{p}grid``."""
    return f"""
{p}last AS (SELECT ip, max(ds) AS last_ds FROM {train} GROUP BY ip),
{p}fut AS (
  SELECT ip, unnest(generate_series(last_ds + INTERVAL 1 HOUR, last_ds + INTERVAL {horizon} HOUR,
                                    INTERVAL 1 HOUR)) AS ds
  FROM {p}last),
{p}fb AS (SELECT ip, min(CASE WHEN hour(ds) > 18 THEN ds END) AS fb FROM {p}fut GROUP BY ip),
{p}rolled AS (
  SELECT f.ip, f.ds AS base_ds,
         CASE WHEN f.ds >= b.fb THEN date_trunc('day', b.fb) + (f.ds - date_trunc('hour', f.ds))
                + to_days(CAST(1 + (date_diff('hour', b.fb, f.ds) // 11) AS INTEGER))
                + to_hours(CAST(8 + date_diff('hour', b.fb, f.ds) % 11 AS BIGINT)) ELSE f.ds END AS ds
  FROM {p}fut f JOIN {p}fb b ON f.ip = b.ip),
{p}grid AS (
  SELECT ip, ds, y FROM {train}
  UNION ALL SELECT ip, ds, CAST(NULL AS DOUBLE) AS y FROM {p}rolled)"""


def _forecast(train: str, training_date: str, p: str = "", horizon: int = HORIZON) -> str:
    """Trend-only forecast table ``{p}fc``."""
    return _trend(train, p) + "," + _grid(train, p, horizon) + f""",
{p}pred AS (
  SELECT g.ds, g.ip, g.y,
         q.mean_y + q.slope * (CAST(floor(epoch(g.ds) / 3600) AS BIGINT) - q.mean_t) AS yhat, q.sigma
  FROM {p}grid g LEFT JOIN {p}params q ON g.ip = q.ip AND q.status = 'ok'),
{p}fc AS (
  SELECT ds, ip, y, yhat, yhat + ({Z95} * sigma) AS yhat_upper, yhat - ({Z95} * sigma) AS yhat_lower,
         DATE '{training_date}' AS training_date
  FROM {p}pred)"""


def _harmonics(order: int) -> list[str]:
    day = "(epoch(ds) / 86400.0)"
    return [f"{f}({day} * {2.0 * math.pi * k!r})" for k in range(1, order + 1) for f in ("sin", "cos")]


def _seasonal_sums(order: int) -> str:
    m = 2 * order
    sums = [f"round(sum(x_{i} * x_{j}), 6) AS xx_{i}_{j}" for i in range(m) for j in range(i, m)]
    sums += [f"round(sum(x_{i} * r), 6) AS xr_{i}" for i in range(m)]
    return f""",
g AS (SELECT ip, ds, y, mean_y + slope * (CAST(floor(epoch(ds) / 3600) AS BIGINT) - mean_t) AS g
      FROM train JOIN params USING (ip) WHERE status = 'ok'),
x AS (SELECT ip, y / g - 1 AS r, {", ".join(f"{h} AS x_{i}" for i, h in enumerate(_harmonics(order)))} FROM g WHERE abs(g) > 1e-9)
SELECT ip, count(*) AS nr, round(sum(r * r), 6) AS rr, {", ".join(sums)} FROM x GROUP BY ip"""


def _seasonal_fixed() -> str:
    k = "CAST(ip AS BIGINT)"
    xb = " + ".join(f"{h} * (({k} % {i + 3} - 1) / {10.0 * (i + 1)}::DOUBLE)" for i, h in enumerate(_harmonics(4)))
    return f""",
f AS (SELECT ip, ds, y, (50 + {k} % 7 + ({k} % 5) / 100.0::DOUBLE * (CAST(floor(epoch(ds) / 3600) AS BIGINT) - {ORIGIN_HOUR})) * (1 + {xb}) AS v,
      {Z95} * (1 + {k} % 3) AS band FROM grid)
SELECT ip, ds, y, round(v, 6) AS yhat, round(v + band, 6) AS yhat_upper, round(v - band, 6) AS yhat_lower FROM f"""


def _moments() -> str:
    """Order 1: harmonics 1, cos and sin of one and two cycles a day; terms 1, sin, cos of one cycle."""
    angle = "(CAST(epoch(ds) AS BIGINT) % 604800) * (2 * pi() * {f} / 604800)"
    waves = ["1"] + [f"{w}({angle.format(f=f)})" for f in (7, 14) for w in ("cos", "sin")]
    hs = ", ".join(f"{w} AS h_{i}" for i, w in enumerate(waves))
    sums = [f"round(sum({'t * ' * p}h_{i}), 6) + 0.0 AS s{p}_{i}" for p in range(3) for i in range(5)]
    sums += [f"round(sum({'t * ' * p}h_{h} * y), 6) + 0.0 AS r{p}_{i}" for p in range(2) for i, h in enumerate((0, 2, 1))]
    return f""",
h AS (SELECT ip, y, hour, floor((hour - {ORIGIN_HOUR}) / 24)::BIGINT AS segment,
             (((hour - {ORIGIN_HOUR}) % 24 + 24) % 24)::DOUBLE AS t, {hs}
      FROM (SELECT *, CAST(floor(epoch(ds) / 3600) AS BIGINT) AS hour FROM train) WHERE y IS NOT NULL)
SELECT ip, segment, {", ".join(sums)}, round(var_pop(y) * count(*), 6) + 0.0 AS spread, max(abs(y)) + 0.0 AS top,
       min(hour) AS first_t, max(hour) AS last_t FROM h GROUP BY ip, segment"""


def _changepoint_fixed() -> str:
    k = "CAST(ip AS BIGINT)"
    h = _harmonics(1)
    return f""",
p AS (SELECT *, {k} AS k, CAST(floor(epoch(ds) / 3600) AS BIGINT) - {ORIGIN_HOUR} AS t FROM grid),
f AS (SELECT *, 50 + k % 7 + (k % 5) / 100.0::DOUBLE * t + ((k % 3) - 1) / 20.0::DOUBLE * greatest(t - 24 * (5 + k % 4), 0)
             + ((k % 4) - 2) / 25.0::DOUBLE * greatest(t - 24 * (15 + k % 5), 0) AS g,
             1 + {h[0]} * ((k % 4) / 20.0::DOUBLE) + {h[1]} * ((k % 3) / -10.0::DOUBLE) AS f,
             greatest(t - 600, 0)::DOUBLE AS ahead, (k % 6) / 200.0::DOUBLE AS scale FROM p),
b AS (SELECT *, {Z95} * sqrt((1 + k % 3) * (1 + k % 3) + 25 / 744.0::DOUBLE * 2 * scale * scale * ahead * ahead * ahead / 3 * f * f) AS band FROM f)
SELECT ip, ds, y, round(g * f, 6) AS yhat, round(g * f + band, 6) AS yhat_upper, round(g * f - band, 6) AS yhat_lower FROM b"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


DECODED_FIELDS = ["src_ip", "timestamp", *METRICS]


def _decoded_select() -> str:
    bad = f"event_id % {MALFORMED_EVERY} = 0"
    cols = []
    for f in DECODED_FIELDS:
        q = f'"{f}"'
        if f == "timestamp":
            expr = f"""strftime("timestamp", '%Y-%m-%d %H:%M:%S')"""
        else:
            expr = f"CAST({q} AS VARCHAR)"
        cols.append(f"CASE WHEN {bad} THEN NULL ELSE {expr} END AS {q}")
    return "SELECT CAST(event_id AS VARCHAR) AS key, " + ", ".join(cols) + " FROM logs"


TYPED_SECONDS = ('SELECT event_id, src_ip, unq_dst_ip, allow, "drop", frequency, pkts_sent, pkts_received, '
                 'bytesin, bytesout, unq_dst_port, date_trunc(\'second\', "timestamp") AS "timestamp" FROM logs')


def _pseudo_select() -> str:
    h = f"sha256('{SALT}' || '|0|' || src_ip)"
    octs = [f"CAST(CAST(('0x' || substr({h}, {1 + 2 * i}, 2)) AS INTEGER) AS VARCHAR)" for i in range(4)]
    return "SELECT event_id, " + " || '.' || ".join(octs) + " AS src_ip FROM logs"


ORACLE_SQL: dict[str, str] = {
    # sources
    "decode_json_payload": _with(LOGS) + _decoded_select(),
    "avg_tolerant": _with(LOGS) + f"""
SELECT CASE WHEN event_id % {MALFORMED_EVERY} = 0 THEN NULL ELSE src_ip END AS src_ip,
       avg(CASE WHEN event_id % {MALFORMED_EVERY} = 0 THEN NULL ELSE CAST(unq_dst_ip AS DOUBLE) END) AS avg_unq_dst_ip
FROM logs GROUP BY 1""",
    "csv_typed_roundtrip": _with(LOGS) + TYPED_SECONDS,
    "rows_to_json": _with(LOGS) + TYPED_SECONDS,
    "json_documents": _with(LOGS) + TYPED_SECONDS,
    "series_range": _with(LOGS, LONG) + f"""
SELECT ip, data_type, ds, value FROM series
WHERE data_type = 'unq_dst_ip' AND ds BETWEEN TIMESTAMP '{RANGE_START}' AND TIMESTAMP '{RANGE_END}'""",
    # sinks
    "append_new_only": _with(LOGS, LONG) + f"""
SELECT ip, CAST(epoch(ds) AS BIGINT) AS ds, CAST(value AS BIGINT) AS unq_dst_ip FROM series
WHERE data_type = 'unq_dst_ip' AND ds >= TIMESTAMP '{CUTOFF}'""",
    "history_cycle": _with(LOGS, _train()) + "SELECT ip, ds, y FROM train",
    "processor_retained": _with(LOGS, LONG) + "SELECT ip, data_type, ds, value FROM series",
    "series_range_after_retention": _with(LOGS, LONG) + f"""
SELECT ip, data_type, ds, value FROM series WHERE ds BETWEEN TIMESTAMP '{RANGE_START}' AND TIMESTAMP '{RANGE_END}'
  AND (data_type = 'bytesin' OR data_type = 'unq_dst_ip' AND ds > TIMESTAMP '{CUTOFF}')""",
    "history_append": _with(LOGS, _train()) + "SELECT ip, ds, y FROM train",
    "route_to_partition": _with(LOGS, PMAP) + """
SELECT l.event_id, l.src_ip, p."partition" FROM logs l JOIN pmap p ON l.src_ip = p.src_ip""",
    "unrouted_rows": _with(LOGS, PMAP) + """
SELECT event_id, src_ip FROM logs WHERE src_ip NOT IN (SELECT src_ip FROM pmap)""",
    "series_retain": _with(LOGS, LONG) + f"""
SELECT ip, data_type, ds, value FROM series WHERE ds > TIMESTAMP '{CUTOFF}'""",
    # projections / scalar functions
    "filter_allowlist": _with(LOGS) + """
SELECT event_id, src_ip, unq_dst_ip FROM logs
WHERE src_ip IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "pseudonymize": _with(LOGS) + _pseudo_select(),
    "series_key": _with(LOGS, LONG) + """
SELECT DISTINCT data_type || '_' || src_ip AS series_key, src_ip AS label_srcIP, data_type AS label_dataType
FROM long""",
    "unpivot_metrics": _with(LOGS, LONG) + "SELECT event_id, src_ip, \"timestamp\", data_type, value FROM long",
    "first_write_wins": _with(LOGS, LONG) + "SELECT ip, data_type, ds, value, arrival FROM series",
    "series_collect": _with(LOGS, LONG) + """
SELECT ip, data_type, date_trunc('day', ds) AS chunk_start, count(*) AS n_samples, min(ds) AS first_ds,
       arg_max(value, ds) AS last_value
FROM series GROUP BY 1, 2, 3""",
    "series_explode": _with(LOGS, LONG) + "SELECT ip, data_type, ds, value FROM series",
    "to_epoch": _with(LOGS) + """
SELECT event_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS ts_text,
       CAST(epoch(date_trunc('second', "timestamp")) AS BIGINT) AS epoch FROM logs""",
    "from_epoch": _with(LOGS) + """SELECT event_id, date_trunc('second', "timestamp") AS ds FROM logs""",
    "add_hours": _with(LOGS) + f"""SELECT event_id, "timestamp" + INTERVAL {HORIZON} HOUR AS ds FROM logs""",
    "run_stamp": _with(LOGS) + """SELECT event_id, strftime("timestamp", '%y%m%d_%H%M') AS stamp FROM logs""",
    "future_grid": _with(LOGS, _train(), _grid()) + "SELECT ip, ds FROM fut",
    "business_hours_roll": _with(LOGS, _train(), _grid()) + "SELECT ip, base_ds, ds, CAST(hour(ds) AS INTEGER) AS hour FROM rolled",
    # aggregates
    "avg_by_key": _with(LOGS) + "SELECT src_ip, avg(unq_dst_ip) AS avg_unq_dst_ip FROM logs GROUP BY src_ip",
    "sum_by_key_hour": _with(LOGS, _train()) + "SELECT ip, ds, y FROM train ORDER BY ip, ds",
    "distinct_keys": _with(LOGS) + "SELECT DISTINCT src_ip FROM logs",
    "forecast_count_by_key": _with(LOGS, _train(), _forecast("train", NEW_TRAINING_DATE)) + """
SELECT ip, count(*) AS n_rows FROM fc GROUP BY ip""",
    "regression_metrics": _with(LOGS, _train()) + """
, lagged AS (SELECT ip, y, lag(y) OVER (PARTITION BY ip ORDER BY ds) AS y_prev FROM train)
SELECT ip, count(*) AS n, sqrt(sum((y - y_prev) * (y - y_prev)) / count(*)) AS rmse,
       sum(abs(y - y_prev)) / count(*) AS mae
FROM lagged WHERE y IS NOT NULL AND y_prev IS NOT NULL GROUP BY ROLLUP (ip)""",
    "trend_fit_bytesout": _with(LOGS, _train(metric="bytesout"), _trend()) + """
SELECT ip, n, round(mean_t, 6) AS mean_t, round(mean_y, 3) AS mean_y, round(ols_slope, 3) AS ols_slope, trend_kept,
       round(sigma, 2) AS sigma, status FROM params""",
    "anomaly_flags_bytesout": _with(LOGS, _train(metric="bytesout"), _forecast("train", NEW_TRAINING_DATE)) + """
SELECT ip, ds, y, CASE WHEN y > yhat_upper THEN 'high' ELSE 'low' END AS side,
       round(greatest(y - yhat_upper, yhat_lower - y), 2) AS excess
FROM fc WHERE y IS NOT NULL AND greatest(y - yhat_upper, yhat_lower - y) > 1e-9 * greatest(abs(yhat), 1.0)""",
    "seasonal_sums": _with(LOGS, _train(), _trend()) + _seasonal_sums(2),
    "forecast_long_horizon": _with(LOGS, _train(), _forecast("train", NEW_TRAINING_DATE, horizon=LONG_HORIZON)) + "SELECT * FROM fc",
    "forecast_from_stored_model": _with(LOGS, _train(), _forecast("train", NEW_TRAINING_DATE)) + "SELECT * FROM fc",
    "forecast_moments": _with(LOGS, _train()) + _moments(),
    "forecast_changepoint_fixed": _with(LOGS, _train(), _grid()) + _changepoint_fixed(),
    "forecast_seasonal_fixed": _with(LOGS, _train(), _grid()) + _seasonal_fixed(),
    "encoded_features": _with(LOGS) + """
, idx AS (SELECT src_ip, CAST(row_number() OVER (ORDER BY count(*) DESC, src_ip) - 1 AS DOUBLE) AS ip_num FROM logs GROUP BY src_ip),
lagged AS (SELECT *, lag(unq_dst_ip) OVER (PARTITION BY src_ip ORDER BY "timestamp", event_id) AS prev_unq_dst_ip FROM logs)
SELECT event_id, src_ip, ip_num, prev_unq_dst_ip FROM lagged JOIN idx USING (src_ip) WHERE prev_unq_dst_ip IS NOT NULL""",
    "encoded_features_bounded": _with(LOGS) + f"""
, idx AS (SELECT src_ip, CAST(least(row_number() OVER (ORDER BY count(*) DESC, src_ip) - 1, {MAX_ONEHOT_KEYS}) AS DOUBLE) AS ip_num
          FROM logs GROUP BY src_ip),
lagged AS (SELECT *, lag(unq_dst_ip) OVER (PARTITION BY src_ip ORDER BY "timestamp", event_id) AS prev_unq_dst_ip FROM logs)
SELECT event_id, src_ip, ip_num, prev_unq_dst_ip FROM lagged JOIN idx USING (src_ip) WHERE prev_unq_dst_ip IS NOT NULL""",
    "trend_fit": _with(LOGS, _train(), _trend()) + "SELECT * FROM params",
    "seasonal_index": _with(LOGS, _train()) + """
, by_hour AS (SELECT ip, CAST(hour(ds) AS INTEGER) AS hour, sum(y) AS sy_h, count(*) AS n_h FROM train GROUP BY 1, 2),
overall AS (SELECT ip, sum(y) AS sy, count(*) AS n FROM train GROUP BY 1)
SELECT b.ip, b.hour, b.n_h, CASE WHEN o.sy <> 0 THEN (b.sy_h / b.n_h) / (o.sy / o.n) - 1 END AS "index"
FROM by_hour b JOIN overall o ON b.ip = o.ip""",
    # windows / ordering
    "lag_feature": _with(LOGS) + """
SELECT event_id, src_ip, "timestamp", unq_dst_ip,
       lag(unq_dst_ip) OVER (PARTITION BY src_ip ORDER BY "timestamp", event_id) AS prev_unq_dst_ip
FROM logs""",
    "tail_n_per_key": _with(LOGS, _train()) + f"""
SELECT ip, ds, y FROM (SELECT *, row_number() OVER (PARTITION BY ip ORDER BY ds DESC) AS rn FROM train)
WHERE rn <= {TAIL_N}""",
    "partition_ordinal": _with(LOGS, PMAP) + """SELECT src_ip, "partition" FROM pmap""",
    "preview_top50": _with(LOGS) + """
SELECT event_id, src_ip, "timestamp", unq_dst_ip FROM logs ORDER BY src_ip, "timestamp", event_id LIMIT 50""",
    "registered_only": _with(LOGS, LONG, REGISTRY) + """
SELECT ip, data_type, ds, value FROM series WHERE ip IN (SELECT src_ip FROM registry)""",
    # forecast
    "forecast_table": _with(LOGS, _train(), _forecast("train", NEW_TRAINING_DATE)) + "SELECT * FROM fc",
    "forecast_relabel": _with(LOGS, _train(), _trend(), _grid()) + f"""
, rgrid AS (SELECT ip, ds, y, ds AS at_ds FROM train
            UNION ALL SELECT ip, ds, CAST(NULL AS DOUBLE) AS y, base_ds AS at_ds FROM rolled),
rpred AS (
  SELECT g.ds, g.ip, g.y,
         q.mean_y + q.slope * (CAST(floor(epoch(g.at_ds) / 3600) AS BIGINT) - q.mean_t) AS yhat, q.sigma
  FROM rgrid g LEFT JOIN params q ON g.ip = q.ip AND q.status = 'ok')
SELECT ds, ip, y, yhat, yhat + ({Z95} * sigma) AS yhat_upper, yhat - ({Z95} * sigma) AS yhat_lower,
       DATE '{NEW_TRAINING_DATE}' AS training_date
FROM rpred""",
    "forecast_pending": _with(LOGS, _train(), _forecast("train", NEW_TRAINING_DATE)) +
    "SELECT * FROM fc WHERE y IS NULL OR isnan(y)",
    "forecast_merge": _with(LOGS, _train(CUTOFF, "train_old"), _train(None, "train_new"),
                            _forecast("train_old", OLD_TRAINING_DATE, "o_"),
                            _forecast("train_new", NEW_TRAINING_DATE, "n_")) + """
, observed AS (SELECT ip, ds, max(y) AS new_y FROM n_fc WHERE y IS NOT NULL GROUP BY ip, ds)
SELECT o.ds, o.ip, coalesce(o.y, b.new_y) AS y, o.yhat, o.yhat_upper, o.yhat_lower, o.training_date
FROM o_fc o LEFT JOIN observed b ON o.ip = b.ip AND o.ds = b.ds
UNION ALL
SELECT ds, ip, y, yhat, yhat_upper, yhat_lower, training_date FROM n_fc WHERE y IS NULL""",
    "anomaly_flags": _with(LOGS, _train(), _forecast("train", NEW_TRAINING_DATE)) + """
SELECT ip, ds, y, yhat_lower, yhat_upper,
       CASE WHEN y > yhat_upper THEN 'high' WHEN y < yhat_lower THEN 'low' END AS side,
       CASE WHEN y > yhat_upper THEN y - yhat_upper WHEN y < yhat_lower THEN yhat_lower - y END AS excess
FROM fc WHERE y IS NOT NULL AND yhat_upper IS NOT NULL
  AND greatest(y - yhat_upper, yhat_lower - y) > 1e-9 * greatest(abs(yhat), 1.0)""",
    "per_key_apply": _with(LOGS, _train()) + """
SELECT ip, count(*) AS n, sum(y) AS y_sum, max(y) AS y_max, min(ds) AS first_ds, max(ds) AS last_ds
FROM train GROUP BY ip""",
    # MLlib
    "index_by_frequency": _with(LOGS) + """
SELECT src_ip, frequency, row_number() OVER (ORDER BY frequency DESC, src_ip ASC) - 1 AS "index"
FROM (SELECT src_ip, count(*) AS frequency FROM logs GROUP BY src_ip)""",
    "complete_feature_rows": _with(LOGS) + """
, lagged AS (SELECT src_ip, lag(unq_dst_ip) OVER (PARTITION BY src_ip ORDER BY "timestamp", event_id) AS prev
             FROM logs)
SELECT src_ip, count(*) AS n_rows FROM lagged WHERE prev IS NOT NULL GROUP BY src_ip""",
    "stable_split": _with(LOGS) + f"""
SELECT event_id, CASE WHEN "timestamp" < TIMESTAMP '{SPLIT_CUTOFF}' THEN 'train' ELSE 'test' END AS split
FROM logs""",
    # streaming
    "stream_avg_by_key": _with(LOGS) + "SELECT src_ip, avg(unq_dst_ip) AS avg_unq_dst_ip FROM logs GROUP BY src_ip",
    "stream_latest_by_key": _with(LOGS) + "SELECT src_ip, avg(unq_dst_ip) AS avg_unq_dst_ip FROM logs GROUP BY src_ip",
    "stream_restart_avg": _with(LOGS) + "SELECT src_ip, avg(unq_dst_ip) AS avg_unq_dst_ip FROM logs GROUP BY src_ip",
    "stream_changelog_kv": _with(LOGS) + """
SELECT src_ip AS key, CAST(avg(unq_dst_ip) AS VARCHAR) AS value FROM logs GROUP BY src_ip""",
    "stream_route_to_partition": _with(LOGS, PMAP) + """
SELECT l.event_id, l.src_ip, p."partition" FROM logs l JOIN pmap p ON l.src_ip = p.src_ip""",
    "stream_dedup": _with(LOGS) + """SELECT DISTINCT event_id, src_ip, "timestamp", unq_dst_ip FROM logs""",
}
# merging a run again, or from a CSV file, gives what merging it once gives
ORACLE_SQL["forecast_merge_rerun"] = ORACLE_SQL["forecast_csv_merge"] = ORACLE_SQL["forecast_merge"]
# streams give what the batch operators give
ORACLE_SQL["stream_lag_feature"] = ORACLE_SQL["lag_feature"]
ORACLE_SQL["stream_first_write_wins"] = ORACLE_SQL["first_write_wins"]
ORACLE_SQL["stream_state_audit"] = ORACLE_SQL["stream_rekeyed_avg"] = ORACLE_SQL["stream_upsert_latest"] = ORACLE_SQL["avg_by_key"]
ORACLE_SQL["per_key_fold"], ORACLE_SQL["history_compacted"] = ORACLE_SQL["per_key_apply"], ORACLE_SQL["history_cycle"]
ORACLE_SQL["filter_allowlist_bloom"] = ORACLE_SQL["filter_allowlist"]
