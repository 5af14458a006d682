"""The same results as plain SQL over the same tables, for the correctness check."""

from __future__ import annotations

# Readings view of the events table.
READINGS = """
r AS (
  SELECT event_id, event_type AS station, ts,
         CAST(round(value * 100) AS BIGINT) - 2000 AS c,
         (CAST(round(value * 100) AS BIGINT) - 2000) / 100.0::DOUBLE AS temp,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
         CAST(950 + user_id AS INTEGER) AS pressure,
         event_id % 2000 AS wc,
         (event_id % 2000) / 100.0::DOUBLE AS wind,
         CAST(round(value * 100) AS BIGINT) - 2000 - CAST(json_extract_string(props, '$.k') AS BIGINT) * 4
           + ((event_id % 2000) * 8) // 100 AS fc,
         CAST(hour(ts) AS INTEGER) AS hour_of_day,
         CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
         user_id
  FROM events
)"""

FULL = READINGS + """,
f AS (
  SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ts_raw, 'PE' AS country,
         CAST(-15.5 AS DOUBLE) AS lat, CAST(-70.13 AS DOUBLE) AS lon,
         fc / 100.0::DOUBLE AS feels_like,
         temp - 1 AS temp_min, temp + 1 AS temp_max,
         CASE event_id % 8 WHEN 0 THEN 'cielo claro' WHEN 1 THEN 'despejado' WHEN 2 THEN 'nubes dispersas'
              WHEN 3 THEN 'algo de nubes' WHEN 4 THEN 'muy nuboso' WHEN 5 THEN 'lluvia ligera'
              WHEN 6 THEN 'lluvia moderada' ELSE 'llovizna' END AS description,
         CAST(event_id % 101 AS INTEGER) AS cloud_pct,
         CAST(event_id % 10000 AS INTEGER) AS visibility
  FROM r
)"""


# Readings with one to six decimals, in whole millionths.
FINE = """
r AS (
  SELECT event_id, event_type AS station, ts,
         CAST(round(value * 100) AS BIGINT) * CAST(10 ** (5 - event_id % 6) AS BIGINT) - 20000000 AS m,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
         CAST(950 + user_id AS INTEGER) AS pressure,
         event_id % 2000 AS wc, (event_id % 2000) / 100.0::DOUBLE AS wind,
         m / 1000000.0::DOUBLE AS temp,
         m - (CAST(json_extract_string(props, '$.k') AS BIGINT) * 4 - ((event_id % 2000) * 8) // 100) * 10000 AS fm,
         fm / 1000000.0::DOUBLE AS feels_like,
         CAST(hour(ts) AS INTEGER) AS hour_of_day
  FROM events
)"""


def _mean(total: str, n: str, digits: int = 2) -> str:
    """total/n half up to ``digits``; total and n are whole numbers."""
    unit = 10 ** digits
    return (
        f"(CAST(sign({total}) AS BIGINT) * ((2 * {unit} * abs(CAST({total} AS BIGINT)) + ({n})) // (2 * nullif({n}, 0)))"
        f" / {unit}.0::DOUBLE)"
    )


def _cents_mean(total: str, n: str, digits: int = 2) -> str:
    return _mean(total, f"(({n}) * 100)", digits)


_SUMS = """sum(c) AS ts_, count(*) AS n, max(c) AS hi, min(c) AS lo, sum(humidity) AS hs,
       sum(wc) AS ws, sum(fc) AS fs"""

_FULL_MEASURES = f"""{_cents_mean('ts_', 'n')} AS avg_temp, hi / 100.0::DOUBLE AS max_temp, lo / 100.0::DOUBLE AS min_temp,
  {_mean('hs', 'n', 1)} AS avg_humidity, {_cents_mean('ws', 'n')} AS avg_wind,
  {_cents_mean('fs', 'n')} AS avg_feels_like, n AS events"""


def _window_sql(minutes: int, keys: str, measures: str) -> str:
    return f"""WITH {READINGS},
g AS (SELECT time_bucket(INTERVAL '{minutes} minutes', ts) AS window_start, {keys}, {_SUMS}
      FROM r GROUP BY ALL)
SELECT window_start, window_start + INTERVAL '{minutes} minutes' AS window_end, {keys}, {measures} FROM g"""


WINDOW_5M = _window_sql(5, "hour_of_day, station", _FULL_MEASURES)

def _micro_mean(total: str, n: str, digits: int = 2) -> str:
    return _mean(total, f"(({n}) * 1000000)", digits)


_BUCKETS = {
    "day": ("CAST(hour(ts) AS INTEGER)", "bucket || 'h'", "CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM r)"),
    "week": ("CAST(ts AS DATE)", "day(bucket) || '/' || month(bucket)", "ts >= (SELECT max(ts) FROM r) - INTERVAL 7 DAY"),
    "month": ("CAST(ts AS DATE)", "day(bucket) || '/' || month(bucket)", "ts >= (SELECT max(ts) FROM r) - INTERVAL 30 DAY"),
    "year": (
        "CAST(date_trunc('month', ts) AS DATE)",
        "['Ene','Feb','Mar','Abr','May','Jun','Jul','Ago','Sep','Oct','Nov','Dic'][month(bucket)] || ' ' || year(bucket)",
        "true",
    ),
}


def _history_sql(period: str) -> str:
    bucket, label, where = _BUCKETS[period]
    return f"""WITH {READINGS},
g AS (SELECT {bucket} AS bucket, sum(c) AS s, sum(pressure) AS p, count(*) AS n FROM r WHERE {where} GROUP BY 1)
SELECT bucket, {label} AS label, {_cents_mean('s', 'n')} AS avg_temp, {_mean('p', 'n')} AS avg_pressure FROM g"""


_HEATMAP = " UNION ALL ".join(
    f"""SELECT '{p}' AS period, h.hour AS hour, {_cents_mean('sum(c)', 'count(c)')} AS avg_temp, count(c) AS events
FROM (SELECT CAST(range AS INTEGER) AS hour FROM range(24)) h
LEFT JOIN (SELECT hour(ts) AS hour, c FROM r WHERE {_BUCKETS[p][2]}) x ON x.hour = h.hour GROUP BY h.hour"""
    for p in ("day", "week", "month", "year")
)


def _last_sql(k: int) -> str:
    return f"""WITH {READINGS}
SELECT station, ts, event_id, temp, humidity, wind, pressure,
       CAST(row_number() OVER (PARTITION BY station ORDER BY ts DESC, event_id DESC) AS INTEGER) AS age
FROM r QUALIFY age <= {k}"""


BATCHES = """
b AS (SELECT event_id // 100 AS batch_no, count(*) AS rows, count(*) FILTER (user_id % 17 = 0) AS errors,
             sum(user_id) % 7000 AS latency_ms
      FROM events GROUP BY 1)"""

RUNNING = BATCHES + f""",
t AS (SELECT batch_no, rows, latency_ms, sum(rows) OVER w AS te, sum(errors) OVER w AS tr,
             sum(latency_ms) OVER w AS tl, count(*) OVER w AS n
      FROM b WINDOW w AS (ORDER BY batch_no)),
m AS (SELECT batch_no, rows, latency_ms / 1000.0::DOUBLE AS latency_s, CAST(te AS BIGINT) AS total_events,
             CAST(tr AS BIGINT) AS total_errors, {_mean('tl', '(n * 1000)', 3)} AS mean_latency_s,
             {_mean('te * 60', 'greatest(n * 30, 60)')} AS throughput_per_min,
             {_mean('tr * 100', 'greatest(te, 1)::BIGINT')} AS error_pct
      FROM t)"""

GRID = READINGS + """,
hm AS (SELECT station, date_trunc('hour', ts) AS hr, sum(c)::DOUBLE / 100.0::DOUBLE / count(*) AS t FROM r GROUP BY ALL),
span AS (SELECT station, min(hr) AS lo, max(hr) AS hi FROM hm GROUP BY 1),
cells AS (SELECT station, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hr FROM span),
j AS (SELECT cells.station, cells.hr, hm.t FROM cells LEFT JOIN hm ON hm.station = cells.station AND hm.hr = cells.hr),
k AS (SELECT station, hr, t,
        last_value(CASE WHEN t IS NOT NULL THEN hr END IGNORE NULLS) OVER wp AS ph,
        last_value(t IGNORE NULLS) OVER wp AS pt,
        first_value(CASE WHEN t IS NOT NULL THEN hr END IGNORE NULLS) OVER wn AS nh,
        first_value(t IGNORE NULLS) OVER wn AS nt
      FROM j
      WINDOW wp AS (PARTITION BY station ORDER BY hr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             wn AS (PARTITION BY station ORDER BY hr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
grid AS (SELECT station, hr, t IS NULL AS filled,
           CASE WHEN t IS NOT NULL THEN t WHEN pt IS NULL THEN NULL WHEN nt IS NULL THEN pt
                ELSE pt + (nt - pt) / (epoch(nh) - epoch(ph)) * (epoch(hr) - epoch(ph)) END AS temp
         FROM k)"""

# Whole milliseconds, eleven days behind the newest event.
_SHUFFLED_WATERMARK = "(epoch_us(max(ts)) // 1000) * 1000 - 11 * 86400000000"

_W = "OVER (PARTITION BY station ORDER BY hr)"


def _samples(value: str, clock: str) -> str:
    """Every sample against the one before it, then summed by second."""
    return READINGS + f""",
d AS (SELECT station, event_id, {clock} AS ts FROM r),
s AS (SELECT station, CAST(floor(epoch(ts)) AS BIGINT) AS sec, {value} AS x, lag({value}) OVER w AS px, row_number() OVER w AS nr
      FROM d WINDOW w AS (PARTITION BY station ORDER BY ts, event_id)),
inc AS (SELECT station, sec, arg_max(x, nr) AS v,
          CAST(sum(CASE WHEN px IS NULL THEN 0 WHEN x < px THEN x ELSE x - px END) AS BIGINT) AS increase
        FROM s GROUP BY station, sec)"""


# A minute of the given time as one second.
_DENSE = "CAST(to_timestamp(floor(epoch(ts) / 60)) AT TIME ZONE 'UTC' AS TIMESTAMP)"


def _rates(value: str, span: int, clock: str = "ts") -> str:
    return _samples(value, clock) + f""",
rt AS (SELECT station, sec, v, increase,
         CAST(sum(increase) OVER (PARTITION BY station ORDER BY sec RANGE BETWEEN {span - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS window_increase
       FROM inc)"""


def _islands(source: str, flag: str, hold: int) -> str:
    """Runs of flagged instants that last at least ``hold`` seconds."""
    return f""",
inst AS (SELECT station, ts, bool_and({flag}) AS flag FROM {source} GROUP BY ALL),
mark AS (SELECT station, ts, flag, sum(CASE WHEN flag THEN 0 ELSE 1 END) OVER (PARTITION BY station ORDER BY ts) AS g FROM inst)
SELECT station, min(ts) AS started, max(ts) AS ended, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS held_s
FROM mark WHERE flag GROUP BY station, g HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= {hold * 1000000}"""


_STAT = """SELECT '{c}' AS column_name, count({v}) AS rows, round(avg({v}::DOUBLE), 6) AS mean,
  round(stddev_samp({v}::DOUBLE), 6) AS std, min({v})::DOUBLE AS min,
  round(quantile_cont({v}::DOUBLE, 0.25), 6) AS q25, round(quantile_cont({v}::DOUBLE, 0.5), 6) AS q50,
  round(quantile_cont({v}::DOUBLE, 0.75), 6) AS q75, max({v})::DOUBLE AS max FROM r"""

_SCORE = "least(greatest((temp - 2) / 18.0::DOUBLE, 0.0), 1.0)"


def _channel(bases: tuple, steps: tuple) -> str:
    parts = [("0.0", "0.33"), ("0.33", "0.33"), ("0.66", "0.34")]
    low, mid, top = (
        f"CAST(floor({b} + (s - {start}::DOUBLE) / {width}::DOUBLE * {st} + 0.5) AS BIGINT)"
        for b, st, (start, width) in zip(bases, steps, parts)
    )
    return f"CASE WHEN s < 0.33::DOUBLE THEN {low} WHEN s < 0.66::DOUBLE THEN {mid} ELSE {top} END"


_COLOUR = "'rgb(' || " + " || ',' || ".join(
    f"({_channel(b, s)})" for b, s in (
        ((30, 30, 245), (0, 215, -6)), ((58, 158, 158), (100, -17, -97)), ((95, 117, 59), (22, -58, -11)),
    )
) + " || ')'"

_DOY = "dayofyear(ts)"
_FH = "(hour(ts) + minute(ts) / 60.0::DOUBLE + CAST(second(ts) AS INTEGER) / 3600.0::DOUBLE)"
_WAVE9 = f"sin(2.0::DOUBLE * pi() * ({_FH} - 9.0::DOUBLE) / 24.0::DOUBLE)"
_WET = f"({_DOY} < 90 OR {_DOY} > 330)"

_EXPECTED_TEMP = (
    f"(8.5::DOUBLE + 2.5::DOUBLE * cos(2.0::DOUBLE * pi() * ({_DOY} - 172) / 365.0::DOUBLE) + 7.5::DOUBLE * {_WAVE9})"
)

LABELLED = """
z AS (SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Lima' AS t, CAST(round(value * 100) AS BIGINT) - 2000 AS c FROM events),
l AS (SELECT event_id, c, event_id % 5 = 0 AS is_test, CAST(hour(t) AS INTEGER) AS hour_of_day,
        CAST(isodow(t) - 1 AS INTEGER) AS day_of_week, CAST(month(t) AS INTEGER) AS month, CAST(week(t) AS INTEGER) AS iso_week FROM z)"""

_FEATURES = ("hour_of_day", "day_of_week", "month", "iso_week")


def _knn(k: int) -> str:
    """Brute force over feature cells: all distances, nearest first, the last place shared."""
    f = ", ".join(_FEATURES)
    scale = ", ".join(f"CASE WHEN var_pop({c}) > 1e-12 THEN stddev_pop({c}) ELSE 1.0 END AS s_{c}" for c in _FEATURES)
    gap = " + ".join(f"((q.{c} - t.{c}) / s_{c}) * ((q.{c} - t.{c}) / s_{c})" for c in _FEATURES)
    return LABELLED + f""",
tc AS (SELECT {f}, count(*) AS n, sum(c) AS s FROM l WHERE NOT is_test GROUP BY ALL),
sc AS (SELECT {scale} FROM l WHERE NOT is_test),
qc AS (SELECT DISTINCT {f} FROM l WHERE is_test),
pr AS (SELECT {', '.join('q.' + c for c in _FEATURES)}, round({gap}, 9) AS d, sum(t.n) AS n, sum(t.s) AS s FROM qc q, tc t, sc GROUP BY ALL),
bf AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY {f} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pr),
tk AS (SELECT *, least(n, {k} - before) AS take FROM bf WHERE before < {k}),
knn AS (SELECT {f}, (CAST(coalesce(sum(s) FILTER (take = n), 0) AS DOUBLE) + coalesce(sum(CAST(take AS DOUBLE) * CAST(s AS DOUBLE) / CAST(n AS DOUBLE)) FILTER (take < n), 0.0::DOUBLE))
          / CAST(sum(take) AS DOUBLE) / 100.0::DOUBLE AS p FROM tk GROUP BY ALL)"""


BASELINES = READINGS + """,
p AS (SELECT station, temp, 8.5::DOUBLE + 2.5::DOUBLE * cos(2.0::DOUBLE * pi() * (dayofyear(ts) - 172) / 365.0::DOUBLE)
        + 7.5::DOUBLE * sin(2.0::DOUBLE * pi() * (hour(ts) - 9.0::DOUBLE) / 24.0::DOUBLE) AS curve,
        10.0::DOUBLE AS constant, humidity / 2.0::DOUBLE AS humid FROM r)"""

ORACLE = {
    "window_agg_5m": WINDOW_5M,
    "window_agg_notebook": _window_sql(
        5, "hour_of_day, station",
        f"{_cents_mean('ts_', 'n')} AS avg_temp, {_mean('hs', 'n', 1)} AS avg_humidity, {_cents_mean('ws', 'n')} AS avg_wind, n AS events",
    ),
    "window_agg_param_10m": _window_sql(
        10, "hour_of_day", "ts_::DOUBLE / 100.0::DOUBLE / n AS mean_temp, n AS events"
    ),
    "json_roundtrip": f"""WITH {FULL}
SELECT event_id, ts_raw, station, country, lat, lon, temp, feels_like, temp_min, temp_max, humidity, pressure,
       description, cloud_pct, wind, visibility, hour_of_day, day_of_week, ts FROM f""",
    "json_flatten": f"WITH {FULL} SELECT event_id, ts_raw, station, temp, humidity, hour_of_day, ts FROM f",
    "nested_payload_flatten": f"""WITH {FULL}
SELECT event_id, ts, station, country, lat, lon,
  temp, feels_like, round(temp_min, 2) AS temp_min, round(temp_max, 2) AS temp_max, humidity, pressure,
  CASE WHEN event_id % 9 <> 0 THEN description END AS description, cloud_pct, wind,
  CASE WHEN event_id % 7 <> 0 THEN visibility ELSE 0 END AS visibility, hour_of_day, day_of_week FROM f""",
    "quarantine_split": f"""WITH {READINGS}, o AS (
SELECT event_id, CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'corrupt'
                      WHEN event_id % 17 = 0 THEN 'timestamp' ELSE 'good' END AS outcome, temp FROM r)
SELECT event_id, outcome, CASE WHEN outcome = 'good' THEN temp END AS temp FROM o""",
    "missing_defaults": f"""WITH {FULL}
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN temp ELSE 0.0::DOUBLE END AS temp,
  CASE WHEN event_id % 6 <> 0 THEN humidity ELSE 0 END AS humidity,
  CASE WHEN event_id % 7 <> 0 THEN wind ELSE 0.0::DOUBLE END AS wind,
  CASE WHEN event_id % 8 <> 0 THEN pressure ELSE 0 END AS pressure,
  hour_of_day, CASE WHEN event_id % 10 <> 0 THEN description ELSE '' END AS description FROM f""",
    "calendar_features": """WITH x AS (SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Lima' AS l FROM events)
SELECT event_id, CAST(hour(l) AS INTEGER) AS hour_of_day, CAST(isodow(l) - 1 AS INTEGER) AS day_of_week,
       CAST(month(l) AS INTEGER) AS month, CAST(week(l) AS INTEGER) AS iso_week FROM x""",
    "time_labels": """SELECT event_id, strftime(ts, '%H:%M:%S') AS clock, hour(ts) || 'h' AS hour_label,
  lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00h' AS padded_hour, day(ts) || '/' || month(ts) AS day_label,
  ['Ene','Feb','Mar','Abr','May','Jun','Jul','Ago','Sep','Oct','Nov','Dic'][month(ts)] || ' ' || year(ts) AS month_label,
  ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(ts)] AS weekday_name,
  ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'][month(ts)] AS month_name
FROM events""",
    "epoch_millis": f"WITH {READINGS} SELECT CAST(floor(epoch(ts)) AS BIGINT) * 1000 AS time_ms, temp AS value, event_id FROM r",
    "pressure_history": f"WITH {READINGS} SELECT CAST(floor(epoch(ts)) AS BIGINT) * 1000 AS time_ms, pressure AS value, event_id FROM r",
    "status_bands": f"""WITH {READINGS}
SELECT event_id, CASE WHEN humidity > 90 THEN 'high' ELSE 'normal' END AS humidity_status,
  CASE WHEN wind > 10 THEN 'strong' ELSE 'normal' END AS wind_status,
  CASE WHEN pressure * 5 > 5000 THEN 'slow' ELSE 'optimal' END AS latency_status FROM r""",
    "heat_score": f"""WITH {READINGS}, h AS (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN {_SCORE} END AS s FROM r)
SELECT event_id, round(s, 6) AS score, CASE WHEN s IS NOT NULL THEN {_COLOUR} END AS colour FROM h""",
    "gauge_split": f"""WITH {READINGS}
SELECT event_id, greatest(0.0::DOUBLE, temp) AS temp_filled, round(greatest(0.0::DOUBLE, 30.0::DOUBLE - greatest(0.0::DOUBLE, temp)), 2) AS temp_empty,
  humidity AS humidity_filled, 100 - humidity AS humidity_empty FROM r""",
    "apparent_temp": f"""WITH {READINGS}
SELECT event_id, (c * 100 + wc * 8 - humidity * 400) / 10000.0::DOUBLE AS apparent FROM r""",
    "sky_class": f"""WITH {FULL}
SELECT event_id, CASE WHEN {_WET} AND humidity > 75 THEN 'rain' WHEN humidity > 50 THEN 'clouds' ELSE 'clear' END AS sky,
  CASE WHEN event_id % 8 <= 1 THEN 'clear' WHEN event_id % 8 <= 4 THEN 'clouds' ELSE 'rain' END AS phrase_sky FROM f""",
    "seasonal_residual": f"""WITH {READINGS}
SELECT event_id, round(temp - {_EXPECTED_TEMP}, 6) AS temp_residual,
  humidity - CAST(trunc(least(greatest(45.0::DOUBLE - 25.0::DOUBLE * {_WAVE9} + CASE WHEN {_WET} THEN 15.0::DOUBLE ELSE 0.0::DOUBLE END, 10.0::DOUBLE), 95.0::DOUBLE)) AS INTEGER) AS humidity_residual,
  pressure - CAST(trunc(1017.5::DOUBLE + 1.8::DOUBLE * cos(2.0::DOUBLE * pi() * {_FH} / 12.0::DOUBLE)) AS INTEGER) AS pressure_residual,
  round(wind - greatest(0.1::DOUBLE, 1.2::DOUBLE + 2.5::DOUBLE * greatest(0.0::DOUBLE, sin(2.0::DOUBLE * pi() * ({_FH} - 10.0::DOUBLE) / 24.0::DOUBLE))), 6) AS wind_residual
FROM r""",
    "hour_range_normalised": """WITH q AS (SELECT event_id,
  greatest(0, least(23, CAST(user_id % 60 - 20 AS INTEGER))) AS a, greatest(0, least(23, CAST(event_id % 50 - 10 AS INTEGER))) AS b FROM events)
SELECT event_id, least(a, b) AS hour_from, greatest(a, b) AS hour_to FROM q""",
    "cyclic_hour": """SELECT event_id, round(sin(2.0::DOUBLE * pi() * hour(ts) / 24.0::DOUBLE), 6) AS hour_sin,
  round(cos(2.0::DOUBLE * pi() * hour(ts) / 24.0::DOUBLE), 6) AS hour_cos FROM events""",
    "persisted_projection": f"""WITH {FULL} SELECT ts_raw, station, temp, feels_like, temp_min, temp_max, humidity,
  pressure, description, wind, visibility, hour_of_day, day_of_week FROM f""",
    "not_null_scan": f"WITH {READINGS} SELECT ts, temp FROM r WHERE event_id % 10 <> 0",
    "table_summary": f"""WITH {READINGS}
SELECT count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts, {_cents_mean('sum(c)', 'count(*)')} AS avg_temp FROM r""",
    "describe_stats": f"WITH {READINGS} " + " UNION ALL ".join(
        _STAT.format(c=c, v=c) for c in ("temp", "humidity", "pressure", "hour_of_day")
    ),
    "exact_window_means": f"""WITH {FINE},
g AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, hour_of_day, station, sum(m) AS ts_, count(*) AS n,
        max(temp) AS hi, min(temp) AS lo, sum(humidity) AS hs, sum(wc) AS ws, sum(fm) AS fs FROM r GROUP BY ALL)
SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, hour_of_day, station, {_micro_mean('ts_', 'n')} AS avg_temp,
  hi AS max_temp, lo AS min_temp, {_mean('hs', 'n', 1)} AS avg_humidity, {_cents_mean('ws', 'n')} AS avg_wind,
  {_micro_mean('fs', 'n')} AS avg_feels_like, n AS events, CAST(ts_ AS BIGINT) / 1000000.0::DOUBLE / n AS mean_temp FROM g""",
    "exact_history_year": f"""WITH {FINE},
g AS (SELECT {_BUCKETS['year'][0]} AS bucket, sum(m) AS s, sum(pressure) AS p, count(*) AS n FROM r GROUP BY 1)
SELECT bucket, {_BUCKETS['year'][1]} AS label, {_micro_mean('s', 'n')} AS avg_temp, {_mean('p', 'n')} AS avg_pressure FROM g""",
    "exact_heatmap": f"WITH {FINE} " + _HEATMAP.replace(_cents_mean('sum(c)', 'count(c)'), _micro_mean('sum(m)', 'count(m)'))
        .replace("AS hour, c FROM", "AS hour, m FROM").replace("count(c) AS events", "count(m) AS events"),
    "exact_hourly": f"""WITH {FINE}
SELECT station, date_trunc('hour', ts) AS hr, CAST(sum(m) AS BIGINT) / 1000000.0::DOUBLE / count(*) AS temp FROM r GROUP BY ALL""",
    "exact_rounded_means": f"""WITH {FINE}
SELECT station, {_micro_mean('sum(m)', 'count(*)', 1)} AS avg_temp_1dp, {_micro_mean('sum(m)', 'count(*)', 2)} AS avg_temp_2dp,
  {_micro_mean('sum(m)', 'count(*)', 3)} AS avg_temp_3dp FROM r GROUP BY station""",
    "exact_describe": f"WITH {FINE} " + " UNION ALL ".join(
        _STAT.format(c=c, v=c) for c in ("temp", "feels_like", "wind", "humidity")
    ),
    "rounded_means": f"""WITH {READINGS}
SELECT station, {_cents_mean('sum(c)', 'count(*)', 1)} AS avg_temp_1dp, {_cents_mean('sum(c)', 'count(*)', 2)} AS avg_temp_2dp,
  {_cents_mean('sum(c)', 'count(*)', 3)} AS avg_temp_3dp FROM r GROUP BY station""",
    **{f"history_{p}": _history_sql(p) for p in _BUCKETS},
    "history_week_per_station": f"""WITH {READINGS}, a AS (SELECT station, max(ts) AS anchor FROM r GROUP BY 1),
g AS (SELECT r.station, CAST(ts AS DATE) AS bucket, sum(c) AS s, sum(pressure) AS p, count(*) AS n
      FROM r JOIN a ON a.station = r.station WHERE ts >= anchor - INTERVAL 7 DAY GROUP BY ALL)
SELECT station, bucket, day(bucket) || '/' || month(bucket) AS label, {_cents_mean('s', 'n')} AS avg_temp, {_mean('p', 'n')} AS avg_pressure FROM g""",
    "heatmap_24h": f"WITH {READINGS} {_HEATMAP}",
    "live_heatmap": f"""WITH {READINGS}
SELECT hour_of_day, {_cents_mean('sum(c)', 'count(*)')} AS avg_temp, count(*) AS events FROM r GROUP BY 1""",
    "counter_bootstrap": """WITH cut AS (SELECT date_trunc('day', max(ts)) AS d FROM events)
SELECT event_type AS station, count(*) FILTER (ts < d) AS stored, count(*) FILTER (ts >= d) AS arrived, count(*) AS total
FROM events, cut GROUP BY 1""",
    "last_60_series": _last_sql(60),
    "last_40_series": _last_sql(40),
    "event_log_10": f"""WITH {FULL}
SELECT station, ts, event_id, temp, humidity, wind, description,
  CAST(row_number() OVER (PARTITION BY station ORDER BY ts DESC, event_id DESC) AS INTEGER) AS age, strftime(ts, '%H:%M:%S') AS clock
FROM f QUALIFY age <= 10""",
    "latest_reading": f"WITH {READINGS} SELECT ts, event_id, station, temp, wind, humidity FROM r ORDER BY ts DESC, event_id DESC LIMIT 1",
    "latest_per_station": f"""WITH {READINGS} SELECT station, ts, event_id, temp, wind, humidity FROM r
QUALIFY row_number() OVER (PARTITION BY station ORDER BY ts DESC, event_id DESC) = 1""",
    "first_10": f"""WITH {READINGS} SELECT event_id, ts, temp, humidity, pressure, hour_of_day, day_of_week
FROM r ORDER BY ts, event_id LIMIT 10""",
    "batch_metrics_running": f"WITH {RUNNING} SELECT * FROM m",
    "threshold_alerts": f"""WITH {RUNNING}
SELECT batch_no, 'latency' AS alert, 'warning' AS severity, latency_s AS value, 5.0::DOUBLE AS limit_value FROM m WHERE latency_s > 5.0
UNION ALL SELECT batch_no, 'errors', 'error', error_pct, 5.0::DOUBLE FROM m WHERE error_pct > 5.0
UNION ALL SELECT batch_no, 'throughput', 'warning', throughput_per_min, 0.5::DOUBLE FROM m WHERE throughput_per_min < 0.5""",
    "latency_mean_20": f"""WITH {BATCHES}, x AS (SELECT batch_no, latency_ms, sum(latency_ms) OVER w AS s, count(*) OVER w AS n
  FROM b WINDOW w AS (ORDER BY batch_no ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT batch_no, CAST(latency_ms AS BIGINT) AS latency_ms, {_mean('s', 'n', 1)} AS recent_latency_ms FROM x""",
    "ops_summary": f"""WITH {BATCHES} SELECT count(*) AS batches, CAST(sum(rows) AS BIGINT) AS total_events,
  CAST(sum(errors) AS BIGINT) AS total_errors, {_mean('sum(latency_ms)', '(count(*) * 1000)')} AS mean_latency_s FROM b""",
    "backpressure": f"""WITH l AS (SELECT CAST(hour(ts) AS INTEGER) AS topic, count(*) FILTER (user_id % 23 = 0) AS lag FROM events GROUP BY 1)
SELECT topic, CAST(lag AS BIGINT) AS lag, least({_mean('lag * 100', 'greatest(lag + 10, 1)', 1)}, 100.0::DOUBLE) AS backpressure_pct,
  lag * 100 > 80 * greatest(lag + 10, 1) AS alert FROM l""",
    "hourly_interpolated": f"WITH {GRID} SELECT station, hr, temp, filled FROM grid",
    "lag_features": f"""WITH {GRID} SELECT station, hr,
  {', '.join(f'lag(temp, {n}) {_W} AS lag_{n}' for n in (1, 2, 24, 168))} FROM grid""",
    "rolling_means": f"""WITH {GRID}, u AS (SELECT station, hr, CAST(round_even(temp * 1000000, 0) AS BIGINT) AS m FROM grid)
SELECT station, hr, {', '.join(
        f'CAST(sum(m) OVER w{n} AS DOUBLE) / count(m) OVER w{n} / 1000000.0::DOUBLE AS roll_{n}' for n in (3, 24))} FROM u
WINDOW {', '.join(f'w{n} AS (PARTITION BY station ORDER BY hr ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)' for n in (3, 24))}""",
    "horizon_targets": f"""WITH {GRID} SELECT station, hr,
  {', '.join(f'lead(temp, {n}) {_W} AS target_{n}' for n in (1, 24, 168))} FROM grid""",
    "counter_rate": f"""WITH {_rates('event_id % 37', 3600)}
SELECT station, sec, v, increase, window_increase, round(window_increase * 60.0::DOUBLE / 3600, 6) AS rate_per_min FROM rt""",
    "sustained_extreme": f"WITH {READINGS} {_islands('r', 'temp > 30 OR temp < -10', 300)}",
    "sustained_errors": f"""WITH {_rates('event_id // 40', 300)},
rated AS (SELECT station, CAST(to_timestamp(sec) AT TIME ZONE 'UTC' AS TIMESTAMP) AS ts, window_increase FROM rt)
{_islands('rated', 'window_increase > 0', 600)}""",
    "counter_rate_1m": f"""WITH {_rates('event_id % 37', 60, _DENSE)}
SELECT station, sec, v, increase, window_increase, round(window_increase * 60.0::DOUBLE / 60, 6) AS rate_per_min FROM rt""",
    "sustained_errors_2m": f"""WITH {_rates('event_id // 40', 120, _DENSE)},
rated AS (SELECT station, CAST(to_timestamp(sec) AT TIME ZONE 'UTC' AS TIMESTAMP) AS ts, window_increase FROM rt)
{_islands('rated', 'window_increase > 0', 60)}""",
    "silent_gaps": """WITH g AS (SELECT event_type AS station, ts AS silent_from,
  lead(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS silent_to FROM events)
SELECT station, silent_from, silent_to, (epoch_us(silent_to) - epoch_us(silent_from)) / 1000000.0::DOUBLE AS gap_s
FROM g WHERE epoch_us(silent_to) - epoch_us(silent_from) > 60000000""",
    "stream_window_complete": WINDOW_5M,
    "stream_update_latest": WINDOW_5M,
    "stream_restart": WINDOW_5M,
    "stream_late_drop": WINDOW_5M.replace("FROM r GROUP BY ALL", """FROM r,
  (SELECT min(epoch_us(ts)) AS t0, max(epoch_us(ts)) AS t1 FROM events)
  WHERE least(floor((epoch_us(ts) - t0) * 4 / (t1 - t0)), 3) IN (0, 3) GROUP BY ALL"""),
    "stream_trial_rows": """WITH t(trial, trigger, watermark, window_width, minutes) AS (VALUES
  (1, '10 seconds', '1 minute', '5 minutes', 5), (2, '30 seconds', '2 minutes', '5 minutes', 5),
  (3, '60 seconds', '5 minutes', '10 minutes', 10))
SELECT CAST(trial AS INTEGER) AS trial, trigger, watermark, window_width,
  (SELECT count(DISTINCT epoch_us(ts) // (60000000 * minutes)) FROM events) AS rows FROM t""",
    "stream_snapshot_heatmap": f"""WITH {READINGS}
SELECT station, hour_of_day, {_cents_mean('sum(c)', 'count(*)')} AS avg_temp, count(*) AS events FROM r GROUP BY ALL""",
    "stream_sustained": f"WITH {READINGS} {_islands('r', 'temp > 30 OR temp < -10', 300)}",
    "stream_silence_timers": f"""WITH s AS (SELECT event_type AS station, ts FROM events
  WHERE (epoch_us(ts) // 600000000 + 1) * 600000000 <= (SELECT {_SHUFFLED_WATERMARK} FROM events)),
g AS (SELECT station, ts AS silent_from, lead(ts) OVER (PARTITION BY station ORDER BY ts) AS silent_to FROM s)
SELECT station, silent_from, silent_to FROM g WHERE epoch_us(silent_to) - epoch_us(silent_from) > 600000000""",
    "stream_sustained_timers": f"""WITH {READINGS},
s AS (SELECT * FROM r WHERE (epoch_us(ts) // 10000000 + 1) * 10000000 <= (SELECT {_SHUFFLED_WATERMARK} FROM events)) """
        + _islands("s", "temp < 35", 7200),
    "stream_silence_clock": """SELECT event_type AS station, max(ts) AS silent_from FROM events GROUP BY 1
UNION ALL SELECT '*', max(ts) FROM events""",
    "stream_progress": "SELECT 0::BIGINT AS batch, count(*) AS rows FROM events",
    "stream_silence": """WITH g AS (SELECT event_type AS station, ts AS silent_from,
  lead(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS silent_to FROM events)
SELECT station, silent_from, silent_to FROM g
WHERE epoch_us(coalesce(silent_to, (SELECT max(ts) FROM events))) - epoch_us(silent_from) > 60000000""",
    "sink_fanout": f"""WITH {FULL}
SELECT sink, station, count(*) AS rows, CAST(sum(c) AS BIGINT) AS temp_sum, CAST(sum(humidity) AS BIGINT) AS humidity_sum, max(ts_raw) AS newest
FROM f, (SELECT unnest(['table', 'csv', 'parquet']) AS sink) GROUP BY ALL""",
    "parquet_compact": f"""WITH {FULL}
SELECT 'large' AS sink, station, count(*) AS rows, CAST(sum(c) AS BIGINT) AS temp_sum, CAST(sum(humidity) AS BIGINT) AS humidity_sum, max(ts_raw) AS newest
FROM f GROUP BY ALL""",
    "csv_roundtrip": f"""WITH {FULL} SELECT ts_raw, station, temp, feels_like, temp_min, temp_max, humidity,
  pressure, description, wind, visibility, hour_of_day, day_of_week FROM f""",
    "split_counts": f"""WITH {LABELLED}
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, count(*) AS rows, CAST(sum(c) AS BIGINT) AS temp_sum FROM l GROUP BY 1""",
    "knn_predict": f"WITH {_knn(5)} SELECT hour_of_day, day_of_week, month, iso_week, p AS knn FROM knn",
    "knn_predict_200": f"WITH {_knn(200)} SELECT hour_of_day, day_of_week, month, iso_week, p AS knn FROM knn",
    "knn_metrics": f"""WITH {_knn(5)},
e AS (SELECT c / 100.0::DOUBLE AS y, p FROM l JOIN knn USING (hour_of_day, day_of_week, month, iso_week) WHERE is_test)
SELECT 'knn' AS model, count(*) AS rows, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
  round(1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 6) AS r2 FROM e""",
    "baseline_scores": f"WITH {BASELINES} " + " UNION ALL ".join(
        f"""SELECT '{m}' AS model, count(*) AS rows, round(avg(abs(temp - {m})), 6) AS mae, round(sqrt(avg((temp - {m}) * (temp - {m}))), 6) AS rmse,
  round(1 - sum((temp - {m}) * (temp - {m})) / (sum(temp * temp) - sum(temp) * sum(temp) / count(*)), 6) AS r2 FROM p"""
        for m in ("curve", "constant", "humid")
    ),
    "baseline_best": f"WITH {BASELINES}, s AS (" + " UNION ALL ".join(
        f"SELECT station, '{m}' AS model, {i} AS place, round(avg(abs(temp - {m})), 2) AS mae FROM p GROUP BY station"
        for i, m in enumerate(("curve", "constant", "humid"))
    ) + ") SELECT station, model, mae FROM s QUALIFY row_number() OVER (PARTITION BY station ORDER BY mae, place) = 1",
    "series_stats": f"""WITH {READINGS}, h AS (SELECT station AS model, {_cents_mean('sum(c)', 'count(*)')} AS value FROM r GROUP BY station, hour(ts)),
v AS (SELECT model, CAST(round(value * 100) AS BIGINT) AS c FROM h)
SELECT model, {_cents_mean('sum(c)', 'count(*)')} AS avg, min(c) / 100.0::DOUBLE AS min, max(c) / 100.0::DOUBLE AS max FROM v GROUP BY model""",
    "trend_grids": """WITH b AS (SELECT CAST(max(ts) AS DATE) AS base FROM events),
hours AS (SELECT CAST(range AS INTEGER) AS h FROM range(5, 21)),
days AS (SELECT m.mode, CAST(i.range AS INTEGER) AS position, base + CAST(i.range AS INTEGER) AS d
         FROM b, (VALUES ('week', 7), ('month', 30)) m(mode, n), range(30) i WHERE i.range < m.n),
months AS (SELECT CAST(range AS INTEGER) AS position, CAST((month(base) - 1 + range) % 12 + 1 AS INTEGER) AS m FROM b, range(12))
SELECT 'day' AS mode, h AS position, lpad(CAST(h AS VARCHAR), 2, '0') || ':00h' AS label, h AS hour_of_day,
  CAST(isodow(base) - 1 AS INTEGER) AS day_of_week, CAST(month(base) AS INTEGER) AS month, CAST(week(base) AS INTEGER) AS iso_week FROM b, hours
UNION ALL
SELECT mode, position, CASE WHEN mode = 'week' THEN ['Lunes','Martes','Miércoles','Jueves','Viernes','Sábado','Domingo'][isodow(d)]
  ELSE day(d) || '/' || month(d) END, h, CAST(isodow(d) - 1 AS INTEGER), CAST(month(d) AS INTEGER), CAST(week(d) AS INTEGER) FROM days, hours
UNION ALL
SELECT 'year', position, ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'][m],
  h, CAST(w.range AS INTEGER), m, [2, 6, 11, 15, 20, 24, 28, 33, 37, 41, 46, 50][m] FROM months, hours, range(7) w""",
    "model_roundtrip": f"""WITH {LABELLED}, q AS (SELECT DISTINCT hour_of_day, day_of_week, month, iso_week FROM l)
SELECT model, count(*) AS points, count(*) AS equal_points
FROM q, (SELECT unnest(['ridge', 'random_forest', 'gradient_boosting', 'knn', 'best']) AS model) GROUP BY model""",
}
