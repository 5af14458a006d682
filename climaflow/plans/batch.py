"""Batch queries over the given tables, one per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import bands, calendar as cal
from ..operators import alerts, counters, describe as stats, history as hist, hourly, latest, pipeline_metrics as pm
from ..operators.windows import FULL_MEASURES, SHORT_MEASURES, TRIAL_MEASURES, WindowSpec, newest_first, windowed_aggregate
from ..schema import naive_timestamps
from ..sources import files, payload, wire
from ..sources.events import events, full_readings, readings


def _r(spark: SparkSession, d: str) -> DataFrame:
    return readings(events(spark, d))


def _full(spark: SparkSession, d: str) -> DataFrame:
    return full_readings(events(spark, d))


# ---- event-time windows -------------------------------------------------------------------

def window_agg_5m(spark, d):
    return windowed_aggregate(_r(spark, d))


def window_agg_notebook(spark, d):
    return newest_first(windowed_aggregate(_r(spark, d), WindowSpec(measures=SHORT_MEASURES)))


def window_agg_param_10m(spark, d):
    spec = WindowSpec("10 minutes", "5 minutes", ("hour_of_day",), TRIAL_MEASURES)
    return windowed_aggregate(_r(spark, d), spec)


# ---- readings of one to six decimals ------------------------------------------------------

def _fine(spark: SparkSession, d: str) -> DataFrame:
    """Readings whose values have one to six decimals, by event."""
    e = events(spark, d)
    units = F.array(*[F.lit(10.0 ** k) for k in range(1, 7)])
    fine = F.rint(F.col("value") * 100) / F.element_at(units, (F.col("event_id") % 6 + 1).cast("int"))
    return readings(e.withColumn("value", fine))


def exact_window_means(spark, d):
    return windowed_aggregate(_fine(spark, d), WindowSpec(measures=(*FULL_MEASURES, "mean_temp")))


def exact_history_year(spark, d):
    return hist.history(_fine(spark, d), "year")


def exact_heatmap(spark, d):
    return hist.heatmaps(_fine(spark, d))


def exact_hourly(spark, d):
    return hourly.hourly_means(_fine(spark, d))


def exact_rounded_means(spark, d):
    return hist.rounded_means(_fine(spark, d))


def exact_describe(spark, d):
    """Moments and quartiles of unrounded values; the result holds nothing of the table but one row per column."""
    return stats.describe(_fine(spark, d), ["temp", "feels_like", "wind", "humidity"])


# ---- JSON events and payloads -------------------------------------------------------------

def json_roundtrip(spark, d):
    """All 17 fields through JSON text and back."""
    text = wire.encode(_full(spark, d), "event_id")
    return naive_timestamps(wire.decode(text, None, "event_id"))


def json_flatten(spark, d):
    """The reduced event: five declared fields of the same text."""
    from ..schema import TRIAL_FIELDS

    text = wire.encode(_full(spark, d), "event_id")
    return naive_timestamps(wire.decode(text, TRIAL_FIELDS, "event_id"))


def _payloads(spark, d) -> DataFrame:
    """Nested documents made from events: three-decimal measures, some without visibility."""
    e = _full(spark, d)
    milli = (F.col("event_id") % 5) / 1000.0
    def measure(c):
        return F.round(F.col(c) + milli, 3)
    doc = F.struct(
        F.col("station").alias("name"),
        F.struct("country").alias("sys"),
        F.struct("lat", "lon").alias("coord"),
        F.struct(
            measure("temp").alias("temp"), measure("feels_like").alias("feels_like"),
            measure("temp_min").alias("temp_min"), measure("temp_max").alias("temp_max"),
            "humidity", "pressure",
        ).alias("main"),
        F.when(F.col("event_id") % 9 == 0, F.array().cast("array<struct<description:string>>"))
        .otherwise(F.array(F.struct("description"), F.struct(F.lit("second").alias("description")))).alias("weather"),
        F.struct(F.col("cloud_pct").alias("all")).alias("clouds"),
        F.struct(measure("wind").alias("speed")).alias("wind"),
        F.when(F.col("event_id") % 7 != 0, F.col("visibility")).alias("visibility"),
    )
    return e.select("event_id", "ts", F.to_json(doc).alias("value"))


def nested_payload_flatten(spark, d):
    return naive_timestamps(payload.flatten_payload(_payloads(spark, d), F.col("ts"), "event_id"))


def quarantine_split(spark, d):
    """Good and quarantined rows of a text stream with cut, mistyped and mistimed events."""
    e = wire.encode(_full(spark, d), "event_id")
    broken = (
        F.when(F.col("event_id") % 11 == 0, F.expr("substring(value, 1, 40)"))
        .when(F.col("event_id") % 13 == 0, F.regexp_replace("value", '"humedad":[0-9]+', '"humedad":"a"'))
        .when(F.col("event_id") % 17 == 0, F.regexp_replace("value", '"timestamp":"[^"]+"', '"timestamp":"nope"'))
        .otherwise(F.col("value"))
    )
    checked = wire.decode_checked(e.withColumn("value", broken), "event_id")
    good = F.col("reason").isNull()
    return checked.select(
        "event_id", F.coalesce("reason", F.lit("good")).alias("outcome"), F.when(good, F.col("temp")).alias("temp")
    )


def missing_defaults(spark, d):
    """Defaults in place of fields that an event lacks."""
    e = _full(spark, d)
    holes = e.withColumns({
        "temp": F.when(F.col("event_id") % 5 != 0, F.col("temp")),
        "humidity": F.when(F.col("event_id") % 6 != 0, F.col("humidity")),
        "wind": F.when(F.col("event_id") % 7 != 0, F.col("wind")),
        "pressure": F.when(F.col("event_id") % 8 != 0, F.col("pressure")),
        "hour_of_day": F.when(F.col("event_id") % 9 != 0, F.col("hour_of_day")),
        "description": F.when(F.col("event_id") % 10 != 0, F.col("description")),
    })
    return wire.with_defaults(holes).select(
        "event_id", "temp", "humidity", "wind", "pressure", "hour_of_day", "description"
    )


# ---- scalar columns -----------------------------------------------------------------------

def calendar_features(spark, d):
    e = events(spark, d).select("event_id", "ts")
    return cal.with_calendar(e, "ts", cal.MODEL_ZONE).drop("ts")


def time_labels(spark, d):
    e = _full(spark, d).select("event_id", "ts", "ts_raw")
    day = F.to_date("ts")
    return e.select(
        "event_id",
        cal.clock_text("ts_raw").alias("clock"),
        cal.hour_label(F.hour("ts")).alias("hour_label"),
        cal.padded_hour_label(F.hour("ts")).alias("padded_hour"),
        cal.day_label(day).alias("day_label"),
        cal.month_label(day).alias("month_label"),
        cal.weekday_name(F.weekday("ts")).alias("weekday_name"),
        cal.month_name(F.month("ts")).alias("month_name"),
    )


def epoch_millis(spark, d):
    """Temperature panel: epoch milliseconds and value, oldest first."""
    return latest.panel_history(_r(spark, d), "temp")


def pressure_history(spark, d):
    return latest.panel_history(_r(spark, d), "pressure")


def status_bands(spark, d):
    r = _r(spark, d)
    return r.select(
        "event_id",
        bands.humidity_status(F.col("humidity")).alias("humidity_status"),
        bands.wind_status(F.col("wind")).alias("wind_status"),
        bands.latency_status(F.col("pressure") * 5).alias("latency_status"),
    )


def heat_score(spark, d):
    r = _r(spark, d).select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("temp")).alias("temp"))
    return r.select(
        "event_id",
        F.round(bands.heat_score(F.col("temp")), 6).alias("score"),
        bands.heat_colour(F.col("temp")).alias("colour"),
    )


def gauge_split(spark, d):
    r = _r(spark, d)
    filled, empty = bands.temperature_gauge(F.col("temp"))
    wet, dry = bands.humidity_gauge(F.col("humidity"))
    return r.select(
        "event_id", filled.alias("temp_filled"), F.round(empty, 2).alias("temp_empty"),
        wet.alias("humidity_filled"), dry.alias("humidity_empty"),
    )


def apparent_temp(spark, d):
    r = _r(spark, d)
    value = bands.apparent_temperature(F.col("temp"), F.col("wind"), F.col("humidity"))
    return r.select("event_id", F.round(value, 4).alias("apparent"))


def sky_class(spark, d):
    f = _full(spark, d)
    return f.select(
        "event_id",
        bands.sky_class(F.dayofyear("ts"), F.col("humidity")).alias("sky"),
        bands.sky_of_phrase(F.col("description")).alias("phrase_sky"),
    )


def seasonal_residual(spark, d):
    r = _r(spark, d)
    doy, hour = F.dayofyear("ts"), bands.fractional_hour(F.col("ts"))
    return r.select(
        "event_id",
        F.round(F.col("temp") - bands.expected_temperature(doy, hour), 6).alias("temp_residual"),
        (F.col("humidity") - bands.expected_humidity(doy, hour)).alias("humidity_residual"),
        (F.col("pressure") - bands.expected_pressure(hour)).alias("pressure_residual"),
        F.round(F.col("wind") - bands.expected_wind(hour), 6).alias("wind_residual"),
    )


def hour_range_normalised(spark, d):
    e = events(spark, d)
    first, last = (F.col("user_id") % 60 - 20).cast("int"), (F.col("event_id") % 50 - 10).cast("int")
    lo, hi = cal.ordered_hours(first, last)
    return e.select("event_id", lo.alias("hour_from"), hi.alias("hour_to"))


def cyclic_hour(spark, d):
    sin, cos = cal.cyclic_hour(F.hour("ts"))
    return events(spark, d).select("event_id", F.round(sin, 6).alias("hour_sin"), F.round(cos, 6).alias("hour_cos"))


# ---- scans --------------------------------------------------------------------------------

def persisted_projection(spark, d):
    return files.stored_projection(_full(spark, d))


def not_null_scan(spark, d):
    r = _r(spark, d).withColumn("temp", F.when(F.col("event_id") % 10 != 0, F.col("temp")))
    return files.training_scan(r)


# ---- aggregates ---------------------------------------------------------------------------

def table_summary(spark, d):
    return hist.table_summary(_r(spark, d))


def describe_stats(spark, d):
    return stats.describe(_r(spark, d), ["temp", "humidity", "pressure", "hour_of_day"])


def rounded_means(spark, d):
    return hist.rounded_means(_r(spark, d))


def _history(period, per=None):
    def query(spark, d):
        return hist.history(_r(spark, d), period, per)
    return query


def heatmap_24h(spark, d):
    return hist.heatmaps(_r(spark, d))


def live_heatmap(spark, d):
    return hist.heatmap_means(hist.hour_heatmap(_r(spark, d)))


def counter_bootstrap(spark, d):
    """Stored rows are all but the newest day's; that day arrives."""
    r = _r(spark, d)
    cut = F.date_trunc("day", hist.newest(r)).cast("timestamp_ntz")
    return counters.counter_bootstrap(r.where(F.col("ts") < cut), r.where(F.col("ts") >= cut))


# ---- newest rows --------------------------------------------------------------------------

def last_60_series(spark, d):
    return latest.last_series(_r(spark, d), 60)


def last_40_series(spark, d):
    return latest.last_series(_r(spark, d), 40)


def event_log_10(spark, d):
    return latest.event_log(_full(spark, d), 10)


def latest_reading(spark, d):
    return latest.latest_reading(_r(spark, d))


def latest_per_station(spark, d):
    return latest.latest_per_station(_r(spark, d))


def first_10(spark, d):
    return latest.first_rows(_r(spark, d), 10)


# ---- pipeline metrics ---------------------------------------------------------------------

def batches(spark, d) -> DataFrame:
    """Batches of 100 events; errors and latency follow from the events in them."""
    e = events(spark, d)
    return e.groupBy(F.floor(F.col("event_id") / 100).alias("batch_no")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("user_id") % 17 == 0, 1)).alias("errors"),
        (F.sum("user_id") % 7000).alias("latency_ms"),
    )


def batch_metrics_running(spark, d):
    return pm.running_metrics(batches(spark, d))


def threshold_alerts(spark, d):
    return alerts.threshold_alerts(pm.running_metrics(batches(spark, d)))


def latency_mean_20(spark, d):
    return pm.recent_latency(batches(spark, d))


def ops_summary(spark, d):
    return pm.operating_summary(batches(spark, d))


def backpressure(spark, d):
    """One topic per hour of day with four partitions; every 23rd message is unread."""
    e = events(spark, d)
    offsets = e.groupBy(F.hour("ts").alias("topic"), (F.col("event_id") % 4).alias("partition")).agg(
        F.count(F.lit(1)).alias("end_offset"),
        F.count(F.when(F.col("user_id") % 23 != 0, 1)).alias("current_offset"),
    )
    return alerts.backpressure(offsets)


# ---- hourly series ------------------------------------------------------------------------

def hourly_interpolated(spark, d):
    return hourly.interpolate_hours(hourly.hourly_means(_r(spark, d)))


def _hourly_columns(columns):
    def query(spark, d):
        grid = hourly.interpolate_hours(hourly.hourly_means(_r(spark, d)))
        return grid.withColumns(columns()).drop("temp", "filled")
    return query


# ---- counters and alerts ------------------------------------------------------------------

def _errors_counter(r: DataFrame) -> DataFrame:
    """A counter that restarts every 37 events, and one that moves every 40 events."""
    return r.withColumns({"restarting": F.col("event_id") % 37, "errors_total": F.floor(F.col("event_id") / 40)})


def counter_rate(spark, d):
    return counters.counter_rate(_errors_counter(_r(spark, d)), "restarting", 3600)


def sustained_extreme(spark, d):
    return alerts.sustained_extreme(_r(spark, d))


def sustained_errors(spark, d):
    """Error rate above zero over five minutes, held for ten (the given events are sparse)."""
    return naive_timestamps(alerts.sustained_errors(_errors_counter(_r(spark, d)), "errors_total", 300, 600))


def _dense(r: DataFrame) -> DataFrame:
    """The counters with a minute of the given time as one second, so that short spans hold samples."""
    quick = F.timestamp_seconds(F.floor(cal.epoch_seconds("ts") / 60)).cast("timestamp_ntz")
    return _errors_counter(r).withColumn("ts", quick)


def counter_rate_1m(spark, d):
    """Rate per minute over the last minute of the dense counter that restarts."""
    return counters.counter_rate(_dense(_r(spark, d)), "restarting", 60)


def sustained_errors_2m(spark, d):
    """The error rule with its own numbers: a rate above zero over two minutes, held for one."""
    return naive_timestamps(alerts.sustained_errors(_dense(_r(spark, d)), "errors_total"))


def silent_gaps(spark, d):
    return alerts.silent_gaps(_r(spark, d))


QUERIES = {
    "window_agg_5m": window_agg_5m,
    "window_agg_notebook": window_agg_notebook,
    "window_agg_param_10m": window_agg_param_10m,
    "json_roundtrip": json_roundtrip,
    "json_flatten": json_flatten,
    "nested_payload_flatten": nested_payload_flatten,
    "quarantine_split": quarantine_split,
    "missing_defaults": missing_defaults,
    "calendar_features": calendar_features,
    "time_labels": time_labels,
    "epoch_millis": epoch_millis,
    "pressure_history": pressure_history,
    "status_bands": status_bands,
    "heat_score": heat_score,
    "gauge_split": gauge_split,
    "apparent_temp": apparent_temp,
    "sky_class": sky_class,
    "seasonal_residual": seasonal_residual,
    "hour_range_normalised": hour_range_normalised,
    "cyclic_hour": cyclic_hour,
    "persisted_projection": persisted_projection,
    "not_null_scan": not_null_scan,
    "table_summary": table_summary,
    "describe_stats": describe_stats,
    "exact_window_means": exact_window_means,
    "exact_history_year": exact_history_year,
    "exact_heatmap": exact_heatmap,
    "exact_hourly": exact_hourly,
    "exact_rounded_means": exact_rounded_means,
    "exact_describe": exact_describe,
    "rounded_means": rounded_means,
    "history_day": _history("day"),
    "history_week": _history("week"),
    "history_month": _history("month"),
    "history_year": _history("year"),
    "history_week_per_station": _history("week", "station"),
    "heatmap_24h": heatmap_24h,
    "live_heatmap": live_heatmap,
    "counter_bootstrap": counter_bootstrap,
    "last_60_series": last_60_series,
    "last_40_series": last_40_series,
    "event_log_10": event_log_10,
    "latest_reading": latest_reading,
    "latest_per_station": latest_per_station,
    "first_10": first_10,
    "batch_metrics_running": batch_metrics_running,
    "threshold_alerts": threshold_alerts,
    "latency_mean_20": latency_mean_20,
    "ops_summary": ops_summary,
    "backpressure": backpressure,
    "hourly_interpolated": hourly_interpolated,
    "lag_features": _hourly_columns(hourly.lag_columns),
    "rolling_means": _hourly_columns(hourly.rolling_columns),
    "horizon_targets": _hourly_columns(hourly.target_columns),
    "counter_rate": counter_rate,
    "sustained_extreme": sustained_extreme,
    "sustained_errors": sustained_errors,
    "counter_rate_1m": counter_rate_1m,
    "sustained_errors_2m": sustained_errors_2m,
    "silent_gaps": silent_gaps,
}
