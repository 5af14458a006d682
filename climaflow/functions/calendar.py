"""Calendar columns, bucket labels and epoch conversions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Weekday and month names used in labels, and month abbreviations.
WEEKDAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
MONTH_SHORT = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]

# Fixed value: zone the models are trained in.
MODEL_ZONE = "America/Lima"

CALENDAR_FEATURES = ["hour_of_day", "day_of_week", "month", "iso_week"]


def epoch_seconds(name: str) -> Column:
    return F.unix_seconds(F.col(name).cast("timestamp"))


def epoch_millis(name: str) -> Column:
    """Whole seconds times 1000, as time-series panels ask for."""
    return epoch_seconds(name) * 1000


def local_time(name: str, zone: str | None) -> Column:
    """Wall-clock time in ``zone``; with no zone the stored clock as it is."""
    naive = F.col(name).cast("timestamp_ntz")
    return naive if zone is None else F.convert_timezone(F.lit("UTC"), F.lit(zone), naive)


def calendar_columns(name: str, zone: str | None = MODEL_ZONE) -> dict[str, Column]:
    """Hour, weekday (Monday 0), month and ISO week of a UTC time in a zone."""
    local = local_time(name, zone)
    return {
        "hour_of_day": F.hour(local),
        "day_of_week": F.weekday(local),
        "month": F.month(local),
        "iso_week": F.weekofyear(local),
    }


def with_calendar(df: DataFrame, name: str = "ts", zone: str | None = MODEL_ZONE) -> DataFrame:
    return df.withColumns(calendar_columns(name, zone))


def cyclic_hour(hour: Column) -> tuple[Column, Column]:
    """Sine and cosine of the hour on a 24-hour circle."""
    angle = F.lit(2.0) * F.pi() * hour / F.lit(24.0)
    return F.sin(angle), F.cos(angle)


def clock_text(raw: str) -> Column:
    """``HH:MM:SS`` cut from an ISO text; keeps the sender's own offset."""
    return F.substring(F.col(raw), 12, 8)


def _named(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))


def hour_label(hour: Column) -> Column:
    return F.concat(hour.cast("string"), F.lit("h"))


def padded_hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00h"))


def day_label(day: Column) -> Column:
    return F.concat_ws("/", F.dayofmonth(day).cast("string"), F.month(day).cast("string"))


def month_label(first_of_month: Column) -> Column:
    return F.concat_ws(" ", _named(MONTH_SHORT, F.month(first_of_month)), F.year(first_of_month).cast("string"))


def month_name(month: Column) -> Column:
    return _named(MONTH_NAMES, month)


def weekday_name(weekday: Column) -> Column:
    return _named(WEEKDAY_NAMES, weekday + 1)


def ordered_hours(first: Column, last: Column) -> tuple[Column, Column]:
    """Clamp both hours to 0-23 and put the smaller first."""
    a = F.greatest(F.lit(0), F.least(F.lit(23), first))
    b = F.greatest(F.lit(0), F.least(F.lit(23), last))
    return F.least(a, b), F.greatest(a, b)
