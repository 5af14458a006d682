"""Status classes, heat colours, gauge parts and expected values of a reading."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Display limits.
HUMID_ABOVE = 90
WINDY_ABOVE = 10
SLOW_ABOVE_MS = 5000
GAUGE_TOP = 30

# Heat scale (offset, span, band cuts) and the colour at each band's start and end.
HEAT_FROM, HEAT_SPAN = 2, 18
HEAT_CUT_LOW, HEAT_CUT_HIGH = 0.33, 0.66
HEAT_BANDS = [
    {"start": 0.0, "width": 0.33, "base": (30, 58, 95), "step": (0, 100, 22)},
    {"start": 0.33, "width": 0.33, "base": (30, 158, 117), "step": (215, -17, -58)},
    {"start": 0.66, "width": 0.34, "base": (245, 158, 59), "step": (-6, -97, -11)},
]

# Description phrases of each sky class.
SKY_PHRASES = {
    "rain": ["lluvia ligera", "lluvia moderada", "llovizna"],
    "clouds": ["nubes dispersas", "algo de nubes", "muy nuboso"],
    "clear": ["cielo claro", "despejado"],
}


def above(value: Column, limit: float, high: str, normal: str = "normal") -> Column:
    return F.when(value > limit, high).otherwise(normal)


def humidity_status(humidity: Column) -> Column:
    return above(humidity, HUMID_ABOVE, "high")


def wind_status(wind: Column) -> Column:
    return above(wind, WINDY_ABOVE, "strong")


def latency_status(millis: Column) -> Column:
    return above(millis, SLOW_ABOVE_MS, "slow", "optimal")


def heat_score(temp: Column) -> Column:
    """Position of a temperature on the 0-1 heat scale; null stays null."""
    scaled = (temp - HEAT_FROM) / HEAT_SPAN
    return F.when(temp.isNotNull(), F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)))


def heat_colour(temp: Column) -> Column:
    """``rgb(r,g,b)`` text of a temperature; null for a missing one."""
    score = heat_score(temp)

    def channel(band: dict, i: int) -> Column:
        part = (score - F.lit(band["start"])) / F.lit(band["width"])
        return F.floor(F.lit(float(band["base"][i])) + part * band["step"][i] + 0.5)

    def pick(i: int) -> Column:
        low, mid, top = (channel(b, i) for b in HEAT_BANDS)
        return F.when(score < HEAT_CUT_LOW, low).when(score < HEAT_CUT_HIGH, mid).otherwise(top)

    text = F.format_string("rgb(%d,%d,%d)", pick(0), pick(1), pick(2))
    return F.when(score.isNotNull(), text)


def temperature_gauge(temp: Column) -> tuple[Column, Column]:
    """Filled and empty part of the temperature gauge."""
    filled = F.greatest(F.lit(0.0), temp)
    return filled, F.greatest(F.lit(0.0), F.lit(float(GAUGE_TOP)) - filled)


def humidity_gauge(humidity: Column) -> tuple[Column, Column]:
    return humidity, F.lit(100) - humidity


def apparent_temperature(temp: Column, wind: Column, humidity: Column) -> Column:
    return temp + F.lit(0.08) * wind - F.lit(0.04) * humidity


def rainy_season(day_of_year: Column) -> Column:
    return (day_of_year < 90) | (day_of_year > 330)


def sky_class(day_of_year: Column, humidity: Column) -> Column:
    return (
        F.when(rainy_season(day_of_year) & (humidity > 75), "rain")
        .when(humidity > 50, "clouds")
        .otherwise("clear")
    )


def sky_of_phrase(description: Column) -> Column:
    """Sky class of a description phrase; null for an unknown one."""
    found = F.lit(None).cast("string")
    for name, phrases in SKY_PHRASES.items():
        found = F.when(description.isin(phrases), name).otherwise(found)
    return found


def _daily_wave(hour: Column, shift: float, period: float = 24.0) -> Column:
    return F.lit(2.0) * F.pi() * (hour - F.lit(shift)) / F.lit(period)


def expected_temperature(day_of_year: Column, hour: Column) -> Column:
    season = F.lit(2.5) * F.cos(F.lit(2.0) * F.pi() * (day_of_year - 172) / F.lit(365.0))
    return F.lit(8.5) + season + F.lit(7.5) * F.sin(_daily_wave(hour, 9.0))


def expected_humidity(day_of_year: Column, hour: Column) -> Column:
    wet = F.when(rainy_season(day_of_year), 15.0).otherwise(0.0)
    raw = F.lit(45.0) - F.lit(25.0) * F.sin(_daily_wave(hour, 9.0)) + wet
    return F.least(F.greatest(raw, F.lit(10.0)), F.lit(95.0)).cast("int")


def expected_pressure(hour: Column) -> Column:
    return (F.lit(1017.5) + F.lit(1.8) * F.cos(_daily_wave(hour, 0.0, 12.0))).cast("int")


def expected_wind(hour: Column) -> Column:
    breeze = F.lit(2.5) * F.greatest(F.lit(0.0), F.sin(_daily_wave(hour, 10.0)))
    return F.greatest(F.lit(0.1), F.lit(1.2) + breeze)


def fractional_hour(ts: Column) -> Column:
    """Hour of day with minutes and whole seconds as a fraction."""
    return F.hour(ts) + F.minute(ts) / F.lit(60.0) + F.second(ts) / F.lit(3600.0)
