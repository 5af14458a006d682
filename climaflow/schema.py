"""Row shapes of the engine and the wire names they have outside."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# Wire names of the 17-field event, their engine names and types.
WIRE_FIELDS = [
    ("timestamp", "ts_raw", T.StringType()),
    ("ciudad", "station", T.StringType()),
    ("pais", "country", T.StringType()),
    ("latitud", "lat", T.DoubleType()),
    ("longitud", "lon", T.DoubleType()),
    ("temperatura", "temp", T.DoubleType()),
    ("sensacion_termica", "feels_like", T.DoubleType()),
    ("temp_min", "temp_min", T.DoubleType()),
    ("temp_max", "temp_max", T.DoubleType()),
    ("humedad", "humidity", T.IntegerType()),
    ("presion", "pressure", T.IntegerType()),
    ("descripcion", "description", T.StringType()),
    ("nubosidad", "cloud_pct", T.IntegerType()),
    ("velocidad_viento", "wind", T.DoubleType()),
    ("visibilidad", "visibility", T.IntegerType()),
    ("hora_dia", "hour_of_day", T.IntegerType()),
    ("dia_semana", "day_of_week", T.IntegerType()),
]

# Engine names of fields that storage keeps (13 of 17, in stored order).
STORED_FIELDS = [
    "ts_raw", "station", "temp", "feels_like", "temp_min", "temp_max", "humidity", "pressure",
    "description", "wind", "visibility", "hour_of_day", "day_of_week",
]

# Fields of the reduced event used by the parameter trials.
TRIAL_FIELDS = ["ts_raw", "station", "temp", "humidity", "hour_of_day"]

_TYPE_OF = {engine: dtype for _, engine, dtype in WIRE_FIELDS}
_WIRE_OF = {engine: wire for wire, engine, _ in WIRE_FIELDS}


def wire_schema(fields: list[str] | None = None) -> T.StructType:
    """Declared JSON schema under wire names, all of it or the listed engine fields."""
    chosen = fields or [engine for _, engine, _ in WIRE_FIELDS]
    return T.StructType([T.StructField(_WIRE_OF[f], _TYPE_OF[f]) for f in chosen])


def to_engine_names(df: DataFrame) -> DataFrame:
    """Rename wire columns to engine names; other columns pass through."""
    return df.withColumnsRenamed({wire: engine for wire, engine, _ in WIRE_FIELDS})


def to_wire_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({engine: wire for wire, engine, _ in WIRE_FIELDS})


def stored_schema() -> T.StructType:
    """Schema of the stored 13 fields under wire names (CSV and Parquet files)."""
    return wire_schema(STORED_FIELDS)


# Nested payload as a weather service sends it.
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("sys", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("coord", T.StructType([
        T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    ])),
    T.StructField("main", T.StructType([
        T.StructField("temp", T.DoubleType()), T.StructField("feels_like", T.DoubleType()),
        T.StructField("temp_min", T.DoubleType()), T.StructField("temp_max", T.DoubleType()),
        T.StructField("humidity", T.IntegerType()), T.StructField("pressure", T.IntegerType()),
    ])),
    T.StructField("weather", T.ArrayType(T.StructType([T.StructField("description", T.StringType())]))),
    T.StructField("clouds", T.StructType([T.StructField("all", T.IntegerType())])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
    T.StructField("visibility", T.IntegerType()),
])

# Hourly history file.
HOURLY_HISTORY_SCHEMA = T.StructType([
    T.StructField("hora", T.TimestampNTZType()),
    T.StructField("temperatura", T.DoubleType()),
    T.StructField("presion", T.DoubleType()),
])


def naive_timestamps(df: DataFrame) -> DataFrame:
    """Zone-free copies of all timestamp columns, for output."""
    casts = {
        f.name: F.col(f"`{f.name}`").cast("timestamp_ntz")
        for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)
    }
    return df.withColumns(casts) if casts else df
