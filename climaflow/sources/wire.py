"""JSON events: encode, decode, defaults and the quarantine split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import WIRE_FIELDS, to_engine_names, wire_schema

CORRUPT = "_corrupt"


def encode(df: DataFrame, *keep: str) -> DataFrame:
    """One JSON text per row under wire names in ``value``; nulls are written out.

    Columns named in ``keep`` travel beside the text.
    """
    fields = [F.col(engine).alias(wire) for wire, engine, _ in WIRE_FIELDS if engine in df.columns]
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(*keep, text.alias("value"))


def instant(raw: str) -> Column:
    """ISO-8601 text with offset as an instant; null when it cannot be read."""
    return F.try_to_timestamp(F.col(raw))


def _finite(name: str) -> Column:
    return F.when(F.abs(F.col(name)) < float("inf"), F.col(name))


def _doubles(df: DataFrame) -> list[str]:
    names = {engine for _, engine, _ in WIRE_FIELDS}
    return [c for c, kind in df.dtypes if kind == "double" and c in names]


def decode(df: DataFrame, fields: list[str] | None = None, *keep: str) -> DataFrame:
    """Parse ``value`` into engine columns plus ``ts``; unlisted fields are never materialised.

    NaN and infinite numbers become null.
    """
    parsed = df.select(*keep, F.from_json(F.col("value").cast("string"), wire_schema(fields)).alias("d"))
    flat = to_engine_names(parsed.select(*keep, "d.*"))
    return flat.withColumns({"ts": instant("ts_raw"), **{c: _finite(c) for c in _doubles(flat) if c not in keep}})


def decode_checked(df: DataFrame, *keep: str) -> DataFrame:
    """As ``decode``, with ``reason`` set on rows that lost something.

    ``corrupt`` covers unreadable JSON and wrong-typed fields, ``timestamp`` a missing or
    unreadable time, ``number`` a NaN or infinite number, which becomes null. Good rows have a null reason.
    """
    schema = wire_schema().add(CORRUPT, "string")
    parsed = df.select(
        *keep,
        F.col("value").cast("string").alias("raw"),
        F.from_json(F.col("value").cast("string"), schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("d"),
    )
    flat = to_engine_names(parsed.select(*keep, "raw", "d.*")).withColumn("ts", instant("ts_raw"))
    numbers = [c for c in _doubles(flat) if c not in keep]
    lost = F.lit(False)
    for c in numbers:
        lost = lost | (F.col(c).isNotNull() & _finite(c).isNull())
    reason = F.when(F.col(CORRUPT).isNotNull(), "corrupt").when(F.col("ts").isNull(), "timestamp").when(lost, "number")
    return flat.withColumns({"reason": reason, **{c: _finite(c) for c in numbers}}).drop(CORRUPT)


def quarantine_split(df: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows of a raw stream or batch."""
    checked = decode_checked(df, *keep)
    good = checked.where(F.col("reason").isNull()).drop("reason", "raw")
    bad = checked.where(F.col("reason").isNotNull()).select(*keep, "reason", "raw")
    return good, bad


def with_defaults(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Defaults for missing fields: zeros, an empty description, the hour of ``ts``."""
    from ..functions.calendar import local_time

    defaults = {
        "temp": F.lit(0.0), "humidity": F.lit(0), "wind": F.lit(0.0), "pressure": F.lit(0),
        "description": F.lit(""), "hour_of_day": F.hour(local_time("ts", zone)),
    }
    return df.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items() if c in df.columns})
