"""Derived identities: SHA-256 over concatenated fields, nulls as empty text."""

from pyspark.sql import Column, functions as F


def _digest(*parts: Column) -> Column:
    blank = F.lit("")
    return F.sha2(F.concat(*[F.coalesce(p.cast("string"), blank) for p in parts]), 256)


def event_id(date: Column, time: Column, location: Column, post: Column) -> Column:
    return F.upper(_digest(date, time, location, post))


def location_id(city: Column, location: Column) -> Column:
    return _digest(city, location)


def event_vehicle_id(event: Column, vehicle_type: Column) -> Column:
    return _digest(event, F.lit("|"), vehicle_type)
