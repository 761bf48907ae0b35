"""Distances and location masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywatch.functions.hashing import unit_interval
from tallywatch.schema import DEFAULT_CONFIG, RiskConfig


def distance_km(lat: Column, long: Column, config: RiskConfig = DEFAULT_CONFIG) -> Column:
    """Great-circle distance from the centre; a missing coordinate counts as 0 km."""
    lat_from, lat_to = F.radians(F.lit(config.center_lat)), F.radians(lat)
    half_lat = (lat_to - lat_from) / 2
    half_long = (F.radians(long) - F.radians(F.lit(config.center_long))) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2.0)) + (
        F.cos(lat_from) * F.cos(lat_to) * F.pow(F.sin(half_long), F.lit(2.0))
    )
    return F.coalesce(2 * F.asin(F.sqrt(chord)) * config.earth_radius_km, F.lit(0.0))


def masked_location(
    row_key: Column, seed: int = 42, config: RiskConfig = DEFAULT_CONFIG
) -> Column:
    """``struct(lat, long)`` inside the box around the centre.

    Independent of the true location; the same row key and seed always give the same point.
    """
    def offset(axis: str) -> Column:
        return (2 * unit_interval(row_key, f"{seed}:{axis}") - 1) * config.mask_radius_deg

    return F.struct(
        (config.center_lat + offset("lat")).alias("lat"),
        (config.center_long + offset("long")).alias("long"),
    )
