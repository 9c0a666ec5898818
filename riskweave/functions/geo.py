"""City coordinates and great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.constants import CITIES, EARTH_RADIUS_KM


def city_table(spark: SparkSession) -> DataFrame:
    """The built-in dimension: ten rows, a literal relation."""
    rows = ", ".join(f"('{city}', {lat!r}D, {lon!r}D)" for city, lat, lon in CITIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS cities(city, lat, lon)")


def with_coordinates(
    df: DataFrame, city: str, lat: str, lon: str, cities: DataFrame | None = None
) -> DataFrame:
    """Add the coordinates of ``city``; NULL when the city is unknown or NULL.

    The built-in table has a fixed ten rows and is broadcast. A caller's own table
    is joined without a hint, so Spark decides by its measured size.
    """
    table = F.broadcast(city_table(df.sparkSession)) if cities is None else cities
    dim = table.select(
        F.col("city").alias(f"__{lat}_city"), F.col("lat").alias(lat), F.col("lon").alias(lon)
    )
    return df.join(dim, F.col(city) == F.col(f"__{lat}_city"), "left").drop(f"__{lat}_city")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    )
    rest = F.greatest(F.lit(1.0) - a, F.lit(0.0))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(rest))
