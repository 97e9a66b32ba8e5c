"""The city gazetteer: a fixed 14-row dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# City, latitude, longitude, in index order.
CITIES = (
    ("New York", 40.7128, -74.0060),
    ("Los Angeles", 34.0522, -118.2437),
    ("Chicago", 41.8781, -87.6298),
    ("Houston", 29.7604, -95.3698),
    ("Phoenix", 33.4484, -112.0740),
    ("Philadelphia", 39.9526, -75.1652),
    ("San Antonio", 29.4241, -98.4936),
    ("Dallas", 32.7767, -96.7970),
    ("Miami", 25.7617, -80.1918),
    ("Seattle", 47.6062, -122.3321),
    ("Tokyo", 35.6762, 139.6503),
    ("London", 51.5074, -0.1278),
    ("Paris", 48.8566, 2.3522),
    ("Sydney", -33.8688, 151.2093),
)


def gazetteer(spark: SparkSession) -> DataFrame:
    values = ", ".join(
        f"({index}, '{city}', {lat}D, {lon}D)" for index, (city, lat, lon) in enumerate(CITIES)
    )
    return spark.sql(
        f"SELECT * FROM VALUES {values} AS cities(city_idx, city, city_latitude, city_longitude)"
    )


def lookup_city(df: DataFrame, on: str = "city", how: str = "inner") -> DataFrame:
    """Add the coordinates of each row's city; the dimension is always 14 rows."""
    return df.join(F.broadcast(gazetteer(df.sparkSession)), on, how)
