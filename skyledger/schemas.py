"""Table contracts (column names and Spark types).

Raw tables keep the landed types (double / bigint / timestamp); staging casts
measures to ``NUMERIC`` = ``DecimalType(18, 9)``; reports cast decimals to
double at the output, as a dashboard client would.
"""

from __future__ import annotations

from pyspark.sql import types as T

NUMERIC = T.DecimalType(18, 9)

RAW_DAILY = T.StructType([
    T.StructField("location_id", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("temperature_2m_max", T.DoubleType()),
    T.StructField("temperature_2m_min", T.DoubleType()),
    T.StructField("precipitation_sum", T.DoubleType()),
    T.StructField("rain_sum", T.DoubleType()),
    T.StructField("wind_speed_10m_max", T.DoubleType()),
    T.StructField("sunrise", T.TimestampType()),
    T.StructField("sunset", T.TimestampType()),
    T.StructField("uv_index_max", T.DoubleType()),
    T.StructField("_extracted_at", T.TimestampType()),
])

RAW_HOURLY = T.StructType([
    T.StructField("location_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("temperature_2m", T.DoubleType()),
    T.StructField("relative_humidity_2m", T.LongType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("wind_speed_10m", T.DoubleType()),
    T.StructField("wind_direction_10m", T.LongType()),
    T.StructField("surface_pressure", T.DoubleType()),
    T.StructField("cloud_cover", T.LongType()),
    T.StructField("visibility", T.DoubleType()),
    T.StructField("weather_code", T.LongType()),
    T.StructField("_extracted_at", T.TimestampType()),
])

RAW_COLUMNS = {
    "daily": [f.name for f in RAW_DAILY.fields],
    "hourly": [f.name for f in RAW_HOURLY.fields],
}

LOCATIONS = T.StructType([
    T.StructField("location_id", T.StringType(), False),
    T.StructField("city_name", T.StringType()),
    T.StructField("state_name", T.StringType()),
    T.StructField("state_code", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("mesoregion", T.StringType()),
    T.StructField("latitude", T.DecimalType(9, 6)),
    T.StructField("longitude", T.DecimalType(9, 6)),
    T.StructField("altitude_m", T.DecimalType(9, 2)),
    T.StructField("population_class", T.StringType()),
])

# Variables requested from the weather API (one parallel array each).
HOURLY_VARS = ["temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m",
               "wind_direction_10m", "surface_pressure", "cloud_cover", "visibility", "weather_code"]
DAILY_VARS = ["temperature_2m_max", "temperature_2m_min", "precipitation_sum", "rain_sum",
              "wind_speed_10m_max", "sunrise", "sunset", "uv_index_max"]


def _arr(t):
    return T.ArrayType(t)


HOURLY_BLOCK = T.StructType(
    [T.StructField("time", _arr(T.StringType()))]
    + [T.StructField(f.name, _arr(f.dataType)) for f in RAW_HOURLY.fields if f.name in HOURLY_VARS]
)
DAILY_BLOCK = T.StructType(
    [T.StructField("time", _arr(T.StringType()))]
    + [T.StructField(f.name, _arr(T.StringType() if f.name in ("sunrise", "sunset") else f.dataType))
       for f in RAW_DAILY.fields if f.name in DAILY_VARS]
)

# One landed API document per location and request window.
API_DOCUMENT = T.StructType([
    T.StructField("location_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("hourly", HOURLY_BLOCK),
    T.StructField("daily", DAILY_BLOCK),
])
