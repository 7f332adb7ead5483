"""Layer transforms: staging -> intermediate -> marts.

Each function is ``DataFrame -> DataFrame`` and stays lazy; Catalyst composes
the whole chain into one plan.  For the daily chain that plan has two
exchanges: one on (location_id, date) for the dedup (after a map-side
top-1), one on location_id for the rolling means; the location dimension is
broadcast after a row-count check.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as SF
from ..operators.dedup import latest_per_key
from ..operators.joins import dim_join, fits_broadcast
from ..operators.windows import rolling_mean, rolling_mean_split
from ..schemas import NUMERIC

ANOMALY = T.DecimalType(18, 2)


def stg_daily(raw: DataFrame, order: Sequence[Column] | None = None, loaded_at: bool = True,
              latest: Callable[..., DataFrame] = latest_per_key) -> DataFrame:
    """T1 = W1 + P1: latest extraction per (location_id, date), renamed and typed."""
    d = latest(raw, ["location_id", "date"], order)
    cols = [
        F.col("location_id").cast("string").alias("location_id"),
        F.col("date").cast("date").alias("date"),
        F.col("latitude").cast(NUMERIC).alias("latitude"),
        F.col("longitude").cast(NUMERIC).alias("longitude"),
        F.col("temperature_2m_max").cast(NUMERIC).alias("temp_max_c"),
        F.col("temperature_2m_min").cast(NUMERIC).alias("temp_min_c"),
        ((F.col("temperature_2m_max") + F.col("temperature_2m_min")).cast(NUMERIC) / 2).cast(NUMERIC)
        .alias("temp_avg_c"),
        F.col("precipitation_sum").cast(NUMERIC).alias("precipitation_mm"),
        F.col("rain_sum").cast(NUMERIC).alias("rain_mm"),
        F.col("wind_speed_10m_max").cast(NUMERIC).alias("wind_speed_max_kmh"),
        F.col("uv_index_max").cast(NUMERIC).alias("uv_index_max"),
        F.col("sunrise").cast("timestamp").alias("sunrise_at"),
        F.col("sunset").cast("timestamp").alias("sunset_at"),
        F.col("_extracted_at").cast("timestamp").alias("_extracted_at"),
    ]
    if loaded_at:
        cols.append(F.current_timestamp().alias("_loaded_at"))
    return d.select(*cols)


def stg_hourly(raw: DataFrame, order: Sequence[Column] | None = None, loaded_at: bool = True) -> DataFrame:
    """T2 = W2 + P2: latest extraction per (location_id, timestamp), renamed and typed."""
    d = latest_per_key(raw, ["location_id", "timestamp"], order)
    cols = [
        F.col("location_id").cast("string").alias("location_id"),
        F.col("timestamp").cast("timestamp").alias("observed_at"),
        F.col("latitude").cast(NUMERIC).alias("latitude"),
        F.col("longitude").cast(NUMERIC).alias("longitude"),
        F.col("elevation").cast(NUMERIC).alias("elevation_m"),
        F.col("timezone").cast("string").alias("timezone"),
        F.col("temperature_2m").cast(NUMERIC).alias("temperature_c"),
        F.col("relative_humidity_2m").cast("bigint").alias("relative_humidity_pct"),
        F.col("precipitation").cast(NUMERIC).alias("precipitation_mm"),
        F.col("wind_speed_10m").cast(NUMERIC).alias("wind_speed_kmh"),
        F.col("wind_direction_10m").cast("bigint").alias("wind_direction_deg"),
        F.col("surface_pressure").cast(NUMERIC).alias("surface_pressure_hpa"),
        F.col("cloud_cover").cast("bigint").alias("cloud_cover_pct"),
        F.col("visibility").cast(NUMERIC).alias("visibility_m"),
        F.col("weather_code").cast("bigint").alias("wmo_weather_code"),
        F.col("_extracted_at").cast("timestamp").alias("_extracted_at"),
    ]
    if loaded_at:
        cols.append(F.current_timestamp().alias("_loaded_at"))
    return d.select(*cols)


LOCATION_COLS = ["city_name", "state_name", "country", "region", "mesoregion",
                 "latitude", "longitude", "altitude_m"]
HOURLY_LOCATION_COLS = ["city_name", "state_name", "region", "mesoregion", "latitude", "longitude"]


def daily_enriched(stg: DataFrame, locations: DataFrame, rows: int = 30, split: bool = False,
                   by_month: bool = False) -> DataFrame:
    """T3 = W3 + W4 + J1 + F9.

    The rolling means run before the dimension join so the shuffle carries
    only observation columns; the broadcast join keeps the partitioning.
    Latitude / longitude come from the dimension, not the observation.
    ``split=True`` cuts each location's series into yearly blocks
    (``rolling_mean_split``) for histories too long for one task per location.
    ``by_month=True`` rebalances the rows by month before the join, for a table
    written by month: the exchange carries no dimension or derived column.
    """
    spec = {"temp_avg_30d_c": "temp_avg_c", "precip_avg_30d_mm": "precipitation_mm"}
    rolled = rolling_mean_split(stg, spec, rows=rows) if split else rolling_mean(stg, spec, rows=rows)
    if by_month:
        rolled = rolled.withColumn("_month", F.trunc("date", "month")).hint("rebalance", "_month")
    dim = locations.select("location_id", *LOCATION_COLS)
    j = dim_join(rolled, dim, "location_id", "left")
    out = [
        "location_id", "date", *LOCATION_COLS,
        "temp_max_c", "temp_min_c", "temp_avg_c", "precipitation_mm", "rain_mm",
        "wind_speed_max_kmh", "uv_index_max", "sunrise_at", "sunset_at",
        SF.daylight_hours("sunrise_at", "sunset_at").alias("daylight_hours"),
        "temp_avg_30d_c", "precip_avg_30d_mm", "_extracted_at",
    ]
    if "_loaded_at" in stg.columns:
        out.append("_loaded_at")
    return j.select(*out)


def _anomaly(value: str, baseline: str) -> Column:
    """round(value - baseline, 2) in decimals, half away from zero."""
    return F.round(F.col(value).cast(NUMERIC) - F.col(baseline).cast(NUMERIC), 2).cast(ANOMALY)


def daily_facts(enriched: DataFrame, updated_at: bool = True) -> DataFrame:
    """T4 projection (P3 + F1 + F2 + F8 + F10-F12); incremental wrapping in ``incremental``."""
    d = F.col("date")
    cols = [
        SF.surrogate_key("location_id", "date").alias("surrogate_key"),
        d.alias("date"),
        F.year(d).cast("bigint").alias("year"),
        F.month(d).cast("bigint").alias("month"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        SF.year_month(d).alias("year_month"),
        SF.dow0(d).alias("day_of_week"),
        SF.is_weekend(d).alias("is_weekend"),
        F.quarter(d).cast("bigint").alias("quarter"),
        "location_id", "city_name", "state_name", "country", "region", "mesoregion",
        "latitude", "longitude", "altitude_m",
        "temp_max_c", "temp_min_c", "temp_avg_c",
        F.round(F.col("temp_max_c") - F.col("temp_min_c"), 2).alias("temp_amplitude_c"),
        _anomaly("temp_avg_c", "temp_avg_30d_c").alias("temp_anomaly_c"),
        "temp_avg_30d_c",
        "precipitation_mm", "rain_mm", "precip_avg_30d_mm",
        _anomaly("precipitation_mm", "precip_avg_30d_mm").alias("precip_anomaly_mm"),
        SF.precipitation_class("precipitation_mm").alias("precipitation_class"),
        "wind_speed_max_kmh", "uv_index_max",
        SF.uv_risk_level("uv_index_max").alias("uv_risk_level"),
        "sunrise_at", "sunset_at", "daylight_hours", "_extracted_at",
    ]
    if "_loaded_at" in enriched.columns:
        cols.append("_loaded_at")
    if updated_at:
        cols.append(F.current_timestamp().alias("_dbt_updated_at"))
    return enriched.select(*cols)


def daily_facts_by_month(stg: DataFrame, locations: DataFrame, updated_at: bool = True,
                         seen: Callable[[DataFrame, str], DataFrame] = lambda df, model: df) -> DataFrame:
    """T3 + T4 for a table written by ``year_month``: rebalanced by month, before the join where the dimension is broadcast.

    ``seen`` may observe the layers, each by its model's name.
    """
    early = fits_broadcast(locations.select("location_id", *LOCATION_COLS))
    f = daily_facts(seen(daily_enriched(seen(stg, "stg_daily"), locations, by_month=early), "daily_enriched"), updated_at)
    return f if early else f.hint("rebalance", "year_month")


def hourly_facts_by_day(stg: DataFrame, locations: DataFrame, updated_at: bool = True,
                        seen: Callable[[DataFrame, str], DataFrame] = lambda df, model: df) -> DataFrame:
    """T5 for a table written by ``date``: rebalanced by day, before the join where the dimension is broadcast."""
    early = fits_broadcast(locations.select("location_id", *HOURLY_LOCATION_COLS))
    f = hourly_facts(seen(stg, "stg_hourly"), locations, updated_at, by_day=early)
    return f if early else f.hint("rebalance", "date")


def hourly_facts(stg: DataFrame, locations: DataFrame, updated_at: bool = True, by_day: bool = False) -> DataFrame:
    """T5 projection (J2 + P4 + F5 + F8); incremental wrapping in ``incremental``.

    ``by_day=True`` rebalances the rows by day before the join, for a table written by day.
    """
    if by_day:
        stg = stg.withColumn("_day", F.to_date("observed_at")).hint("rebalance", "_day")
    j = dim_join(stg, locations.select("location_id", *HOURLY_LOCATION_COLS), "location_id", "left")
    ts = F.col("observed_at")
    cols = [
        SF.surrogate_key("location_id", SF.instant_text("observed_at")).alias("surrogate_key"),
        "observed_at",
        F.to_date(ts).alias("date"),
        F.hour(ts).cast("bigint").alias("hour"),
        F.year(ts).cast("bigint").alias("year"),
        F.month(ts).cast("bigint").alias("month"),
        SF.year_month(F.to_date(ts)).alias("year_month"),
        "location_id", "city_name", "state_name", "region", "mesoregion", "latitude", "longitude",
        "temperature_c", "relative_humidity_pct", "precipitation_mm", "wind_speed_kmh",
        "wind_direction_deg", "surface_pressure_hpa", "cloud_cover_pct", "visibility_m",
        "wmo_weather_code", SF.wmo_label("wmo_weather_code").alias("wmo_weather_label"),
        "_extracted_at",
    ]
    if "_loaded_at" in stg.columns:
        cols.append("_loaded_at")
    if updated_at:
        cols.append(F.current_timestamp().alias("_dbt_updated_at"))
    return j.select(*cols)


def alerts(facts: DataFrame) -> DataFrame:
    """T6 = F3 + F4 + P5: one row per (location, date) that raises an alert.

    Row-local (no shuffle).  The table carries no order; ``sort_alerts`` (O2)
    gives the listing order when a consumer needs it.
    """
    cols = [
        SF.surrogate_key("location_id", "date").alias("surrogate_key"),
        "date", "year_month", "location_id", "city_name", "state_name", "region", "mesoregion",
        SF.alert_type().alias("alert_type"),
        SF.severity().alias("severity"),
        "temp_max_c", "temp_min_c", "temp_anomaly_c", "precipitation_mm", "wind_speed_max_kmh",
        "uv_index_max",
    ]
    if "_dbt_updated_at" in facts.columns:
        cols.append("_dbt_updated_at")
    return facts.select(*cols).filter(F.col("alert_type").isNotNull())


def date_spine(spark: SparkSession, start, end, inclusive: bool = True) -> DataFrame:
    """G1: one row per day from start to end.  ``start``/``end`` may be literals or
    scalar columns (e.g. ``max_date`` subqueries); the day list is generated by
    ``sequence`` inside one row, so it is bounded by the span in days."""
    s = F.lit(start).cast("date") if not hasattr(start, "_jc") else start.cast("date")
    e = F.lit(end).cast("date") if not hasattr(end, "_jc") else end.cast("date")
    if not inclusive:
        e = F.date_sub(e, 1)
    return spark.range(1).select(F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def calendar(spine: DataFrame, col: str = "date_day") -> DataFrame:
    """T7 = G2 + F18 + F19: pt-BR calendar dimension, one row per date of ``spine``."""
    d = F.col(col)
    dow = SF.dow0(d)
    doy = F.dayofyear(d)
    q = F.quarter(d)
    return spine.select(
        d.alias("dt_data"),
        F.year(d).cast("bigint").alias("ano"),
        F.month(d).cast("bigint").alias("mes"),
        F.dayofmonth(d).cast("bigint").alias("dia"),
        q.cast("bigint").alias("trimestre"),
        F.floor((doy + 6 - dow) / 7).cast("bigint").alias("semana_ano"),
        F.weekofyear(d).cast("bigint").alias("semana_iso"),
        dow.alias("dia_semana_num"),
        doy.cast("bigint").alias("dia_do_ano"),
        SF.month_name_pt(d).alias("nm_mes"),
        SF.month_abbr_pt(d).alias("nm_mes_abrev"),
        SF.weekday_name_pt(d).alias("nm_dia_semana"),
        SF.weekday_abbr_pt(d).alias("nm_dia_semana_abrev"),
        SF.season_south(d).alias("estacao"),
        SF.year_month(d).alias("ano_mes"),
        F.concat(q.cast("string"), F.lit("º Tri")).alias("nm_trimestre"),
        F.concat(F.lit("Q"), q.cast("string")).alias("sigla_trimestre"),
        dow.isin(0, 6).alias("fl_fim_de_semana"),
        F.trunc(d, "month").alias("primeiro_dia_mes"),
        F.last_day(d).alias("ultimo_dia_mes"),
        F.trunc(d, "quarter").alias("primeiro_dia_trimestre"),
        F.date_sub(F.add_months(F.trunc(d, "quarter"), 3), 1).alias("ultimo_dia_trimestre"),
        F.trunc(d, "year").alias("primeiro_dia_ano"),
        F.date_sub(F.add_months(F.trunc(d, "year"), 12), 1).alias("ultimo_dia_ano"),
        F.add_months(d, -12).alias("dt_data_ano_anterior"),
        F.date_sub(d, 1).alias("dt_data_ontem"),
        F.date_add(d, 1).alias("dt_data_amanha"),
    )
