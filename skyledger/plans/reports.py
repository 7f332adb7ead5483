"""Parametrised analytical reports over the marts.

Every report anchors its period on the table's own MAX(date) (a scalar
subquery planned once), takes parameters as literals, aggregates with
partial/final hash aggregation and returns decimals as doubles.  Listings that
are top-k reports keep their LIMIT (TakeOrderedAndProject); every ORDER BY has a
key tie-break so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label_pt
from ..functions.numeric import clean_floor, mean, round_half_even, round_half_up, to_double
from ..operators.filters import half_open, isin_filter, last_days, latest_date, max_date, optional_eq, require
from ..operators.ordering import top_k
from ..operators.windows import previous_value


def _period(df: DataFrame, days: int, meso=None, severity=None, city=None,
            anchor_df: DataFrame | None = None) -> DataFrame:
    """Rows of the last ``days`` (+1) dates of the table, then the optional filters."""
    anchor = max_date(anchor_df if anchor_df is not None else df)
    out = last_days(df, days, anchor=anchor)
    out = optional_eq(out, "mesoregion", meso)
    out = optional_eq(out, "severity", severity)
    return optional_eq(out, "city_name", city)


def _r(x: Column, n: int) -> Column:
    return round_half_up(x, n)


# ── home page ────────────────────────────────────────────────────────────────

def home_kpis(facts: DataFrame, days: int = 7, meso=None) -> DataFrame:
    """A1: mean max/min/avg temperature, rain per location, mean anomaly."""
    f = _period(facts, days, meso)
    per_loc = F.try_divide(F.sum("precipitation_mm").cast("double"),
                           F.nullif(F.count_distinct("location_id"), F.lit(0)).cast("double"))
    return f.agg(
        _r(mean("temp_max_c"), 1).alias("avg_max"),
        _r(mean("temp_min_c"), 1).alias("avg_min"),
        _r(mean("temp_avg_c"), 1).alias("avg_temp"),
        _r(per_loc, 1).alias("avg_precip"),
        _r(mean("temp_anomaly_c"), 2).alias("avg_anomaly"),
    )


def alert_count(alerts: DataFrame, days: int = 7, meso=None) -> DataFrame:
    """A2: number of alerts in the period."""
    return _period(alerts, days, meso).agg(F.count(F.lit(1)).alias("total"))


def temp_trend(facts: DataFrame, days: int = 30, meso=None) -> DataFrame:
    """A3: daily mean max/min/avg temperature."""
    return (_period(facts, days, meso).groupBy("date")
            .agg(_r(mean("temp_max_c"), 1).alias("temp_max"),
                 _r(mean("temp_min_c"), 1).alias("temp_min"),
                 _r(mean("temp_avg_c"), 1).alias("temp_avg"))
            .orderBy("date"))


def _latest_rows(facts: DataFrame, meso=None) -> DataFrame:
    """One row per location by an aggregate: the map side keeps one candidate each, nothing is sorted."""
    f = optional_eq(require(facts, "mesoregion"), "mesoregion", meso)
    cols = ["date", "city_name", "mesoregion", "latitude", "longitude", "temp_max_c", "precipitation_mm"]
    g = f.groupBy("location_id").agg(F.max_by(F.struct(*cols), "date").alias("r"))
    return g.select("location_id", *[F.col(f"r.{c}").alias(c) for c in cols])


def latest_per_location(facts: DataFrame, meso=None) -> DataFrame:
    """W6 (+F16): latest row per location for the map, with the marker size."""
    f = _latest_rows(facts, meso)
    return to_double(f.select("location_id", "city_name", "mesoregion", "latitude", "longitude",
                              "temp_max_c", "precipitation_mm",
                              clean_floor("precipitation_mm").alias("marker_size")))


def spatial_summary(facts: DataFrame, meso=None) -> DataFrame:
    """Centre and spread of the latest-row map for one region."""
    m = _latest_rows(facts, meso)
    return m.agg(
        mean("latitude").alias("center_lat"),
        mean("longitude").alias("center_lon"),
        F.greatest(F.max("latitude") - F.min("latitude"),
                   F.max("longitude") - F.min("longitude")).cast("double").alias("spread"),
    )


# ── temperature page ─────────────────────────────────────────────────────────

def hottest(facts: DataFrame, days: int = 7, n: int = 10, meso=None) -> DataFrame:
    """A4: top ``n`` cities by mean maximum temperature."""
    g = (_period(facts, days, meso).groupBy("city_name", "mesoregion")
         .agg(_r(mean("temp_max_c"), 1).alias("media_max")))
    return top_k(g, [F.col("media_max").desc_nulls_last(), F.col("city_name"), F.col("mesoregion")], n)


def coldest(facts: DataFrame, days: int = 7, n: int = 10, meso=None) -> DataFrame:
    """A5: top ``n`` cities by lowest mean minimum temperature."""
    g = (_period(facts, days, meso).groupBy("city_name", "mesoregion")
         .agg(_r(mean("temp_min_c"), 1).alias("media_min")))
    return top_k(g, [F.col("media_min").asc_nulls_first(), F.col("city_name"), F.col("mesoregion")], n)


def meso_temp(facts: DataFrame, days: int = 30, meso=None) -> DataFrame:
    """Mean temperature per mesoregion and date."""
    return (_period(facts, days, meso).groupBy("date", "mesoregion")
            .agg(_r(mean("temp_avg_c"), 1).alias("temp_avg")).orderBy("date", "mesoregion"))


def meso_anomaly(facts: DataFrame, days: int = 30) -> DataFrame:
    """Mean anomaly per mesoregion and date (no region filter, as on the page)."""
    return (_period(facts, days).groupBy("date", "mesoregion")
            .agg(_r(mean("temp_anomaly_c"), 2).alias("anomaly")).orderBy("date", "mesoregion"))


# ── rain page ────────────────────────────────────────────────────────────────

def rain_ranking(facts: DataFrame, days: int = 30, meso=None, n: int | None = None) -> DataFrame:
    """Rain total and rainy days per city; top 20 (300 inside one region)."""
    n = n or (20 if meso in (None, "all", "Todas") else 300)
    g = (_period(facts, days, meso).groupBy("city_name", "mesoregion")
         .agg(F.round(F.sum("precipitation_mm"), 1).cast("double").alias("total_mm"),
              F.count_if(F.col("precipitation_mm") > 0).alias("dias_chuva")))
    return top_k(g, [F.col("total_mm").desc_nulls_last(), F.col("city_name"), F.col("mesoregion")], n)


def rain_classes(facts: DataFrame, days: int = 30, meso=None) -> DataFrame:
    """A9 (+J8 without fallback): day count per precipitation class, with the pt-BR label."""
    g = _period(facts, days, meso).groupBy("precipitation_class").agg(F.count(F.lit(1)).alias("qtd"))
    return (g.select("precipitation_class", "qtd",
                     label_pt("precipitation_class", "precipitation_class", fallback=False).alias("classe"))
            .orderBy(F.col("qtd").desc(), "precipitation_class"))


def meso_rain(facts: DataFrame, days: int = 30) -> DataFrame:
    """A10: mean rain per mesoregion and date."""
    return (_period(facts, days).groupBy("date", "mesoregion")
            .agg(_r(mean("precipitation_mm"), 1).alias("avg_precip")).orderBy("date", "mesoregion"))


# ── alerts page ──────────────────────────────────────────────────────────────

def severity_kpis(alerts: DataFrame, days: int = 30, meso=None, severity=None) -> DataFrame:
    """Alert count, total and per severity."""
    f = _period(alerts, days, meso, severity)
    sev = F.col("severity")
    return f.agg(F.count(F.lit(1)).alias("total"),
                 *[F.count_if(sev == s).alias(s) for s in ("critical", "high", "medium", "low")])


def alerts_by_type(alerts: DataFrame, days: int = 30, meso=None, severity=None) -> DataFrame:
    """A12 (+J8/F17): alerts per type and severity, with pt-BR labels (fallback to code)."""
    g = (_period(alerts, days, meso, severity).groupBy("alert_type", "severity")
         .agg(F.count(F.lit(1)).alias("qtd")))
    return (g.select("alert_type", "severity", "qtd",
                     label_pt("alert_type", "alert_type").alias("tipo"),
                     label_pt("severity", "severity").alias("sev_pt"))
            .orderBy(F.col("qtd").desc(), "alert_type", "severity"))


def affected_cities(alerts: DataFrame, days: int = 30, meso=None, severity=None,
                    n: int | None = None) -> DataFrame:
    """Cities with most alerts; top 15 (300 inside one region)."""
    n = n or (15 if meso in (None, "all", "Todas") else 300)
    g = (_period(alerts, days, meso, severity).groupBy("city_name", "mesoregion")
         .agg(F.count(F.lit(1)).alias("alertas")))
    return top_k(g, [F.col("alertas").desc(), F.col("city_name"), F.col("mesoregion")], n)


def _alert_listing(f: DataFrame, with_place: bool) -> DataFrame:
    cols = ["date"] + (["city_name", "mesoregion"] if with_place else []) + [
        "alert_type", "severity",
        F.round("temp_max_c", 1).cast("double").alias("temp_max"),
        F.round("temp_anomaly_c", 1).cast("double").alias("anomalia"),
        F.round("precipitation_mm", 1).cast("double").alias("precip"),
        F.round("wind_speed_max_kmh", 1).cast("double").alias("vento_max" if with_place else "vento"),
        F.col("uv_index_max").cast("double").alias("uv_index_max"),
    ]
    return f.select(*cols)


def recent_alerts(alerts: DataFrame, days: int = 30, meso=None, severity=None, n: int = 200) -> DataFrame:
    """O3: latest alerts, date DESC then severity text ASC, top ``n``."""
    f = _period(alerts, days, meso, severity)
    f = top_k(f, [F.col("date").desc(), F.col("severity").asc(), F.col("location_id")], n)
    return _alert_listing(f, True)


def sort_alerts(alerts: DataFrame) -> DataFrame:
    """O2: alerts table order: date DESC, severity (text) DESC, then key."""
    return alerts.orderBy(F.col("date").desc(), F.col("severity").desc(), "location_id")


# ── hourly pages ─────────────────────────────────────────────────────────────

def _city_hourly(hourly: DataFrame, city: str) -> DataFrame:
    return hourly.filter(F.col("city_name") == F.lit(city))


def hour_profile(hourly: DataFrame, city: str, days: int = 7) -> DataFrame:
    """24-hour profile of one city over its last ``days`` (+1) dates."""
    h = last_days(_city_hourly(hourly, city), days, anchor=city_day(hourly, city))
    per_day = F.try_divide(F.sum("precipitation_mm").cast("double"),
                           F.nullif(F.count_distinct("date"), F.lit(0)).cast("double"))
    return (h.groupBy("hour")
            .agg(_r(mean("temperature_c"), 1).alias("avg_temp"),
                 _r(mean("relative_humidity_pct"), 1).alias("avg_humidity"),
                 _r(mean("wind_speed_kmh"), 1).alias("avg_wind"),
                 _r(per_day, 2).alias("avg_precip_dia"))
            .orderBy("hour"))


def city_window(hourly: DataFrame, city: str, days: int = 7,
                cols: Sequence[str] = ("temperature_c", "relative_humidity_pct")) -> DataFrame:
    """One city's hourly series over its last ``days`` (+1) dates."""
    h = last_days(_city_hourly(hourly, city), days, anchor=city_day(hourly, city))
    return to_double(h.select("observed_at", *cols)).orderBy("observed_at")


def city_day(hourly: DataFrame, city: str) -> Column:
    """Default reference day for the day-vs-history pages: the city's latest date."""
    return latest_date(hourly, F.col("city_name") == F.lit(city))


def day_profile(hourly: DataFrame, city: str, day: Column | str | None = None) -> DataFrame:
    """Hourly mean temperature / humidity of one city on one day."""
    h = _city_hourly(hourly, city)
    day = city_day(hourly, city) if day is None else F.lit(day).cast("date") if isinstance(day, str) else day
    return (h.filter(F.col("date") == day).groupBy("hour")
            .agg(_r(mean("temperature_c"), 1).alias("temp"),
                 _r(mean("relative_humidity_pct"), 1).alias("humidity"))
            .orderBy("hour"))


def prior_profile(hourly: DataFrame, city: str, day: Column | str | None = None, n: int = 30) -> DataFrame:
    """Hourly means of the ``n`` days before ``day`` (half-open [day-n, day))."""
    h = _city_hourly(hourly, city)
    day = city_day(hourly, city) if day is None else F.lit(day).cast("date") if isinstance(day, str) else day
    return (half_open(h, F.date_sub(day, n), day).groupBy("hour")
            .agg(_r(mean("temperature_c"), 1).alias("avg_temp"),
                 _r(mean("relative_humidity_pct"), 1).alias("avg_humidity"))
            .orderBy("hour"))


def compare_profiles(hourly: DataFrame, city: str, day: Column | str | None = None) -> DataFrame:
    """The day's profile LEFT JOIN the prior profile on hour, per-hour difference."""
    day = city_day(hourly, city) if day is None else day
    a = day_profile(hourly, city, day)
    h = prior_profile(hourly, city, day)
    m = a.join(h, "hour", "left")
    return m.select("hour", "temp", "humidity", "avg_temp", "avg_humidity",
                    round_half_even(F.col("temp") - F.col("avg_temp"), 1).alias("diff_temp"))


def day_vs_history(hourly: DataFrame, city: str, day: Column | str | None = None) -> DataFrame:
    """Mean / max / min of the per-hour deviations."""
    m = compare_profiles(hourly, city, day)
    return m.agg(mean(F.col("diff_temp").cast("decimal(18,1)")).alias("avg_diff"),
                 F.max("diff_temp").alias("max_diff"), F.min("diff_temp").alias("min_diff"))


# ── city pages ───────────────────────────────────────────────────────────────

def city_period(facts: DataFrame, city: str, days: int = 90) -> DataFrame:
    """P12 (daily): one city's daily facts in the period (table-anchored)."""
    return _period(facts, days, city=city)


def city_summary(facts: DataFrame, city: str, days: int = 90) -> DataFrame:
    """Mean max, mean min, rain total, mean anomaly; rounded half-even (as pandas)."""
    f = city_period(facts, city, days)
    return f.agg(
        round_half_even(mean("temp_max_c"), 1).alias("temp_max_c"),
        round_half_even(mean("temp_min_c"), 1).alias("temp_min_c"),
        round_half_even(F.coalesce(F.sum("precipitation_mm").cast("double"), F.lit(0.0)), 1)
        .alias("precipitation_mm"),
        round_half_even(mean("temp_anomaly_c"), 1).alias("temp_anomaly_c"),
    )


def city_rain(facts: DataFrame, city: str, days: int = 90) -> DataFrame:
    """Rain total, rainy days and day count for one city."""
    f = city_period(facts, city, days)
    return f.agg(F.coalesce(F.sum("precipitation_mm").cast("double"), F.lit(0.0)).alias("total_rain"),
                 F.count_if(F.col("precipitation_mm") > 0).alias("rain_days"),
                 F.count(F.lit(1)).alias("n_days"))


def city_alerts(alerts: DataFrame, city: str, days: int = 90, n: int = 100) -> DataFrame:
    """One city's alerts, newest first, top ``n``."""
    f = _period(alerts, days, city=city)
    f = top_k(f, [F.col("date").desc(), F.col("alert_type")], n)
    return _alert_listing(f, False)


def location_catalogue(locations: DataFrame) -> DataFrame:
    """City list with coordinates rounded to 4 places."""
    return (require(locations, "city_name")
            .select("city_name", "mesoregion",
                    F.round("latitude", 4).cast("double").alias("latitude"),
                    F.round("longitude", 4).cast("double").alias("longitude"),
                    F.col("altitude_m").cast("double").alias("altitude_m"))
            .orderBy("city_name", "mesoregion"))


# ── comparison page ──────────────────────────────────────────────────────────

METRICS = {"temp_max": "temp_max_c", "temp_min": "temp_min_c", "temp_avg": "temp_avg_c",
           "precip": "precipitation_mm"}


def city_series(facts: DataFrame, cities: Sequence[str], metric: str = "temp_max_c",
                days: int = 30) -> DataFrame:
    """Daily value of one metric for 2-3 cities."""
    f = isin_filter(last_days(facts, days), "city_name", cities)
    return (f.select("date", "city_name", F.round(metric, 1).cast("double").alias("valor"))
            .orderBy("date", "city_name"))


def city_compare(facts: DataFrame, cities: Sequence[str], metric: str = "temp_max_c",
                 days: int = 30) -> DataFrame:
    """Min / max / mean of the series per city (pandas-style half-even rounding)."""
    s = city_series(facts, cities, metric, days)
    return (s.groupBy("city_name")
            .agg(round_half_even(F.min("valor"), 1).alias("minimo"),
                 round_half_even(F.max("valor"), 1).alias("maximo"),
                 round_half_even(F.try_divide(F.sum(F.col("valor").cast("decimal(18,1)")).cast("double"),
                                              F.count("valor").cast("double")), 1).alias("media"))
            .orderBy("city_name"))


def city_date_rain(facts: DataFrame, meso: str, days: int = 30) -> DataFrame:
    """Rain sum per city and date inside one mesoregion."""
    f = optional_eq(last_days(facts, days), "mesoregion", meso)
    return (f.groupBy("date", "city_name")
            .agg(F.round(F.sum("precipitation_mm"), 1).cast("double").alias("precipitation_mm"))
            .orderBy("city_name", "date"))


# ── pivots ───────────────────────────────────────────────────────────────────

def _pivot_days(long: DataFrame, index: str, value: str, anchor: Column, days: int,
                fill: float | None) -> DataFrame:
    """Pivot ``long`` (index, date, value) to one column per day offset d_0..d_days.

    d_k is the date MAX(date) - k.  Giving the pivot values explicitly fixes the
    schema and saves Spark the extra job that discovers distinct values.
    """
    offs = list(range(days + 1))
    p = (long.withColumn("_off", F.datediff(anchor, F.col("date")))
         .groupBy(index).pivot("_off", offs).agg(F.first(value)))
    p = p.select(index, *[F.col(str(k)).alias(f"d_{k}") for k in offs])
    if fill is not None:
        p = p.na.fill(fill, [f"d_{k}" for k in offs])
    return p.orderBy(index)


def pivot_anomaly(facts: DataFrame, days: int = 30) -> DataFrame:
    """Mesoregion x day mean anomaly; missing cells stay NULL."""
    return _pivot_days(meso_anomaly(facts, days), "mesoregion", "anomaly", max_date(facts), days, None)


def pivot_meso_rain(facts: DataFrame, days: int = 30) -> DataFrame:
    """Mesoregion x day mean rain; missing cells 0."""
    return _pivot_days(meso_rain(facts, days), "mesoregion", "avg_precip", max_date(facts), days, 0.0)


def pivot_city_rain(facts: DataFrame, meso: str, days: int = 30) -> DataFrame:
    """City x day rain sum inside one mesoregion; missing cells 0."""
    return _pivot_days(city_date_rain(facts, meso, days), "city_name", "precipitation_mm",
                       max_date(facts), days, 0.0)


# ── lookups and audits ───────────────────────────────────────────────────────

def max_dates(facts: DataFrame, alerts: DataFrame, hourly: DataFrame) -> DataFrame:
    """MAX(date) of each mart, one row."""
    return facts.sparkSession.range(1).select(max_date(facts).alias("max_daily"),
                                               max_date(alerts).alias("max_alerts"),
                                               latest_date(hourly).alias("max_hourly"))


def max_date_per_city(hourly: DataFrame) -> DataFrame:
    """A25 per city: MAX(date) of the hourly facts by city."""
    return hourly.groupBy("city_name").agg(F.max("date").alias("max_date"))


def row_and_location_counts(raw_daily: DataFrame, raw_hourly: DataFrame) -> DataFrame:
    """Raw row counts and distinct locations."""
    n_hourly = raw_hourly.select(F.count(F.lit(1))).scalar()
    return (raw_daily.agg(F.count(F.lit(1)).alias("daily_rows"),
                          F.count_distinct("location_id").alias("municipios_coletados"))
            .select("*", n_hourly.alias("hourly_rows")))


def rows_per_location(raw: DataFrame) -> DataFrame:
    """Raw rows per location."""
    return raw.groupBy("location_id").agg(F.count(F.lit(1)).alias("total")).orderBy("location_id")


def previous_dates(facts: DataFrame) -> DataFrame:
    """Each (location, date) with the previous date of that location."""
    return previous_value(facts.select("location_id", "date"), "date", "location_id", "prev_date")
