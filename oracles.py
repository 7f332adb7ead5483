"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code: plain SQL over the driver's tables,
built from shared CTE text.  The bridge expressions repeat those of
``skyledger.plans.bridge``; the rest follows the layer and report semantics.
Means are exact sums divided once in double and rounding is the IEEE form of
half-away-from-zero, so both engines produce identical doubles.
"""

from __future__ import annotations

NULLKEY = "'_dbt_utils_surrogate_key_null_'"
CITY = "'Supplier#000000001'"
CITIES = "('Supplier#000000001', 'Supplier#000000002', 'Supplier#000000003')"
MESO = "'ASIA'"


def rhu(e: str, n: int) -> str:
    p = f"{10 ** n}.0"
    return (f"(CASE WHEN ({e}) < 0 THEN -(floor(abs({e}) * {p} + 0.5) / {p}) "
            f"ELSE floor(abs({e}) * {p} + 0.5) / {p} END)")


def rhe(e: str, n: int) -> str:
    p = f"{10 ** n}.0"
    return f"(round_even(CAST({e} AS DOUBLE) * {p}, 0) / {p})"


def mean(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def units(x: str) -> str:
    """A DECIMAL(18,9) as a whole number of 1e-9."""
    return f"CAST(({x}) * CAST(1000000000 AS DECIMAL(20,0)) AS HUGEINT)"


def half_away(num: str, den: str) -> str:
    """num / den of whole numbers, den > 0, rounded half away from zero."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def numeric_mean(x: str, w: str) -> str:
    """AVG of a NUMERIC over a window as NUMERIC: nine places, half away from zero."""
    n = f"NULLIF(COUNT({x}) OVER {w}, 0)"
    return f"CAST(CAST({half_away(f'SUM({units(x)}) OVER {w}', n)} AS DECIMAL(27,0)) * 0.000000001 AS DECIMAL(18,9))"


def anomaly(value: str, baseline: str) -> str:
    d = f"({units(value)} - {units(baseline)})"
    return f"CAST(CAST({half_away(d, '10000000')} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


def skey(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), {NULLKEY})" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def dbl(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in cols)


LOCATIONS = """
locations AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS location_id, s.s_name AS city_name, n.n_name AS state_name,
         upper(substr(n.n_name, 1, 2)) AS state_code, 'BR' AS country, r.r_name AS region, r.r_name AS mesoregion,
         CAST(-26.0 - (s.s_suppkey % 40) / 10.0 AS DECIMAL(9,4)) AS latitude,
         CAST(-48.0 - (s.s_suppkey % 60) / 10.0 AS DECIMAL(9,4)) AS longitude,
         CAST(s.s_nationkey AS DECIMAL(9,2)) AS altitude_m, 'small' AS population_class
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

RAW_DAILY = """
raw_daily AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS location_id, CAST(l_shipdate AS DATE) AS date,
         CAST(l_quantity AS DOUBLE) AS temperature_2m_max,
         CAST(l_quantity - round(l_discount * 100) AS DOUBLE) AS temperature_2m_min,
         CAST(nullif(3 * l_linenumber * CAST(round(l_tax * 100) AS INTEGER), 9) AS DOUBLE) AS precipitation_sum,
         CAST(nullif(3 * l_linenumber * CAST(round(l_tax * 100) AS INTEGER), 9) AS DOUBLE) AS rain_sum,
         CAST(floor(l_extendedprice / 1000) AS DOUBLE) AS wind_speed_10m_max,
         CAST(l_shipdate AS DATE) + to_minutes(300 + l_partkey % 60) AS sunrise,
         CAST(l_shipdate AS DATE) + to_minutes(1080 + 7 * l_linenumber) AS sunset,
         CAST(nullif(CAST(l_partkey % 13 AS INTEGER), 7) AS DOUBLE) AS uv_index_max,
         make_timestamp(l_orderkey * 1000000) AS _extracted_at,
         l_orderkey, l_linenumber, l_partkey, l_extendedprice
  FROM lineitem
)"""

STG_DAILY = """
stg_daily AS (
  SELECT location_id, date,
         CAST(temperature_2m_max AS DECIMAL(18,9)) AS temp_max_c,
         CAST(temperature_2m_min AS DECIMAL(18,9)) AS temp_min_c,
         CAST(CAST(temperature_2m_max + temperature_2m_min AS DECIMAL(18,9)) / 2 AS DECIMAL(18,9)) AS temp_avg_c,
         CAST(precipitation_sum AS DECIMAL(18,9)) AS precipitation_mm,
         CAST(rain_sum AS DECIMAL(18,9)) AS rain_mm,
         CAST(wind_speed_10m_max AS DECIMAL(18,9)) AS wind_speed_max_kmh,
         CAST(uv_index_max AS DECIMAL(18,9)) AS uv_index_max,
         sunrise AS sunrise_at, sunset AS sunset_at, _extracted_at
  FROM (SELECT *, row_number() OVER (PARTITION BY location_id, date
                  ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS rn
        FROM raw_daily WHERE location_id IS NOT NULL AND date IS NOT NULL) x
  WHERE rn = 1
)"""

ENRICHED = f"""
enriched AS (
  SELECT d.location_id, d.date, l.city_name, l.state_name, l.country, l.region, l.mesoregion,
         l.latitude, l.longitude, l.altitude_m,
         d.temp_max_c, d.temp_min_c, d.temp_avg_c, d.precipitation_mm, d.rain_mm,
         d.wind_speed_max_kmh, d.uv_index_max, d.sunrise_at, d.sunset_at,
         CAST(epoch(d.sunset_at) - epoch(d.sunrise_at) AS BIGINT) / 3600.0 AS daylight_hours,
         {numeric_mean('d.temp_avg_c', 'w')} AS temp_avg_30d_c,
         {numeric_mean('d.precipitation_mm', 'w')} AS precip_avg_30d_mm,
         d._extracted_at
  FROM stg_daily d LEFT JOIN locations l ON d.location_id = l.location_id
  WINDOW w AS (PARTITION BY d.location_id ORDER BY d.date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
)"""

FACTS = f"""
facts AS (
  SELECT {skey('location_id', 'date')} AS surrogate_key,
         date, year(date) AS year, month(date) AS month, day(date) AS day,
         strftime(date, '%Y-%m') AS year_month, dayofweek(date) AS day_of_week,
         dayofweek(date) IN (0, 6) AS is_weekend, quarter(date) AS quarter,
         location_id, city_name, state_name, country, region, mesoregion, latitude, longitude, altitude_m,
         temp_max_c, temp_min_c, temp_avg_c,
         round(temp_max_c - temp_min_c, 2) AS temp_amplitude_c,
         {anomaly('temp_avg_c', 'temp_avg_30d_c')} AS temp_anomaly_c,
         temp_avg_30d_c,
         precipitation_mm, rain_mm, precip_avg_30d_mm,
         {anomaly('precipitation_mm', 'precip_avg_30d_mm')} AS precip_anomaly_mm,
         CASE WHEN precipitation_mm = 0 THEN 'dry' WHEN precipitation_mm < 5 THEN 'light'
              WHEN precipitation_mm < 20 THEN 'moderate' WHEN precipitation_mm < 50 THEN 'heavy'
              ELSE 'extreme' END AS precipitation_class,
         wind_speed_max_kmh, uv_index_max,
         CASE WHEN uv_index_max < 3 THEN 'low' WHEN uv_index_max < 6 THEN 'moderate'
              WHEN uv_index_max < 8 THEN 'high' WHEN uv_index_max < 11 THEN 'very_high'
              ELSE 'extreme' END AS uv_risk_level,
         sunrise_at, sunset_at, daylight_hours, _extracted_at
  FROM enriched
)"""

ALERTS = f"""
alerts AS (
  SELECT * FROM (
    SELECT {skey('location_id', 'date')} AS surrogate_key, date, year_month, location_id, city_name,
           state_name, region, mesoregion,
           CASE WHEN temp_max_c > 40 THEN 'extreme_heat' WHEN temp_min_c < 0 THEN 'frost'
                WHEN precipitation_mm > 80 THEN 'heavy_rain' WHEN wind_speed_max_kmh > 90 THEN 'high_winds'
                WHEN uv_index_max >= 11 THEN 'extreme_uv' WHEN temp_anomaly_c > 5 THEN 'heat_anomaly'
                WHEN temp_anomaly_c < -5 THEN 'cold_anomaly' WHEN precip_anomaly_mm > 40 THEN 'precip_anomaly'
                ELSE NULL END AS alert_type,
           CASE WHEN temp_max_c > 45 OR precipitation_mm > 150 THEN 'critical'
                WHEN temp_max_c > 40 OR precipitation_mm > 80 THEN 'high'
                WHEN temp_anomaly_c > 5 OR uv_index_max >= 11 THEN 'medium'
                ELSE 'low' END AS severity,
           temp_max_c, temp_min_c, temp_anomaly_c, precipitation_mm, wind_speed_max_kmh, uv_index_max
    FROM facts) a
  WHERE alert_type IS NOT NULL
)"""

RAW_HOURLY = """
raw_hourly AS (
  SELECT CAST(user_id AS VARCHAR) AS location_id, date_trunc('hour', ts) AS "timestamp",
         CAST(-26.0 - (user_id % 40) / 10.0 AS DOUBLE) AS latitude,
         CAST(-48.0 - (user_id % 60) / 10.0 AS DOUBLE) AS longitude,
         CAST(user_id % 50 AS DOUBLE) AS elevation, 'America/Sao_Paulo' AS timezone,
         CAST(floor(value / 10) AS DOUBLE) AS temperature_2m,
         CAST(event_id % 101 AS BIGINT) AS relative_humidity_2m,
         CAST(nullif(event_id % 7, 6) AS DOUBLE) AS precipitation,
         CAST(floor(value / 4) AS DOUBLE) AS wind_speed_10m,
         CAST(event_id % 361 AS BIGINT) AS wind_direction_10m,
         CAST(990 + event_id % 40 AS DOUBLE) AS surface_pressure,
         CAST(event_id % 101 AS BIGINT) AS cloud_cover,
         CAST(1000 * (event_id % 25) AS DOUBLE) AS visibility,
         CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS weather_code,
         make_timestamp(event_id * 1000000) AS _extracted_at,
         event_id
  FROM events
)"""

STG_HOURLY = """
stg_hourly AS (
  SELECT location_id, "timestamp" AS observed_at,
         CAST(latitude AS DECIMAL(18,9)) AS latitude, CAST(longitude AS DECIMAL(18,9)) AS longitude,
         CAST(elevation AS DECIMAL(18,9)) AS elevation_m, timezone,
         CAST(temperature_2m AS DECIMAL(18,9)) AS temperature_c,
         CAST(relative_humidity_2m AS BIGINT) AS relative_humidity_pct,
         CAST(precipitation AS DECIMAL(18,9)) AS precipitation_mm,
         CAST(wind_speed_10m AS DECIMAL(18,9)) AS wind_speed_kmh,
         CAST(wind_direction_10m AS BIGINT) AS wind_direction_deg,
         CAST(surface_pressure AS DECIMAL(18,9)) AS surface_pressure_hpa,
         CAST(cloud_cover AS BIGINT) AS cloud_cover_pct,
         CAST(visibility AS DECIMAL(18,9)) AS visibility_m,
         CAST(weather_code AS BIGINT) AS wmo_weather_code, _extracted_at
  FROM (SELECT *, row_number() OVER (PARTITION BY location_id, "timestamp" ORDER BY event_id DESC) AS rn
        FROM raw_hourly WHERE location_id IS NOT NULL AND "timestamp" IS NOT NULL) x
  WHERE rn = 1
)"""

WMO = [(0, "Clear sky"), (1, "Mainly clear"), (2, "Partly cloudy"), (3, "Overcast"), (45, "Fog"),
       (48, "Icy fog"), (51, "Light drizzle"), (53, "Moderate drizzle"), (55, "Dense drizzle"),
       (61, "Slight rain"), (63, "Moderate rain"), (65, "Heavy rain"), (71, "Slight snow"),
       (73, "Moderate snow"), (75, "Heavy snow"), (77, "Snow grains"), (80, "Slight showers"),
       (81, "Moderate showers"), (82, "Violent showers"), (85, "Slight snow showers"),
       (86, "Heavy snow showers"), (95, "Thunderstorm"), (96, "Thunderstorm with hail"),
       (99, "Thunderstorm with heavy hail")]
WMO_CASE = "CASE h.wmo_weather_code " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in WMO) + " ELSE 'Unknown' END"

HOURLY_FACTS = f"""
hourly_facts AS (
  SELECT {skey('h.location_id', "CAST(h.observed_at AS VARCHAR) || '+00'")} AS surrogate_key, h.observed_at,
         CAST(h.observed_at AS DATE) AS date, hour(h.observed_at) AS hour, year(h.observed_at) AS year,
         month(h.observed_at) AS month, strftime(CAST(h.observed_at AS DATE), '%Y-%m') AS year_month,
         h.location_id, l.city_name, l.state_name, l.region, l.mesoregion, l.latitude, l.longitude,
         h.temperature_c, h.relative_humidity_pct, h.precipitation_mm, h.wind_speed_kmh, h.wind_direction_deg,
         h.surface_pressure_hpa, h.cloud_cover_pct, h.visibility_m, h.wmo_weather_code,
         {WMO_CASE} AS wmo_weather_label, h._extracted_at
  FROM stg_hourly h LEFT JOIN locations l ON h.location_id = l.location_id
)"""

DAILY_CHAIN = [LOCATIONS, RAW_DAILY, STG_DAILY, ENRICHED, FACTS]
ALERT_CHAIN = DAILY_CHAIN + [ALERTS]
HOURLY_CHAIN = [LOCATIONS, RAW_HOURLY, STG_HOURLY, HOURLY_FACTS]


def with_(ctes, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def period(table: str, days: int, extra: str = "") -> str:
    return f"date >= (SELECT max(date) FROM {table}) - {days} {extra}"


FACT_COLS_DEC = ["latitude", "longitude", "altitude_m", "temp_max_c", "temp_min_c", "temp_avg_c",
                 "temp_amplitude_c", "temp_anomaly_c", "precipitation_mm", "rain_mm", "precip_anomaly_mm",
                 "wind_speed_max_kmh", "uv_index_max"]


def _queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["t1_stg_daily"] = with_(
        [RAW_DAILY, STG_DAILY],
        "SELECT location_id, date, " + dbl("temp_max_c", "temp_min_c", "temp_avg_c", "precipitation_mm",
                                           "rain_mm", "wind_speed_max_kmh", "uv_index_max")
        + ", sunrise_at, sunset_at, _extracted_at FROM stg_daily")
    q["t3_daily_enriched"] = with_(
        [LOCATIONS, RAW_DAILY, STG_DAILY, ENRICHED],
        "SELECT location_id, date, city_name, mesoregion, " + dbl("latitude", "longitude", "temp_avg_c")
        + ", daylight_hours, " + dbl("temp_avg_30d_c", "precip_avg_30d_mm") + " FROM enriched")
    q["t4_daily_facts"] = with_(
        DAILY_CHAIN,
        "SELECT surrogate_key, date, year, month, day, year_month, day_of_week, is_weekend, quarter, "
        "location_id, city_name, state_name, country, region, mesoregion, "
        + dbl(*FACT_COLS_DEC)
        + ", " + dbl("temp_avg_30d_c", "precip_avg_30d_mm") + ", precipitation_class, uv_risk_level, daylight_hours FROM facts")
    q["t6_alerts"] = with_(
        ALERT_CHAIN,
        "SELECT surrogate_key, date, year_month, location_id, city_name, state_name, region, mesoregion, "
        "alert_type, severity, " + dbl("temp_max_c", "temp_min_c", "temp_anomaly_c", "precipitation_mm",
                                        "wind_speed_max_kmh", "uv_index_max") + " FROM alerts")
    q["a3_temp_trend"] = with_(
        DAILY_CHAIN,
        f"SELECT date, {rhu(mean('temp_max_c'), 1)} AS temp_max, {rhu(mean('temp_min_c'), 1)} AS temp_min, "
        f"{rhu(mean('temp_avg_c'), 1)} AS temp_avg FROM facts WHERE {period('facts', 30)} "
        "GROUP BY date ORDER BY date")
    return q


def oracle_queries() -> dict[str, str]:
    return _queries()


HOURLY_DEC = ["latitude", "longitude", "temperature_c", "precipitation_mm", "wind_speed_kmh",
              "surface_pressure_hpa", "visibility_m"]
ALL_CHAIN = [LOCATIONS, RAW_DAILY, STG_DAILY, ENRICHED, FACTS, ALERTS, RAW_HOURLY, STG_HOURLY, HOURLY_FACTS]

PT_ALERT = ("CASE alert_type WHEN 'cold_anomaly' THEN 'Anomalia de Frio' "
            "WHEN 'precip_anomaly' THEN 'Anomalia de Precipitação' WHEN 'heat_anomaly' THEN 'Anomalia de Calor' "
            "WHEN 'heavy_rain' THEN 'Chuva Forte' ELSE alert_type END")
PT_SEV = ("CASE severity WHEN 'critical' THEN 'Crítica' WHEN 'high' THEN 'Alta' WHEN 'medium' THEN 'Média' "
          "WHEN 'low' THEN 'Baixa' ELSE severity END")
PT_CLASS = ("CASE precipitation_class WHEN 'dry' THEN 'Seco' WHEN 'light' THEN 'Leve' "
            "WHEN 'moderate' THEN 'Moderado' WHEN 'heavy' THEN 'Forte' WHEN 'extreme' THEN 'Extremo' END")


def city_anchor(days: int) -> str:
    return f"date >= (SELECT max(date) FROM hourly_facts WHERE city_name = {CITY}) - {days}"


CITY_DAY = f"(SELECT max(date) FROM hourly_facts WHERE city_name = {CITY})"


def pivot(src: str, index: str, value: str, days: int, fill: bool) -> str:
    cells = []
    for k in range(days + 1):
        c = f"MAX(CASE WHEN (SELECT max(date) FROM facts) - date = {k} THEN {value} END)"
        cells.append(f"{'COALESCE(' + c + ', 0.0)' if fill else c} AS d_{k}")
    return f"SELECT {index}, {', '.join(cells)} FROM ({src}) p GROUP BY {index} ORDER BY {index}"


def _more() -> dict[str, str]:
    q: dict[str, str] = {}
    D, A, H = DAILY_CHAIN, ALERT_CHAIN, HOURLY_CHAIN
    q["t2_stg_hourly"] = with_(
        [RAW_HOURLY, STG_HOURLY],
        "SELECT location_id, observed_at, " + dbl("latitude", "longitude", "elevation_m") + ", timezone, "
        + dbl("temperature_c") + ", relative_humidity_pct, " + dbl("precipitation_mm", "wind_speed_kmh")
        + ", wind_direction_deg, " + dbl("surface_pressure_hpa") + ", cloud_cover_pct, " + dbl("visibility_m")
        + ", wmo_weather_code, _extracted_at FROM stg_hourly")
    q["t5_hourly_facts"] = with_(
        H,
        "SELECT surrogate_key, observed_at, date, hour, year, month, year_month, location_id, city_name, "
        "state_name, region, mesoregion, " + dbl("latitude", "longitude", "temperature_c")
        + ", relative_humidity_pct, " + dbl("precipitation_mm", "wind_speed_kmh") + ", wind_direction_deg, "
        + dbl("surface_pressure_hpa") + ", cloud_cover_pct, " + dbl("visibility_m")
        + ", wmo_weather_code, wmo_weather_label, _extracted_at FROM hourly_facts")
    kpis = (f"SELECT {rhu(mean('temp_max_c'), 1)} AS avg_max, {rhu(mean('temp_min_c'), 1)} AS avg_min, "
            f"{rhu(mean('temp_avg_c'), 1)} AS avg_temp, "
            f"{rhu('CAST(SUM(precipitation_mm) AS DOUBLE) / NULLIF(COUNT(DISTINCT location_id), 0)', 1)} AS avg_precip, "
            f"{rhu(mean('temp_anomaly_c'), 2)} AS avg_anomaly FROM facts WHERE {period('facts', 7)}")
    q["a1_home_kpis"] = with_(D, kpis)
    q["a1_home_kpis_meso"] = with_(D, kpis + f" AND mesoregion = {MESO}")
    q["a2_alert_count"] = with_(A, f"SELECT COUNT(*) AS total FROM alerts WHERE {period('alerts', 7)}")
    q["a3_temp_trend_meso"] = with_(
        D, f"SELECT date, {rhu(mean('temp_max_c'), 1)} AS temp_max, {rhu(mean('temp_min_c'), 1)} AS temp_min, "
           f"{rhu(mean('temp_avg_c'), 1)} AS temp_avg FROM facts WHERE {period('facts', 90)} "
           f"AND mesoregion = {MESO} GROUP BY date ORDER BY date")
    q["a4_hottest"] = with_(
        D, f"SELECT city_name, mesoregion, {rhu(mean('temp_max_c'), 1)} AS media_max FROM facts "
           f"WHERE {period('facts', 7)} GROUP BY city_name, mesoregion "
           "ORDER BY media_max DESC NULLS LAST, city_name, mesoregion LIMIT 10")
    q["a5_coldest"] = with_(
        D, f"SELECT city_name, mesoregion, {rhu(mean('temp_min_c'), 1)} AS media_min FROM facts "
           f"WHERE {period('facts', 7)} GROUP BY city_name, mesoregion "
           "ORDER BY media_min ASC NULLS FIRST, city_name, mesoregion LIMIT 10")
    q["a6_meso_temp"] = with_(
        D, f"SELECT date, mesoregion, {rhu(mean('temp_avg_c'), 1)} AS temp_avg FROM facts "
           f"WHERE {period('facts', 30)} GROUP BY date, mesoregion ORDER BY date")
    meso_anom = (f"SELECT date, mesoregion, {rhu(mean('temp_anomaly_c'), 2)} AS anomaly FROM facts "
                 f"WHERE {period('facts', 30)} GROUP BY date, mesoregion")
    q["a7_meso_anomaly"] = with_(D, meso_anom)
    rank = (f"SELECT city_name, mesoregion, CAST(round(SUM(precipitation_mm), 1) AS DOUBLE) AS total_mm, "
            "COUNT(CASE WHEN precipitation_mm > 0 THEN 1 END) AS dias_chuva FROM facts "
            f"WHERE {period('facts', 30)} {{f}} GROUP BY city_name, mesoregion "
            "ORDER BY total_mm DESC NULLS LAST, city_name, mesoregion LIMIT {n}")
    q["a8_rain_ranking"] = with_(D, rank.format(f="", n=20))
    q["a8_rain_ranking_meso"] = with_(D, rank.format(f=f"AND mesoregion = {MESO}", n=300))
    q["a9_rain_classes"] = with_(
        D, f"SELECT precipitation_class, COUNT(*) AS qtd, {PT_CLASS} AS classe FROM facts "
           f"WHERE {period('facts', 30)} GROUP BY precipitation_class")
    meso_rain = (f"SELECT date, mesoregion, {rhu(mean('precipitation_mm'), 1)} AS avg_precip FROM facts "
                 f"WHERE {period('facts', 30)} GROUP BY date, mesoregion")
    q["a10_meso_rain"] = with_(D, meso_rain)
    sev = ("SELECT COUNT(*) AS total, COUNT(CASE WHEN severity = 'critical' THEN 1 END) AS critical, "
           "COUNT(CASE WHEN severity = 'high' THEN 1 END) AS high, "
           "COUNT(CASE WHEN severity = 'medium' THEN 1 END) AS medium, "
           "COUNT(CASE WHEN severity = 'low' THEN 1 END) AS low FROM alerts WHERE ")
    q["a11_severity_kpis"] = with_(A, sev + period("alerts", 30))
    q["a11_severity_kpis_filtered"] = with_(
        A, sev + period("alerts", 60) + f" AND mesoregion = {MESO} AND severity = 'high'")
    q["a12_alerts_by_type"] = with_(
        A, f"SELECT alert_type, severity, COUNT(*) AS qtd, {PT_ALERT} AS tipo, {PT_SEV} AS sev_pt FROM alerts "
           f"WHERE {period('alerts', 30)} GROUP BY alert_type, severity")
    q["a13_affected_cities"] = with_(
        A, f"SELECT city_name, mesoregion, COUNT(*) AS alertas FROM alerts WHERE {period('alerts', 30)} "
           "GROUP BY city_name, mesoregion ORDER BY alertas DESC, city_name, mesoregion LIMIT 15")
    city90 = f"city_name = {CITY} AND {period('facts', 90)}"
    q["a15_city_summary"] = with_(
        D, f"SELECT {rhe(mean('temp_max_c'), 1)} AS temp_max_c, {rhe(mean('temp_min_c'), 1)} AS temp_min_c, "
           f"{rhe('coalesce(CAST(SUM(precipitation_mm) AS DOUBLE), 0.0)', 1)} AS precipitation_mm, "
           f"{rhe(mean('temp_anomaly_c'), 1)} AS temp_anomaly_c FROM facts WHERE {city90}")
    q["a16_city_rain"] = with_(
        D, "SELECT coalesce(CAST(SUM(precipitation_mm) AS DOUBLE), 0.0) AS total_rain, "
           "COUNT(CASE WHEN precipitation_mm > 0 THEN 1 END) AS rain_days, COUNT(*) AS n_days "
           f"FROM facts WHERE {city90}")
    series = (f"SELECT date, city_name, CAST(round(temp_max_c, 1) AS DOUBLE) AS valor FROM facts "
              f"WHERE city_name IN {CITIES} AND {period('facts', 30)}")
    q["p7_city_series"] = with_(D, series)
    q["a17_city_compare"] = with_(
        D, f"SELECT city_name, {rhe('min(valor)', 1)} AS minimo, {rhe('max(valor)', 1)} AS maximo, "
           f"{rhe('CAST(SUM(CAST(valor AS DECIMAL(18,1))) AS DOUBLE) / NULLIF(COUNT(valor), 0)', 1)} AS media "
           f"FROM ({series}) s GROUP BY city_name")
    city_rain = ("SELECT date, city_name, CAST(round(SUM(precipitation_mm), 1) AS DOUBLE) AS precipitation_mm "
                 f"FROM facts WHERE mesoregion = {MESO} AND {period('facts', 30)} GROUP BY date, city_name")
    q["a18_city_date_rain"] = with_(D, city_rain)
    q["a22_pivot_anomaly"] = with_(D, pivot(meso_anom, "mesoregion", "anomaly", 30, False))
    q["a23_pivot_meso_rain"] = with_(D, pivot(meso_rain, "mesoregion", "avg_precip", 30, True))
    q["a24_pivot_city_rain"] = with_(D, pivot(city_rain, "city_name", "precipitation_mm", 30, True))
    q["a25_max_dates"] = with_(
        ALL_CHAIN, "SELECT (SELECT max(date) FROM facts) AS max_daily, (SELECT max(date) FROM alerts) AS max_alerts, "
                   "(SELECT max(date) FROM hourly_facts) AS max_hourly")
    q["a25_max_date_per_city"] = with_(H, "SELECT city_name, max(date) AS max_date FROM hourly_facts GROUP BY city_name")
    q["a26_row_and_location_counts"] = with_(
        [RAW_DAILY], "SELECT COUNT(*) AS daily_rows, COUNT(DISTINCT location_id) AS municipios_coletados, "
                     "(SELECT COUNT(*) FROM events) AS hourly_rows FROM raw_daily")
    q["a27_rows_per_location"] = with_([RAW_DAILY], "SELECT location_id, COUNT(*) AS total FROM raw_daily GROUP BY location_id")
    latest = ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY date DESC) AS rn "
              "FROM facts WHERE mesoregion IS NOT NULL {f}) x WHERE rn = 1")
    q["a28_spatial_summary"] = with_(
        D, f"SELECT {mean('latitude')} AS center_lat, {mean('longitude')} AS center_lon, "
           "CAST(greatest(max(latitude) - min(latitude), max(longitude) - min(longitude)) AS DOUBLE) AS spread "
           f"FROM ({latest.format(f='AND mesoregion = ' + MESO)}) l")
    q["w5_previous_date"] = with_(
        D, "SELECT location_id, date, lag(date) OVER (PARTITION BY location_id ORDER BY date) AS prev_date FROM facts")
    q["w6_latest_per_location"] = with_(
        D, "SELECT location_id, city_name, mesoregion, " + dbl("latitude", "longitude", "temp_max_c", "precipitation_mm")
           + ", greatest(coalesce(CAST(precipitation_mm AS DOUBLE), 0.0), 1.0) AS marker_size "
           f"FROM ({latest.format(f='')}) l")
    q["o2_sort_alerts"] = with_(
        A, "SELECT surrogate_key, date, year_month, location_id, city_name, state_name, region, mesoregion, "
           "alert_type, severity, " + dbl("temp_max_c", "temp_min_c", "temp_anomaly_c", "precipitation_mm",
                                           "wind_speed_max_kmh", "uv_index_max")
           + " FROM alerts ORDER BY date DESC, severity DESC, location_id")
    q["o3_recent_alerts"] = with_(
        A, "SELECT date, city_name, mesoregion, alert_type, severity, "
           "CAST(round(temp_max_c, 1) AS DOUBLE) AS temp_max, CAST(round(temp_anomaly_c, 1) AS DOUBLE) AS anomalia, "
           "CAST(round(precipitation_mm, 1) AS DOUBLE) AS precip, CAST(round(wind_speed_max_kmh, 1) AS DOUBLE) AS vento_max, "
           f"CAST(uv_index_max AS DOUBLE) AS uv_index_max FROM alerts WHERE {period('alerts', 30)} "
           "ORDER BY date DESC, severity ASC, location_id LIMIT 200")
    q["o4_city_alerts"] = with_(
        A, "SELECT date, alert_type, severity, "
           "CAST(round(temp_max_c, 1) AS DOUBLE) AS temp_max, CAST(round(temp_anomaly_c, 1) AS DOUBLE) AS anomalia, "
           "CAST(round(precipitation_mm, 1) AS DOUBLE) AS precip, CAST(round(wind_speed_max_kmh, 1) AS DOUBLE) AS vento, "
           f"CAST(uv_index_max AS DOUBLE) AS uv_index_max FROM alerts WHERE city_name = {CITY} AND {period('alerts', 90)} "
           "ORDER BY date DESC, alert_type LIMIT 100")
    q["o6_distinct_mesoregions"] = with_(
        [LOCATIONS], "SELECT DISTINCT mesoregion FROM locations WHERE mesoregion IS NOT NULL ORDER BY mesoregion")
    q["o6_latest_city_dates"] = with_(
        H, f"SELECT DISTINCT date FROM hourly_facts WHERE city_name = {CITY} ORDER BY date DESC LIMIT 60")
    q["o7_location_catalogue"] = with_(
        [LOCATIONS], "SELECT city_name, mesoregion, CAST(round(latitude, 4) AS DOUBLE) AS latitude, "
                     "CAST(round(longitude, 4) AS DOUBLE) AS longitude, CAST(altitude_m AS DOUBLE) AS altitude_m "
                     "FROM locations WHERE city_name IS NOT NULL ORDER BY city_name")
    q["p12_city_window"] = with_(
        H, f"SELECT observed_at, CAST(temperature_c AS DOUBLE) AS temperature_c, relative_humidity_pct "
           f"FROM hourly_facts WHERE city_name = {CITY} AND {city_anchor(7)} ORDER BY observed_at")
    q["p12_city_period"] = with_(
        D, "SELECT date, " + dbl("temp_max_c", "temp_min_c", "temp_avg_c", "temp_anomaly_c", "precipitation_mm")
           + ", precipitation_class, " + dbl("wind_speed_max_kmh", "uv_index_max") + ", uv_risk_level "
           f"FROM facts WHERE {city90} ORDER BY date")
    q["a14_hour_profile"] = with_(
        H, f"SELECT hour, {rhu(mean('temperature_c'), 1)} AS avg_temp, {rhu(mean('relative_humidity_pct'), 1)} AS avg_humidity, "
           f"{rhu(mean('wind_speed_kmh'), 1)} AS avg_wind, "
           f"{rhu('CAST(SUM(precipitation_mm) AS DOUBLE) / NULLIF(COUNT(DISTINCT date), 0)', 2)} AS avg_precip_dia "
           f"FROM hourly_facts WHERE city_name = {CITY} AND {city_anchor(7)} GROUP BY hour ORDER BY hour")
    day = (f"SELECT hour, {rhu(mean('temperature_c'), 1)} AS temp, {rhu(mean('relative_humidity_pct'), 1)} AS humidity "
           f"FROM hourly_facts WHERE city_name = {CITY} AND date = {CITY_DAY} GROUP BY hour")
    prior = (f"SELECT hour, {rhu(mean('temperature_c'), 1)} AS avg_temp, "
             f"{rhu(mean('relative_humidity_pct'), 1)} AS avg_humidity FROM hourly_facts "
             f"WHERE city_name = {CITY} AND date >= {CITY_DAY} - 30 AND date < {CITY_DAY} GROUP BY hour")
    q["a19_day_profile"] = with_(H, day)
    q["a20_prior_profile"] = with_(H, prior)
    merged = (f"SELECT a.hour, a.temp, a.humidity, h.avg_temp, h.avg_humidity, "
              f"{rhe('a.temp - h.avg_temp', 1)} AS diff_temp FROM ({day}) a LEFT JOIN ({prior}) h ON a.hour = h.hour")
    q["j6_compare_profiles"] = with_(H, merged)
    q["a21_day_vs_history"] = with_(
        H, f"SELECT {mean('CAST(diff_temp AS DECIMAL(18,1))')} AS avg_diff, max(diff_temp) AS max_diff, "
           f"min(diff_temp) AS min_diff FROM ({merged}) m")
    return q


def oracle_queries() -> dict[str, str]:  # noqa: F811
    q = _queries()
    q.update(_more())
    return q


MONTHS = ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto", "Setembro",
          "Outubro", "Novembro", "Dezembro"]
MONTHS_ABBR = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez"]
WEEKDAYS = ["Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado"]
WEEKDAYS_ABBR = ["Dom", "Seg", "Ter", "Qua", "Qui", "Sex", "Sáb"]


def _lst(xs):
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


SPINE = """
spine AS (
  SELECT CAST(unnest(generate_series(CAST((SELECT min(date) FROM raw_daily) AS TIMESTAMP),
                                     CAST((SELECT max(date) FROM raw_daily) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_day
)"""

CALENDAR = f"""
calendar AS (
  SELECT date_day AS dt_data, year(date_day) AS ano, month(date_day) AS mes, day(date_day) AS dia,
         quarter(date_day) AS trimestre,
         CAST(floor((dayofyear(date_day) + 6 - dayofweek(date_day)) / 7) AS BIGINT) AS semana_ano,
         weekofyear(date_day) AS semana_iso, dayofweek(date_day) AS dia_semana_num, dayofyear(date_day) AS dia_do_ano,
         {_lst(MONTHS)}[month(date_day)] AS nm_mes, {_lst(MONTHS_ABBR)}[month(date_day)] AS nm_mes_abrev,
         {_lst(WEEKDAYS)}[dayofweek(date_day) + 1] AS nm_dia_semana,
         {_lst(WEEKDAYS_ABBR)}[dayofweek(date_day) + 1] AS nm_dia_semana_abrev,
         CASE WHEN (month(date_day) = 12 AND day(date_day) >= 21) OR month(date_day) IN (1, 2)
                   OR (month(date_day) = 3 AND day(date_day) <= 20) THEN 'Verão'
              WHEN (month(date_day) = 3 AND day(date_day) >= 21) OR month(date_day) IN (4, 5)
                   OR (month(date_day) = 6 AND day(date_day) <= 20) THEN 'Outono'
              WHEN (month(date_day) = 6 AND day(date_day) >= 21) OR month(date_day) IN (7, 8)
                   OR (month(date_day) = 9 AND day(date_day) <= 22) THEN 'Inverno'
              ELSE 'Primavera' END AS estacao,
         strftime(date_day, '%Y-%m') AS ano_mes,
         CAST(quarter(date_day) AS VARCHAR) || 'º Tri' AS nm_trimestre,
         'Q' || CAST(quarter(date_day) AS VARCHAR) AS sigla_trimestre,
         dayofweek(date_day) IN (0, 6) AS fl_fim_de_semana,
         CAST(date_trunc('month', date_day) AS DATE) AS primeiro_dia_mes,
         last_day(date_day) AS ultimo_dia_mes,
         CAST(date_trunc('quarter', date_day) AS DATE) AS primeiro_dia_trimestre,
         CAST(date_trunc('quarter', date_day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS ultimo_dia_trimestre,
         CAST(date_trunc('year', date_day) AS DATE) AS primeiro_dia_ano,
         CAST(date_trunc('year', date_day) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS ultimo_dia_ano,
         CAST(date_day - INTERVAL 1 YEAR AS DATE) AS dt_data_ano_anterior,
         date_day - 1 AS dt_data_ontem, date_day + 1 AS dt_data_amanha
  FROM spine
)"""

ASOF = "(SELECT max(_extracted_at) FROM raw_daily)"


def hours_diff(later: str, earlier: str) -> str:
    return f"CAST(trunc((epoch({later}) - epoch({earlier})) / 3600) AS BIGINT)"


# Failing rows of the singular tests in the suite, over the views of ALL_CHAIN.
SINGULAR = {
    "d5_facts": "SELECT location_id, date FROM facts GROUP BY location_id, date HAVING COUNT(*) > 1",
    "d6": "SELECT * FROM facts WHERE temp_min_c > temp_max_c",
    "d7": "SELECT * FROM (SELECT date - lag(date) OVER (PARTITION BY location_id ORDER BY date) AS gap FROM facts "
          "WHERE date >= (SELECT max(date) FROM facts) - 30) g WHERE gap > 1",
    "d8": "SELECT * FROM (SELECT l.location_id, max(r._extracted_at) AS t FROM locations l LEFT JOIN raw_daily r "
          "USING (location_id) GROUP BY l.location_id) x WHERE t IS NULL OR "
          "floor((epoch((SELECT max(_extracted_at) FROM raw_daily)) - epoch(t)) / 3600) > 25",
    "d9": "SELECT * FROM alerts WHERE location_id NOT IN (SELECT location_id FROM locations)",
}


def _dq() -> dict[str, str]:
    from skyledger.operators.quality import SUITES
    q: dict[str, str] = {}
    D, H = DAILY_CHAIN, HOURLY_CHAIN
    q["g1_date_spine"] = with_([RAW_DAILY, SPINE], "SELECT date_day FROM spine")
    q["g2_calendar"] = with_([RAW_DAILY, SPINE, CALENDAR], "SELECT * FROM calendar ORDER BY dt_data")
    q["d1_not_null_city"] = with_(H, "SELECT location_id, observed_at FROM hourly_facts WHERE city_name IS NULL")
    q["d2_unique_surrogate_key"] = with_(
        D, "SELECT surrogate_key, COUNT(*) AS n_records FROM facts WHERE surrogate_key IS NOT NULL "
           "GROUP BY surrogate_key HAVING COUNT(*) > 1")
    meso_vals = dict((t[1], t[2]) for t in SUITES["locations"] if t[0] == "accepted_values")["mesoregion"]
    q["d3_accepted_mesoregion"] = with_(
        [LOCATIONS], "SELECT location_id, mesoregion FROM locations WHERE mesoregion NOT IN ("
                     + ", ".join(f"'{v}'" for v in meso_vals) + ")")
    q["d4_accepted_range_anomaly"] = with_(
        D, "SELECT location_id, date, CAST(temp_anomaly_c AS DOUBLE) AS temp_anomaly_c FROM facts "
           "WHERE temp_anomaly_c < -25 OR temp_anomaly_c > 25")
    q["d5_unique_key_raw"] = with_(
        [RAW_DAILY], "SELECT location_id, date, COUNT(*) AS occurrences FROM raw_daily "
                     "GROUP BY location_id, date HAVING COUNT(*) > 1")
    q["d6_min_above_max"] = with_(
        D, "SELECT location_id, date, CAST(temp_min_c AS DOUBLE) AS temp_min_c, CAST(temp_max_c AS DOUBLE) AS temp_max_c "
           "FROM facts WHERE temp_min_c > temp_max_c")
    q["d7_date_gaps"] = with_(
        D, "SELECT location_id, prev_date AS gap_start, date AS gap_end, date - prev_date AS gap_days FROM ("
           "SELECT location_id, date, lag(date) OVER (PARTITION BY location_id ORDER BY date) AS prev_date "
           "FROM facts WHERE date >= (SELECT max(date) FROM facts) - 30) s "
           "WHERE prev_date IS NOT NULL AND date - prev_date > 1")
    age = hours_diff(ASOF, "l.latest_extracted_at")
    q["d8_location_freshness"] = with_(
        [LOCATIONS, RAW_DAILY],
        f"SELECT * FROM (SELECT e.location_id, l.latest_extracted_at, {age} AS age_hours, "
        f"CASE WHEN l.latest_extracted_at IS NULL THEN 'never_loaded' WHEN {age} > 25 THEN 'stale' ELSE 'fresh' END AS status "
        "FROM locations e LEFT JOIN (SELECT location_id, max(_extracted_at) AS latest_extracted_at FROM raw_daily "
        "GROUP BY location_id) l ON e.location_id = l.location_id) x WHERE status <> 'fresh' "
        "ORDER BY age_hours DESC NULLS FIRST, location_id")
    q["d9_relationship_alerts"] = with_(
        ALERT_CHAIN, "SELECT a.location_id, a.date, a.alert_type FROM alerts a "
                     "WHERE NOT EXISTS (SELECT 1 FROM locations l WHERE l.location_id = a.location_id)")
    q["j3_orphans_hourly"] = with_(
        [LOCATIONS, RAW_HOURLY, STG_HOURLY],
        "SELECT h.location_id, h.observed_at FROM stg_hourly h "
        "WHERE NOT EXISTS (SELECT 1 FROM locations l WHERE l.location_id = h.location_id)")
    fage = hours_diff(ASOF, "max_loaded_at")
    q["d10_source_freshness"] = with_(
        [RAW_DAILY], f"SELECT max_loaded_at, {fage} AS age_hours, CASE WHEN max_loaded_at IS NULL THEN 'error' "
                     f"WHEN epoch({ASOF}) - epoch(max_loaded_at) > 49 * 3600 THEN 'error' "
                     f"WHEN epoch({ASOF}) - epoch(max_loaded_at) > 25 * 3600 THEN 'warn' ELSE 'pass' END AS status "
                     "FROM (SELECT max(_extracted_at) AS max_loaded_at FROM raw_daily) m")
    q["d11_recent_load"] = with_(
        [RAW_DAILY], f"SELECT COUNT(CASE WHEN _extracted_at >= {ASOF} - INTERVAL 420 MINUTE THEN 1 END) AS recent_rows, "
                     "max(_extracted_at) AS max_loaded_at, CASE WHEN COUNT(CASE WHEN _extracted_at >= "
                     f"{ASOF} - INTERVAL 420 MINUTE THEN 1 END) > 0 THEN 'pass' ELSE 'fail' END AS status FROM raw_daily")
    q["d12_incomplete_daily"] = with_(
        [RAW_DAILY], "SELECT location_id, COUNT(*) AS total_coletado, 1931 - COUNT(*) AS faltando FROM raw_daily "
                     "GROUP BY location_id HAVING COUNT(*) < 1931")
    q["d13_count_mismatch_hourly"] = with_(
        [RAW_HOURLY], "SELECT location_id, COUNT(*) AS total, COUNT(*) - 20064 AS diferenca FROM raw_hourly "
                      "GROUP BY location_id HAVING COUNT(*) <> 20064")
    exp = "((SELECT max(date) FROM raw_daily) - (SELECT min(date) FROM raw_daily) + 1)"
    q["d14_incomplete_calendar"] = with_(
        [RAW_DAILY], f"SELECT location_id, COUNT(*) AS dias_coletados, {exp} AS dias_esperados, "
                     f"{exp} - COUNT(*) AS dias_faltando FROM raw_daily GROUP BY location_id HAVING COUNT(*) < {exp}")
    q["d15_complete_locations"] = with_(
        [RAW_HOURLY], "SELECT COUNT(DISTINCT location_id) AS municipios_completos FROM raw_hourly WHERE location_id IN "
                      "(SELECT location_id FROM raw_hourly GROUP BY location_id HAVING COUNT(*) >= 20016)")
    q["d2_unique_extraction"] = with_(
        [RAW_DAILY], "SELECT _extracted_at, COUNT(*) AS n_records FROM raw_daily WHERE _extracted_at IS NOT NULL "
                     "GROUP BY _extracted_at HAVING COUNT(*) > 1")
    q["d6_narrow_day"] = with_(
        D, "SELECT location_id, date, CAST(temp_min_c AS DOUBLE) AS temp_min_c, CAST(temp_max_c AS DOUBLE) AS temp_max_c "
           "FROM facts WHERE temp_min_c + 5 > temp_max_c")
    week_age = hours_diff(ASOF, "max(r._extracted_at)")
    q["d8_location_freshness_week"] = with_(
        [LOCATIONS, RAW_DAILY],
        f"SELECT e.location_id, max(r._extracted_at) AS latest_extracted_at, {week_age} AS age_hours, "
        "CASE WHEN count(r._extracted_at) = 0 THEN 'never_loaded' ELSE 'stale' END AS status FROM locations e "
        "LEFT JOIN raw_daily r ON r.location_id = e.location_id AND r.date > (SELECT max(date) FROM raw_daily) - 7 "
        f"GROUP BY e.location_id HAVING count(r._extracted_at) = 0 OR {week_age} > 5")
    q["d9_relationship_region"] = with_(
        ALERT_CHAIN, "SELECT a.location_id, a.date, a.alert_type FROM alerts a LEFT JOIN (SELECT location_id AS asia FROM "
                     "locations WHERE mesoregion = 'ASIA') l ON l.asia = a.location_id WHERE l.asia IS NULL")
    q["j5_members_region"] = with_(
        [LOCATIONS, RAW_HOURLY, STG_HOURLY],
        "SELECT h.location_id, h.observed_at FROM stg_hourly h JOIN locations l ON l.location_id = h.location_id "
        "WHERE l.mesoregion = 'ASIA'")
    q["d10_source_freshness_late"] = with_(
        [RAW_DAILY], "SELECT max_loaded_at, CAST(h AS BIGINT) AS age_hours, CASE WHEN h > 49 THEN 'error' WHEN h > 25 THEN 'warn' "
                     "ELSE 'pass' END AS status FROM (SELECT max(_extracted_at) AS max_loaded_at FROM raw_daily) m, "
                     "(SELECT unnest([25, 30, 60]) AS h) a")
    q["d11_recent_load_late"] = with_(
        [RAW_DAILY], "SELECT (SELECT COUNT(*) FROM raw_daily WHERE h = 0 AND _extracted_at >= max_loaded_at - INTERVAL 1 HOUR) "
                     "AS recent_rows, max_loaded_at, CASE WHEN h = 0 THEN 'pass' ELSE 'fail' END AS status "
                     "FROM (SELECT max(_extracted_at) AS max_loaded_at FROM raw_daily) m, (SELECT unnest([0, 8]) AS h) a")
    q["d15_complete_locations_daily"] = with_(
        [RAW_DAILY], "SELECT COUNT(*) AS municipios_completos FROM (SELECT location_id FROM raw_daily "
                     "GROUP BY location_id HAVING COUNT(*) >= 600) x")
    present = {
        "raw_daily": "raw_daily", "raw_hourly": "raw_hourly", "stg_daily": "stg_daily", "stg_hourly": "stg_hourly",
        "daily_enriched": "enriched", "daily_facts": "facts", "alerts": "alerts", "hourly_facts": "hourly_facts",
        "locations": "locations", "calendar": "calendar",
    }
    absent = {"_loaded_at", "_dbt_updated_at"}
    parts = []
    for model, view in present.items():
        for test, col, *arg in SUITES[model]:
            if col in absent:
                parts.append(f"SELECT '{model}' AS model, '{test}' AS test, '{col}' AS \"column\", NULL AS failures")
                continue
            c = f'"{col}"'
            if test == "not_null":
                cond = f"{c} IS NULL"
            elif test == "accepted_values":
                cond = f"{c} NOT IN (" + ", ".join(f"'{v}'" for v in arg[0]) + ")"
            elif test == "accepted_range":
                cond = f"{c} < {arg[0][0]} OR {c} > {arg[0][1]}"
            else:
                parts.append(f"SELECT '{model}' AS model, 'unique' AS test, '{col}' AS \"column\", "
                             f"(SELECT COUNT(*) FROM (SELECT {c} FROM {view} WHERE {c} IS NOT NULL GROUP BY {c} "
                             f"HAVING COUNT(*) > 1) u) AS failures")
                continue
            parts.append(f"SELECT '{model}' AS model, '{test}' AS test, '{col}' AS \"column\", "
                         f"COUNT(CASE WHEN {cond} THEN 1 END) AS failures FROM {view}")
    for model, test, col, key in (("daily_facts", "unique_key", "location_id, date", "d5_facts"),
                                  ("daily_facts", "min_above_max", "temp_min_c", "d6"), ("daily_facts", "date_gaps", "date", "d7"),
                                  ("raw_daily", "location_freshness", "_extracted_at", "d8"),
                                  ("alerts", "relationship", "location_id", "d9")):
        parts.append(f"SELECT '{model}' AS model, '{test}' AS test, '{col}' AS \"column\", "
                     f"(SELECT COUNT(*) FROM ({SINGULAR[key]}) f) AS failures")
    q["d16_run_suite"] = with_(ALL_CHAIN + [SPINE, CALENDAR], "\nUNION ALL\n".join(parts))
    return q


def oracle_queries() -> dict[str, str]:  # noqa: F811
    q = _queries()
    q.update(_more())
    q.update(_dq())
    return q


RAW_DAILY_COLS = ("location_id, date, latitude, longitude, temperature_2m_max, temperature_2m_min, "
                  "precipitation_sum, rain_sum, wind_speed_10m_max, sunrise, sunset, uv_index_max")
RAW_HOURLY_COLS = ("location_id, \"timestamp\", latitude, longitude, elevation, timezone, temperature_2m, "
                   "relative_humidity_2m, precipitation, wind_speed_10m, wind_direction_10m, surface_pressure, "
                   "cloud_cover, visibility, weather_code")
RAW_DAILY_GEO = """
raw_daily_geo AS (
  SELECT r.*, CAST(-26.0 - (CAST(location_id AS BIGINT) % 40) / 10.0 AS DOUBLE) AS latitude,
         CAST(-48.0 - (CAST(location_id AS BIGINT) % 60) / 10.0 AS DOUBLE) AS longitude
  FROM raw_daily r
)"""


def _io() -> dict[str, str]:
    q: dict[str, str] = {}
    landed = "TIMESTAMP '2024-02-01 00:00:00'"
    flat_h = with_([RAW_HOURLY], f"SELECT {RAW_HOURLY_COLS}, {landed} AS _extracted_at FROM raw_hourly")
    q["s1_flatten_hourly"] = flat_h
    q["st1_stream_ingest"] = flat_h
    q["s2_flatten_daily"] = with_([RAW_DAILY, RAW_DAILY_GEO],
                                  f"SELECT {RAW_DAILY_COLS}, {landed} AS _extracted_at FROM raw_daily_geo")
    q["s6_read_new"] = with_(
        [RAW_DAILY], "SELECT location_id, date, _extracted_at FROM raw_daily WHERE _extracted_at > "
                     "(SELECT max(_extracted_at) FROM raw_daily WHERE date < (SELECT max(date) FROM raw_daily) - 365)")
    q["s8_to_wire"] = with_(
        [RAW_DAILY, RAW_DAILY_GEO],
        "SELECT location_id, strftime(date, '%Y-%m-%d') AS date, latitude, longitude, temperature_2m_max, "
        "temperature_2m_min, precipitation_sum, rain_sum, wind_speed_10m_max, "
        "strftime(sunrise, '%Y-%m-%dT%H:%M:%S') AS sunrise, strftime(sunset, '%Y-%m-%dT%H:%M:%S') AS sunset, "
        "uv_index_max, strftime(_extracted_at, '%Y-%m-%dT%H:%M:%S') AS _extracted_at FROM raw_daily_geo")
    q["k2_reload_window"] = with_(
        [RAW_DAILY, RAW_DAILY_GEO],
        f"SELECT {RAW_DAILY_COLS}, _extracted_at FROM raw_daily_geo WHERE date < (SELECT max(date) FROM raw_daily) - 30 "
        f"UNION ALL SELECT {RAW_DAILY_COLS}, (SELECT max(_extracted_at) FROM raw_daily) + INTERVAL 1 HOUR "
        "FROM raw_daily_geo WHERE date >= (SELECT max(date) FROM raw_daily) - 30")
    top = '(SELECT max("timestamp") FROM raw_hourly)'
    dedup = ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location_id, \"timestamp\" "
             "ORDER BY _extracted_at DESC) AS rn FROM raw_hourly WHERE {w}) x WHERE rn = 1")
    meas = ["temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m", "wind_direction_10m",
            "surface_pressure", "cloud_cover", "visibility", "weather_code", "_extracted_at"]
    keep = ["latitude", "longitude", "elevation", "timezone"]
    new_sel = ("SELECT location_id, \"timestamp\", latitude + 1.0 AS latitude, longitude, elevation, timezone, "
               "temperature_2m + 1.0 AS temperature_2m, " + ", ".join(meas[1:]) + " FROM ("
               + dedup.format(w=f'"timestamp" >= {top} - INTERVAL 5 DAY') + ") n0")
    cols = ", ".join([f"CASE WHEN t.location_id IS NOT NULL THEN t.{c} ELSE n.{c} END AS {c}" for c in keep]
                     + [f"CASE WHEN n.location_id IS NOT NULL THEN n.{c} ELSE t.{c} END AS {c}" for c in meas])
    q["k3_upsert_raw_hourly"] = with_(
        [RAW_HOURLY],
        "SELECT coalesce(t.location_id, n.location_id) AS location_id, coalesce(t.\"timestamp\", n.\"timestamp\") "
        f"AS \"timestamp\", {cols} FROM ({dedup.format(w=chr(34) + 'timestamp' + chr(34) + ' < ' + top + ' - INTERVAL 3 DAY')}) t "
        f"FULL OUTER JOIN ({new_sel}) n ON t.location_id = n.location_id AND t.\"timestamp\" = n.\"timestamp\"")
    q["k6_expire_partitions"] = with_(
        [RAW_HOURLY], f"SELECT location_id, \"timestamp\" FROM raw_hourly WHERE CAST(\"timestamp\" AS DATE) >= "
                      f"CAST({top} AS DATE) - 450")
    base = _queries()
    q["u1_merge_upsert"] = base["t4_daily_facts"]
    q["u3_hourly_incremental"] = _more()["t5_hourly_facts"]
    q["u6_missing_locations"] = with_(
        [LOCATIONS, RAW_DAILY],
        "SELECT location_id, city_name FROM locations WHERE location_id NOT IN (SELECT location_id FROM raw_daily "
        "WHERE date >= (SELECT min(date) FROM raw_daily) AND date < (SELECT min(date) FROM raw_daily) + 7)")
    q["st2_stream_upsert"] = with_(
        [RAW_HOURLY], f"SELECT {RAW_HOURLY_COLS}, _extracted_at FROM ({dedup.format(w='TRUE')}) d")
    q["st4_stream_dedup"] = with_([RAW_HOURLY], 'SELECT DISTINCT location_id, "timestamp" FROM raw_hourly')
    return q


def _conv() -> dict[str, str]:
    bounds = [1, 6, 12, 20, 29, 39, 50, 62, 75, 89, 103, 118]
    beaufort = "CASE " + " ".join(f"WHEN wind_speed_kmh < {b} THEN {i}" for i, b in enumerate(bounds)) + " ELSE 12 END"
    return {"f6_f7_conversions": with_(
        HOURLY_CHAIN, f"SELECT location_id, observed_at, {beaufort} AS beaufort, "
                      "CAST(round(temperature_c * 9.0 / 5.0 + 32, 2) AS DOUBLE) AS temperature_f FROM hourly_facts")}


def oracle_queries() -> dict[str, str]:  # noqa: F811
    q = _queries()
    q.update(_more())
    q.update(_dq())
    q.update(_io())
    q.update(_conv())
    q["t3_daily_enriched_split"] = q["t3_daily_enriched"]
    q.update(_stored(q))
    return q


def _stored(base: dict[str, str]) -> dict[str, str]:
    """Queries over stored tables, landed documents and streams; dates and times as text, as those queries return them."""
    q: dict[str, str] = {}
    uniq_h = ('uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location_id, "timestamp" '
              'ORDER BY event_id DESC) AS rn FROM raw_hourly) x WHERE rn = 1)')
    landed = ('span AS (SELECT min(CAST("timestamp" AS DATE)) AS a, max(CAST("timestamp" AS DATE)) AS b FROM uniq), '
              'based AS (SELECT u.*, CAST(floor(3 * (CAST("timestamp" AS DATE) - a) / (b - a + 1)) AS INTEGER) AS base FROM uniq u, span), '
              'landed AS (SELECT *, CASE WHEN relative_humidity_2m = 7 THEN least(base + 1, 2) ELSE base END AS landing FROM based), '
              'mark AS (SELECT l.n, (SELECT max("timestamp") FROM landed WHERE landing < l.n) - INTERVAL 4 DAY AS w '
              'FROM (SELECT unnest([0, 1, 2]) AS n) l)')
    q["st3_late_days"] = with_([RAW_HOURLY, uniq_h, landed], """
SELECT location_id, strftime(CAST("timestamp" AS DATE), '%Y-%m-%d') AS day, count(*) AS n_rows, count(temperature_2m) AS n_values,
       CAST(sum(CAST(temperature_2m AS DECIMAL(18,3))) AS DOUBLE) AS total
FROM landed JOIN mark ON landing = n WHERE w IS NULL OR CAST("timestamp" AS DATE) + INTERVAL 1 DAY > w
GROUP BY location_id, CAST("timestamp" AS DATE)""")
    q["st4_resent_rows"] = with_([RAW_HOURLY, uniq_h, landed], """
SELECT location_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS observed_at, temperature_2m
FROM landed JOIN mark ON landing = n WHERE w IS NULL OR "timestamp" > w""")

    def rejects(raw: str, period: str, n: str, array: str) -> str:
        h = f"(CAST(location_id AS INTEGER) * 7 + {n}) % 13"
        return with_([raw], f"""
SELECT 'rows' AS kind, NULL AS reason, location_id, p AS period, c AS n FROM g WHERE h NOT IN (3, 5, 7)
UNION ALL
SELECT 'rejects', CASE h WHEN 3 THEN 'ragged: {array}' WHEN 5 THEN 'unparseable: no time' ELSE 'malformed' END,
       CASE WHEN h = 7 THEN NULL ELSE location_id END, NULL, CAST(sum(ceil(c / 48.0)) AS BIGINT)
FROM g WHERE h IN (3, 5, 7) GROUP BY 2, 3""").replace("\nSELECT 'rows'", f""", g AS (
  SELECT location_id, {period} AS p, count(*) AS c, {h} AS h FROM {raw.split()[0]} GROUP BY location_id, {period}, {h})
SELECT 'rows'""", 1)
    day = 'CAST("timestamp" AS DATE)'
    q["s1_rejects"] = rejects(RAW_HOURLY, f"strftime({day}, '%Y-%m-%d')", f"({day} - DATE '1970-01-01')", "temperature_2m")
    q["s2_rejects"] = rejects(RAW_DAILY, "strftime(date, '%Y-%m')", "(year(date) * 12 + month(date))", "rain_sum")
    q["s4_locations_csv"] = with_(
        [LOCATIONS], "SELECT * REPLACE (CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, "
                     "CAST(altitude_m AS DOUBLE) AS altitude_m) FROM locations")
    q["s9_window_rows"] = with_(
        [RAW_DAILY], "SELECT location_id, strftime(date, '%Y-%m-%d') AS date, temperature_2m_max FROM raw_daily "
                     "WHERE date >= (SELECT max(date) FROM raw_daily) - 45")
    q["k1_append_truncate"] = with_(
        [RAW_HOURLY], f"SELECT 'append' AS load, strftime({day}, '%Y-%m-%d') AS part_date, 2 * count(*) AS n FROM raw_hourly "
                      f"GROUP BY {day} UNION ALL SELECT 'truncate', strftime({day}, '%Y-%m-%d'), count(*) FROM raw_hourly "
                      f"WHERE {day} >= DATE '2024-01-20' GROUP BY {day}")
    q["k3_upsert_stored"] = ("SELECT * REPLACE (strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS \"timestamp\", "
                             "strftime(_extracted_at, '%Y-%m-%d %H:%M:%S') AS _extracted_at) FROM (\n"
                             + base["k3_upsert_raw_hourly"] + ") k")
    uniq_d = ("uniq_daily AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location_id, date ORDER BY l_orderkey DESC, "
              "l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS rn FROM raw_daily_geo) x WHERE rn = 1)")
    top = "(SELECT max(date) FROM raw_daily)"
    q["k4_upsert_daily_stored"] = with_(
        [RAW_DAILY, RAW_DAILY_GEO, uniq_d],
        f"SELECT location_id, strftime(date, '%Y-%m-%d') AS date, CASE WHEN date >= {top} - 30 THEN latitude + 1.0 ELSE latitude END "
        f"AS latitude, longitude, CASE WHEN date >= {top} - 60 THEN temperature_2m_max + 1.0 ELSE temperature_2m_max END "
        "AS temperature_2m_max, temperature_2m_min FROM uniq_daily")
    q["k6_expire_stored"] = with_(
        [RAW_HOURLY], f"SELECT strftime({day}, '%Y-%m-%d') AS part_date, count(*) AS n FROM raw_hourly "
                      f"WHERE {day} >= (SELECT max({day}) FROM raw_hourly) - 10 GROUP BY {day}")
    q["k8_view_and_table"] = with_(
        ALERT_CHAIN, "SELECT s.location_id, count(*) AS n_days, count(a.alert_type) AS n_alerts FROM stg_daily s LEFT JOIN alerts a "
                     "ON a.location_id = s.location_id AND a.date = s.date GROUP BY s.location_id")
    from skyledger.operators.quality import SUITES
    parts = []
    for test, col, *arg in SUITES["daily_facts"]:
        if test == "unique" or col == "_dbt_updated_at":
            continue
        cond = (f'"{col}" IS NULL' if test == "not_null" else
                f'"{col}" NOT IN (' + ", ".join(f"'{v}'" for v in arg[0]) + ")" if test == "accepted_values" else
                f'"{col}" < {arg[0][0]} OR "{col}" > {arg[0][1]}')
        parts.append(f"SELECT '{test}__{col}' AS test, location_id, strftime(date, '%Y-%m-%d') AS date FROM facts WHERE {cond}")
    q["k9_stored_failures"] = with_(DAILY_CHAIN, "\nUNION ALL\n".join(parts))
    q["u1_merge_stored"] = as_text("u1_merge_upsert", base["u1_merge_upsert"])
    q["u5_schema_sync"] = with_(
        DAILY_CHAIN, "SELECT surrogate_key, location_id, strftime(date, '%Y-%m-%d') AS date, year_month, "
                     "CAST(temp_max_c AS DOUBLE) AS temp_max_c, CASE WHEN date >= (SELECT max(date) FROM facts) - 35 "
                     "THEN temp_max_c > 30 END AS is_hot FROM facts")
    bad = "(CAST(location_id AS INTEGER) * 7 + year(date) * 12 + month(date)) % 13"
    q["t8_daily_job"] = with_(
        DAILY_CHAIN, f"""SELECT location_id, strftime(date, '%Y-%m-%d') AS date, CAST(temp_max_c AS DOUBLE) AS value FROM facts
WHERE {bad} NOT IN (3, 5, 7)
UNION ALL
SELECT 'rejected', CASE h WHEN 3 THEN 'ragged: rain_sum' WHEN 5 THEN 'unparseable: no time' ELSE 'malformed' END,
       CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT location_id, year_month, {bad} AS h FROM facts) d WHERE h IN (3, 5, 7) GROUP BY h""")
    q["u7_backfill"] = with_(
        [RAW_DAILY], f"""SELECT location_id, count(DISTINCT date) AS n_rows, CAST(1 AS BIGINT) AS n_loads, CAST(CASE WHEN
  CAST(location_id AS INTEGER) % 2 = 0 AND min(date) < (SELECT min(date) FROM raw_daily) + 7 THEN 0 ELSE 1 END AS INTEGER) AS load_hour
FROM raw_daily GROUP BY location_id""")
    q["o5_freshness_order"] = with_(
        [LOCATIONS, RAW_HOURLY], f"SELECT l.location_id, CAST((SELECT max({day}) FROM raw_hourly) - max(CAST(r.\"timestamp\" AS DATE)) "
                                 "AS INTEGER) AS age_days FROM locations l LEFT JOIN raw_hourly r USING (location_id) GROUP BY l.location_id")
    return q


# Date / timestamp output columns per query (from the Spark schemas); at the driver boundary
# both engines hand them over as ISO text: dates 'YYYY-MM-DD', timestamps 'YYYY-MM-DD HH:MM:SS'.
TEMPORAL: dict[str, tuple[list[str], list[str]]] = {
    'd2_unique_extraction': ([], ['_extracted_at']),
    'd6_narrow_day': (['date'], []),
    'd8_location_freshness_week': ([], ['latest_extracted_at']),
    'd9_relationship_region': (['date'], []),
    'j5_members_region': ([], ['observed_at']),
    'd10_source_freshness_late': ([], ['max_loaded_at']),
    'd11_recent_load_late': ([], ['max_loaded_at']),
    't1_stg_daily': (['date'], ['sunrise_at', 'sunset_at', '_extracted_at']),
    't3_daily_enriched': (['date'], []),
    't3_daily_enriched_split': (['date'], []),
    't4_daily_facts': (['date'], []),
    't6_alerts': (['date'], []),
    'a3_temp_trend': (['date'], []),
    't2_stg_hourly': ([], ['observed_at', '_extracted_at']),
    't5_hourly_facts': (['date'], ['observed_at', '_extracted_at']),
    'a3_temp_trend_meso': (['date'], []),
    'a6_meso_temp': (['date'], []),
    'a7_meso_anomaly': (['date'], []),
    'a10_meso_rain': (['date'], []),
    'a18_city_date_rain': (['date'], []),
    'a25_max_dates': (['max_daily', 'max_alerts', 'max_hourly'], []),
    'a25_max_date_per_city': (['max_date'], []),
    'w5_previous_date': (['date', 'prev_date'], []),
    'o2_sort_alerts': (['date'], []),
    'o3_recent_alerts': (['date'], []),
    'o4_city_alerts': (['date'], []),
    'o6_latest_city_dates': (['date'], []),
    'p7_city_series': (['date'], []),
    'p12_city_window': ([], ['observed_at']),
    'p12_city_period': (['date'], []),
    'g1_date_spine': (['date_day'], []),
    'g2_calendar': (['dt_data', 'primeiro_dia_mes', 'ultimo_dia_mes', 'primeiro_dia_trimestre', 'ultimo_dia_trimestre', 'primeiro_dia_ano', 'ultimo_dia_ano', 'dt_data_ano_anterior', 'dt_data_ontem', 'dt_data_amanha'], []),
    'd1_not_null_city': ([], ['observed_at']),
    'd4_accepted_range_anomaly': (['date'], []),
    'd5_unique_key_raw': (['date'], []),
    'd6_min_above_max': (['date'], []),
    'd7_date_gaps': (['gap_start', 'gap_end'], []),
    'd8_location_freshness': ([], ['latest_extracted_at']),
    'd9_relationship_alerts': (['date'], []),
    'j3_orphans_hourly': ([], ['observed_at']),
    'd10_source_freshness': ([], ['max_loaded_at']),
    'd11_recent_load': ([], ['max_loaded_at']),
    's1_flatten_hourly': ([], ['timestamp', '_extracted_at']),
    's2_flatten_daily': (['date'], ['sunrise', 'sunset', '_extracted_at']),
    's6_read_new': (['date'], ['_extracted_at']),
    'k2_reload_window': (['date'], ['sunrise', 'sunset', '_extracted_at']),
    'k3_upsert_raw_hourly': ([], ['timestamp', '_extracted_at']),
    'k6_expire_partitions': ([], ['timestamp']),
    'u1_merge_upsert': (['date'], []),
    'u3_hourly_incremental': (['date'], ['observed_at', '_extracted_at']),
    'f6_f7_conversions': ([], ['observed_at']),
    'st1_stream_ingest': ([], ['timestamp', '_extracted_at']),
    'st2_stream_upsert': ([], ['timestamp', '_extracted_at']),
    'st4_stream_dedup': ([], ['timestamp']),
}


def as_text(key: str, sql: str) -> str:
    d, t = TEMPORAL.get(key, ([], []))
    if not d and not t:
        return sql
    rep = [f"strftime(\"{c}\", '%Y-%m-%d') AS \"{c}\"" for c in d]
    rep += [f"strftime(\"{c}\", '%Y-%m-%d %H:%M:%S') AS \"{c}\"" for c in t]
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{sql}\n) q"


def driver_oracles() -> dict[str, str]:
    return {k: as_text(k, v) for k, v in oracle_queries().items()}
