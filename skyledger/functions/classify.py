"""Scalar classifiers over weather measures.

All are ``when`` chains evaluated JVM-side.  NULL handling follows the source
semantics on purpose: a CASE with no matching branch falls to its ELSE, so a
NULL measure lands in the last class ('extreme', 12, 'Unknown').
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def precipitation_class(mm) -> Column:
    """0 dry; <5 light; <20 moderate; <50 heavy; else (and NULL) extreme."""
    mm = _c(mm)
    return (F.when(mm == 0, "dry").when(mm < 5, "light").when(mm < 20, "moderate")
            .when(mm < 50, "heavy").otherwise("extreme"))


def uv_risk_level(uv) -> Column:
    """<3 low; <6 moderate; <8 high; <11 very_high; else (and NULL) extreme."""
    uv = _c(uv)
    return (F.when(uv < 3, "low").when(uv < 6, "moderate").when(uv < 8, "high")
            .when(uv < 11, "very_high").otherwise("extreme"))


def alert_type(temp_max="temp_max_c", temp_min="temp_min_c", precip="precipitation_mm",
               wind="wind_speed_max_kmh", uv="uv_index_max", anomaly="temp_anomaly_c",
               precip_anomaly="precip_anomaly_mm") -> Column:
    """first matching rule wins; no match gives NULL (row is not an alert)."""
    tmax, tmin, p, w, u, a, pa = map(_c, (temp_max, temp_min, precip, wind, uv, anomaly, precip_anomaly))
    return (F.when(tmax > 40, "extreme_heat")
            .when(tmin < 0, "frost")
            .when(p > 80, "heavy_rain")
            .when(w > 90, "high_winds")
            .when(u >= 11, "extreme_uv")
            .when(a > 5, "heat_anomaly")
            .when(a < -5, "cold_anomaly")
            .when(pa > 40, "precip_anomaly"))


def severity(temp_max="temp_max_c", precip="precipitation_mm", anomaly="temp_anomaly_c",
             uv="uv_index_max") -> Column:
    """severity, independent of the alert type."""
    tmax, p, a, u = map(_c, (temp_max, precip, anomaly, uv))
    return (F.when((tmax > 45) | (p > 150), "critical")
            .when((tmax > 40) | (p > 80), "high")
            .when((a > 5) | (u >= 11), "medium")
            .otherwise("low"))


# WMO weather-interpretation codes and their labels, as published
# with the weather API.  Any other code (and NULL) is 'Unknown'.
WMO_LABELS = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Icy fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    71: "Slight snow",
    73: "Moderate snow",
    75: "Heavy snow",
    77: "Snow grains",
    80: "Slight showers",
    81: "Moderate showers",
    82: "Violent showers",
    85: "Slight snow showers",
    86: "Heavy snow showers",
    95: "Thunderstorm",
    96: "Thunderstorm with hail",
    99: "Thunderstorm with heavy hail",
}


def wmo_label(code) -> Column:
    """literal map lookup (a codegen'd CASE), 'Unknown' otherwise."""
    code = _c(code)
    expr = None
    for k, v in WMO_LABELS.items():
        expr = F.when(code == k, v) if expr is None else expr.when(code == k, v)
    return expr.otherwise("Unknown")


# Beaufort upper bounds in km/h for forces 0..11; 12 above.
BEAUFORT_UPPER_KMH = [1, 6, 12, 20, 29, 39, 50, 62, 75, 89, 103, 118]


def beaufort(kmh) -> Column:
    """Beaufort force 0-12; NULL falls through to 12."""
    kmh = _c(kmh)
    expr = None
    for force, bound in enumerate(BEAUFORT_UPPER_KMH):
        expr = F.when(kmh < bound, force) if expr is None else expr.when(kmh < bound, force)
    return expr.otherwise(12)


def c_to_f(celsius) -> Column:
    """Fahrenheit rounded half away from zero to 2 places."""
    return F.round(_c(celsius) * 9.0 / 5.0 + 32, 2)
