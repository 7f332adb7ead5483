"""Golden boundary values of the scalar classifiers."""

import datetime as dt

from pyspark.sql import functions as F

from skyledger import functions as SF


def one(spark, col, values, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col(F.col("x"))).collect()]


def test_precipitation_class(spark):
    vals = [0.0, 0.01, 4.99, 5.0, 19.99, 20.0, 49.99, 50.0, None, -1.0]
    assert one(spark, SF.precipitation_class, vals) == [
        "dry", "light", "light", "moderate", "moderate", "heavy", "heavy", "extreme", "extreme", "light"]


def test_uv_risk_level(spark):
    assert one(spark, SF.uv_risk_level, [2.99, 3.0, 6.0, 8.0, 11.0, None]) == [
        "low", "moderate", "high", "very_high", "extreme", "extreme"]


def _alert(spark, rows):
    cols = "temp_max_c double, temp_min_c double, precipitation_mm double, wind_speed_max_kmh double, " \
           "uv_index_max double, temp_anomaly_c double, precip_anomaly_mm double"
    df = spark.createDataFrame(rows, cols)
    return [(r[0], r[1]) for r in df.select(SF.alert_type(), SF.severity()).collect()]


def test_alert_type_and_severity(spark):
    base = [20.0, 10.0, 0.0, 0.0, 0.0, 0.0, 0.0]

    def row(**kw):
        r = list(base)
        names = ["tmax", "tmin", "p", "w", "uv", "a", "pa"]
        for k, v in kw.items():
            r[names.index(k)] = v
        return tuple(r)
    got = _alert(spark, [row(tmax=40.0), row(tmax=40.01), row(tmin=0.0), row(tmin=-0.01), row(p=80.0),
                         row(p=80.01), row(w=90.0), row(w=90.01), row(uv=11.0), row(a=5.0), row(a=5.01),
                         row(a=-5.01), row(pa=40.01), row(tmax=41.0, tmin=-1.0), row(tmax=45.01),
                         row(p=150.01)])
    assert [g[0] for g in got] == [None, "extreme_heat", None, "frost", None, "heavy_rain", None, "high_winds",
                                   "extreme_uv", None, "heat_anomaly", "cold_anomaly", "precip_anomaly",
                                   "extreme_heat", "extreme_heat", "heavy_rain"]
    sev = dict(zip(["t40.01", "frost", "uv", "a5.01", "t45", "p150"], [got[1][1], got[3][1], got[8][1],
                                                                       got[10][1], got[14][1], got[15][1]]))
    assert sev == {"t40.01": "high", "frost": "low", "uv": "medium", "a5.01": "medium", "t45": "critical",
                   "p150": "critical"}


def test_wmo_label(spark):
    assert one(spark, SF.wmo_label, [0, 99, 4, None], "int") == [
        "Clear sky", "Thunderstorm with heavy hail", "Unknown", "Unknown"]


def test_beaufort_and_fahrenheit(spark):
    assert one(spark, SF.beaufort, [0.9, 1.0, 117.9, 118.0, None]) == [0, 1, 11, 12, 12]
    assert [float(v) for v in one(spark, SF.c_to_f, [0.0, 100.0, -40.0])] == [32.0, 212.0, -40.0]


def test_dow_weekend_and_season(spark):
    days = [dt.date(2024, 1, 7), dt.date(2024, 1, 6), dt.date(2024, 1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [(r[0], r[1]) for r in df.select(SF.dow0("d"), SF.is_weekend("d")).collect()]
    assert got == [(0, True), (6, True), (1, False)]
    sdays = [(3, 20), (3, 21), (6, 20), (6, 21), (9, 22), (9, 23), (12, 20), (12, 21)]
    df = spark.createDataFrame([(dt.date(2024, m, d),) for m, d in sdays], "d date")
    assert [r[0] for r in df.select(SF.season_south("d")).collect()] == [
        "Verão", "Outono", "Outono", "Inverno", "Inverno", "Primavera", "Primavera", "Verão"]


def test_daylight_hours(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 0), dt.datetime(2024, 1, 1, 18, 30))],
                               "a timestamp, b timestamp")
    assert df.select(SF.daylight_hours("a", "b")).first()[0] == 13.5


def test_surrogate_key_and_rounding(spark):
    df = spark.createDataFrame([("1", dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 1))], "a string, d date")
    import hashlib
    got = [r[0] for r in df.select(SF.surrogate_key("a", "d")).collect()]
    assert got[0] == hashlib.md5(b"1-2024-01-01").hexdigest()
    assert got[1] == hashlib.md5(b"_dbt_utils_surrogate_key_null_-2024-01-01").hexdigest()
    at = spark.createDataFrame([("1", dt.datetime(2024, 1, 1, 5))], "a string, t timestamp")
    assert at.select(SF.surrogate_key("a", SF.instant_text("t"))).first()[0] == hashlib.md5(b"1-2024-01-01 05:00:00+00").hexdigest()
    r = spark.createDataFrame([(2.25,), (-2.25,), (0.15,)], "x double")
    assert [v[0] for v in r.select(SF.round_half_up("x", 1)).collect()] == [2.3, -2.3, 0.2]
    assert [v[0] for v in r.select(SF.round_half_even("x", 1)).collect()] == [2.2, -2.2, 0.2]


def test_labels(spark):
    df = spark.createDataFrame([("heavy_rain",), ("frost",), (None,)], "t string")
    assert [r[0] for r in df.select(SF.label_pt("t", "alert_type")).collect()] == ["Chuva Forte", "frost", None]
