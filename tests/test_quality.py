"""The DQ checks flag seeded bad rows and pass on clean rows."""

import datetime as dt

from pyspark.sql import functions as F

from skyledger.operators import quality as Q

D = dt.date(2024, 1, 10)


def test_seeded_failures(spark):
    facts = spark.createDataFrame([
        ("k1", "1", D, 20.0, 10.0, 12.0, "low"),
        ("k1", "1", D, 20.0, 10.0, 12.0, "low"),          # duplicate surrogate key + duplicate (location, date)
        ("k3", None, D, 20.0, 10.0, 12.0, "low"),          # null key
        ("k4", "2", D, 5.0, 9.0, 14.06, "urgent"),         # min > max, daylight above 14.05, bad severity
        ("k5", "3", D, 5.0, 4.0, 14.0166, "low"),          # daylight 14.0166 passes
    ], "surrogate_key string, location_id string, date date, temp_max_c double, temp_min_c double, "
       "daylight_hours double, severity string")
    assert Q.not_null(facts, "location_id").count() == 1
    assert Q.unique(facts, "surrogate_key").count() == 1
    assert Q.accepted_values(facts, "severity", ["critical", "high", "medium", "low"]).count() == 1
    assert Q.accepted_range(facts, "daylight_hours", 10, 14.05).count() == 1
    assert Q.unique_key(facts, "location_id", "date").count() == 1
    assert Q.expression(facts, F.col("temp_min_c") > F.col("temp_max_c")).count() == 1


def test_gaps_freshness_relationship(spark):
    facts = spark.createDataFrame([("1", D), ("1", D + dt.timedelta(days=1)), ("1", D + dt.timedelta(days=3)),
                                   ("2", D)], "location_id string, date date")
    gaps = Q.date_gaps(facts, F.lit(D + dt.timedelta(days=3)), 30).collect()
    assert [(g.location_id, g.gap_days) for g in gaps] == [("1", 2)]
    locs = spark.createDataFrame([("1",), ("2",), ("3",)], "location_id string")
    now = dt.datetime(2024, 1, 10, 12, 0)
    raw = spark.createDataFrame([("1", now - dt.timedelta(hours=27)), ("2", now - dt.timedelta(hours=2))],
                                "location_id string, _extracted_at timestamp")
    fr = {r.location_id: r.status for r in Q.location_freshness(locs, raw, F.lit(now), 25).collect()}
    assert fr == {"1": "stale", "3": "never_loaded"}
    alerts = spark.createDataFrame([("1", D), ("9", D)], "location_id string, date date")
    assert [r.location_id for r in Q.relationship(alerts, locs).collect()] == ["9"]


def test_suite_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 101)], "id string, relative_humidity_2m int")
    suites = {"t": [("not_null", "relative_humidity_2m"), ("unique", "id"),
                    ("accepted_range", "relative_humidity_2m", (0, 100))]}
    got = {(r.test, r.column): r.failures for r in Q.run_suite({"t": df}, suites).collect()}
    assert got == {("not_null", "relative_humidity_2m"): 1, ("unique", "id"): 1,
                   ("accepted_range", "relative_humidity_2m"): 1}


def test_suite_clean(spark):
    df = spark.createDataFrame([("a", 1), ("b", 50)], "id string, relative_humidity_2m int")
    suites = {"t": [("not_null", "relative_humidity_2m"), ("unique", "id"),
                    ("accepted_range", "relative_humidity_2m", (0, 100))]}
    assert all(r.failures == 0 for r in Q.run_suite({"t": df}, suites).collect())
