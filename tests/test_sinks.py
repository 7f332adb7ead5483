"""Sources / sinks kept as library functions: S4, S5, S9, K1, K2, K4, K6, K8."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from skyledger.sinks import tables as K
from skyledger.sources import tables as ST


def test_read_locations_csv(spark):
    d = tempfile.mkdtemp(prefix="skyledger-seed-")
    with open(os.path.join(d, "locations.csv"), "w") as f:
        f.write("location_id,city_name,state_name,state_code,country,region,mesoregion,latitude,longitude,"
                "altitude_m,population_class\n")
        f.write("9990001,Vila Inventada,Santa Catarina,SC,Brasil,Sul,Serrana,-27.5000,-50.5000,800,small\n")
    df = ST.read_locations(spark, os.path.join(d, "locations.csv"))
    r = df.first()
    assert r.location_id == "9990001" and float(r.latitude) == -27.5 and dict(df.dtypes)["latitude"].startswith("decimal")


def test_window_bounds_and_between(spark):
    assert ST.window_bounds(dt.date(2024, 1, 10), 2) == (dt.date(2024, 1, 8), dt.date(2024, 1, 10))
    assert ST.window_bounds(dt.date(2024, 1, 10), 2, dt.date(2023, 1, 1), dt.date(2023, 2, 1)) == (
        dt.date(2023, 1, 1), dt.date(2023, 2, 1))
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 11)], "date date")
    assert ST.between(df, dt.date(2024, 1, 8), dt.date(2024, 1, 10)).count() == 3


def test_append_read_and_reload_window(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="skyledger-raw-"), "daily")
    rows = [("1", dt.date(2024, 1, d), float(d)) for d in range(1, 6)]
    df = spark.createDataFrame(rows, "location_id string, date date, v double")
    K.append_raw(df, path)
    K.append_raw(df, path)                        # appends duplicates
    raw = ST.read_raw(spark, path)
    assert raw.count() == 10
    new = spark.createDataFrame([("1", dt.date(2024, 1, 4), 40.0)], "location_id string, date date, v double")
    out = K.reload_window(raw.select("location_id", "date", "v"), new, dt.date(2024, 1, 4))
    assert sorted(r.v for r in out.collect()) == [1.0, 1.0, 2.0, 2.0, 3.0, 3.0, 40.0]   # no upper bound
    out2 = K.reload_window(raw.select("location_id", "date", "v"), new, dt.date(2024, 1, 4), dt.date(2024, 1, 4))
    assert sorted(r.v for r in out2.collect()) == [1.0, 1.0, 2.0, 2.0, 3.0, 3.0, 5.0, 5.0, 40.0]


def test_upsert_raw_daily_keeps_coordinates(spark):
    t = spark.createDataFrame([("1", dt.date(2024, 1, 1), -27.0, -50.0, 10.0)],
                              "location_id string, date date, latitude double, longitude double, temperature_2m_max double")
    n = spark.createDataFrame([("1", dt.date(2024, 1, 1), -1.0, -1.0, 20.0), ("2", dt.date(2024, 1, 1), -2.0, -2.0, 5.0)],
                              t.schema)
    got = sorted(map(tuple, K.upsert_raw_daily(t, n).collect()))
    assert got == [("1", dt.date(2024, 1, 1), -27.0, -50.0, 20.0), ("2", dt.date(2024, 1, 1), -2.0, -2.0, 5.0)]


def test_expire_and_materialize(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1),), (dt.datetime(2024, 6, 1),)], "timestamp timestamp")
    assert K.expire_partitions(df, 450, F.lit(dt.datetime(2024, 6, 2))).count() == 1
    K.materialize(df, "view", name="tmp_view_test")
    assert spark.table("tmp_view_test").count() == 2
    path = os.path.join(tempfile.mkdtemp(prefix="skyledger-mat-"), "t")
    assert K.materialize(df, "table", path=path).count() == 2


def test_merge_stops_on_an_unreadable_file_and_keeps_all_rows(spark, tmp_path):
    import os

    import pytest

    from skyledger.sinks.tables import upsert_partitions

    path = str(tmp_path / "facts")
    rows = [("a", 1, "2024-01"), ("b", 2, "2024-02"), ("c", 3, "2024-02")]
    schema = "surrogate_key string, v int, part_month string"
    spark.createDataFrame(rows, schema).write.partitionBy("part_month").parquet(path)
    bad = os.path.join(path, "part_month=2024-01", "part-broken.parquet")
    with open(bad, "wb") as f:
        f.write(b"not parquet")
    new = spark.createDataFrame([("b", 20, "2024-02")], schema)
    with pytest.raises(Exception):  # noqa: B017  (the reader's error, whichever it is)
        upsert_partitions(spark, path, new)
    feb = spark.read.parquet(os.path.join(path, "part_month=2024-02"))
    assert sorted(r.surrogate_key for r in feb.collect()) == ["b", "c"]
    with open(bad, "wb") as f:
        f.truncate(0)
    os.remove(bad)
    for extra in (f"{path}/part_month=2024-01/.part-broken.parquet.crc",):
        if os.path.exists(extra):
            os.remove(extra)
    upsert_partitions(spark, path, new)
    got = {r.surrogate_key: r.v for r in spark.read.parquet(path).collect()}
    assert got == {"a": 1, "b": 20, "c": 3}
