"""What the daily chain, the stored marts and the merges shuffle, and that their rows stay the same."""

import datetime as dt
import glob
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyledger.operators.incremental import merge_upsert
from skyledger.operators.quality import run_suite, unique
from skyledger.plans import bridge, layers
from skyledger.plans.marts import Marts
from skyledger.plans.warehouse import StoredMarts

DAY = dt.date(2023, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def marts(spark):
    rows = [(str(loc), DAY + dt.timedelta(days=d), -27.0, -49.0, float(20 + (loc * d) % 25), float(5 + d % 9), float(d % 70), 1.0,
             float(d % 90), dt.datetime(2023, 1, 1, 6), dt.datetime(2023, 1, 1, 18), float(d % 13), dt.datetime(2023, 6, 1, copy))
            for loc in range(4) for d in range(0, 120, 1 + loc) for copy in range(1 + d % 2)]
    rows += [(None, DAY, *rows[0][2:]), ("1", None, *rows[0][2:])]
    daily = spark.createDataFrame(rows, "location_id string, date date, latitude double, longitude double, temperature_2m_max double, "
                                  "temperature_2m_min double, precipitation_sum double, rain_sum double, wind_speed_10m_max double, "
                                  "sunrise timestamp, sunset timestamp, uv_index_max double, _extracted_at timestamp")
    locations = spark.createDataFrame([(str(i), f"c{i}", "s", "BR", "r", f"m{i % 2}", -27.0, -49.0, 3.0) for i in range(3)],
                                      "location_id string, city_name string, state_name string, country string, region string, "
                                      "mesoregion string, latitude double, longitude double, altitude_m double")
    return Marts(daily, None, locations, stamps=False)


def test_rows_by_month_carry_no_derived_column(marts):
    f = layers.daily_facts_by_month(marts.stg_daily, marts.locations, updated_at=False)
    # plans are printed from the top: keys and dimension columns come after the rebalance
    assert plan(f).index("md5") < plan(f).index("BroadcastHashJoin") < plan(f).index("REBALANCE")
    assert sorted(map(str, f.collect())) == sorted(map(str, marts.facts.collect()))


def test_stored_marts_equal_the_composed_ones(spark, marts):
    root = tempfile.mkdtemp(prefix="skyledger-marts-")
    s = StoredMarts(spark, marts, root)
    for got, want in ((s.facts, marts.facts), (s.alerts, marts.alerts)):
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    # the alerts of a month come from that month's files: as few as those
    for month in glob.glob(f"{root}/alerts/year_month=*"):
        assert len(glob.glob(f"{month}/*.parquet")) <= len(glob.glob(month.replace("/alerts/", "/daily_facts/") + "/*.parquet"))


def test_suite_counts_views_by_the_tables_they_fill(spark, marts):
    hourly = spark.createDataFrame([("1", dt.datetime(2023, 1, 1, h), *[1.0] * 3, "tz", *[1.0] * 4, 1, 1.0, 1, 1.0, 1, dt.datetime(2023, 1, 2))
                                    for h in (1, 1, 2)], "location_id string, timestamp timestamp, latitude double, longitude double, "
                                   "elevation double, timezone string, temperature_2m double, relative_humidity_2m double, precipitation double, "
                                   "wind_speed_10m double, wind_direction_10m long, surface_pressure double, cloud_cover long, "
                                   "visibility double, weather_code long, _extracted_at timestamp")
    for locations in (marts.locations, marts.locations.unionByName(marts.locations.where("location_id = '1'"))):
        m = Marts(marts.raw_daily, hourly, locations, stamps=False)
        s = StoredMarts(spark, m, tempfile.mkdtemp(prefix="skyledger-marts-"))
        views = {"stg_daily": m.stg_daily, "daily_enriched": m.enriched, "stg_hourly": m.stg_hourly}
        sized = s.sized_as()
        assert {k: v.count() for k, v in sized.items()} == {k: views[k].count() for k in sized}
        # a repeated location multiplies the rows it meets: then staging is counted itself
        assert set(sized) == (set(views) if locations is marts.locations else {"daily_enriched"})
        # a view with a stored table of its size is not evaluated: this one would fail
        dead = views["stg_daily"].withColumn("location_id", F.raise_error(F.lit("evaluated")))
        suites = {"daily_enriched": [("not_null", "location_id")]}
        got = run_suite({"daily_enriched": dead.filter(F.col("location_id").isNull())}, suites, s.metrics(), s.sized_as())
        assert [tuple(r) for r in got.collect()] == [("daily_enriched", "not_null", "location_id", 0)]


def test_uniqueness_shuffles_keys_as_bytes(spark):
    keys = ["0123456789abcdef" * 2] * 2 + ["0123456789ABCDEF" * 2] * 2 + ["x", "x", "y", "0123456789abcdef" * 2 + "\n", None, None]
    keys += [bytes.fromhex("41" * 16).decode()] * 3 + ["41" * 16] * 2  # a key's bytes as a text of its own
    df = spark.createDataFrame([(k, i % 2) for i, k in enumerate(keys)], "k string, n int")
    want = {k: n for k, n in Counter(keys).items() if n > 1 and k is not None}
    assert {r.k: r.n_records for r in unique(df, "k").collect()} == want
    assert unique(df, "k").columns == ["k", "n_records"]
    assert {r.n for r in unique(df, "n").collect()} == {0, 1}
    assert "hashpartitioning(k" not in plan(unique(df, "k")) and "unhex" in plan(unique(df, "k"))


def test_merge_leaves_rows_outside_the_increment_alone(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z"), ("d", None, "w"), (None, 3, "v")], "k string, d int, v string")
    source = spark.createDataFrame([("c", 3, "new"), ("e", 4, "new")], "k string, d int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = merge_upsert(target, source, "k", within=F.col("d") >= 3)
        assert sorted(map(str, got.collect())) == sorted(map(str, merge_upsert(target, source, "k").collect()))
        # only rows that may meet the source are shuffled: the filter lies below the join's exchange
        below = plan(got)[plan(got).index("LeftAnti"):].split("Exchange", 2)[1]
        assert "coalesce((d" in below
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_table_with_splits_enough_is_not_kept(spark):
    path = tempfile.mkdtemp(prefix="skyledger-many-")
    n = spark.sparkContext.defaultParallelism
    spark.range(1000).repartition(4 * n).write.option("maxRecordsPerFile", 5).mode("overwrite").parquet(f"{path}/lineitem.parquet")
    spark.range(10).coalesce(1).write.parquet(f"{path}/events.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        assert not bridge.table(spark, path, "lineitem").is_cached
        assert bridge.table(spark, path, "events").is_cached or n == 1
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
