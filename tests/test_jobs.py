"""End-to-end daily job: landed documents -> raw -> marts -> checks; rerun is idempotent."""

import datetime as dt
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from smoke_tables import SMOKE
from skyledger.operators import quality as Q
from skyledger.operators.dedup import latest_of_repeated, latest_per_key
from skyledger.plans import bridge, jobs, layers
from skyledger.plans.jobs import backfill, build_marts, daily_job, ingest, reload_raw
from skyledger.plans.marts import Marts
from skyledger.session import scratch_path, shuffles_dropped
from skyledger.sinks.stored import read_table, replace_partitions
from skyledger.sources import api_json as SJ
from skyledger.sources.tables import select_raw_columns

def stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")
COLS = ["surrogate_key", "date", "location_id", "temp_avg_c", "temp_anomaly_c", "precip_avg_30d_mm",
        "precipitation_class", "daylight_hours"]


def test_daily_job_end_to_end(spark):
    raw_d = latest_per_key(bridge.raw_daily(spark, SMOKE), ["location_id", "date"], bridge.daily_order())
    raw_h = latest_per_key(bridge.raw_hourly(spark, SMOKE), ["location_id", "timestamp"], bridge.hourly_order())
    raw_d = select_raw_columns(raw_d, "daily").withColumn("_extracted_at", stamp())
    raw_h = select_raw_columns(raw_h, "hourly").withColumn("_extracted_at", stamp())
    landing = tempfile.mkdtemp(prefix="skyledger-landing-")
    SJ.to_documents_daily(raw_d).write.mode("overwrite").json(os.path.join(landing, "daily"))
    SJ.to_documents_hourly(raw_h).write.mode("overwrite").json(os.path.join(landing, "hourly"))
    wh = tempfile.mkdtemp(prefix="skyledger-wh-")
    locs = bridge.locations(spark, SMOKE)
    summary = backfill(spark, os.path.join(landing, "*"), wh, locs, "1990-01-01", None, stamp(), "month")
    assert summary.filter("model = 'daily_facts' AND test = 'unique'").first().failures == 0

    want = Marts(raw_d, raw_h, locs, stamps=False).facts.select(*COLS)
    got = spark.read.parquet(os.path.join(wh, "marts", "daily_facts")).select(*COLS)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    # a re-run over the same landed files changes nothing but the update stamps
    daily_job(spark, os.path.join(landing, "*"), wh, locs, "1990-01-01", None, stamp(), raw_daily_grain="month")
    again = spark.read.parquet(os.path.join(wh, "marts", "daily_facts")).select(*COLS)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, want.collect()))
    hourly = spark.read.parquet(os.path.join(wh, "marts", "hourly_facts"))
    assert hourly.count() == raw_h.count()
    assert os.path.exists(os.path.join(wh, "quality", "summary"))


RAW = ("location_id string, date date, latitude double, longitude double, temperature_2m_max double, temperature_2m_min double, "
       "precipitation_sum double, rain_sum double, wind_speed_10m_max double, sunrise timestamp, sunset timestamp, "
       "uv_index_max double, _extracted_at timestamp")
HOURLY = ("location_id string, timestamp timestamp, latitude double, longitude double, elevation double, timezone string, "
          "temperature_2m double, relative_humidity_2m long, precipitation double, wind_speed_10m double, wind_direction_10m long, "
          "surface_pressure double, cloud_cover long, visibility double, weather_code long, _extracted_at timestamp")


def raw_daily(spark, locs, days, copies=1, value=20.0):
    d0, at = dt.date(2024, 1, 20), dt.datetime(2024, 6, 1)
    return spark.createDataFrame(
        [(loc, d0 + dt.timedelta(days=d), -27.0, -49.0, value + d % 9, 10.0, float(d % 70), 1.0, float(d % 90), dt.datetime(2024, 1, 1, 6),
          dt.datetime(2024, 1, 1, 18), float(d % 13), at + dt.timedelta(hours=c)) for loc in locs for d in days for c in range(copies)], RAW)


def raw_hourly(spark, locs, hours):
    return spark.createDataFrame(
        [(loc, dt.datetime(2024, 1, 30) + dt.timedelta(hours=h), -27.0, -49.0, 5.0, "tz", 20.0 + h, 50, 1.0, 3.0, 90, 1000.0, 30, 5000.0, 1,
          dt.datetime(2024, 6, 1)) for loc in locs for h in hours], HOURLY)


def locations_of(spark, ids):
    return spark.createDataFrame([(i, f"c{i}", "s", "SC", "BR", "r", "m", -27.0, -49.0, 3.0, "small") for i in ids],
                                 "location_id string, city_name string, state_name string, state_code string, country string, "
                                 "region string, mesoregion string, latitude double, longitude double, altitude_m double, "
                                 "population_class string")


def stored(df):
    return sorted(map(str, df.collect()))


def shuffle_files(spark):
    return glob.glob(f"{spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0]}/*/shuffle_*")


def test_shuffle_files_go_with_their_query(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    path = tempfile.mkdtemp(prefix="skyledger-drop-")
    before = set(shuffle_files(spark))
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
        assert not set(shuffle_files(spark)) - before
        assert df.count() == 7  # the same frame once more
    assert spark.conf.get(key) == "false"
    with pytest.raises(ValueError), shuffles_dropped(spark):
        raise ValueError
    assert spark.conf.get(key) == "false"


def test_reload_of_some_locations_spares_the_others(spark, monkeypatch):
    month = lambda df: df.withColumn("part_month", F.date_format("date", "yyyy-MM"))
    odd = raw_daily(spark, ["a"], [2]).withColumn("location_id", F.lit(None).cast("string"))
    old = month(raw_daily(spark, ["a", "b", "c"], range(0, 40)).unionByName(odd))
    new = month(raw_daily(spark, ["b", "b", "d"], range(5, 60, 5), value=30.0))
    only = spark.createDataFrame([("b",), ("b",), ("d",)], "location_id string")
    start = "2024-01-25"
    gone = (F.col("date") >= start) & F.coalesce(F.col("location_id").isin("b", "d"), F.lit(False))
    want = stored(old.filter(~gone).unionByName(new))
    plans = []
    write = jobs.replace_partitions

    def watched(spark, path, rows, part, touched=None):
        plans.append((rows._jdf.queryExecution().optimizedPlan().toString(), touched))
        write(spark, path, rows, part, touched)

    monkeypatch.setattr(jobs, "replace_partitions", watched)
    for fits in (True, False):
        path = scratch_path(spark, f"reload-{fits}")
        replace_partitions(spark, path, old, "part_month")
        if not fits:
            monkeypatch.setattr(jobs, "fits_broadcast", lambda *_: False)
        reload_raw(spark, path, new, "part_month", "date", start, only=only)
        assert stored(read_table(spark, path).select(*old.columns)) == want
        # kept rows lie by partition: only the new ones are dealt, unless a join dealt them by location
        assert plans[-1][0].count("RebalancePartitions") == (1 if fits else 2)
        reload_raw(spark, path, new.limit(0), "part_month", "date", start, only=only)
        assert stored(read_table(spark, path).select(*old.columns)) == stored(old.filter(~gone))


def test_backfill_writes_raw_once_and_keeps_no_copies(spark):
    locs = locations_of(spark, "abc")
    land, wh = tempfile.mkdtemp(prefix="skyledger-landing-"), tempfile.mkdtemp(prefix="skyledger-wh-")
    d, h = raw_daily(spark, "abc", range(14)), raw_hourly(spark, "abc", range(30))
    for name, keep in (("all", F.lit(True)), ("some", F.col("location_id") == "a")):
        SJ.to_documents_daily(d.filter(keep)).write.json(f"{land}/{name}/daily")
        SJ.to_documents_hourly(h.filter(keep)).write.option("compression", "gzip").json(f"{land}/{name}/hourly")
    ingest(spark, SJ.read_documents(spark, f"{land}/some/*"), wh, "2024-01-20", None, stamp(), True, "month")
    ckpt = spark.sparkContext.getCheckpointDir()
    left = lambda: {f for f in glob.glob(f"{spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix('file:')}/rdd-*")}
    before = left() if ckpt else set()
    backfill(spark, f"{land}/all/*", wh, locs, "2024-01-20", None, stamp() + F.expr("INTERVAL 1 HOUR"), "month", skip_loaded=True)
    for block, rows in (("daily", d), ("hourly", h)):
        got = read_table(spark, f"{wh}/raw/{block}")
        assert {(r[0], r[1]): r[2] for r in got.groupBy("location_id", F.hour("_extracted_at")).count().collect()} == {
            (loc, 0 if loc == "a" else 1): rows.count() // 3 for loc in "abc"}
    # checkpoints: the locations to do and the repeated keys of raw, not its rows
    assert len(left() - before) <= 2


def test_repeated_keys_alone_are_ranked(spark):
    rows = raw_daily(spark, ["a", "b"], range(30)).unionByName(raw_daily(spark, ["b", "c"], range(10, 20), copies=3, value=25.0))
    odd = raw_daily(spark, ["a"], [1, 1])
    rows = rows.unionByName(odd.withColumn("date", F.lit(None).cast("date"))).unionByName(
        odd.withColumn("location_id", F.lit(None).cast("string")))
    order = [F.col("_extracted_at").desc(), F.col("temperature_2m_max").desc()]
    keys = ["location_id", "date"]
    want = stored(latest_per_key(rows, keys, order))
    for most in (20, 19):  # 20 keys repeat
        got = latest_of_repeated(rows, keys, order, most)
        assert stored(got) == want
        assert ("LeftAnti" in got._jdf.queryExecution().optimizedPlan().toString()) == (most >= 20)
    once = rows.dropDuplicates(keys).filter("location_id IS NOT NULL AND date IS NOT NULL")
    assert stored(latest_of_repeated(once, keys)) == stored(once)


def test_full_build_counts_its_views_while_it_writes(spark, monkeypatch):
    wh = tempfile.mkdtemp(prefix="skyledger-wh-")
    d = raw_daily(spark, "abx", range(12), copies=2)
    replace_partitions(spark, f"{wh}/raw/daily", d.withColumn("part_month", F.date_format("date", "yyyy-MM")), "part_month")
    h = raw_hourly(spark, "abx", range(0, 48, 6))  # over 55 degrees at the end
    replace_partitions(spark, f"{wh}/raw/hourly", h.withColumn("part_date", F.to_date("timestamp")), "part_date")
    suite, calls = Q.run_suite, []

    def watched(tables, **kw):
        calls.append((tables, kw))
        return suite(tables, **kw)

    monkeypatch.setattr(Q, "run_suite", watched)
    locs = locations_of(spark, "ab")
    got = build_marts(spark, wh, locs, incremental=False, raw_daily_grain="month")
    tables, kw = calls[-1]
    assert set(kw["metrics"]) == {"stg_daily", "daily_enriched", "stg_hourly"}
    assert {m: kw["metrics"][m]["n_rows"] for m in kw["metrics"]} == {m: tables[m].count() for m in kw["metrics"]}
    assert stored(got) == stored(suite(tables, singular=kw["singular"]))
    # x has no location
    assert got.filter("model = 'daily_enriched' AND column = 'city_name'").first().failures == 12
    assert got.filter("model = 'stg_hourly' AND column = 'temperature_c'").first().failures == 3 * 2
    # hourly rows are dealt by day before the join widens them
    plan = layers.hourly_facts_by_day(layers.stg_hourly(h), locs)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("BroadcastHashJoin") < plan.index("REBALANCE")
