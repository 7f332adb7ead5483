"""Stored tables: declared schema, interrupted swaps, expiry, merges; halo; rejects; state of streams."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from skyledger.operators import incremental as U
from skyledger.operators import quality as Q
from skyledger.operators.filters import latest_date, partition_list
from skyledger.operators.windows import rolling_mean
from skyledger.sinks import stored as S
from skyledger.sinks import tables as K
from skyledger.sources import api_json as SJ
from skyledger.sources.tables import select_raw_columns

SCHEMA = "surrogate_key string, part_month string, v int"


def rows(df):
    return sorted(map(tuple, df.select("surrogate_key", "part_month", "v").collect()))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    S.replace_partitions(spark, path, spark.createDataFrame(
        [("a", "2024-01", 1), ("b", "2024-02", 2), ("c", "2024-03", 3), ("d", "2024-03", 4)], SCHEMA), "part_month")
    return path


def test_merge_touches_only_its_partitions(spark, table):
    before = {n: os.stat(f"{table}/{n}").st_ino for n in S.names(spark, table) if "=" in n}
    S.merge_table(spark, table, spark.createDataFrame([("c", "2024-03", 30), ("e", "2024-04", 5)], SCHEMA), "part_month")
    assert rows(S.read_table(spark, table)) == [("a", "2024-01", 1), ("b", "2024-02", 2), ("c", "2024-03", 30),
                                                ("d", "2024-03", 4), ("e", "2024-04", 5)]
    after = {n: os.stat(f"{table}/{n}").st_ino for n in S.names(spark, table) if "=" in n}
    assert {n for n in before if before[n] == after[n]} == {"part_month=2024-01", "part_month=2024-02"}
    assert not [n for n in S.names(spark, table) if n.startswith("_swap")]


@pytest.mark.parametrize("dies_at", [1, 2])
def test_a_run_that_dies_between_deletion_and_swap_is_completed(spark, table, monkeypatch, dies_at):
    move, calls = S._move, []

    def dying(*a):
        calls.append(a)
        if len(calls) == dies_at:
            raise KeyboardInterrupt("the driver is gone")
        move(*a)

    monkeypatch.setattr(S, "_move", dying)
    new = spark.createDataFrame([("b", "2024-02", 20), ("c", "2024-03", 30)], SCHEMA)
    with pytest.raises(KeyboardInterrupt):
        S.merge_table(spark, table, new, "part_month")
    monkeypatch.setattr(S, "_move", move)
    want = [("a", "2024-01", 1), ("b", "2024-02", 20), ("c", "2024-03", 30), ("d", "2024-03", 4)]
    assert rows(S.read_table(spark, table)) == want          # the next read completes the swap
    S.merge_table(spark, table, new, "part_month")           # and the run can simply be repeated
    assert rows(S.read_table(spark, table)) == want


def test_declared_schema_holds_for_untouched_partitions(spark, table):
    new = spark.createDataFrame([("c", "2024-03", True)], "surrogate_key string, part_month string, flag boolean")
    S.merge_table(spark, table, new, "part_month")
    got = S.read_table(spark, table)
    assert sorted(got.columns) == ["flag", "part_month", "surrogate_key"]
    assert {r.surrogate_key: r.flag for r in got.collect()} == {"a": None, "b": None, "c": True, "d": None}


def test_expiry_drops_folders(spark, table):
    assert S.expire(spark, table, "part_month", "2024-03") == ["2024-01", "2024-02"]
    assert rows(S.read_table(spark, table)) == [("c", "2024-03", 3), ("d", "2024-03", 4)]


def test_reload_keeps_the_rest_of_a_month_without_window_rows(spark, tmp_path):
    from skyledger.plans.jobs import reload_raw
    path, schema = str(tmp_path / "raw"), "location_id string, date date, part_month string"
    day = lambda d: ("1", dt.date(2024, 1, d), "2024-01")
    reload_raw(spark, path, spark.createDataFrame([day(1), day(2)], schema), "part_month", "date", "2024-01-01")
    reload_raw(spark, path, spark.createDataFrame([day(15)], schema), "part_month", "date", "2024-01-10")
    assert sorted(r.date.day for r in S.read_table(spark, path).collect()) == [1, 2, 15]
    reload_raw(spark, path, spark.createDataFrame([day(20)], schema), "part_month", "date", "2024-01-02")
    assert sorted(r.date.day for r in S.read_table(spark, path).collect()) == [1, 20]


def test_truncating_append_leaves_its_own_rows(spark, tmp_path):
    df = spark.createDataFrame([("1", dt.date(2024, 1, d)) for d in (1, 2, 3)], "location_id string, date date")
    K.append_raw(df, str(tmp_path / "t"))
    K.append_raw(df.filter("date = '2024-01-03'"), str(tmp_path / "t"), truncate=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_halo_widens_only_for_sparse_locations(spark):
    day = dt.date(2024, 6, 1)
    series = {"dense": range(0, 400), "sparse": range(0, 400, 9), "new": range(0, 3), "gone": range(100, 300)}
    data = [(loc, day - dt.timedelta(days=n), float(n % 17)) for loc, ns in series.items() for n in ns]
    stg = spark.createDataFrame(data, "location_id string, date date, v double")
    asked, plain = [], U.staged(stg)

    def source(lo, hi):
        asked.append((lo, hi))
        return plain(lo, hi)

    start = day - dt.timedelta(days=10)
    with_halo = U.with_halo(source, start, dt.date(2000, 1, 1))
    got = rolling_mean(with_halo, {"m": "v"}).filter(F.col("date") >= F.lit(start))
    want = rolling_mean(stg, {"m": "v"}).filter(F.col("date") >= F.lit(start))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    per = {r.location_id: r["count"] for r in with_halo.groupBy("location_id").count().collect()}
    assert per["dense"] == 11 + 29 and "gone" not in per
    assert asked[1] == (start - dt.timedelta(days=60), start) and len(asked) > 2


def test_latest_date_asks_the_newest_partitions_first(spark, tmp_path):
    path = str(tmp_path / "h")
    data = [("x" if d % 7 else "y", dt.date(2024, 1, d)) for d in range(1, 31)]
    spark.createDataFrame(data, "city_name string, date date").write.partitionBy("date").parquet(path)
    df = spark.read.parquet(path)
    assert partition_list(df, "date")[-1] == "2024-01-30" and partition_list(df, "city_name") is None
    one = spark.range(1)
    for city, want in (("x", dt.date(2024, 1, 30)), ("y", dt.date(2024, 1, 28)), ("z", None)):
        assert one.select(latest_date(df, F.col("city_name") == city).alias("d")).first().d == want


DOC = "location_id string, latitude double, longitude double, elevation double, timezone string"


def test_rejects_take_no_good_document_with_them(spark, tmp_path):
    lines = ['{"location_id": "1", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, 2.5]}}',
             '{"location_id": "1", "hourly": {"time": ["2024-01-02T00:00"], "temperature_2m": [1.5, 9.0]}}',
             '{"location_id": "1", "hourly": {"time": ["soon", null], "temperature_2m": [1.5, 9.0]}}',
             '{"location_id": "2", "hourly": {"time": ["2024-01-01T00:00"], "tempera',
             '{"location_id": "3", "daily": {"time": ["2024-13-45"]}}', '{"location_id": "4"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "d"))
    docs = SJ.read_documents(spark, str(tmp_path / "d"))
    got = SJ.split_documents(docs, "hourly", "2024-02-01 00:00:00").collect()
    assert sorted((r.reason, r.location_id) for r in got if r.kind == "rejects" and r.reason != "malformed") == [
        ("ragged: temperature_2m", "1"), ("unparseable: soon", "1")]
    assert [r.document for r in got if r.reason == "malformed"] == [lines[3]]
    assert sorted((r.location_id, str(r.timestamp), r.temperature_2m) for r in got if r.kind == "rows") == [
        ("1", "2024-01-01 00:00:00", 1.5), ("1", "2024-01-01 01:00:00", 2.5)]
    daily = SJ.split_documents(docs, "daily", "2024-02-01 00:00:00").filter("reason <> 'malformed'").collect()
    assert [(r.reason, r.location_id) for r in daily] == [("unparseable: 2024-13-45", "3")]
    assert SJ.flatten_daily(docs.filter("location_id = '3'"), "2024-02-01 00:00:00").first().date is None
    assert select_raw_columns(SJ.split_documents(docs, "hourly", "2024-02-01 00:00:00"), "hourly").columns[0] == "location_id"


def test_suite_reports_absent_columns_and_distrusts_double_counts(spark):
    df = spark.createDataFrame([("1", None), (None, "x")], "location_id string, city_name string")
    suites = {"m": [("not_null", "location_id"), ("not_null", "missing"), ("unique", "city_name")]}
    want = [("m", "not_null", "location_id", 1), ("m", "not_null", "missing", None), ("m", "unique", "city_name", 0)]
    for metrics in (None, {"m": {"n_rows": 2, "c0": 1}}, {"m": {"n_rows": 4, "c0": 2}}):
        assert sorted(map(str, map(tuple, Q.run_suite({"m": df}, suites, metrics).collect()))) == sorted(map(str, want))
    tagged = Q.tagged_failures(df, "m", {"m": [("not_null", "location_id"), ("not_null", "city_name")]})
    assert sorted((r.test, r.location_id) for r in tagged.collect()) == [("not_null__city_name", "1"), ("not_null__location_id", None)]


def test_stream_state_is_bounded_and_outlives_a_restart(spark, tmp_path):
    from skyledger.streaming.ingest import read_landing, stream_dedup
    landing, sink, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    schema = "location_id string, timestamp timestamp, v int"
    t0 = dt.datetime(2024, 1, 1)
    at = lambda day, v, loc="1": (loc, t0 + dt.timedelta(days=day), v)
    state = []
    for batch in ([at(d, 1) for d in range(10)], [at(9, 2), at(7, 2), at(7, 3, "2"), at(2, 3, "2"), at(12, 1)], [at(d, 1) for d in range(30, 33)] + [at(12, 5)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landing)
        q = (stream_dedup(read_landing(spark, landing, "parquet", spark.createDataFrame([], schema).schema),
                          ["location_id", "timestamp"], "timestamp", 4).writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
        state.append([p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1])
    got = {(r.location_id, (r.timestamp - t0).days): r.v for r in spark.read.parquet(sink).collect()}
    # sent again (days 9, 7, 12): dropped; late within four days (location 2, day 7): kept; beyond (day 2): dropped
    assert got == {("1", d): 1 for d in (*range(10), 12, 30, 31, 32)} | {("2", 7): 3}
    assert spark.read.parquet(sink).count() == len(got)
    assert state[-1] == 3  # only the days within reach of the watermark are remembered
