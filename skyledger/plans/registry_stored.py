"""Registered queries over stored tables, landed documents and streams of several triggers.

They land or store the test tables' rows in scratch folders of ``spark.checkpoint.dir``, run the jobs' own code on them and
return what the table or the run holds afterwards.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import to_double
from ..operators import incremental as U
from ..operators import quality as Q
from ..operators.dedup import latest_per_key
from ..operators.filters import max_date
from ..operators.joins import bounded_broadcast
from ..operators.ordering import sort_nulls_first
from ..session import shuffles_dropped
from ..sinks import stored as S
from ..sinks import tables as K
from ..sources import api_json as SJ
from ..sources import tables as ST
from . import bridge, layers
from .registry import LANDED_AT, _facts_out, _hourly_docs, _m, _scratch, _w, register


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


# ── streams over several triggers ────────────────────────────────────────────

def _landings(spark, sf_dir, resend: bool) -> list[DataFrame]:
    """Hourly rows, unique per key, in three landings by time; rows of humidity 7 arrive one landing late, and those of
    humidity 13 are sent again (100 degrees warmer) in the next landing if ``resend``."""
    raw = ST.select_raw_columns(_m(spark, sf_dir).raw_hourly, "hourly")
    raw = latest_per_key(raw, ["location_id", "timestamp"], bridge.hourly_order())
    first, last = raw.agg(F.min(F.to_date("timestamp")), F.max(F.to_date("timestamp"))).first()
    span = (last - first).days + 1
    base = F.floor(3 * F.datediff(F.to_date("timestamp"), F.lit(first)) / span).cast("int")
    h = F.col("relative_humidity_2m")
    landed = raw.withColumn("_base", base).withColumn(
        "_landing", F.when(h == 7, F.least(F.col("_base") + 1, F.lit(2))).otherwise(F.col("_base")))
    if resend:
        again = landed.filter((h == 13) & (F.col("_base") < 2)).withColumn("_landing", F.col("_base") + 1).withColumn(
            "temperature_2m", F.col("temperature_2m") + 100)
        landed = landed.unionByName(again)
    landed = U.materialize(landed)
    return [landed.filter(F.col("_landing") == i).drop("_landing", "_base") for i in range(3)]


@register("st3_late_days")
def st3_late_days(spark, sf_dir):
    """ST3: daily sums kept as event-time state over three runs of one stream, each started from the checkpoint; late rows
    within four days count, later ones are dropped."""
    from ..streaming.ingest import daily_means, read_landing, stream_days
    landing, target, ckpt = _scratch(spark, "landing-late"), _scratch(spark, "days"), _scratch(spark, "ckpt")
    for rows in _landings(spark, sf_dir, resend=False):
        rows.write.mode("append").parquet(landing)
        days = daily_means(read_landing(spark, landing, "parquet", rows.schema), "timestamp", 4)
        stream_days(days, target, ckpt).awaitTermination()
    out = S.read_table(spark, target)
    return out.select("location_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_rows", "n_values",
                      F.col("total").cast("double").alias("total"))


@register("st4_resent_rows")
def st4_resent_rows(spark, sf_dir):
    """ST4: rows sent again in a later trigger are dropped by the state of the earlier ones; the first copy's values stay."""
    from ..streaming.ingest import read_landing, stream_dedup
    landing, sink, ckpt = _scratch(spark, "landing-resent"), _scratch(spark, "deduped"), _scratch(spark, "ckpt")
    for rows in _landings(spark, sf_dir, resend=True):
        rows.write.mode("append").parquet(landing)
        s = stream_dedup(read_landing(spark, landing, "parquet", rows.schema), ["location_id", "timestamp"], "timestamp", 4)
        q = (s.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(sink).select(
        "location_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("observed_at"), "temperature_2m")


# ── landed documents with faults ─────────────────────────────────────────────

def _faulty(docs: DataFrame, block: str, array: str, n: Column) -> DataFrame:
    """JSON lines of ``docs``; by (location, ``n``) some are ragged, some hold a bad time, some are cut off."""
    h = F.pmod(F.col("location_id").cast("int") * 7 + n, F.lit(13))
    b = F.col(block)
    short = b.withField(array, F.slice(b[array], F.lit(1), F.size(b[array]) - 1))
    bad = b.withField("time", F.concat(F.array(F.lit("no time")), F.slice(b["time"], F.lit(2), F.size(b["time"]))))
    docs = docs.withColumn("_h", h).withColumn(block, F.when(F.col("_h") == 3, short).when(F.col("_h") == 5, bad).otherwise(b))
    text = F.to_json(F.struct(*[c for c in docs.columns if c != "_h"]))
    return docs.select(F.when(F.col("_h") == 7, F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text).alias("value"))


def _accounts(spark, lines: DataFrame, block: str, period: Column) -> DataFrame:
    """Rows and rejects of landed lines, written and read as the ingest job does, counted."""
    landing, stage = _scratch(spark, f"landing-faulty-{block}"), _scratch(spark, f"split-{block}")
    lines.write.text(landing)
    rows = SJ.split_documents(SJ.read_documents(spark, landing), block, LANDED_AT)
    rows.write.partitionBy("kind").parquet(stage)
    both = spark.read.schema(rows.schema).parquet(stage)
    return both.groupBy("kind", "reason", "location_id", F.when(F.col("kind") == "rows", period).alias("period")).agg(
        F.count(F.lit(1)).alias("n"))


@register("s1_rejects")
def s1_rejects(spark, sf_dir):
    """Hourly documents of which some are ragged, cut off or hold an unreadable hour: rows and rejects with reason."""
    docs = _hourly_docs(_m(spark, sf_dir))
    n = F.unix_date(F.to_date(F.substring(F.col("hourly.time")[0], 1, 10)))
    return _accounts(spark, _faulty(docs, "hourly", "temperature_2m", n), "hourly", F.date_format("timestamp", "yyyy-MM-dd"))


@register("s2_rejects")
def s2_rejects(spark, sf_dir):
    """The same for daily documents (one per location and month)."""
    raw = ST.select_raw_columns(_m(spark, sf_dir).raw_daily, "daily")
    docs = SJ.to_documents_daily(raw, ["date", "_extracted_at"])
    t = F.col("daily.time")[0]
    n = F.substring(t, 1, 4).cast("int") * 12 + F.substring(t, 6, 2).cast("int")
    return _accounts(spark, _faulty(docs, "daily", "rain_sum", n), "daily", F.date_format("date", "yyyy-MM"))


# ── sources and sinks on stored files ────────────────────────────────────────

@register("s4_locations_csv")
def s4_locations_csv(spark, sf_dir):
    """The location seed as CSV, read back under its declared types."""
    path = _scratch(spark, "seed")
    loc = bridge.locations(spark, sf_dir)
    loc.write.option("header", True).csv(path)
    return to_double(ST.read_locations(spark, path).select(*loc.columns))


@register("s9_window_rows")
def s9_window_rows(spark, sf_dir):
    """S5 + S9: the collection window (45 days up to the newest date) of a stored raw table, read by path."""
    path = _scratch(spark, "raw-daily")
    raw = ST.select_raw_columns(_m(spark, sf_dir).raw_daily, "daily")
    K.append_raw(raw.withColumn("part_month", F.date_format("date", "yyyy-MM")).hint("rebalance", "part_month"), path, "part_month")
    stored = ST.read_raw(spark, path)
    start, end = ST.window_bounds(U.high_water_mark(stored, "date"), 45)
    rows = ST.between(stored, start, end).filter(F.col("part_month") >= f"{start:%Y-%m}")
    return rows.select("location_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "temperature_2m_max")


@register("k1_append_truncate")
def k1_append_truncate(spark, sf_dir):
    """K1 + K7: two appends leave every row twice; a truncating load leaves its own rows only."""
    raw = ST.select_raw_columns(_m(spark, sf_dir).raw_hourly, "hourly").withColumn("part_date", F.to_date("timestamp"))
    raw = U.materialize(raw.hint("rebalance", "part_date"))
    twice, once = _scratch(spark, "raw-appended"), _scratch(spark, "raw-truncated")
    for _ in range(2):
        K.append_raw(raw, twice, "part_date")
        K.append_raw(raw, once, "part_date")
    K.append_raw(raw.filter("part_date >= date'2024-01-20'"), once, "part_date", truncate=True)
    counts = [spark.read.parquet(p).groupBy("part_date").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("load"), F.date_format("part_date", "yyyy-MM-dd").alias("part_date"), "n")
        for name, p in (("append", twice), ("truncate", once))]
    return counts[0].unionByName(counts[1])


@register("k3_upsert_stored")
def k3_upsert_stored(spark, sf_dir):
    """K3 on a stored table: only the days that the increment touches are read and swapped."""
    raw = ST.select_raw_columns(_m(spark, sf_dir).raw_hourly, "hourly").withColumn("part_date", F.to_date("timestamp"))
    keys = ["location_id", "timestamp"]
    top = raw.agg(F.max("timestamp")).first()[0]
    path = _scratch(spark, "raw-hourly-stored")
    S.replace_partitions(spark, path, latest_per_key(raw.filter(F.col("timestamp") < F.lit(top) - _days(3)), keys), "part_date")
    new = latest_per_key(raw.filter(F.col("timestamp") >= F.lit(top) - _days(5)), keys)
    new = (new.withColumn("latitude", F.col("latitude") + 1.0)
              .withColumn("temperature_2m", F.col("temperature_2m") + 1.0))
    S.upsert_table(spark, path, new, "part_date", keys, ["latitude", "longitude", "elevation", "timezone"])
    return S.read_table(spark, path).drop("part_date").withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).withColumn(
        "_extracted_at", F.date_format("_extracted_at", "yyyy-MM-dd HH:mm:ss"))


@register("k4_upsert_daily_stored")
def k4_upsert_daily_stored(spark, sf_dir):
    """K4 on a stored table by month: coordinates keep the stored value, measures take the new one."""
    keys = ["location_id", "date"]
    raw = latest_per_key(_m(spark, sf_dir).raw_daily, keys, bridge.daily_order())
    raw = U.materialize(ST.select_raw_columns(raw, "daily").withColumn("part_month", F.date_format("date", "yyyy-MM")))
    top = raw.agg(F.max("date")).first()[0]
    path = _scratch(spark, "raw-daily-stored")
    S.replace_partitions(spark, path, raw.filter(F.col("date") < F.lit(top - dt.timedelta(days=30))).hint(
        "rebalance", "part_month"), "part_month")
    new = raw.filter(F.col("date") >= F.lit(top - dt.timedelta(days=60)))
    new = (new.withColumn("latitude", F.col("latitude") + 1.0)
              .withColumn("temperature_2m_max", F.col("temperature_2m_max") + 1.0))
    S.upsert_table(spark, path, new, "part_month", keys, ["latitude", "longitude"])
    return S.read_table(spark, path).select("location_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "latitude",
                                            "longitude", "temperature_2m_max", "temperature_2m_min")


@register("k6_expire_stored")
def k6_expire_stored(spark, sf_dir):
    """K6: day folders older than ten days before the newest one are dropped; what is left, by day."""
    raw = ST.select_raw_columns(_m(spark, sf_dir).raw_hourly, "hourly").withColumn("part_date", F.to_date("timestamp"))
    path = _scratch(spark, "raw-expiring")
    S.replace_partitions(spark, path, raw.hint("rebalance", "part_date"), "part_date")
    last = dt.date.fromisoformat(S.partitions(spark, path, "part_date")[-1])
    S.expire(spark, path, "part_date", (last - dt.timedelta(days=10)).isoformat())
    return S.read_table(spark, path).groupBy(F.date_format("part_date", "yyyy-MM-dd").alias("part_date")).agg(
        F.count(F.lit(1)).alias("n"))


@register("k8_view_and_table")
def k8_view_and_table(spark, sf_dir):
    """K8: staging as a view, alerts as a table built in full from the stored facts; both asked by SQL."""
    path = _scratch(spark, "alerts-table")
    K.materialize(_m(spark, sf_dir).stg_daily, "view", name="stg_daily_view")
    K.materialize(K.materialize(_w(spark, sf_dir).alerts, "table", path=path), "view", name="alerts_table")
    return spark.sql("SELECT s.location_id, count(*) AS n_days, count(a.alert_type) AS n_alerts FROM stg_daily_view s "
                     "LEFT JOIN alerts_table a ON a.location_id = s.location_id AND a.date = s.date GROUP BY s.location_id")


@register("k9_stored_failures")
def k9_stored_failures(spark, sf_dir):
    """K9: failing rows of the facts' row-level tests, tagged in one scan, stored in one folder per test and read back."""
    path = _scratch(spark, "failures")
    K.store_failures(Q.tagged_failures(_w(spark, sf_dir).facts, "daily_facts"), path)
    return spark.read.parquet(path).select("test", "location_id", F.date_format("date", "yyyy-MM-dd").alias("date"))


# ── merges on stored tables ──────────────────────────────────────────────────

def _stored_facts(spark, sf_dir, before: int) -> tuple[str, DataFrame]:
    """Facts of the raw history up to ``before`` days before its end as a stored table, and the whole raw history."""
    from .marts import Marts
    m = _m(spark, sf_dir)
    old = Marts(m.raw_daily.filter(F.col("date") < F.date_sub(max_date(m.raw_daily), before)), None, m.locations,
                m.daily_order, stamps=False)
    path = _scratch(spark, "facts-stored")
    S.replace_partitions(spark, path, layers.daily_facts_by_month(old.stg_daily, m.locations, updated_at=False), "year_month")
    return path, m.raw_daily


@register("u1_merge_stored")
def u1_merge_stored(spark, sf_dir):
    """U1 + U2 on stored tables: raw keeps its last 700 days only, the facts hold the history before; the increment (35 days back
    from the facts' end, halo from raw's monthly folders) is merged month by month."""
    m = _m(spark, sf_dir)
    path, raw = _stored_facts(spark, sf_dir, 200)
    raw_path = _scratch(spark, "raw-recent")
    recent = raw.filter(F.col("date") >= F.date_sub(max_date(raw), 700)).withColumn("part_month", F.date_format("date", "yyyy-MM"))
    S.replace_partitions(spark, raw_path, recent.hint("rebalance", "part_month"), "part_month")
    source = _staged_recent(S.read_table(spark, raw_path), m.daily_order)
    earliest = dt.date.fromisoformat(S.partitions(spark, raw_path, "part_month")[0] + "-01")
    inc = U.daily_increment(source, m.locations, S.read_table(spark, path), 35, updated_at=False, earliest=earliest)
    S.merge_table(spark, path, inc, "year_month")
    f = _facts_out(S.read_table(spark, path))
    return f.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def _staged_recent(raw: DataFrame, order) -> U.Staged:
    def source(lo, hi):
        out = raw
        if lo is not None:
            out = out.filter((F.col("date") >= F.lit(lo)) & (F.col("part_month") >= f"{lo:%Y-%m}"))
        if hi is not None:
            out = out.filter((F.col("date") < F.lit(hi)) & (F.col("part_month") <= f"{hi:%Y-%m}"))
        return layers.stg_daily(out.drop("part_month"), order, loaded_at=False)
    return source


@register("u5_schema_sync")
def u5_schema_sync(spark, sf_dir):
    """The increment's columns become the table's: a new one is NULL in untouched months, a dropped one is gone."""
    path = _scratch(spark, "facts-synced")
    f = _w(spark, sf_dir).facts.select("surrogate_key", "location_id", "date", "year_month", "temp_max_c", "rain_mm")
    f = f.withColumn("temp_max_c", F.col("temp_max_c").cast("double")).withColumn("rain_mm", F.col("rain_mm").cast("double"))
    S.replace_partitions(spark, path, f.sortWithinPartitions("year_month", "location_id", "date"), "year_month")  # the mart's files lie by month
    top = U.high_water_mark(f, "date")
    inc = f.filter(F.col("date") >= F.lit(top - dt.timedelta(days=35))).drop("rain_mm").withColumn(
        "is_hot", F.col("temp_max_c") > 30)
    S.merge_table(spark, path, inc, "year_month")
    out = S.read_table(spark, path)
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


# ── jobs ─────────────────────────────────────────────────────────────────────

def _latest_rows(raw: DataFrame, block: str, keys: list[str], order: list[Column]) -> DataFrame:
    """The latest row per key as landed, dealt once by location and period: grouping them to documents shuffles nothing again."""
    period = SJ.PERIOD[block]
    dealt = SJ.with_period(raw, block).repartition("location_id", period)
    rows = latest_per_key(dealt, [*keys, period], order).select(*ST.RAW_COLUMNS[block], period)
    return rows.withColumn("_extracted_at", F.lit(LANDED_AT).cast("timestamp"))


def _land_daily(spark, sf_dir, faulty: bool) -> str:
    """All daily and hourly rows, unique per key, as landed documents; some of the daily ones with faults."""
    m = _m(spark, sf_dir)
    raw_d = _latest_rows(m.raw_daily, "daily", ["location_id", "date"], bridge.daily_order())
    raw_h = _latest_rows(m.raw_hourly, "hourly", ["location_id", "timestamp"], bridge.hourly_order())
    landing = _scratch(spark, "landing-job")
    docs = SJ.to_documents_daily(raw_d)
    with shuffles_dropped(spark):
        if faulty:
            t = F.col("daily.time")[0]
            n = F.substring(t, 1, 4).cast("int") * 12 + F.substring(t, 6, 2).cast("int")
            _faulty(docs, "daily", "rain_sum", n).write.option("compression", "gzip").text(os.path.join(landing, "daily"))
        else:
            docs.write.option("compression", "gzip").json(os.path.join(landing, "daily"))
        SJ.to_documents_hourly(raw_h).write.option("compression", "gzip").json(os.path.join(landing, "hourly"))
    return landing


@register("t8_daily_job")
def t8_daily_job(spark, sf_dir):
    """Landed documents (some faulty) to raw, marts and checks; the facts' rows, and how many documents were rejected."""
    from .jobs import daily_job
    wh = _scratch(spark, "warehouse")
    daily_job(spark, os.path.join(_land_daily(spark, sf_dir, True), "*"), wh, _m(spark, sf_dir).locations, "1990-01-01", None,
              F.lit(LANDED_AT).cast("timestamp"), raw_daily_grain="month")
    f = S.read_table(spark, f"{wh}/marts/daily_facts")
    bad = spark.read.parquet(f"{wh}/raw/rejects")
    return f.select("location_id", F.date_format("date", "yyyy-MM-dd").alias("date"), F.col("temp_max_c").cast("double").alias("value"),
                    ).unionByName(bad.groupBy("reason").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
                        F.lit("rejected").alias("location_id"), F.col("reason").alias("date"), "value"))


@register("u7_backfill")
def u7_backfill(spark, sf_dir):
    """Half of the locations loaded with truncation, then a backfill of all that skips those already loaded."""
    from .jobs import backfill, ingest
    m, wh, stamp = _m(spark, sf_dir), _scratch(spark, "warehouse"), F.lit(LANDED_AT).cast("timestamp")
    landing = _land_daily(spark, sf_dir, False)
    keep = m.locations.filter(F.col("location_id").cast("int") % 2 == 0).select("location_id")
    docs = SJ.read_documents(spark, os.path.join(landing, "*")).drop(SJ.CORRUPT)
    half = _scratch(spark, "landing-half")
    docs.join(bounded_broadcast(keep), "location_id").write.option("compression", "gzip").json(os.path.join(half, "d"))
    start = m.raw_daily.agg(F.min("date")).first()[0].isoformat()
    ingest(spark, SJ.read_documents(spark, os.path.join(half, "*")), wh, start, None, stamp, True, "month")
    later = stamp + F.make_dt_interval(F.lit(0), F.lit(1))
    backfill(spark, os.path.join(landing, "*"), wh, m.locations, start, None, later, "month", skip_loaded=True)
    raw = S.read_table(spark, f"{wh}/raw/daily")
    return raw.groupBy("location_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_extracted_at").alias("n_loads"),
                                          F.max(F.hour("_extracted_at")).cast("int").alias("load_hour"))


@register("o5_freshness_order")
def o5_freshness_order(spark, sf_dir):
    """Age in days of every location's newest hourly row, unknown ages first; the place in that order."""
    m = _m(spark, sf_dir)
    raw = m.raw_hourly
    last = raw.groupBy("location_id").agg(F.max(F.to_date("timestamp")).alias("last_day"))
    age = F.datediff(max_date(raw, "timestamp").cast("date"), F.col("last_day"))
    j = m.locations.select("location_id").join(last, "location_id", "left").select("location_id", age.alias("age_days"))
    return sort_nulls_first(j, "age_days")
