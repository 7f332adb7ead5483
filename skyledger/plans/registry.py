"""Registered queries over the driver's test tables, one per inventory item.

Keys are the inventory ID plus a short name.  Every query reads the whole
tables through the bridge; parameters are the fixed ones of the bridge
(city, mesoregion) and the report defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import to_double
from ..session import session_key
from . import reports as R
from .bridge import CITY, MESO
from .marts import from_test_tables

CITIES = ["Supplier#000000001", "Supplier#000000002", "Supplier#000000003"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


_chains: dict[tuple, object] = {}


def _m(spark, sf_dir):
    """The lazily composed mart chain over the test tables (layer / build queries).

    DataFrames are immutable plans, so one composed chain per session and input
    directory is reused by every query (plan construction is paid once).
    """
    k = (*session_key(spark), sf_dir)
    if k not in _chains:
        _chains[k] = from_test_tables(spark, sf_dir, stamps=False)
    return _chains[k]


def _w(spark, sf_dir):
    """The materialised marts over the test tables (report queries read these)."""
    from .warehouse import stored
    inputs = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("lineitem", "events", "supplier", "nation", "region")]
    return stored(spark, _m(spark, sf_dir), sf_dir.strip("/").replace("/", "_"), inputs)


@register("t1_stg_daily")
def t1_stg_daily(spark, sf_dir):
    return to_double(_m(spark, sf_dir).stg_daily.drop("latitude", "longitude"))


@register("t3_daily_enriched")
def t3_daily_enriched(spark, sf_dir):
    e = _m(spark, sf_dir).enriched
    return to_double(e.select("location_id", "date", "city_name", "mesoregion", "latitude", "longitude",
                              "temp_avg_c", "daylight_hours", "temp_avg_30d_c", "precip_avg_30d_mm"))


@register("t3_daily_enriched_split")
def t3_daily_enriched_split(spark, sf_dir):
    """T3 with the skew-splitting rolling means (yearly blocks per location)."""
    from .layers import daily_enriched
    m = _m(spark, sf_dir)
    e = daily_enriched(m.stg_daily, m.locations, split=True)
    return to_double(e.select("location_id", "date", "city_name", "mesoregion", "latitude", "longitude",
                              "temp_avg_c", "daylight_hours", "temp_avg_30d_c", "precip_avg_30d_mm"))


@register("t4_daily_facts")
def t4_daily_facts(spark, sf_dir):
    f = _m(spark, sf_dir).facts
    return to_double(f.drop("sunrise_at", "sunset_at", "_extracted_at"))


@register("t6_alerts")
def t6_alerts(spark, sf_dir):
    return to_double(_m(spark, sf_dir).alerts)


@register("a3_temp_trend")
def a3_temp_trend(spark, sf_dir):
    return R.temp_trend(_w(spark, sf_dir).facts, 30)


@register("t2_stg_hourly")
def t2_stg_hourly(spark, sf_dir):
    return to_double(_m(spark, sf_dir).stg_hourly)


@register("t5_hourly_facts")
def t5_hourly_facts(spark, sf_dir):
    return to_double(_m(spark, sf_dir).hourly_facts)


# ── reports over the daily facts / alerts ────────────────────────────────────

@register("a1_home_kpis")
def a1_home_kpis(spark, sf_dir):
    return R.home_kpis(_w(spark, sf_dir).facts, 7)


@register("a1_home_kpis_meso")
def a1_home_kpis_meso(spark, sf_dir):
    return R.home_kpis(_w(spark, sf_dir).facts, 7, MESO)


@register("a2_alert_count")
def a2_alert_count(spark, sf_dir):
    return R.alert_count(_w(spark, sf_dir).alerts, 7)


@register("a3_temp_trend_meso")
def a3_temp_trend_meso(spark, sf_dir):
    return R.temp_trend(_w(spark, sf_dir).facts, 90, MESO)


@register("a4_hottest")
def a4_hottest(spark, sf_dir):
    return R.hottest(_w(spark, sf_dir).facts, 7, 10)


@register("a5_coldest")
def a5_coldest(spark, sf_dir):
    return R.coldest(_w(spark, sf_dir).facts, 7, 10)


@register("a6_meso_temp")
def a6_meso_temp(spark, sf_dir):
    return R.meso_temp(_w(spark, sf_dir).facts, 30)


@register("a7_meso_anomaly")
def a7_meso_anomaly(spark, sf_dir):
    return R.meso_anomaly(_w(spark, sf_dir).facts, 30)


@register("a8_rain_ranking")
def a8_rain_ranking(spark, sf_dir):
    return R.rain_ranking(_w(spark, sf_dir).facts, 30)


@register("a8_rain_ranking_meso")
def a8_rain_ranking_meso(spark, sf_dir):
    return R.rain_ranking(_w(spark, sf_dir).facts, 30, MESO)


@register("a9_rain_classes")
def a9_rain_classes(spark, sf_dir):
    return R.rain_classes(_w(spark, sf_dir).facts, 30)


@register("a10_meso_rain")
def a10_meso_rain(spark, sf_dir):
    return R.meso_rain(_w(spark, sf_dir).facts, 30)


@register("a11_severity_kpis")
def a11_severity_kpis(spark, sf_dir):
    return R.severity_kpis(_w(spark, sf_dir).alerts, 30)


@register("a11_severity_kpis_filtered")
def a11_severity_kpis_filtered(spark, sf_dir):
    return R.severity_kpis(_w(spark, sf_dir).alerts, 60, MESO, "high")


@register("a12_alerts_by_type")
def a12_alerts_by_type(spark, sf_dir):
    return R.alerts_by_type(_w(spark, sf_dir).alerts, 30)


@register("a13_affected_cities")
def a13_affected_cities(spark, sf_dir):
    return R.affected_cities(_w(spark, sf_dir).alerts, 30)


@register("a15_city_summary")
def a15_city_summary(spark, sf_dir):
    return R.city_summary(_w(spark, sf_dir).facts, CITY, 90)


@register("a16_city_rain")
def a16_city_rain(spark, sf_dir):
    return R.city_rain(_w(spark, sf_dir).facts, CITY, 90)


@register("a17_city_compare")
def a17_city_compare(spark, sf_dir):
    return R.city_compare(_w(spark, sf_dir).facts, CITIES, "temp_max_c", 30)


@register("a18_city_date_rain")
def a18_city_date_rain(spark, sf_dir):
    return R.city_date_rain(_w(spark, sf_dir).facts, MESO, 30)


@register("a22_pivot_anomaly")
def a22_pivot_anomaly(spark, sf_dir):
    return R.pivot_anomaly(_w(spark, sf_dir).facts, 30)


@register("a23_pivot_meso_rain")
def a23_pivot_meso_rain(spark, sf_dir):
    return R.pivot_meso_rain(_w(spark, sf_dir).facts, 30)


@register("a24_pivot_city_rain")
def a24_pivot_city_rain(spark, sf_dir):
    return R.pivot_city_rain(_w(spark, sf_dir).facts, MESO, 30)


@register("a25_max_dates")
def a25_max_dates(spark, sf_dir):
    m = _w(spark, sf_dir)
    return R.max_dates(m.facts, m.alerts, m.hourly_facts)


@register("a25_max_date_per_city")
def a25_max_date_per_city(spark, sf_dir):
    return R.max_date_per_city(_w(spark, sf_dir).hourly_facts)


@register("a26_row_and_location_counts")
def a26_row_and_location_counts(spark, sf_dir):
    m = _m(spark, sf_dir)
    return R.row_and_location_counts(m.raw_daily, m.raw_hourly)


@register("a27_rows_per_location")
def a27_rows_per_location(spark, sf_dir):
    return R.rows_per_location(_m(spark, sf_dir).raw_daily)


@register("a28_spatial_summary")
def a28_spatial_summary(spark, sf_dir):
    return R.spatial_summary(_w(spark, sf_dir).facts, MESO)


@register("w5_previous_date")
def w5_previous_date(spark, sf_dir):
    return R.previous_dates(_w(spark, sf_dir).facts)


@register("w6_latest_per_location")
def w6_latest_per_location(spark, sf_dir):
    return R.latest_per_location(_w(spark, sf_dir).facts)


@register("o2_sort_alerts")
def o2_sort_alerts(spark, sf_dir):
    return to_double(R.sort_alerts(_w(spark, sf_dir).alerts))


@register("o3_recent_alerts")
def o3_recent_alerts(spark, sf_dir):
    return R.recent_alerts(_w(spark, sf_dir).alerts, 30)


@register("o4_city_alerts")
def o4_city_alerts(spark, sf_dir):
    return R.city_alerts(_w(spark, sf_dir).alerts, CITY, 90)


@register("o6_distinct_mesoregions")
def o6_distinct_mesoregions(spark, sf_dir):
    from ..operators.ordering import distinct_values
    return distinct_values(_w(spark, sf_dir).locations, "mesoregion", not_null=True)


@register("o6_latest_city_dates")
def o6_latest_city_dates(spark, sf_dir):
    from ..operators.ordering import distinct_values
    h = _w(spark, sf_dir).hourly_facts
    return distinct_values(h.filter(F.col("city_name") == CITY), "date", n=60, descending=True)


@register("o7_location_catalogue")
def o7_location_catalogue(spark, sf_dir):
    return R.location_catalogue(_w(spark, sf_dir).locations)


@register("p7_city_series")
def p7_city_series(spark, sf_dir):
    return R.city_series(_w(spark, sf_dir).facts, CITIES, "temp_max_c", 30)


@register("p12_city_window")
def p12_city_window(spark, sf_dir):
    return R.city_window(_w(spark, sf_dir).hourly_facts, CITY, 7)


@register("p12_city_period")
def p12_city_period(spark, sf_dir):
    f = R.city_period(_w(spark, sf_dir).facts, CITY, 90)
    return to_double(f.select("date", "temp_max_c", "temp_min_c", "temp_avg_c", "temp_anomaly_c",
                              "precipitation_mm", "precipitation_class", "wind_speed_max_kmh",
                              "uv_index_max", "uv_risk_level"))


# ── reports over the hourly facts ────────────────────────────────────────────

@register("a14_hour_profile")
def a14_hour_profile(spark, sf_dir):
    return R.hour_profile(_w(spark, sf_dir).hourly_facts, CITY, 7)


@register("a19_day_profile")
def a19_day_profile(spark, sf_dir):
    return R.day_profile(_w(spark, sf_dir).hourly_facts, CITY)


@register("a20_prior_profile")
def a20_prior_profile(spark, sf_dir):
    return R.prior_profile(_w(spark, sf_dir).hourly_facts, CITY)


@register("j6_compare_profiles")
def j6_compare_profiles(spark, sf_dir):
    return R.compare_profiles(_w(spark, sf_dir).hourly_facts, CITY)


@register("a21_day_vs_history")
def a21_day_vs_history(spark, sf_dir):
    return R.day_vs_history(_w(spark, sf_dir).hourly_facts, CITY)


# ── calendar ─────────────────────────────────────────────────────────────────

def _data_span_spine(spark, sf_dir):
    from .layers import date_spine
    from ..operators.filters import max_date
    raw = _m(spark, sf_dir).raw_daily
    start = raw.select(F.min("date")).scalar()
    return date_spine(spark, start, max_date(raw))


@register("g1_date_spine")
def g1_date_spine(spark, sf_dir):
    """G1: every day between the first and last observed date."""
    return _data_span_spine(spark, sf_dir)


@register("g2_calendar")
def g2_calendar(spark, sf_dir):
    """Calendar dimension over the observed period."""
    from .layers import calendar
    return calendar(_data_span_spine(spark, sf_dir)).orderBy("dt_data")


# ── data quality ─────────────────────────────────────────────────────────────

from ..operators import quality as Q  # noqa: E402


@register("d1_not_null_city")
def d1_not_null_city(spark, sf_dir):
    """D1 on the hourly facts' city_name (observations without a dimension row)."""
    return Q.not_null(_w(spark, sf_dir).hourly_facts, "city_name").select("location_id", "observed_at")


@register("d2_unique_surrogate_key")
def d2_unique_surrogate_key(spark, sf_dir):
    return Q.unique(_w(spark, sf_dir).facts, "surrogate_key")


@register("d3_accepted_mesoregion")
def d3_accepted_mesoregion(spark, sf_dir):
    vals = dict((t[1], t[2]) for t in Q.SUITES["locations"] if t[0] == "accepted_values")["mesoregion"]
    return Q.accepted_values(_w(spark, sf_dir).locations, "mesoregion", vals).select("location_id", "mesoregion")


@register("d4_accepted_range_anomaly")
def d4_accepted_range_anomaly(spark, sf_dir):
    f = Q.accepted_range(_w(spark, sf_dir).facts, "temp_anomaly_c", -25, 25)
    return to_double(f.select("location_id", "date", "temp_anomaly_c"))


@register("d5_unique_key_raw")
def d5_unique_key_raw(spark, sf_dir):
    return Q.unique_key(_m(spark, sf_dir).raw_daily, "location_id", "date")


@register("d6_min_above_max")
def d6_min_above_max(spark, sf_dir):
    f = Q.expression(_w(spark, sf_dir).facts, F.col("temp_min_c") > F.col("temp_max_c"))
    return to_double(f.select("location_id", "date", "temp_min_c", "temp_max_c"))


@register("d7_date_gaps")
def d7_date_gaps(spark, sf_dir):
    from ..operators.filters import max_date
    f = _w(spark, sf_dir).facts
    return Q.date_gaps(f, max_date(f), 30)


def _as_of(m):
    return m.raw_daily.select(F.max("_extracted_at")).scalar()


@register("d8_location_freshness")
def d8_location_freshness(spark, sf_dir):
    m = _m(spark, sf_dir)
    return Q.location_freshness(m.locations, m.raw_daily, _as_of(m), 25)


@register("d9_relationship_alerts")
def d9_relationship_alerts(spark, sf_dir):
    m = _w(spark, sf_dir)
    return Q.relationship(m.alerts, m.locations).select("location_id", "date", "alert_type")


@register("j3_orphans_hourly")
def j3_orphans_hourly(spark, sf_dir):
    from ..operators.joins import orphans
    m = _m(spark, sf_dir)
    return orphans(m.stg_hourly, m.locations).select("location_id", "observed_at")


@register("d10_source_freshness")
def d10_source_freshness(spark, sf_dir):
    m = _m(spark, sf_dir)
    return Q.source_freshness(m.raw_daily, _as_of(m), 25, 49)


@register("d11_recent_load")
def d11_recent_load(spark, sf_dir):
    m = _m(spark, sf_dir)
    return Q.recent_load(m.raw_daily, _as_of(m), 7)


@register("d12_incomplete_daily")
def d12_incomplete_daily(spark, sf_dir):
    return Q.incomplete(_m(spark, sf_dir).raw_daily, 1931)


@register("d13_count_mismatch_hourly")
def d13_count_mismatch_hourly(spark, sf_dir):
    return Q.count_mismatch(_m(spark, sf_dir).raw_hourly, 20064)


@register("d14_incomplete_calendar")
def d14_incomplete_calendar(spark, sf_dir):
    from ..operators.filters import max_date
    raw = _m(spark, sf_dir).raw_daily
    start = raw.select(F.min("date")).scalar()
    return Q.incomplete_calendar(raw, start, F.date_add(max_date(raw), 1))


@register("d15_complete_locations")
def d15_complete_locations(spark, sf_dir):
    return Q.complete_locations(_m(spark, sf_dir).raw_hourly, 20016)


def _hours(n: int):
    return F.make_dt_interval(F.lit(0), F.lit(n))


@register("d2_unique_extraction")
def d2_unique_extraction(spark, sf_dir):
    """D2 where it fails: extraction instants shared by several raw rows."""
    return Q.unique(_m(spark, sf_dir).raw_daily, "_extracted_at")


@register("d6_narrow_day")
def d6_narrow_day(spark, sf_dir):
    """D6 with failing and passing rows: days whose span is under five degrees."""
    f = Q.expression(_w(spark, sf_dir).facts, F.col("temp_min_c") + 5 > F.col("temp_max_c"))
    return to_double(f.select("location_id", "date", "temp_min_c", "temp_max_c"))


@register("d8_location_freshness_week")
def d8_location_freshness_week(spark, sf_dir):
    """D8/J4 on the table's last seven days: locations without a row, stale and fresh ones."""
    from ..operators.filters import max_date
    m = _m(spark, sf_dir)
    week = m.raw_daily.filter(F.col("date") > F.date_sub(max_date(m.raw_daily), 7))
    return Q.location_freshness(m.locations, week, _as_of(m), 5)


@register("d9_relationship_region")
def d9_relationship_region(spark, sf_dir):
    """D9 against the locations of one region: alerts of the others fail."""
    m = _w(spark, sf_dir)
    parent = m.locations.filter(F.col("mesoregion") == MESO)
    return Q.relationship(m.alerts, parent).select("location_id", "date", "alert_type")


@register("j5_members_region")
def j5_members_region(spark, sf_dir):
    """Hourly observations of one region's locations."""
    from ..operators.joins import members
    m = _m(spark, sf_dir)
    return members(m.stg_hourly, m.locations.filter(F.col("mesoregion") == MESO)).select("location_id", "observed_at")


@register("d10_source_freshness_late")
def d10_source_freshness_late(spark, sf_dir):
    """D10 asked 25, 30 and 60 hours after the newest load: pass at the threshold, warn, error."""
    m = _m(spark, sf_dir)
    at = [Q.source_freshness(m.raw_daily, _as_of(m) + _hours(h), 25, 49) for h in (25, 30, 60)]
    return at[0].unionByName(at[1]).unionByName(at[2])


@register("d11_recent_load_late")
def d11_recent_load_late(spark, sf_dir):
    """D11 for the hour before the newest load (a part of the rows) and asked eight hours after it (none)."""
    m = _m(spark, sf_dir)
    return Q.recent_load(m.raw_daily, _as_of(m), 1).unionByName(Q.recent_load(m.raw_daily, _as_of(m) + _hours(8), 7))


@register("d15_complete_locations_daily")
def d15_complete_locations_daily(spark, sf_dir):
    """D15 where about half of the locations are complete."""
    return Q.complete_locations(_m(spark, sf_dir).raw_daily, 600)


@register("d16_run_suite")
def d16_run_suite(spark, sf_dir):
    from ..operators.filters import max_date
    from .layers import calendar
    m = _w(spark, sf_dir)
    tables = {"raw_daily": m.raw_daily, "raw_hourly": m.raw_hourly, "stg_daily": m.stg_daily,
              "stg_hourly": m.stg_hourly, "daily_enriched": m.enriched, "daily_facts": m.facts,
              "alerts": m.alerts, "hourly_facts": m.hourly_facts, "locations": m.locations,
              "calendar": calendar(_data_span_spine(spark, sf_dir))}
    singular = Q.singular_tests(m.facts, m.alerts, m.raw_daily, m.locations, max_date(m.facts), _as_of(m))
    return Q.run_suite(tables, metrics=m.metrics(), sized_as=m.sized_as(), singular=singular)


# ── sources ──────────────────────────────────────────────────────────────────

from ..sources import api_json as SJ  # noqa: E402
from ..sources import tables as ST  # noqa: E402

LANDED_AT = "2024-02-01 00:00:00"


def _hourly_docs(m):
    return SJ.to_documents_hourly(ST.select_raw_columns(m.raw_hourly, "hourly"), ["timestamp", "_extracted_at"])


@register("s1_flatten_hourly")
def s1_flatten_hourly(spark, sf_dir):
    """S1+S3: hourly documents (one per location and day) flattened back to rows."""
    return SJ.flatten_hourly(_hourly_docs(_m(spark, sf_dir)), LANDED_AT)


@register("s2_flatten_daily")
def s2_flatten_daily(spark, sf_dir):
    """S2+S3: daily documents (one per location and month) flattened back to rows."""
    m = _m(spark, sf_dir)
    docs = SJ.to_documents_daily(ST.select_raw_columns(m.raw_daily, "daily"), ["date", "_extracted_at"])
    return SJ.flatten_daily(docs, LANDED_AT)


@register("s6_read_new")
def s6_read_new(spark, sf_dir):
    """Rows above the high-water mark of a target holding the older history."""
    from ..operators.filters import max_date
    raw = _m(spark, sf_dir).raw_daily
    target = raw.filter(F.col("date") < F.date_sub(max_date(raw), 365))
    return ST.read_new(raw, target).select("location_id", "date", "_extracted_at")


@register("s8_to_wire")
def s8_to_wire(spark, sf_dir):
    """S7+S8: declared raw columns, serialised for the wire."""
    return ST.to_wire(ST.select_raw_columns(_m(spark, sf_dir).raw_daily, "daily"))


# ── sinks / maintenance / incremental ────────────────────────────────────────

from ..operators import incremental as U  # noqa: E402
from ..sinks import tables as K  # noqa: E402


@register("k2_reload_window")
def k2_reload_window(spark, sf_dir):
    """K2: the last 30 days re-extracted one hour after the newest load."""
    from ..operators.filters import max_date
    raw = ST.select_raw_columns(_m(spark, sf_dir).raw_daily, "daily")
    start = F.date_sub(max_date(raw), 30)
    stamp = max_date(raw, "_extracted_at") + F.make_dt_interval(F.lit(0), F.lit(1))
    new = raw.filter(F.col("date") >= start).withColumn("_extracted_at", stamp)
    return K.reload_window(raw, new, start)


@register("k3_upsert_raw_hourly")
def k3_upsert_raw_hourly(spark, sf_dir):
    """K3: overlapping re-extraction; measures update, coordinates keep the stored value."""
    from ..operators.dedup import latest_per_key
    from ..operators.filters import max_date
    raw = ST.select_raw_columns(_m(spark, sf_dir).raw_hourly, "hourly")
    top = max_date(raw, "timestamp")
    keys = ["location_id", "timestamp"]
    target = latest_per_key(raw.filter(F.col("timestamp") < top - F.make_dt_interval(F.lit(3))), keys)
    new = latest_per_key(raw.filter(F.col("timestamp") >= top - F.make_dt_interval(F.lit(5))), keys)
    new = (new.withColumn("latitude", F.col("latitude") + 1.0)
              .withColumn("temperature_2m", F.col("temperature_2m") + 1.0))
    return K.upsert_raw_hourly(target, new)


@register("k6_expire_partitions")
def k6_expire_partitions(spark, sf_dir):
    """K6: hourly rows inside the 450-day retention of the newest hour."""
    from ..operators.filters import max_date
    raw = _m(spark, sf_dir).raw_hourly
    return K.expire_partitions(raw, 450, max_date(raw, "timestamp")).select("location_id", "timestamp")


def _facts_out(f):
    return to_double(f.drop("sunrise_at", "sunset_at", "_extracted_at"))


@register("u1_merge_upsert")
def u1_merge_upsert(spark, sf_dir):
    """U1+U2+U4: facts of an older history merged with a 35-day incremental run == full rebuild."""
    from ..operators.filters import max_date
    from .marts import Marts
    m = _m(spark, sf_dir)
    old_raw = m.raw_daily.filter(F.col("date") < F.date_sub(max_date(m.raw_daily), 200))
    old = Marts(old_raw, None, m.locations, m.daily_order, stamps=False)
    target = U.materialize(old.facts)          # the existing mart table
    merged = U.incremental_daily_facts(m.stg_daily, m.locations, target, 35, updated_at=False)
    return _facts_out(merged)


@register("u3_hourly_incremental")
def u3_hourly_incremental(spark, sf_dir):
    """U1+U3: hourly facts of older hours merged with a 4-day incremental run == full rebuild."""
    from ..operators.filters import max_date
    from .marts import Marts
    m = _m(spark, sf_dir)
    top = max_date(m.raw_hourly, "timestamp")
    old_raw = m.raw_hourly.filter(F.col("timestamp") < top - F.make_dt_interval(F.lit(10)))
    old = Marts(m.raw_daily, old_raw, m.locations, m.daily_order, m.hourly_order, stamps=False)
    target = U.materialize(old.hourly_facts)   # the existing mart table
    merged = U.incremental_hourly_facts(m.stg_hourly, m.locations, target, 4, updated_at=False)
    return to_double(merged)


@register("u6_missing_locations")
def u6_missing_locations(spark, sf_dir):
    """Locations without a row in the first 7 days of the period."""
    m = _m(spark, sf_dir)
    start = m.raw_daily.select(F.min("date")).scalar()
    return U.missing_locations(m.locations, m.raw_daily, start, 7).select("location_id", "city_name")


# ── streaming ────────────────────────────────────────────────────────────────

def _scratch(spark, name):
    import uuid
    from ..session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("st1_stream_ingest")
def st1_stream_ingest(spark, sf_dir):
    """ST1: hourly documents landed as JSON, ingested by an availableNow file stream."""
    from ..streaming.ingest import stream_ingest
    landing, sink = _scratch(spark, "landing-json"), _scratch(spark, "raw-hourly")
    _hourly_docs(_m(spark, sf_dir)).write.mode("overwrite").json(landing)
    q = stream_ingest(spark, landing, sink, _scratch(spark, "ckpt"), "hourly",
                      F.lit(LANDED_AT).cast("timestamp"))
    q.awaitTermination()
    return spark.read.parquet(sink).drop("part_date")


def _land_raw_hourly(spark, sf_dir):
    """Raw hourly rows as landed files, as many as there are tasks, and how many files make a third of them."""
    landing = _scratch(spark, "landing-parquet")
    raw = ST.select_raw_columns(_m(spark, sf_dir).raw_hourly, "hourly")
    raw.withColumn("part_date", F.to_date("timestamp")).write.parquet(landing)
    n_files = len(spark.read.parquet(landing).inputFiles())
    return landing, raw.schema.add("part_date", "date"), -(-n_files // 3)


@register("st2_stream_upsert")
def st2_stream_upsert(spark, sf_dir):
    """ST2: micro-batches upserted by key (latest extraction wins) == batch dedup."""
    from ..streaming.ingest import read_landing, stream_upsert
    landing, schema, third = _land_raw_hourly(spark, sf_dir)
    target = _scratch(spark, "raw-hourly-upserted")
    stream = read_landing(spark, landing, "parquet", schema, max_files_per_trigger=third)
    q = stream_upsert(stream, target, ["location_id", "timestamp"], [F.col("_extracted_at").desc()],
                      _scratch(spark, "ckpt"))
    q.awaitTermination()
    return spark.read.parquet(target).drop("part_date")


@register("st4_stream_dedup")
def st4_stream_dedup(spark, sf_dir):
    """ST3+ST4: watermarked stream dedup of re-sent observations; the key set equals the batch one.

    The landed files are not in event-time order, so they are read in one
    trigger; across triggers rows older than the 4-day watermark are dropped
    as late, by design.
    """
    from ..streaming.ingest import read_landing, stream_dedup
    landing, schema, _ = _land_raw_hourly(spark, sf_dir)
    sink = _scratch(spark, "dedup")
    s = stream_dedup(read_landing(spark, landing, "parquet", schema), ["location_id", "timestamp"],
                     "timestamp", 4)
    q = (s.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", _scratch(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink).select("location_id", "timestamp")


@register("f6_f7_conversions")
def f6_f7_conversions(spark, sf_dir):
    """F6/F7 (defined, not called by the source's models): Beaufort force and Fahrenheit per hour."""
    from .. import functions as SF
    h = _w(spark, sf_dir).hourly_facts
    return h.select("location_id", "observed_at", SF.beaufort("wind_speed_kmh").alias("beaufort"),
                    SF.c_to_f("temperature_c").cast("double").alias("temperature_f"))


from . import registry_stored  # noqa: E402, F401  (registers its queries)
