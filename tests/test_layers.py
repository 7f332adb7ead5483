"""Layer properties: dedup, rolling window, incremental == full, merge, pivot."""

import datetime as dt
import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.operators.dedup import latest_per_key
from skyledger.operators.incremental import incremental_daily_facts, merge_upsert
from skyledger.operators.windows import rolling_mean
from skyledger.plans import layers
from skyledger.schemas import RAW_DAILY

D0 = dt.date(2024, 1, 1)


def raw_rows(n_loc=3, n_days=80, seed=1):
    rnd = random.Random(seed)
    rows = []
    for loc in range(n_loc):
        for d in range(n_days):
            if rnd.random() < 0.25:        # gaps
                continue
            for copy in range(rnd.choice([1, 1, 2])):  # re-sent extractions
                tmax = float(rnd.randint(10, 45))
                rain = None if rnd.random() < 0.1 else float(rnd.randint(0, 120))
                day = D0 + dt.timedelta(days=d)
                rows.append((str(loc), day, -27.0, -50.0, tmax, tmax - rnd.randint(0, 12), rain, rain,
                             float(rnd.randint(0, 100)),
                             dt.datetime.combine(day, dt.time(5, 10)), dt.datetime.combine(day, dt.time(18, 40)),
                             float(rnd.randint(0, 12)), dt.datetime(2024, 6, 1, copy, rnd.randint(0, 59))))
    return rows


def locations(spark, n_loc=3):
    return spark.createDataFrame(
        [(str(i), f"City {i}", "SC", "SC", "Brasil", "Sul", "Serrana", -27.5, -50.5, 900.0, "small")
         for i in range(n_loc)],
        "location_id string, city_name string, state_name string, state_code string, country string, "
        "region string, mesoregion string, latitude double, longitude double, altitude_m double, "
        "population_class string")


def test_dedup_keeps_latest(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 30), ("a", 2, 5), (None, 1, 99)], "k string, d int, _extracted_at int")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k", "d"]).collect())
    assert got == [("a", 1, 30), ("a", 2, 5)]


@settings(max_examples=5, deadline=None)
@given(st.randoms())
def test_dedup_invariant_to_input_order(spark, rnd):
    rows = raw_rows(2, 30, seed=3)
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    a = layers.stg_daily(spark.createDataFrame(rows, RAW_DAILY), loaded_at=False)
    b = layers.stg_daily(spark.createDataFrame(shuffled, RAW_DAILY), loaded_at=False)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_rolling_mean_matches_bruteforce(spark):
    stg = layers.stg_daily(spark.createDataFrame(raw_rows(), RAW_DAILY), loaded_at=False)
    got = rolling_mean(stg, {"m": "precipitation_mm"}).select("location_id", "date", F.col("m").cast("double").alias("m")).toPandas()
    pdf = stg.select("location_id", "date", F.col("precipitation_mm").cast("double").alias("p")).toPandas()
    pdf = pdf.sort_values(["location_id", "date"])
    pdf["want"] = pdf.groupby("location_id")["p"].transform(lambda s: s.rolling(30, min_periods=1).mean())
    m = got.merge(pdf, on=["location_id", "date"])
    assert len(m) == len(pdf)
    both_null = m["m"].isna() & m["want"].isna()
    assert (both_null | ((m["m"] - m["want"]).abs() < 1e-9)).all()


def test_incremental_equals_full_rebuild(spark):
    raw = spark.createDataFrame(raw_rows(3, 120, seed=7), RAW_DAILY)
    loc = locations(spark)
    stg_all = layers.stg_daily(raw, loaded_at=False)
    full = incremental_daily_facts(stg_all, loc, None, updated_at=False)
    old = incremental_daily_facts(layers.stg_daily(raw.filter(F.col("date") < dt.date(2024, 2, 20)),
                                                   loaded_at=False), loc, None, updated_at=False)
    inc = incremental_daily_facts(stg_all, loc, old, 35, updated_at=False)
    assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, full.collect()))


def test_merge_upsert_idempotent_and_key_unique(spark):
    t = spark.createDataFrame([("k1", 1), ("k2", 2)], "surrogate_key string, v int")
    s = spark.createDataFrame([("k2", 20), ("k3", 30)], "surrogate_key string, v int")
    once = merge_upsert(t, s)
    twice = merge_upsert(once, s)
    assert sorted(map(tuple, once.collect())) == [("k1", 1), ("k2", 20), ("k3", 30)]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    s2 = spark.createDataFrame([("k1", 10, "x")], "surrogate_key string, v int, extra string")
    synced = merge_upsert(once, s2)
    assert synced.columns == ["surrogate_key", "v", "extra"]
    assert sorted(map(tuple, synced.collect())) == [("k1", 10, "x"), ("k2", 20, None), ("k3", 30, None)]


def test_pivot_sum_equals_group_sum(spark):
    from skyledger.plans import reports as R
    raw = spark.createDataFrame(raw_rows(3, 60, seed=11), RAW_DAILY)
    facts = incremental_daily_facts(layers.stg_daily(raw, loaded_at=False), locations(spark), None,
                                    updated_at=False)
    p = R.pivot_city_rain(facts, "Serrana", 30).toPandas().set_index("city_name")
    g = R.city_date_rain(facts, "Serrana", 30).toPandas()
    assert abs(p.sum().sum() - g["precipitation_mm"].fillna(0).sum()) < 1e-6


def test_calendar(spark):
    from skyledger.plans.layers import calendar, date_spine
    cal = calendar(date_spine(spark, "2024-01-01", "2030-12-31")).toPandas()
    assert len(cal) == 2557
    r = cal.set_index("dt_data").loc[dt.date(2024, 2, 29)]
    assert r["nm_mes"] == "Fevereiro" and r["estacao"] == "Verão" and r["dt_data_ano_anterior"] == dt.date(2023, 2, 28)
    assert r["ultimo_dia_trimestre"] == dt.date(2024, 3, 31) and r["sigla_trimestre"] == "Q1"
    jan1 = cal.set_index("dt_data").loc[dt.date(2023 + 1, 1, 1)]
    assert jan1["semana_ano"] == 0 and jan1["dia_semana_num"] == 1
    assert pd.Series(cal["dt_data"]).is_unique


def test_rolling_mean_split_equals_single_partition(spark):
    from skyledger.operators.windows import rolling_mean_split
    stg = layers.stg_daily(spark.createDataFrame(raw_rows(3, 800, seed=5), RAW_DAILY), loaded_at=False)
    spec = {"t": "temp_avg_c", "p": "precipitation_mm"}
    a = rolling_mean(stg, spec).select("location_id", "date", "t", "p")
    b = rolling_mean_split(stg, spec).select("location_id", "date", "t", "p")
    assert b.count() == stg.count()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_rolling_mean_split_hot_and_sparse_series(spark):
    """A hot key of 40 years, and keys whose blocks hold fewer rows than the frame reaches back; one join."""
    from decimal import Decimal

    from skyledger.operators.windows import rolling_mean_split
    rng = random.Random(8)
    start = dt.date(1980, 1, 1)
    rows = [("hot", start + dt.timedelta(i), Decimal(rng.randint(-300, 600)) / 20) for i in range(40 * 365)]
    for k in range(3):
        rows += [(f"sparse{k}", start + dt.timedelta(i), None if rng.random() < 0.1 else Decimal(rng.randint(-300, 600)) / 20)
                 for i in sorted(rng.sample(range(40 * 365), 60 + 100 * k))]
    df = spark.createDataFrame(rows, "location_id string, date date, v decimal(18,9)")
    plain = rolling_mean(df, {"m": "v"})
    for block in (F.year, lambda c: F.date_trunc("month", c)):
        split = rolling_mean_split(df, {"m": "v"}, block=block)
        assert split.columns == plain.columns and sorted(map(tuple, split.collect()), key=str) == sorted(
            map(tuple, plain.collect()), key=str)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1   # the row counts only


def test_anomaly_rounds_in_decimal(spark):
    """Means to nine places and anomalies to two, both half away from zero, on values with decimals."""
    import random
    from datetime import date, timedelta
    from decimal import ROUND_HALF_UP, Decimal

    from skyledger.plans.layers import _anomaly

    rng = random.Random(3)
    rows = [(f"k{k}", date(2023, 1, 1) + timedelta(i),
             None if rng.random() < 0.05 else Decimal(rng.randint(-300, 600)) / 20) for k in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "location_id string, date date, v decimal(18,9)")
    got = rolling_mean(df, {"m": "v"}).select("location_id", "date", "m", _anomaly("v", "m").alias("a")).collect()
    got = {(r[0], r[1]): (r[2], r[3]) for r in got}
    seen = {}
    for k, d, v in rows:
        seen.setdefault(k, []).append(v)
        last = [x for x in seen[k][-30:] if x is not None]
        m = (sum(last) / len(last)).quantize(Decimal("1e-9"), ROUND_HALF_UP) if last else None
        a = None if v is None else (v - m).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert got[k, d] == (m, a)
    one = spark.createDataFrame([(Decimal("20.05"), Decimal("21.125")), (Decimal("25.05"), Decimal("20.045"))],
                                "v decimal(18,9), m decimal(18,9)")
    assert [r[0] for r in one.select(_anomaly("v", "m")).collect()] == [Decimal("-1.08"), Decimal("5.01")]
