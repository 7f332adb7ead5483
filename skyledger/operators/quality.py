"""Data-quality checks (D1-D16).  Each check returns its failing rows; 0 rows = pass.

Checks are distributed DataFrame plans (filters, grouped counts, anti joins);
nothing is collected to the driver except the suite summary, which has one
row per declared test.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import days_between, hours_between
from .joins import bounded_broadcast, expected_left
from .ordering import having


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ── generic column tests ─────────────────────────────────────────────────────

def not_null(df: DataFrame, col: str) -> DataFrame:
    """D1."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values occurring more than once (NULLs are not counted).

    Text is grouped as bytes, hexadecimal keys of 32 digits by the 16 bytes they stand for: half as much to shuffle.
    """
    some = df.filter(F.col(col).isNotNull())
    repeated = [F.count(F.lit(1)).alias("n_records")]
    if df.schema[col].dataType != T.StringType():
        return some.groupBy(col).agg(*repeated).filter(F.col("n_records") > 1)
    is_hex = F.col(col).rlike(r"\A[0-9a-f]{32}\z")
    packed = F.when(is_hex, F.unhex(col)).otherwise(F.col(col).cast("binary"))
    text = F.when(F.col("_hex"), F.lower(F.hex("_packed"))).otherwise(F.col("_packed").cast("string"))
    return (some.groupBy(is_hex.alias("_hex"), packed.alias("_packed")).agg(*repeated).filter(F.col("n_records") > 1)
            .select(text.alias(col), "n_records"))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """D3: non-NULL values outside the list (NULL passes)."""
    return df.filter(~F.col(col).isin(list(values)))


def accepted_range(df: DataFrame, col: str, lo=None, hi=None, inclusive: bool = True) -> DataFrame:
    """Values outside [lo, hi] (or the open interval); NULL passes."""
    c = F.col(col)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | ((c < lo) if inclusive else (c <= lo))
    if hi is not None:
        cond = cond | ((c > hi) if inclusive else (c >= hi))
    return df.filter(cond)


def unique_key(df: DataFrame, *cols: str) -> DataFrame:
    """Composite keys occurring more than once, with their count."""
    return having(df, cols, [F.count(F.lit(1)).alias("occurrences")], F.col("occurrences") > 1)


def expression(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows where ``predicate`` is true (e.g. temp_min_c > temp_max_c)."""
    return df.filter(predicate)


# ── singular tests ───────────────────────────────────────────────────────────

def date_gaps(facts: DataFrame, as_of: Column, days: int = 30, key: str = "location_id",
              col: str = "date") -> DataFrame:
    """Consecutive dates more than one day apart in the last ``days`` before ``as_of``."""
    from pyspark.sql import Window
    f = facts.select(key, col).filter(F.col(col) >= F.date_sub(as_of, days))
    w = Window.partitionBy(key).orderBy(col)
    f = f.withColumn("prev_date", F.lag(col).over(w))
    gap = days_between(col, "prev_date")
    return (f.filter(F.col("prev_date").isNotNull() & (gap > 1))
            .select(key, F.col("prev_date").alias("gap_start"), F.col(col).alias("gap_end"),
                    gap.cast("bigint").alias("gap_days")))


def location_freshness(locations: DataFrame, raw: DataFrame, as_of: Column, hours: int = 25,
                       key: str = "location_id", col: str = "_extracted_at") -> DataFrame:
    """Every expected location that is never loaded or older than ``hours``."""
    latest = raw.groupBy(key).agg(F.max(col).alias("latest_extracted_at"))
    age = hours_between(as_of, "latest_extracted_at")
    j = expected_left(locations.select(key), latest, key)
    status = (F.when(F.col("latest_extracted_at").isNull(), "never_loaded")
              .when(age > hours, "stale").otherwise("fresh"))
    return (j.select(key, "latest_extracted_at", age.alias("age_hours"), status.alias("status"))
            .filter(F.col("status") != "fresh")
            .orderBy(F.col("age_hours").desc_nulls_first(), key))


def relationship(child: DataFrame, parent: DataFrame, key: str = "location_id") -> DataFrame:
    """Child rows whose key has no parent (anti join; parent keys broadcast when bounded)."""
    return child.join(bounded_broadcast(parent.select(key).distinct()), key, "left_anti")


def source_freshness(raw: DataFrame, as_of: Column, warn: int = 25, error: int = 49,
                     col: str = "_extracted_at") -> DataFrame:
    """Age of the newest load against warn / error thresholds (hours)."""
    age = hours_between(as_of, "max_loaded_at")
    secs = F.timestamp_diff("SECOND", F.col("max_loaded_at"), as_of)   # thresholds are strict on elapsed time
    return (raw.agg(F.max(col).alias("max_loaded_at"))
            .select("max_loaded_at", age.alias("age_hours"),
                    F.when(F.col("max_loaded_at").isNull(), "error")
                    .when(secs > error * 3600, "error").when(secs > warn * 3600, "warn")
                    .otherwise("pass").alias("status")))


def recent_load(raw: DataFrame, as_of: Column, hours: float = 7.0, col: str = "_extracted_at") -> DataFrame:
    """Rows loaded within ``hours`` before ``as_of``; status fails when none."""
    since = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(round(hours * 60))), F.lit(0))
    return (raw.agg(F.count_if(F.col(col) >= since).alias("recent_rows"), F.max(col).alias("max_loaded_at"))
            .withColumn("status", F.when(F.col("recent_rows") > 0, "pass").otherwise("fail")))


def incomplete(raw: DataFrame, expected: int, key: str = "location_id") -> DataFrame:
    """Locations with fewer rows than expected, and how many are missing."""
    return (having(raw, [key], [F.count(F.lit(1)).alias("total_coletado")], F.col("total_coletado") < expected)
            .select(key, "total_coletado", (F.lit(expected) - F.col("total_coletado")).alias("faltando")))


def count_mismatch(raw: DataFrame, expected: int, key: str = "location_id") -> DataFrame:
    """Locations whose row count differs from expected (signed difference)."""
    return (having(raw, [key], [F.count(F.lit(1)).alias("total")], F.col("total") != expected)
            .select(key, "total", (F.col("total") - F.lit(expected)).alias("diferenca")))


def incomplete_calendar(raw: DataFrame, start: Column, as_of: Column, key: str = "location_id") -> DataFrame:
    """expected = days from ``start`` to the day before ``as_of``, inclusive."""
    exp = (days_between(F.date_sub(as_of, 1), start) + 1).cast("bigint")
    return (raw.groupBy(key).agg(F.count(F.lit(1)).alias("dias_coletados"))
            .select(key, "dias_coletados", exp.alias("dias_esperados"),
                    (exp - F.col("dias_coletados")).alias("dias_faltando"))
            .filter(F.col("dias_coletados") < F.col("dias_esperados")))


def complete_locations(raw: DataFrame, expected: int, key: str = "location_id") -> DataFrame:
    """Number of locations with at least ``expected`` rows, from one read: the HAVING set holds each location once."""
    full = having(raw, [key], [F.count(F.lit(1)).alias("n")], F.col("n") >= expected)
    return full.agg(F.count(key).alias("municipios_completos"))


# ── declared suite ───────────────────────────────────────────────────────────

# The declared column tests per model (test, column, argument).
SUITES: dict[str, list[tuple]] = {
    "raw_hourly": [
        ("not_null", "location_id"), ("not_null", "timestamp"),
        ("accepted_range", "temperature_2m", (-20, 55)), ("accepted_range", "relative_humidity_2m", (0, 100)),
        ("accepted_range", "precipitation", (0, 200)), ("accepted_range", "wind_speed_10m", (0, 300)),
        ("not_null", "_extracted_at"),
    ],
    "raw_daily": [
        ("not_null", "location_id"), ("not_null", "date"),
        ("accepted_range", "temperature_2m_max", (-20, 60)), ("accepted_range", "temperature_2m_min", (-30, 55)),
        ("accepted_range", "precipitation_sum", (0, 500)), ("accepted_range", "uv_index_max", (0, 20)),
        ("not_null", "_extracted_at"),
    ],
    "stg_daily": [
        ("not_null", "location_id"), ("not_null", "date"), ("not_null", "temp_max_c"),
        ("not_null", "temp_min_c"), ("not_null", "temp_avg_c"),
        ("accepted_range", "precipitation_mm", (0, 500)), ("accepted_range", "uv_index_max", (0, 20)),
        ("not_null", "_extracted_at"), ("not_null", "_loaded_at"),
    ],
    "stg_hourly": [
        ("not_null", "location_id"), ("not_null", "observed_at"), ("not_null", "latitude"),
        ("accepted_range", "latitude", (-35, 5)), ("not_null", "longitude"),
        ("accepted_range", "longitude", (-75, -30)), ("accepted_range", "temperature_c", (-20, 55)),
        ("accepted_range", "relative_humidity_pct", (0, 100)), ("accepted_range", "precipitation_mm", (0, 200)),
        ("accepted_range", "wind_direction_deg", (0, 360)), ("not_null", "_extracted_at"),
        ("not_null", "_loaded_at"),
    ],
    "daily_enriched": [("not_null", "location_id"), ("not_null", "date"), ("not_null", "city_name")],
    "hourly_facts": [
        ("not_null", "surrogate_key"), ("unique", "surrogate_key"), ("not_null", "observed_at"),
        ("not_null", "date"), ("not_null", "hour"), ("accepted_range", "hour", (0, 23)),
        ("not_null", "location_id"), ("not_null", "city_name"), ("not_null", "_dbt_updated_at"),
    ],
    "daily_facts": [
        ("not_null", "surrogate_key"), ("unique", "surrogate_key"), ("not_null", "date"),
        ("not_null", "location_id"), ("not_null", "city_name"), ("not_null", "year"),
        ("accepted_range", "month", (1, 12)), ("not_null", "temp_max_c"),
        ("accepted_range", "temp_max_c", (-20, 60)), ("accepted_range", "temp_min_c", (-30, 55)),
        ("accepted_range", "temp_amplitude_c", (0, 40)), ("accepted_range", "temp_anomaly_c", (-25, 25)),
        ("accepted_range", "precipitation_mm", (0, 500)), ("not_null", "precipitation_class"),
        ("accepted_values", "precipitation_class", ("dry", "light", "moderate", "heavy", "extreme")),
        ("accepted_range", "uv_index_max", (0, 20)),
        ("accepted_values", "uv_risk_level", ("low", "moderate", "high", "very_high", "extreme")),
        ("accepted_range", "daylight_hours", (10, 14.05)), ("not_null", "_dbt_updated_at"),
    ],
    "alerts": [
        ("not_null", "surrogate_key"), ("unique", "surrogate_key"), ("not_null", "date"),
        ("not_null", "location_id"), ("not_null", "alert_type"),
        ("accepted_values", "alert_type", ("extreme_heat", "frost", "heavy_rain", "high_winds", "extreme_uv",
                                           "heat_anomaly", "cold_anomaly", "precip_anomaly")),
        ("not_null", "severity"), ("accepted_values", "severity", ("critical", "high", "medium", "low")),
    ],
    "calendar": [
        ("not_null", "dt_data"), ("unique", "dt_data"), ("not_null", "ano"), ("not_null", "mes"),
        ("accepted_range", "mes", (1, 12)), ("not_null", "dia"), ("not_null", "trimestre"),
        ("accepted_range", "trimestre", (1, 4)), ("accepted_range", "dia_semana_num", (0, 6)),
        ("not_null", "nm_mes"),
        ("accepted_values", "nm_mes", ("Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho",
                                       "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro")),
        ("not_null", "nm_mes_abrev"), ("not_null", "nm_dia_semana"),
        ("accepted_values", "nm_dia_semana", ("Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira",
                                              "Quinta-feira", "Sexta-feira", "Sábado")),
        ("not_null", "estacao"), ("accepted_values", "estacao", ("Verão", "Outono", "Inverno", "Primavera")),
        ("not_null", "ano_mes"), ("not_null", "nm_trimestre"), ("not_null", "sigla_trimestre"),
        ("accepted_values", "sigla_trimestre", ("Q1", "Q2", "Q3", "Q4")), ("not_null", "fl_fim_de_semana"),
        ("not_null", "primeiro_dia_mes"), ("not_null", "ultimo_dia_mes"),
    ],
    "locations": [
        ("not_null", "location_id"), ("unique", "location_id"), ("not_null", "city_name"),
        ("not_null", "state_name"), ("accepted_values", "state_name", ("Santa Catarina",)),
        ("not_null", "state_code"), ("accepted_values", "state_code", ("SC",)),
        ("not_null", "country"), ("accepted_values", "country", ("Brasil",)),
        ("not_null", "region"), ("accepted_values", "region", ("Sul",)),
        ("not_null", "mesoregion"),
        ("accepted_values", "mesoregion", ("Grande Florianópolis", "Norte Catarinense", "Vale do Itajaí",
                                           "Serrana", "Oeste Catarinense", "Sul Catarinense")),
        ("not_null", "latitude"), ("accepted_range", "latitude", (-30, -26)),
        ("not_null", "longitude"), ("accepted_range", "longitude", (-54, -48)),
        ("accepted_values", "population_class", ("small", "medium", "large", "metropolitan")),
    ],
}


def failing_condition(test: str, col: str, arg=None) -> Column:
    """Row-level failure predicate of a declared test (uniqueness is not row-level)."""
    c = F.col(col)
    if test == "not_null":
        return c.isNull()
    if test == "accepted_values":
        return ~c.isin(list(arg))
    if test == "accepted_range":
        lo, hi = arg
        return (c < lo) | (c > hi)
    raise ValueError(test)


def _row_tests(model: str, columns: Sequence[str], suites: Mapping[str, list[tuple]]) -> list[tuple]:
    return [t for t in suites.get(model, []) if t[0] != "unique" and t[1] in columns]


def row_metrics(model: str, df: DataFrame, suites: Mapping[str, list[tuple]] | None = None) -> list[Column]:
    """Row count and one failure count per row-level test, as aggregates: to scan for, or to observe while ``df`` is written."""
    tests = _row_tests(model, df.columns, SUITES if suites is None else suites)
    return [F.count(F.lit(1)).alias("n_rows"),
            *(F.count_if(failing_condition(*t)).alias(f"c{i}") for i, t in enumerate(tests))]


def observe(df: DataFrame, model: str, observation) -> DataFrame:
    """``df`` whose suite metrics are counted by whatever job reads it (``Observation.get`` after that job)."""
    return df.observe(observation, *row_metrics(model, df))


SUMMARY = "model string, test string, column string, failures long"


def run_suite(tables: Mapping[str, DataFrame], suites: Mapping[str, list[tuple]] | None = None,
              metrics: Mapping[str, Mapping[str, int]] | None = None,
              sized_as: Mapping[str, DataFrame] | None = None,
              singular: Mapping[tuple[str, str, str], DataFrame] | None = None) -> DataFrame:
    """``(model, test, column, failures)``, one row per declared test.

    Row-level tests take one aggregation per table, or none where ``metrics`` holds what was observed while the table
    was written; observed counts are used only if their row count is the table's (a stage that ran again after a lost
    executor counts twice, and is then counted by a scan).  Uniqueness takes one grouped count per test.  A test whose column the table
    lacks is reported with NULL failures.  ``sized_as``: for a model that is a view, a stored table of as many rows, which is
    counted in its place.  ``singular``: further tests by (model, test, column), given as their failing rows.
    """
    suites = SUITES if suites is None else suites
    parts, known = [], []
    spark = next(iter(tables.values())).sparkSession
    for model, df in tables.items():
        row_tests = _row_tests(model, df.columns, suites)
        seen = (metrics or {}).get(model)
        if seen is not None and seen["n_rows"] != (sized_as or {}).get(model, df).count():
            seen = None
        if seen is not None:
            known += [(model, t[0], t[1], seen[f"c{i}"]) for i, t in enumerate(row_tests)]
        elif row_tests:
            counts = df.agg(*row_metrics(model, df, suites))
            stack = ", ".join(f"'{t[0]}', '{t[1]}', c{i}" for i, t in enumerate(row_tests))
            parts.append(counts.selectExpr(f"'{model}' AS model",
                                           f"stack({len(row_tests)}, {stack}) AS (test, column, failures)"))
        for t in suites.get(model, []):
            if t[1] not in df.columns:
                known.append((model, t[0], t[1], None))
            elif t[0] == "unique":
                parts.append(_counted(unique(df, t[1]), model, "unique", t[1]))
    for (model, test, col), rows in (singular or {}).items():
        parts.append(_counted(rows, model, test, col))
    out = spark.createDataFrame(known, SUMMARY)
    for p in parts:
        out = out.unionByName(p)
    return out


def _counted(rows: DataFrame, model: str, test: str, col: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(col).alias("column"), "failures")


def singular_tests(facts: DataFrame, alerts: DataFrame, raw_daily: DataFrame, locations: DataFrame,
                   as_of_date: Column, as_of_time: Column) -> dict[tuple[str, str, str], DataFrame]:
    """D5-D9 as members of the suite, keyed by (model, test, column)."""
    return {
        ("daily_facts", "unique_key", "location_id, date"): unique_key(facts, "location_id", "date"),
        ("daily_facts", "min_above_max", "temp_min_c"): expression(facts, F.col("temp_min_c") > F.col("temp_max_c")),
        ("daily_facts", "date_gaps", "date"): date_gaps(facts, as_of_date, 30),
        ("raw_daily", "location_freshness", "_extracted_at"): location_freshness(locations, raw_daily, as_of_time, 25),
        ("alerts", "relationship", "location_id"): relationship(alerts, locations),
    }


def tagged_failures(df: DataFrame, model: str, suites: Mapping[str, list[tuple]] | None = None) -> DataFrame:
    """K9: every failing row of the model's row-level tests, once per test it fails (``test`` = ``<test>__<column>``).

    One scan evaluates all tests; rows that fail none leave before anything is shuffled or written.
    """
    tests = _row_tests(model, df.columns, SUITES if suites is None else suites)
    if not tests:
        return df.filter(F.lit(False)).withColumn("test", F.lit(""))
    tags = F.array_compact(F.array(*(F.when(failing_condition(*t), F.lit(f"{t[0]}__{t[1]}")) for t in tests)))
    return df.withColumn("_tags", tags).filter(F.size("_tags") > 0).withColumn("test", F.explode("_tags")).drop("_tags")
