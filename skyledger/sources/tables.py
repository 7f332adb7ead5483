"""Raw-table and seed sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LOCATIONS, RAW_COLUMNS


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Location seed CSV with declared column types."""
    return spark.read.schema(LOCATIONS).option("header", True).csv(path)


def read_raw(spark: SparkSession, path_or_table: str) -> DataFrame:
    """A raw table by path (Parquet) or catalog name."""
    if "/" in path_or_table:
        return spark.read.parquet(path_or_table)
    return spark.table(path_or_table)


def read_new(source: DataFrame, target: DataFrame, col: str = "_extracted_at") -> DataFrame:
    """Source rows strictly newer than the target's high-water mark; all rows if the target is empty.

    The mark is evaluated once and used as a literal, so the predicate reaches
    the source scan (pushed filter / partition pruning).
    """
    from ..operators.incremental import high_water_mark
    hw = high_water_mark(target, col)
    return source if hw is None else source.filter(F.col(col) > F.lit(hw))


def select_raw_columns(df: DataFrame, table: str) -> DataFrame:
    """The declared raw column list (drops internal columns such as ``id``)."""
    return df.select(*RAW_COLUMNS[table])


def to_wire(df: DataFrame) -> DataFrame:
    """Decimals -> double, dates -> 'YYYY-MM-DD', timestamps -> ISO 'YYYY-MM-DDTHH:MM:SS'."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def window_bounds(as_of: dt.date, days: int = 2, start: dt.date | None = None,
                  end: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """Collection window — explicit [start, end], else the last ``days`` days up to ``as_of``."""
    if start is not None and end is not None:
        return start, end
    return as_of - dt.timedelta(days=days), as_of


def between(df: DataFrame, start, end, col: str = "date") -> DataFrame:
    """S9 as a filter: ``start <= col <= end``."""
    s = start if isinstance(start, Column) else F.lit(start)
    e = end if isinstance(end, Column) else F.lit(end)
    return df.filter((F.col(col) >= s) & (F.col(col) <= e))


def temporal_to_text(df: DataFrame) -> DataFrame:
    """Dates as 'YYYY-MM-DD', timestamps as 'YYYY-MM-DD HH:MM:SS' (other columns unchanged):
    the form query results take when they leave the engine for another client."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)
