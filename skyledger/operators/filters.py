"""Parametrised filters (P6-P10, P12).  Parameters become literals, never SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def optional_eq(df: DataFrame, col: str, value=None) -> DataFrame:
    """``col = value`` unless value is None / 'all'."""
    if value is None or value in ("all", "Todas"):
        return df
    return df.filter(F.col(col) == F.lit(value))


def isin_filter(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """``col IN (values)``."""
    return df.filter(F.col(col).isin(list(values)))


def max_date(df: DataFrame, col: str = "date", month_col: str = "year_month") -> Column:
    """A25 as a scalar subquery column: MAX(col) of ``df``, planned once.

    On a table partitioned by month (``year_month`` derived from ``date``) the
    latest date lies in the latest month: MAX(year_month) is answered from the
    partition column (no data columns read), and MAX(date) then scans only
    that month's files — the anchor costs one month, not the whole history.
    """
    if col == "date" and month_col in df.columns:
        last = df.select(F.max(month_col)).scalar()
        return df.filter(F.col(month_col) == last).select(F.max(col)).scalar()
    return df.select(F.max(col)).scalar()


def partition_list(df: DataFrame, col: str) -> list[str] | None:
    """Values of the partition folders of the stored table ``df`` (as read, unfiltered) in ascending order; None if
    ``col`` is not its partition column.

    One row's file name gives the table's folder, the file system lists the rest: no data is scanned, and
    the list has one entry per day or month, whatever the number of files.
    """
    from ..sinks.stored import partitions
    one = df.select(F.input_file_name()).first()
    if one is None or f"/{col}=" not in one[0]:
        return None
    return partitions(df.sparkSession, one[0].split(f"/{col}=")[0], col)


def latest_date(df: DataFrame, condition: Column | None = None, col: str = "date") -> Column:
    """A25 as a literal: MAX(col) of the rows of ``df`` that meet ``condition``, NULL if there is none.

    On a table partitioned by ``col`` the newest partitions are asked first, then four times as many, until a row meets the
    condition: for a series that is up to date one partition is read.  As a literal the date prunes partitions when the
    query is planned.  Any other table is asked with ``max_date``.
    """
    rows = df if condition is None else df.filter(condition)
    days = partition_list(df, col)
    if not days:
        return max_date(rows, col)
    n = 1
    while True:
        found = rows.filter(F.col(col) >= F.lit(days[-min(n, len(days))]).cast("date")).select(F.max(col)).first()[0]
        if found is not None or n >= len(days):
            return F.lit(found).cast("date")
        n *= 4


def last_days(df: DataFrame, days: int, col: str = "date", anchor: Column | None = None) -> DataFrame:
    """``col >= MAX(col) - days`` (both ends closed: 7 days cover 8 dates).

    The anchor is the table's own maximum (a scalar subquery), never the clock.
    """
    anchor = max_date(df, col) if anchor is None else anchor
    start = F.date_sub(anchor, days)
    out = df.filter(F.col(col) >= start)
    if col == "date" and "year_month" in df.columns:
        # same predicate on the month column: prunes monthly partitions at scan time
        out = out.filter(F.col("year_month") >= F.date_format(start, "yyyy-MM"))
    return out


def half_open(df: DataFrame, start: Column, end: Column, col: str = "date") -> DataFrame:
    """``start <= col < end``."""
    return df.filter((F.col(col) >= start) & (F.col(col) < end))


def require(df: DataFrame, *cols: str) -> DataFrame:
    """P10: all ``cols`` IS NOT NULL."""
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
    return df
