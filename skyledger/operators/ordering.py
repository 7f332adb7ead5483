"""Sorting, top-k, DISTINCT lookups and HAVING."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """O1: ORDER BY ... LIMIT n -> TakeOrderedAndProject (per-task top-n, then merge).

    Callers append key columns to ``order`` so ties resolve deterministically.
    """
    return df.orderBy(*order).limit(n)


def sort_nulls_first(df: DataFrame, col: str) -> DataFrame:
    """``ORDER BY col DESC NULLS FIRST``."""
    return df.orderBy(F.col(col).desc_nulls_first())


def distinct_values(df: DataFrame, col: str, n: int | None = None, descending: bool = False,
                    not_null: bool = False) -> DataFrame:
    """Sorted DISTINCT values of one column, optionally the first ``n``."""
    out = df.select(col)
    if not_null:
        out = out.filter(F.col(col).isNotNull())
    out = out.distinct()
    o = F.col(col).desc() if descending else F.col(col).asc()
    return out.orderBy(o).limit(n) if n else out.orderBy(o)


def having(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], predicate: Column) -> DataFrame:
    """GROUP BY keys, aggregates, then the HAVING predicate."""
    return df.groupBy(*keys).agg(*aggs).filter(predicate)
