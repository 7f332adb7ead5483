"""Joins (J1-J7).  All are single-key equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import session_key

# A dimension is broadcast only when it is proven to hold at most this many
# rows and bytes; above either the join falls back to a shuffled (sort-merge) join.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20


_checked: dict[tuple, tuple[int, int]] = {}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as a join's hash table holds it: a header, a word or two per field, and what its values add."""
    def extra(f: T.StructField) -> Column | None:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.octet_length(c)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(c)))
        return None

    out = F.lit(16 + 16 * len(df.schema.fields)).cast("long")
    for x in filter(lambda x: x is not None, map(extra, df.schema.fields)):
        out = out + F.coalesce(x, F.lit(0))
    return out


def bounded_size(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[int, int]:
    """Rows of ``dim``, at most ``max_rows + 1`` of them, and their bytes.

    ``limit`` stops the scan after ``max_rows + 1`` rows, of which only the
    size travels, so the check stays cheap whatever the table size.  Results are remembered per session, plan and input
    file list, so a dimension reused by many reports is checked once.
    """
    try:
        key = (*session_key(dim.sparkSession), dim.semanticHash(), tuple(sorted(dim.inputFiles())), max_rows)
    except Exception:  # noqa: BLE001  (plans without file inputs)
        key = None
    if key is not None and key in _checked:
        return _checked[key]
    got = dim.select(row_bytes(dim).alias("size")).limit(max_rows + 1).agg(F.count("*"), F.sum("size")).first()
    size = got[0], got[1] or 0
    if key is not None:
        _checked[key] = size
    return size


def fits_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``dim`` is proven to hold <= ``max_rows`` rows and <= ``max_bytes`` bytes."""
    rows, size = bounded_size(dim, max_rows)
    return rows <= max_rows and size <= max_bytes


def bounded_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark ``dim`` for broadcast only when it is proven to hold <= ``max_rows`` rows and <= ``max_bytes`` bytes;
    otherwise return it unchanged so the planner shuffles both sides."""
    return F.broadcast(dim) if fits_broadcast(dim, max_rows, max_bytes) else dim


def dim_join(fact: DataFrame, dim: DataFrame, key: str = "location_id", how: str = "left",
             max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Fact LEFT JOIN dimension USING (key); dimension columns win on name clashes."""
    clash = [c for c in fact.columns if c in dim.columns and c != key]
    return fact.drop(*clash).join(bounded_broadcast(dim, max_rows, max_bytes), key, how)


def orphans(child: DataFrame, parent: DataFrame, key: str = "location_id") -> DataFrame:
    """Child rows whose key has no parent row (LEFT JOIN ... IS NULL)."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def expected_left(expected: DataFrame, agg: DataFrame, key: str = "location_id") -> DataFrame:
    """Every expected key with its aggregate (NULL when never loaded)."""
    return expected.join(agg, key, "left")


def members(df: DataFrame, keys_df: DataFrame, key: str = "location_id") -> DataFrame:
    """Rows whose key is IN the key set (semi join)."""
    return df.join(keys_df.select(key), key, "left_semi")


def not_loaded(expected: DataFrame, loaded: DataFrame, key: str = "location_id") -> DataFrame:
    """Expected keys absent from the loaded set (anti join)."""
    return expected.join(loaded.select(key), key, "left_anti")
