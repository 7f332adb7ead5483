"""Latest-extraction dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import MAX_BROADCAST_ROWS, fits_broadcast


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order`` (default latest ``_extracted_at``).

    Rows with a NULL key are dropped first.  Written as ``row_number() == 1`` so
    Catalyst plans a partial ``WindowGroupLimit`` before the shuffle: each map
    task forwards at most one row per key, which pre-aggregates re-sent
    extractions and keeps a hot key from flooding one reducer.
    Pass a total order (append tie-break columns) for a deterministic pick.
    """
    order = list(order) if order else [F.col("_extracted_at").desc()]
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.filter(cond)
              .withColumn("_row_num", F.row_number().over(w))
              .filter(F.col("_row_num") == 1)
              .drop("_row_num"))


def latest_of_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
                       max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The rows of ``latest_per_key``, for a stored table in which few keys repeat, as in one that is reloaded by window.

    Only the keys are shuffled to find the repeated ones; the rows of those are ranked, all others are the latest of
    their key as they lie.  If more than ``max_rows`` keys (or a broadcast's bytes) repeat, every row is ranked.  ``df`` is
    read three times.
    """
    from .incremental import materialize
    known = df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    repeated = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    repeated = materialize(repeated.limit(max_rows + 1))
    if not fits_broadcast(repeated, max_rows):
        return latest_per_key(df, keys, order)
    small = F.broadcast(repeated)
    ranked = latest_per_key(known.join(small, list(keys), "left_semi"), keys, order)
    return known.join(small, list(keys), "left_anti").unionByName(ranked)
