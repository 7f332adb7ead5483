"""Sinks and table maintenance (K1-K9) on partitioned Parquet.

Writes never overwrite a path that the same plan reads: merged partitions are
staged under the shared checkpoint folder first (``session.scratch_path``),
then swapped in one by one under a redo note (``stored``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_key
from .stored import CODEC


def append_raw(df: DataFrame, path: str, partition_col: str = "date", truncate: bool = False) -> None:
    """K1 (+K7 ``truncate``, which replaces the whole table, whatever partitions ``df`` holds): typed append, partitioned by day."""
    (df.write.mode("overwrite" if truncate else "append").option("partitionOverwriteMode", "static")
     .partitionBy(partition_col).parquet(path))


def partition_column(df: DataFrame, grain: str | None, col: str) -> tuple[DataFrame, str]:
    """Partition column: ``grain=None`` uses ``col`` as is; 'day' -> part_date,
    'month' -> part_month ('YYYY-MM')."""
    if grain is None:
        return df, col
    if grain == "day":
        return df.withColumn("part_date", F.to_date(col)), "part_date"
    if grain == "month":
        return df.withColumn("part_month", F.date_format(col, "yyyy-MM")), "part_month"
    raise ValueError(grain)


def write_partitioned(df: DataFrame, path: str, grain: str | None = "month", time_col: str = "date",
                      cluster: Sequence[str] = ("location_id",), mode: str = "overwrite",
                      max_records_per_file: int = 5_000_000, rebalance: bool = True) -> None:
    """K5: partition by day/month of ``time_col`` (or by ``time_col`` itself when
    ``grain`` is None), cluster rows inside files.

    The REBALANCE hint shuffles by the partition column so each table
    partition is written by few tasks (few files), and lets adaptive execution
    split a skewed partition (a hot month) into several tasks and merge small
    ones — without the sampling pass a range repartition would add.  The sort
    within partitions gives Parquet row groups tight min/max ranges for the
    cluster keys (row-group pruning).  ``rebalance=False``: the rows lie by partition already,
    rebalanced before they were widened or read from a table partitioned alike, and are not shuffled again.
    """
    d, part = partition_column(df, grain, time_col)
    out = (d.hint("rebalance", part) if rebalance else d).sortWithinPartitions(part, *cluster)
    (out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).option("compression", CODEC)
     .partitionBy(part).parquet(path))


def reload_window(target: DataFrame, new: DataFrame, start, end=None, col: str = "date") -> DataFrame:
    """K2: drop target rows with ``col >= start`` (and ``<= end`` when given), append ``new``.

    With ``end=None`` there is no upper bound, as in the source's delete.
    """
    c = F.col(col)
    s = F.lit(start).cast(target.schema[col].dataType) if not isinstance(start, Column) else start
    cond = c >= s
    if end is not None:
        e = F.lit(end).cast(target.schema[col].dataType) if not isinstance(end, Column) else end
        cond = cond & (c <= e)
    return target.filter(~cond | c.isNull()).unionByName(new.select(*target.columns))


def upsert_on_conflict(target: DataFrame, new: DataFrame, keys: Sequence[str],
                       keep_cols: Sequence[str] = ()) -> DataFrame:
    """K3/K4: INSERT ... ON CONFLICT (keys) DO UPDATE for all columns except ``keep_cols``.

    Full outer join on the (unique) key: matched rows take the new values, but
    ``keep_cols`` keep the stored value; unmatched rows come from either side.
    """
    t = target.withColumn("_in_t", F.lit(True))
    n = new.select(*target.columns).withColumn("_in_n", F.lit(True))
    j = t.alias("t").join(n.alias("n"), list(keys), "full_outer")
    cols = []
    for c in target.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c in keep_cols:
            cols.append(F.when(F.col("t._in_t").isNotNull(), F.col(f"t.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
        else:
            cols.append(F.when(F.col("n._in_n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return j.select(*cols)


def upsert_raw_hourly(target: DataFrame, new: DataFrame) -> DataFrame:
    """K3: conflict on (location_id, timestamp); coordinates/elevation/timezone are kept."""
    return upsert_on_conflict(target, new, ["location_id", "timestamp"],
                              ["latitude", "longitude", "elevation", "timezone"])


def upsert_raw_daily(target: DataFrame, new: DataFrame) -> DataFrame:
    """K4: conflict on (location_id, date); coordinates are kept."""
    return upsert_on_conflict(target, new, ["location_id", "date"], ["latitude", "longitude"])


def expire_partitions(df: DataFrame, days: int, as_of: Column, col: str = "timestamp") -> DataFrame:
    """K6: rows newer than ``days`` before ``as_of`` (partition expiry as a filter)."""
    c = F.col(col)
    start = F.date_sub(as_of.cast("date"), days)
    return df.filter(c.cast("date") >= start)


def materialize(df: DataFrame, kind: str, name: str | None = None, path: str | None = None) -> DataFrame:
    """K8: 'view' -> temp view; 'table' -> full rebuild as Parquet (overwrite)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind == "table":
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    raise ValueError(kind)


def store_failures(failures: DataFrame, path: str) -> None:
    """K9: persist failing rows, those of a tagged table in one folder per test."""
    w = failures.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy("test") if "test" in failures.columns else w).parquet(path)


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, key: str = "surrogate_key",
                      partition_col: str = "part_month") -> None:
    """U1 on a stored table (see ``stored.merge_table``)."""
    from .stored import merge_table
    merge_table(spark, path, source, partition_col, key)


def upsert_latest_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                             order: Sequence[Column], partition_col: str = "part_date") -> None:
    """Latest row per key over ``batch`` and the target partitions it touches.

    Used by the streaming upsert: the touched partitions are deduplicated together with the batch (map-side top-1 before the
    shuffle) and swapped in; a batch that is run again gives the same result.
    """
    from .stored import change_partitions, read_table, replace_partitions
    if read_table(spark, path) is None:
        rows = latest_per_key(batch, keys, order)
        if not rows.isEmpty():
            replace_partitions(spark, path, rows, partition_col)
        return
    change_partitions(spark, path, batch, partition_col,
                      lambda old, new: latest_per_key(old.unionByName(new.select(*old.columns)), keys, order))
