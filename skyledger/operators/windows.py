"""Ordered window operators."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import NUMERIC

UNIT = 1_000_000_000  # 10^scale of NUMERIC


def _numeric_mean(units: Column, n: Column) -> Column:
    """AVG of NUMERIC values from their exact sum in units of 1e-9: rounded half away from zero at nine places."""
    q = F.try_divide(units.cast(T.DecimalType(27, 0)), n.cast(T.DecimalType(10, 0)))
    # scaled by a product, not a quotient, so no digit is lost after the rounding
    return (F.round(q, 0).cast(T.DecimalType(18, 0)) * F.lit(Decimal("0.000000001"))).cast(NUMERIC)


def rolling_mean(df: DataFrame, cols: dict[str, str], partition: str | Sequence[str] = "location_id",
                 order: str = "date", rows: int = 30) -> DataFrame:
    """Mean of the current and ``rows - 1`` preceding rows per partition.

    ``cols`` maps output name -> input column.  Counts rows, not days: with
    gaps the frame spans more than ``rows`` days; NULLs are skipped.

    Computed as running sums: sum(last n rows) = S(i) - S(i - n), where S is the
    running sum (an incremental, O(1)-per-row frame) and S(i - n) is a LAG of
    it; the same for the non-NULL count.  A bounded ROWS frame would re-add its
    whole buffer for every row, because Spark's aggregates cannot retract.
    Decimal sums are exact, so the result equals the frame average as NUMERIC
    (nine places, half away from zero).

    The frame runs on rows already unique per (partition, order) — one row per
    location and day — so a partition holds at most one row per calendar day:
    its size is bounded by the covered period, not by the data volume, and
    every metric shares one sort.
    """
    ordered = Window.partitionBy(*([partition] if isinstance(partition, str) else partition)).orderBy(order)
    run = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tmp = {}
    for out, src in cols.items():
        # exact fixed-point units of 1e-9 (NUMERIC scale) in a long: running sums stay
        # on the fast 64-bit path instead of wide decimals
        units = (F.col(src).cast(NUMERIC) * F.lit(UNIT)).cast("bigint")
        tmp[f"_s_{out}"] = F.coalesce(F.sum(units).over(run), F.lit(0))
        tmp[f"_n_{out}"] = F.count(src).over(run)
    staged = df.select("*", *[c.alias(n) for n, c in tmp.items()])
    outs = []
    for out in cols:
        s, n = F.col(f"_s_{out}"), F.col(f"_n_{out}")
        ds = s - F.coalesce(F.lag(s, rows).over(ordered), F.lit(0))
        dn = n - F.coalesce(F.lag(n, rows).over(ordered), F.lit(0))
        outs.append(_numeric_mean(ds, dn).alias(out))
    return staged.select(*df.columns, *outs)


def previous_value(df: DataFrame, col: str = "date", partition: str = "location_id",
                   out: str = "prev_date") -> DataFrame:
    """LAG of ``col`` per partition in ``col`` order."""
    w = Window.partitionBy(partition).orderBy(col)
    return df.withColumn(out, F.lag(col).over(w))


def latest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per group by ``order`` (QUALIFY ROW_NUMBER() = 1)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def rolling_mean_split(df: DataFrame, cols: dict[str, str], partition: str = "location_id",
                       order: str = "date", rows: int = 30, block=None) -> DataFrame:
    """W3/W4 for series too long for one task per key: the same result as ``rolling_mean``.

    Each key is cut into blocks (default: calendar year of ``order``).  The last
    ``rows - 1`` rows of a block are handed on to the blocks after it, as far as
    they reach (past sparse blocks, too), and ``rolling_mean`` runs per
    (key, block), so a hot key is spread over all tasks and no row is joined
    with another.  How far a row reaches follows from the row counts per key
    and block; they come from a second, column-pruned read of ``df`` and share
    the partitioning of the first window.  ``partition`` and ``order`` are not NULL, as in
    the staging tables; rows where they are stay, averaged in their own block only.
    """
    d = df.withColumn("_blk", (block or F.year)(F.col(order)))
    blocks = Window.partitionBy(partition).orderBy("_blk")
    counts = (d.groupBy(partition, "_blk").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_upto", F.sum("_n").over(blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    # a block holds a row at least, so no row reaches further than rows - 1 blocks
    later = F.struct(F.col("_blk").alias("to"), (F.col("_upto") - F.col("_n")).alias("before"))
    reach = counts.select(partition, "_blk", "_upto", F.collect_list(later).over(blocks.rowsBetween(1, rows - 1)).alias("_later"))
    from_end = Window.partitionBy(partition, "_blk").orderBy(F.col(order).desc())
    j = d.withColumn("_end", F.row_number().over(from_end)).join(reach, [partition, "_blk"], "left")
    halo = F.filter("_later", lambda b: b["before"] - F.col("_upto") + F.col("_end") < rows)
    to = F.concat(F.array("_blk"), F.coalesce(F.transform(halo, lambda b: b["to"]), F.slice(F.array("_blk"), 1, 0)))
    handed = j.select(*df.columns, "_blk", F.explode(to).alias("_to"))
    rolled = rolling_mean(handed, cols, [partition, "_to"], order, rows)
    return rolled.filter(F.col("_blk").eqNullSafe(F.col("_to"))).select(*df.columns, *cols)
