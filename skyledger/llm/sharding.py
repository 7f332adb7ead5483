"""Consistent-hash ring with virtual nodes and bounded loads.

Law ``rows``: shard capacities sum to the row count and are at most one
apart (the first ``n mod shards`` shards hold one more).  Each shard owns
``vnodes`` points of a 64-bit ring, each key asks the owner of the next point clockwise.
A full shard passes the keys it cannot take on to the next point clockwise,
and so on; since the capacities sum to the row count, everyone is placed and the loads
are exactly the capacities.  With another shard count, a key moves only if its arc changed
owner or it overflowed.

At scale: keys are only counted per arc (shards x vnodes counters, whatever
the data's size); the driver passes the counters' overflow clockwise, which gives at
most ``shards * (vnodes + 1)`` intervals ``(arc, from rank, to rank) -> shard, first
slot``.  Rows find their interval by their rank in the arc.  Ranks come from
sub-cells of an arc, dealt by a hash of the whole row and ordered by place on the ring and that hash, so the same
rows get the same shards and slots in every run, however they are stored.  Only rows that are equal in all columns tie; where very many are, they
are spread over ``salts`` cells by place, which changes nothing that can be seen.

Defined cases: a null key is a key like any other; repeated rows take slots of
their own; an empty table gives an empty result; a null text counts 0 bytes.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialise


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, list[int]]:
    """Points in ring order (signed 64-bit) and the shard that owns each."""
    pts = sorted((xxhash.xxh64_intdigest(f"{s}/{v}") - (1 << 63), s) for s in range(shards) for v in range(vnodes))
    return np.array([p for p, _ in pts], np.int64), [s for _, s in pts]


def place(counts: list[int], owner: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Pass the arcs' counts clockwise: ``(arc, lo, hi, shard, slot of lo)`` intervals, gapless.

    Every round each arc's askers go to its owner while it has room, in ring
    order; the rest moves one point on.  An interval is cut only when a
    shard fills up, so there are at most ``len(counts) + shards`` of them.
    """
    n = sum(counts)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    taken = [0] * shards
    asking: list[list[tuple[int, int, int]]] = [[(a, 0, c)] if c else [] for a, c in enumerate(counts)]
    out = []
    while any(asking):
        moved: list[list[tuple[int, int, int]]] = [[] for _ in counts]
        for at, queue in enumerate(asking):
            s = owner[at]
            for arc, lo, hi in queue:
                k = min(hi - lo, room[s] - taken[s])
                if k:
                    out.append((arc, lo, lo + k, s, taken[s]))
                    taken[s] += k
                if lo + k < hi:
                    moved[(at + 1) % len(counts)].append((arc, lo + k, hi))
        asking = moved
    return out


def assign(df: DataFrame, key_cols: list[str], shards: int = 40, vnodes: int = 100, salts: int = 16,
           hot_rows: int = 10_000) -> DataFrame:
    """``df`` (all columns) with ``shard`` and ``slot`` (gapless from 0 in each shard).

    ``df`` must not have columns of these names; ``key_cols`` decide the place on the ring.  Rows that are equal in all columns are ``hot``
    if there are ``hot_rows`` of them or more, and then ranked in ``salts`` tasks.
    """
    if {"shard", "slot"} & {c.lower() for c in df.columns}:
        raise ValueError("the table has a column shard or slot already: rename it")
    spark = df.sparkSession
    points, owner = ring(shards, vnodes)
    arc, pos, sub, rank, same, place_ = (fresh(df, x) for x in ("arc_", "pos_", "sub_", "rank_", "same_", "place_"))

    @F.pandas_udf("int")
    def arc_of(h: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(points, h.to_numpy(np.int64)) % len(points)).astype(np.int32))

    rows = materialise(df.select("*", F.xxhash64(*key_cols).alias(pos), F.xxhash64(*df.columns).alias(same),
                                 F.monotonically_increasing_id().alias(place_)).withColumn(arc, arc_of(F.col(pos))), "shard-rows")
    # equal rows stay together in one cell, whatever their place: which of them gets which slot does not matter
    sub_of = F.pmod(F.col(same), F.lit(salts)).cast("long")
    hot = materialise(rows.groupBy(arc, same).count().where(F.col("count") >= hot_rows).withColumn(
        "at", F.row_number().over(Window.partitionBy(arc).orderBy(same))).select(F.col(same).alias("hot_"), "at"), "shard-hot")
    if hot.isEmpty():
        rows = rows.withColumn(sub, sub_of)
    else:  # a cell group of its own for each, after the others
        rows = rows.join(hot, F.col(same) == F.col("hot_"), "left").withColumn(
            sub, F.coalesce(F.col("at") * salts + F.pmod(F.xxhash64(place_), F.lit(salts)), sub_of)).drop("hot_", "at")
    cells = rows.groupBy(arc, sub).agg(F.count("*").alias("n"))
    counts = [0] * len(points)
    for r in cells.groupBy(arc).agg(F.sum("n").alias("n")).collect():  # at most shards * vnodes rows
        counts[r[0]] = r[1]
    plan = spark.createDataFrame(place(counts, owner, shards) or [(0, 0, 0, 0, 0)],
                                 f"`{arc}` int, lo long, hi long, shard int, slot0 long")
    before = cells.select(arc, sub, (F.sum("n").over(Window.partitionBy(arc).orderBy(sub)) - F.col("n")).alias("base"))
    w = Window.partitionBy(arc, sub).orderBy(pos, same, place_)
    ranked = (rows.withColumn(rank, F.row_number().over(w) - 1).join(before, [arc, sub])
              .withColumn(rank, F.col(rank) + F.col("base")))
    # bounded by shards * (vnodes + 1) rows, whatever the data's size
    return (ranked.join(F.broadcast(plan), arc).where((F.col(rank) >= F.col("lo")) & (F.col(rank) < F.col("hi")))
            .select(*df.columns, "shard", (F.col("slot0") + F.col(rank) - F.col("lo")).alias("slot")))


def home_shards(keys: list[int], shards: int, vnodes: int = 100) -> list[int]:
    """Owner of each 64-bit place on the ring before any overflow (for tests and capacity planning)."""
    points, owner = ring(shards, vnodes)
    p = points.tolist()
    return [owner[bisect_left(p, k) % len(p)] for k in keys]
