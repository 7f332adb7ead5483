"""Materialised marts: build the mart tables once, serve the reports from them.

This is the warehouse side of the pipeline: the fact and alert marts are
written as partitioned Parquet (daily facts and alerts by month, hourly facts
by day, each clustered by location inside files), exactly once per input,
into the shared folder named by ``spark.checkpoint.dir``.  Reports then scan
only the columns they use and only the partitions their period needs; the
written tables also cut the lineage, so a lost executor recomputes from the
files, not from raw.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators.joins import fits_broadcast
from ..operators.quality import observe, unique
from ..session import scratch_path, session_key
from ..sinks.stored import _read_text, _write_text, exists
from ..sinks.tables import write_partitioned
from . import layers
from .marts import Marts


class StoredMarts:
    """Same surface as ``Marts`` for the reports; the marts come from written tables."""

    def __init__(self, spark: SparkSession, marts: Marts, root: str):
        self.spark = spark
        self.m = marts
        self.root = root
        self.locations = marts.locations
        self.raw_daily = marts.raw_daily
        self.raw_hourly = marts.raw_hourly
        self.daily_order = marts.daily_order
        self.hourly_order = marts.hourly_order

    def _table(self, name: str, chain: dict[str, Callable[[DataFrame | None], DataFrame]], part: str,
               cluster: tuple[str, ...], rebalance: bool = True) -> DataFrame:
        """Write the last layer of ``chain`` partitioned by its own column ``part`` (once), read it back typed.

        ``chain`` names the layers from raw to the table, each made from the one before; the suite metrics of all of them are
        observed by the one job that writes the table and kept beside it.
        """
        path = os.path.join(self.root, name)
        df = None
        seen = {}
        for model, layer in chain.items():
            seen[model] = Observation(f"{name}-{model}-{uuid.uuid4().hex}")
            df = observe(layer(df), model, seen[model])
        if not exists(self.spark, os.path.join(path, "_SUCCESS")):
            write_partitioned(df, path, grain=None, time_col=part, cluster=cluster, rebalance=rebalance)
            _write_text(self.spark, os.path.join(path, "_metrics.json"), json.dumps({m: o.get for m, o in seen.items()}))
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def metrics(self) -> dict[str, dict[str, int]]:
        """Suite metrics of every layer, as observed when the marts were written."""
        self.build()
        out: dict[str, dict[str, int]] = {}
        for name in ("daily_facts", "alerts", "hourly_facts"):
            file = os.path.join(self.root, name, "_metrics.json")
            out |= json.loads(_read_text(self.spark, file)) if exists(self.spark, file) else {}
        return out

    def sized_as(self) -> dict[str, DataFrame]:
        """The layers that stay views, by a written table of as many rows, so that counting them does not dedup raw again.

        Facts are the enriched rows; a staged row meets one location at most where location ids are unique.
        """
        out = {"daily_enriched": self.facts}
        if unique(self.locations, "location_id").isEmpty():
            out |= {"stg_daily": self.facts, "stg_hourly": self.hourly_facts}
        return out

    @cached_property
    def facts(self) -> DataFrame:
        # monthly partitions, clustered by (location_id, date) as the source's mart
        m = self.m
        # a dimension that is not broadcast shuffles the rows in its join: then they are rebalanced after it
        early = fits_broadcast(m.locations.select("location_id", *layers.LOCATION_COLS))
        return self._table("daily_facts", {
            "raw_daily": lambda _: m.raw_daily,
            "stg_daily": lambda raw: layers.stg_daily(raw, m.daily_order, loaded_at=m.stamps),
            "daily_enriched": lambda stg: layers.daily_enriched(stg, m.locations, by_month=early),
            "daily_facts": lambda e: layers.daily_facts(e, updated_at=m.stamps)},
            "year_month", ("location_id", "date"), rebalance=not early)

    @cached_property
    def alerts(self) -> DataFrame:
        # derived from the written facts, not by recomputing the daily chain; their files lie by month already
        return self._table("alerts", {"alerts": lambda _: layers.alerts(self.facts)}, "year_month", ("location_id", "date"),
                           rebalance=False)

    def build(self) -> None:
        """Materialise every mart now (otherwise each is built on first use)."""
        self.facts, self.alerts, self.hourly_facts  # noqa: B018

    @cached_property
    def hourly_facts(self) -> DataFrame:
        # daily partitions, clustered by (location_id, mesoregion) as the source's mart
        m = self.m
        early = fits_broadcast(m.locations.select("location_id", *layers.HOURLY_LOCATION_COLS))
        return self._table("hourly_facts", {
            "raw_hourly": lambda _: m.raw_hourly,
            "stg_hourly": lambda raw: layers.stg_hourly(raw, m.hourly_order, loaded_at=m.stamps),
            "hourly_facts": lambda stg: layers.hourly_facts(stg, m.locations, updated_at=m.stamps, by_day=early)},
            "date", ("location_id", "mesoregion"), rebalance=not early)

    # staging / intermediate stay views (as in the source project)
    @property
    def stg_daily(self) -> DataFrame:
        return self.m.stg_daily

    @property
    def stg_hourly(self) -> DataFrame:
        return self.m.stg_hourly

    @property
    def enriched(self) -> DataFrame:
        return self.m.enriched


def input_fingerprint(paths: list[str]) -> str:
    """Identity of the inputs (path, size, mtime) so a changed input rebuilds the marts."""
    h = hashlib.sha1()
    for p in sorted(paths):
        try:
            st = os.stat(p)
            h.update(f"{p}:{st.st_size}:{st.st_mtime_ns}".encode())
        except OSError:
            h.update(p.encode())
    return h.hexdigest()[:16]


_stores: dict[tuple, StoredMarts] = {}


def stored(spark: SparkSession, marts: Marts, key: str, inputs: list[str]) -> StoredMarts:
    """The materialised marts for ``marts``; built on first use per session and input."""
    fp = input_fingerprint(inputs)
    k = (*session_key(spark), key, fp)
    if k not in _stores:
        _stores[k] = StoredMarts(spark, marts, scratch_path(spark, f"marts-{'-'.join(session_key(spark))}-{key}-{fp}"))
    return _stores[k]
