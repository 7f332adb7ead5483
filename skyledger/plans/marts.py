"""The mart chain as one lazily composed object.

``Marts`` wires raw inputs -> staging -> intermediate -> marts.  Each
property is a lazy DataFrame; nothing runs until an action, so a report that
needs only ``facts`` plans only the daily chain.  ``stamps=False`` leaves out
the load / update timestamps (non-deterministic columns) for comparisons.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from . import bridge, layers


class Marts:
    def __init__(self, raw_daily: DataFrame, raw_hourly: DataFrame | None, locations: DataFrame,
                 daily_order=None, hourly_order=None, stamps: bool = True):
        self.raw_daily = raw_daily
        self.raw_hourly = raw_hourly
        self.locations = locations
        self.daily_order = daily_order
        self.hourly_order = hourly_order
        self.stamps = stamps

    @cached_property
    def stg_daily(self) -> DataFrame:
        return layers.stg_daily(self.raw_daily, self.daily_order, loaded_at=self.stamps)

    @cached_property
    def enriched(self) -> DataFrame:
        return layers.daily_enriched(self.stg_daily, self.locations)

    @cached_property
    def facts(self) -> DataFrame:
        return layers.daily_facts(self.enriched, updated_at=self.stamps)

    @cached_property
    def alerts(self) -> DataFrame:
        return layers.alerts(self.facts)

    @cached_property
    def stg_hourly(self) -> DataFrame:
        return layers.stg_hourly(self.raw_hourly, self.hourly_order, loaded_at=self.stamps)

    @cached_property
    def hourly_facts(self) -> DataFrame:
        return layers.hourly_facts(self.stg_hourly, self.locations, updated_at=self.stamps)


def from_test_tables(spark: SparkSession, sf_dir: str, stamps: bool = False) -> Marts:
    """Marts over the driver's test tables (see ``bridge``)."""
    return Marts(bridge.raw_daily(spark, sf_dir), bridge.raw_hourly(spark, sf_dir),
                 bridge.locations(spark, sf_dir), bridge.daily_order(), bridge.hourly_order(), stamps)
