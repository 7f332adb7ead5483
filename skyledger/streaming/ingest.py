"""Structured Streaming jobs (ST1-ST4).

The batch high-water-mark load becomes a file-source stream with a
checkpoint (exactly-once file tracking; a restarted or failed run resumes from
the checkpoint); the key upsert of the marts becomes a ``foreachBatch`` sink;
the lookback windows become event-time watermarks.  Checkpoints live in the
shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import API_DOCUMENT
from ..session import scratch_path
from ..sinks.tables import upsert_latest_partitions, upsert_partitions
from ..sources.api_json import flatten_daily, flatten_hourly


def read_landing(spark: SparkSession, landing: str, fmt: str = "json", schema=API_DOCUMENT,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of landed files with a declared schema."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.format(fmt).load(landing)


def stream_ingest(spark: SparkSession, landing: str, sink: str, checkpoint: str | None = None,
                  block: str = "hourly", extracted_at: Column | None = None,
                  available_now: bool = True) -> StreamingQuery:
    """ST1: landed documents -> flattened raw rows appended to a Parquet table.

    Each document is stamped with its processing time unless ``extracted_at``
    is given; ``availableNow`` processes every new file and stops.
    """
    docs = read_landing(spark, landing)
    ts = extracted_at if extracted_at is not None else F.current_timestamp()
    rows = flatten_hourly(docs, ts) if block == "hourly" else flatten_daily(docs, ts)
    part = "timestamp" if block == "hourly" else "date"
    rows = rows.withColumn("part_date", F.to_date(part))
    w = (rows.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"ckpt-ingest-{block}"))
         .partitionBy("part_date").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def upsert_batch(target_path: str, keys: Sequence[str], order: Sequence[Column],
                 partition_col: str = "part_date"):
    """ST2 batch function: latest row per key across the micro-batch and the
    target partitions it touches (see ``sinks.upsert_latest_partitions``).

    Staged then swapped in per partition, so a failed batch leaves the previous
    version intact and a replay of the same batch gives the same result.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_latest_partitions(batch.sparkSession, target_path, batch, keys, order, partition_col)
    return run


def stream_upsert(stream: DataFrame, target_path: str, keys: Sequence[str], order: Sequence[Column],
                  checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """ST2: streaming upsert by key via ``foreachBatch`` (latest extraction wins)."""
    w = (stream.writeStream.foreachBatch(upsert_batch(target_path, keys, order))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def with_lateness(stream: DataFrame, col: str = "observed_at", days: int = 4) -> DataFrame:
    """ST3: accept rows up to ``days`` late (4 hourly / 35 daily) via an event-time watermark."""
    return stream.withWatermark(col, f"{days} days")


def daily_means(stream: DataFrame, col: str = "timestamp", days: int = 4, key: str = "location_id",
                value: str = "temperature_2m") -> DataFrame:
    """ST3: rows, non-NULL values and their sum per ``key`` and day, as event-time state over all triggers.

    A row is late, and dropped, once its day has ended ``days`` or more before the newest event time of the earlier triggers;
    state of days that have ended is evicted by the same mark, so it holds the days within the lateness only.  In update mode
    every trigger returns the days that changed.
    """
    s = with_lateness(stream, col, days)
    return s.groupBy(key, F.window(col, "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_values"),
        F.sum(F.col(value).cast("decimal(18,3)")).alias("total")).select(
        key, F.col("w.start").cast("date").alias("day"), "n_rows", "n_values", "total")


def stream_days(days: DataFrame, target_path: str, checkpoint: str, key: str = "location_id",
                available_now: bool = True) -> StreamingQuery:
    """ST3: the changed days of every trigger replace the stored ones (partitioned by month; ``stored.upsert_table``)."""
    from ..sinks.stored import upsert_table

    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch.sparkSession, target_path,
                     batch.withColumn("part_month", F.date_format("day", "yyyy-MM")), "part_month", [key, "day"])
    w = days.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_dedup(stream: DataFrame, keys: Sequence[str], col: str = "timestamp", days: int = 4) -> DataFrame:
    """ST4 (+ST3): drop re-sent observations, also those of later triggers; the first copy wins.

    A key stays in the state until the watermark has passed its time by ``days``; a copy that comes later than that is late
    itself and dropped as such, so no copy gets through and the state holds the last ``2 * days`` days of keys.
    """
    return with_lateness(stream, col, days).dropDuplicatesWithinWatermark(list(keys))


def merge_facts_batch(target_path: str, key: str = "surrogate_key", partition_col: str = "part_month"):
    """ST2 for the fact marts: merge each micro-batch of facts on the surrogate key."""
    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_partitions(batch.sparkSession, target_path, batch, key, partition_col)
    return run
