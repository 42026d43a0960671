"""Incremental ingestion: records arrive as a stream; late versions replace early ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textmill.operators.corpus import latest


def deduplicate(stream: DataFrame, keys: list[str], changed: str = "changed", delay: str = "1 day") -> DataFrame:
    """One row for each key while the watermark holds it."""
    return stream.withColumn(changed, F.to_timestamp(changed)).withWatermark(changed, delay).dropDuplicatesWithinWatermark(keys)


def changes_by_window(stream: DataFrame, changed: str = "changed", width: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Records in each window of change time."""
    return stream.withColumn(changed, F.to_timestamp(changed)).withWatermark(changed, delay).groupBy(F.window(changed, width)).agg(F.count("*").alias("records"))


def upsert_stream(stream: DataFrame, table: str, checkpoint: str, keys: list[str], order: list[str]) -> StreamingQuery:
    """Append each batch's latest versions, marked with the batch, to a Parquet table; `current` reads it.

    A repeated batch writes the same folder again, so a restart neither loses nor doubles records.
    """

    def write(batch: DataFrame, number: int) -> None:
        latest(batch, keys, order).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(history: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest version of each key."""
    return latest(history, keys, [*order, "batch"]).drop("batch")
