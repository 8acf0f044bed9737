"""Structured Streaming forms of the continuous loops: ingest, counters, sync, expiry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, folder: str, schema: StructType, per_batch: int = 1000) -> DataFrame:
    """New files of a folder, at most so many per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def ingest_once(stream: DataFrame, key: str, path: str, checkpoint: str, at: str | None = None, late: str = "7 days") -> StreamingQuery:
    """Idempotent ingest by id, across runs: the checkpoint holds what was seen.

    With an event-time column, ids are forgotten ``late`` after their time, so state is bounded.
    """
    rows = stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key]) if at else stream.dropDuplicates([key])
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def tumbling_counts(stream: DataFrame, at: str, width: str, late: str, by: list[str] | None = None) -> DataFrame:
    """Counts per window and key; a window is given out once the watermark has passed it."""
    window = F.window(at, width).alias("window")
    return stream.withWatermark(at, late).groupBy(window, *(by or [])).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *(by or []), "n")


def session_counts(stream: DataFrame, at: str, gap: str, late: str, by: list[str]) -> DataFrame:
    session = F.session_window(at, gap).alias("session")
    return stream.withWatermark(at, late).groupBy(session, *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("session.start").alias("start"), F.col("session.end").alias("end"), *by, "n")


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run what is there now, then stop; a second run goes on where the first ended."""
    return stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def sync(stream: DataFrame, send: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """High-water-mark sync to one target: the mark advances only when ``send`` returns.

    Each target has a query and a checkpoint of its own, so one that fails neither misses
    rows nor makes another receive them twice.
    """
    return stream.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def with_retries(send: Callable[[DataFrame, int], None], tries: int = 3) -> Callable[[DataFrame, int], None]:
    """Send a batch up to so many times; the last failure stops the query, before its mark."""

    def attempt(batch: DataFrame, number: int) -> None:
        for k in range(tries):
            try:
                return send(batch, number)
            except Exception:
                if k == tries - 1:
                    raise
        return None

    return attempt
