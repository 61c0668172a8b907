"""Structured Streaming into the store of accepted names, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..functions.names import name_key
from ..operators import dedup

STORE = "domain string, algorithm_code string, seq bigint, epoch bigint"


def insert_stream(spark: SparkSession, source: str, schema: T.StructType, store: str, checkpoint: str, name: str, code: str, order: str, files_per_batch: int = 1, normal: Callable[..., Column] = name_key) -> DataFrame:
    """Run all files of ``source`` through insert-or-ignore and return the store.

    Each micro-batch writes its new names under ``epoch=<id>``, overwriting what a failed attempt at
    the same batch left, so a restart from the checkpoint neither loses nor repeats names. The
    store is joined, never collected.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def absorb(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        rows = batch.select(normal(F.col(name)).alias("domain"), F.col(code).alias("algorithm_code"), F.col(order).cast("bigint").alias("seq"))
        fresh = dedup.insert_or_ignore(read_store(session, store, before=epoch), rows, "domain", "seq")
        fresh.write.mode("overwrite").parquet(f"{store}/epoch={epoch}")

    query = stream.writeStream.foreachBatch(absorb).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return read_store(spark, store)


def read_store(spark: SparkSession, store: str, before: int | None = None) -> DataFrame:
    """Accepted names, of the epochs in front of one if given; none if there is no store yet."""
    if not storage.exists(spark, store):
        return spark.createDataFrame([], STORE)
    rows = spark.read.schema(STORE).parquet(store)
    return rows if before is None else rows.where(F.col("epoch") < before)


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """``window_start, kind, n`` of tumbling windows; on a stream, rows later than ``lateness`` are dropped."""
    marked = events.withWatermark(time, lateness) if events.isStreaming else events
    return marked.groupBy(F.window(time, width).alias("w"), F.col(kind).alias("kind")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "kind", "n")
