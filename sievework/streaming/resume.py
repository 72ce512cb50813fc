"""Stages as streams: new files of attempts or grades come in, running tables come out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievework.operators import verdicts


def file_stream(spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", per_trigger: int = 100) -> DataFrame:
    """Files as they arrive in a folder, a bounded number per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(folder)


def verdict_counts(attempts: DataFrame, late: str = "2 hours", every: str = "1 hour") -> DataFrame:
    """Right and wrong verdicts per model and hour of event time; what comes later than ``late`` is left out."""
    facts = verdicts.facts(attempts, "verifier_result", ["model", "loaded_at"]).withWatermark("loaded_at", late)
    return facts.groupBy(F.window("loaded_at", every), "model").agg(F.count_if(F.col("verified") == 1).alias("correct"), F.count_if(F.col("verified") == 0).alias("incorrect"))


def unseen(stream: DataFrame, key: str, time: str, within: str = "1 day") -> DataFrame:
    """Rows whose key did not come before within the watermark (deliveries repeated under the same key)."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def each_batch(stream: DataFrame, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Runs a batch plan on every micro-batch; a batch that runs again replaces its own output."""

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
