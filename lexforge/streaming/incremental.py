"""Skip-existing as a stream: new files are converted once, a checkpoint remembers which."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def convert_new(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, convert: Callable[[DataFrame], DataFrame]) -> None:
    """Convert the Parquet files under source that no earlier run has taken, appending to target, then stop."""
    rows = spark.readStream.schema(schema).parquet(source)
    query = convert(rows).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest_states(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Counts of states per day of an event stream (ts, state), late rows taken up to delay."""
    from pyspark.sql import functions as F

    return events.withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), "state").count()
