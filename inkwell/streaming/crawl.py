"""The crawl log as a stream: new tries from a folder of files, the first success of each url, counts an hour.

Late rows are taken for ``late`` after the newest event time, then left out; rows with a null time or url are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def crawl_stream(spark: SparkSession, folder: str, schema: StructType, files_a_batch: int = 100) -> DataFrame:
    """Parquet files as they arrive in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def first_successes(log: DataFrame, late: str = "30 days") -> DataFrame:
    """The first row of each url with status ok, within the watermark."""
    ok = log.where("status = 'ok' and url is not null and logged_at is not null").withWatermark("logged_at", late)
    return ok.dropDuplicatesWithinWatermark(["url"])


def hourly_counts(log: DataFrame, late: str = "30 days") -> DataFrame:
    """Tries and successes by hour and collection: begin, collection, tries, ok."""
    timed = log.where("logged_at is not null").withWatermark("logged_at", late)
    return timed.groupBy(F.window("logged_at", "1 hour").alias("w"), "collection").agg(
        F.count(F.lit(1)).alias("tries"), F.sum(F.when(F.col("status") == "ok", 1).otherwise(0)).alias("ok")
    ).select(F.col("w.start").alias("begin"), "collection", "tries", "ok")


def write_once(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """All that is there now, exactly once: a run takes up where the checkpoint of the last one ended."""
    return df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
