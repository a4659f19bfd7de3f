"""Per-forum high watermarks kept up by a stream."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from threadloom.operators.incremental import newer_than_watermark, next_watermarks
from threadloom.sinks.state import upsert_watermarks
from threadloom.sources.state import read_watermarks


def append_newer(
    path: str, state_path: str, created: Column, forum: str = "subreddit"
) -> Callable[[DataFrame, str], None]:
    """Batch writer that keeps rows newer than their forum's watermark and advances it.

    Rows at or before the watermark of the earlier batches are dropped. The kept
    rows are written first and the new watermarks taken from them; both are keyed
    by the batch name, so repeating a batch gives the same table and state.
    """

    def write(batch: DataFrame, name: str) -> None:
        spark = batch.sparkSession
        state = read_watermarks(spark, state_path, name)
        state = state.withColumnRenamed("subreddit", forum)
        kept = newer_than_watermark(batch, state, created, forum)
        folder = f"{path}/batch={name}"
        kept.write.mode("overwrite").parquet(folder)
        written = spark.read.schema(batch.schema).parquet(folder)
        advanced = next_watermarks(written, created, forum)
        advanced = advanced.withColumnRenamed(forum, "subreddit")
        upsert_watermarks(spark, state_path, advanced, name)

    return write
