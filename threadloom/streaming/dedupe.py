"""Replay-safe dedupe."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.operators.dedupe import latest_by_key
from threadloom.operators.joins import not_known
from threadloom.sources import paths

MAX_LISTED_DAYS = 1000


def dedupe_within(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """First record per key, with state bounded by ``delay`` in event time.

    Records later than ``delay`` behind the newest event seen are dropped, first-seen
    ones included, so the delay must cover all disorder of the stream. Where that has
    no bound, use :func:`append_unseen`, which loses nothing.
    """
    return (
        stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
        .withWatermark(event_time, delay)
        .dropDuplicatesWithinWatermark([key])
    )


def append_unseen(path: str, key: str, day: str) -> Callable[[DataFrame, str], None]:
    """Batch writer that adds the records whose key no earlier batch wrote.

    It compares with the table itself, so a replay is recognised however late it
    comes, and a repeated batch replaces its own folder only. One stream at a time
    may write to the table. The table is partitioned by ``day``, a column that every
    copy of a record shares, null included, and only the days of the batch are
    compared, not the whole history.
    """

    def write(batch: DataFrame, name: str) -> None:
        spark = batch.sparkSession
        fresh = latest_by_key(batch, [key], [])
        if paths.exists(spark, f"{path}/batch=*/_SUCCESS"):
            fields = [batch.schema[key], batch.schema[day], T.StructField("batch", T.StringType())]
            table = spark.read.schema(T.StructType(fields)).option("basePath", path)
            earlier = table.parquet(f"{path}/batch=*").where(F.col("batch") != name)
            days = batch.select(F.col(day).alias("_day")).distinct()
            some = [r[0] for r in days.limit(MAX_LISTED_DAYS + 1).collect()]
            if len(some) <= MAX_LISTED_DAYS:  # the list prunes folders
                listed = F.col(day).isin([d for d in some if d is not None])
                earlier = earlier.where(listed | F.col(day).isNull() if None in some else listed)
            else:
                earlier = earlier.join(days, F.col(day).eqNullSafe(F.col("_day")), "left_semi")
            fresh = not_known(fresh, earlier, key)
        out = fresh.write.mode("overwrite").option("partitionOverwriteMode", "static")
        out.partitionBy(day).parquet(f"{path}/batch={name}")

    return write
