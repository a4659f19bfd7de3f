"""Dedupe with keyed state that expires, and a side output for what comes too late for it.

Keys are held from their first record until the watermark has passed it; the state is as large as the
disorder of the stream, not as its history. The keys of a shard and a stretch of event time share a
state and a timer, so a batch costs a call per stretch it touches and not one per key. A record
behind the watermark may be a copy of a key that is no longer held, so it is neither taken nor
dropped: it goes to the side output, which compares it with the table itself. A delay shorter than
the disorder costs lookups, never records.
"""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from threadloom.streaming.dedupe import append_unseen

#: The first records of keys, and records that came behind the watermark.
FIRST, LATE = "first", "late"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOfKey(StatefulProcessor):
    """Passes on the first record of each key of a shard and stretch, and all behind the watermark with a mark."""

    def __init__(self, key: str, millis: str, kind: str, stretch: int):
        self.key, self.millis, self.kind, self.stretch = key, millis, kind, stretch

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("keys", T.ArrayType(T.StringType()))]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), 0)
        # A call of the state is a trip to the JVM. A stretch behind the watermark holds late rows only.
        found = self.seen.get() if (key[1] + 1) * self.stretch > now else None
        held = set(found[0]) if found else set()
        before = len(held)
        for frame in rows:
            late = frame[self.millis] < now
            if late.any():
                yield frame[late].assign(**{self.kind: LATE})
            some = frame[~late]
            names = some[self.key].astype(str)
            # Which copy is the first of a batch does not hang on the order of arrival only where copies are equal.
            first = some[~names.isin(held) & ~names.duplicated()]
            if len(first):
                held.update(names[first.index])
                yield first.assign(**{self.kind: FIRST})
        if len(held) > before:
            self.seen.update((sorted(held),))
            if not before:
                self.handle.registerTimer((key[1] + 1) * self.stretch)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_of_key(
    stream: DataFrame, key: str, event_time: str, delay: str, stretch_seconds: int = 3600, shards: int = 8
) -> DataFrame:
    """The stream's rows with a column ``kind``: first records of their key, and late ones.

    All copies of a record share its event time. Rows without one count as late, since no watermark ever
    passes them. Column names must not begin with an underscore. Take as many shards as keep the keys of one
    in a stretch to some thousands, and stretches that hold that many: each that a batch touches costs tens of
    milliseconds in Python, however few rows it has. The session must keep streaming state in RocksDB (see :func:`use_rocksdb`).
    """
    time = F.col(event_time).cast("timestamp")
    marked = stream.withColumn("_time", F.coalesce(time, F.timestamp_seconds(F.lit(0)))).withWatermark("_time", delay)
    # In milliseconds, and no longer marked as the event time, so that late rows are not dropped before they are seen.
    millis = F.when(time.isNull(), -1).otherwise(F.unix_millis("_time"))
    stretch = 1000 * stretch_seconds
    rows = marked.withColumn("event_millis", millis).drop("_time")
    rows = rows.withColumn("key_shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))
    rows = rows.withColumn("time_stretch", F.floor(F.col("event_millis") / stretch).cast("long"))
    schema = T.StructType([*rows.schema.fields, T.StructField("kind", T.StringType())])
    processed = rows.groupBy("key_shard", "time_stretch").transformWithStateInPandas(
        statefulProcessor=FirstOfKey(key, "event_millis", "kind", stretch), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
    return processed.drop("event_millis", "key_shard", "time_stretch")


def use_rocksdb(spark) -> None:
    """Keep streaming state on the executors' disks, with changelogs in the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def append_first(path: str, key: str, day: str) -> Callable[[DataFrame, str], None]:
    """Batch writer of :func:`first_of_key`: first records are appended, late ones only if the table has not their key.

    Both land below ``path`` in folders named by the batch, so a repeated batch replaces itself.
    """
    late_writer = append_unseen(path, key, day)

    def write(batch: DataFrame, name: str) -> None:
        batch.persist()
        first = batch.where(F.col("kind") == FIRST).drop("kind")
        out = first.write.mode("overwrite").option("partitionOverwriteMode", "static")
        out.partitionBy(day).parquet(f"{path}/batch={name}")
        late = batch.where(F.col("kind") == LATE).drop("kind")
        if not late.isEmpty():
            late_writer(late, f"{name}-late")
        batch.unpersist()

    return write

