"""Incremental file ingest: each file is read once, progress lives in the checkpoint."""

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    kind: str = "json",
    files_per_batch: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """New files below a folder as a stream."""
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def run_available(
    stream: DataFrame, checkpoint: str, write_batch: Callable[[DataFrame, str], None]
) -> StreamingQuery:
    """Process what has arrived, batch by batch, and stop. Running it again resumes.

    An interrupted batch is repeated. ``write_batch`` gets a name with it that is the
    same in the repeat and never given to another batch, also not after a start from
    a new checkpoint, and must replace what it wrote under that name.
    """

    ids: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not ids:  # the same for all batches of a checkpoint
            metadata = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()
            ids.append(json.loads(metadata[0])["id"])
        write_batch(batch, f"{ids[0]}-{batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
