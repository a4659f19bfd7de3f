"""State writes. A version is written beside the one being read and counts once complete."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.times import as_literal
from threadloom.operators.incremental import merge_watermarks
from threadloom.sources import paths
from threadloom.sources.state import read_watermarks

KEEP_VERSIONS = 20


def upsert_watermarks(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    writer: str,
    as_of: datetime | Column | None = None,
    keep: int = KEEP_VERSIONS,
) -> int:
    """Fold new per-forum watermarks into the state; returns the version written.

    ``writer`` names the run or streaming batch. If the newest version is its own, this
    is a repeat and replaces it. Versions more than ``keep`` behind are deleted.
    """
    versions = paths.complete_versions(spark, path)
    number = versions[-1].number + 1 if versions else 0
    if versions and versions[-1].writer == writer:
        number = versions[-1].number
    fresh = new.select(
        "subreddit", "last_ingested_utc", as_literal(as_of).cast("timestamp").alias("updated_at")
    )
    merged = merge_watermarks(read_watermarks(spark, path, writer), fresh)
    merged.write.mode("overwrite").parquet(paths.version_folder(path, number, writer))
    for outdated in paths.complete_versions(spark, path)[:-keep]:
        paths.delete(spark, outdated.folder)
    return number


def add_completed(path: str, ids: DataFrame, batch: str) -> None:
    """Record finished post ids; repeating a batch replaces what it wrote."""
    ids.select(F.col("id").cast("string").alias("id")).distinct().write.mode(
        "overwrite"
    ).parquet(f"{path}/batch={batch}")
