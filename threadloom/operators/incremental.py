"""Incremental ingest: high watermarks per forum and progress by id."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.times import epoch_to_timestamp


def newer_than_watermark(
    posts: DataFrame,
    watermarks: DataFrame,
    created: Column | None = None,
    forum: str = "subreddit",
) -> DataFrame:
    """Rows strictly newer than their forum's watermark; forums without one keep all.

    It is set based: the order of a listing does not matter. One row per forum is
    joined, which is broadcast while it is small; beyond that, adaptive execution
    splits a hot forum, as the posts are the preserved side.
    """
    created = epoch_to_timestamp(F.col("created_utc")) if created is None else created
    state = watermarks.select(
        F.col(forum).alias("_forum"), F.col("last_ingested_utc").alias("_since")
    )
    return (
        posts.withColumn("_created", created)
        .join(state, F.col(forum) == F.col("_forum"), "left")
        .where(F.col("_since").isNull() | (F.col("_created") > F.col("_since")))
        .drop("_forum", "_since", "_created")
    )


def next_watermarks(
    posts: DataFrame, created: Column | None = None, forum: str = "subreddit"
) -> DataFrame:
    """The newest creation time per forum; forums without posts do not appear."""
    created = epoch_to_timestamp(F.col("created_utc")) if created is None else created
    return posts.groupBy(forum).agg(F.max(created).alias("last_ingested_utc"))


def merge_watermarks(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per forum, never moving backwards, kept to whole seconds."""
    return (
        old.unionByName(new)
        .groupBy("subreddit")
        .agg(
            F.date_trunc("second", F.max("last_ingested_utc")).alias("last_ingested_utc"),
            F.date_trunc("second", F.max("updated_at")).alias("updated_at"),
        )
    )


def progress_counts(
    posts: DataFrame, completed: DataFrame, key: str = "id", by: list[str] | None = None
) -> DataFrame:
    """How many posts are done and how many remain."""
    done = completed.select(key).distinct().withColumn("_done", F.lit(True))
    return (
        posts.join(done, key, "left")
        .groupBy(*(by or []))
        .agg(
            F.count_if("_done").alias("done"),
            F.count_if(F.col("_done").isNull()).alias("remaining"),
        )
    )
