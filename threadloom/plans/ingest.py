"""Incremental ingest of landed API responses, all forums in one job."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.operators import filters, incremental, ranking
from threadloom.operators.joins import not_known
from threadloom.sinks import state as state_sinks
from threadloom.sinks import tables as sinks
from threadloom.sources import files, listings, paths, state


def eligible_posts(
    pages: DataFrame, watermarks: DataFrame, known: DataFrame | None = None
) -> DataFrame:
    """Listed posts that have enough text, are newer than their forum's watermark and not known."""
    posts = filters.drop_low_quality(listings.unnest_listing(pages))
    recent = incremental.newer_than_watermark(posts, watermarks)
    return recent if known is None else not_known(recent, known, "id")


def new_posts(
    pages: DataFrame,
    watermarks: DataFrame,
    max_posts: int | None = None,
    known: DataFrame | None = None,
    page_order: str = "page",
) -> DataFrame:
    """The eligible posts; with ``max_posts``, the first ones per forum in listing order.

    Known posts do not count towards the cap.
    """
    posts = eligible_posts(pages, watermarks, known)
    if max_posts is not None:
        order = [F.col(page_order), F.col("position")]
        posts = ranking.first_posts(posts, order, max_posts)
    return posts.select(*schemas.POST.names)


def safe_watermarks(kept: DataFrame, eligible: DataFrame) -> DataFrame:
    """The newest kept post per forum that is older than every post cut from it.

    A watermark below the oldest cut post lets the next run find it; kept posts above
    the watermark are known by then.
    """
    created = F.coalesce("created_utc", F.lit(float("-inf")))
    cut = (
        not_known(eligible.select("id", "subreddit", "created_utc"), kept, "id")
        .groupBy(F.col("subreddit").alias("_forum"))
        .agg(F.min(created).alias("_oldest"))
    )
    below = kept.join(cut, F.col("subreddit") == F.col("_forum"), "left").where(
        F.col("_oldest").isNull() | (F.col("created_utc") < F.col("_oldest"))
    )
    return incremental.next_watermarks(below)


def comments_with_resume(
    posts: DataFrame,
    envelopes: DataFrame,
    completed: DataFrame,
    fetched: DataFrame,
    limit: int | None = None,
) -> DataFrame:
    """Comments of the posts: those already fetched, and those of the remaining posts."""
    remaining = not_known(posts.select("id"), completed, "id")
    pending = envelopes.join(remaining, envelopes["post_id"] == remaining["id"], "left_semi")
    fresh = listings.unnest_comments(pending, limit=limit)
    return fetched.select(*schemas.COMMENT.names).unionByName(fresh)


def run_ingest(
    spark: SparkSession,
    pages: DataFrame,
    envelopes: DataFrame,
    root: str,
    run: str,
    max_posts: int | None = None,
    comment_limit: int | None = None,
    progress: str | None = None,
    as_of: datetime | Column | None = None,
) -> bool:
    """Write the new posts and their comments as raw JSON and advance the watermarks.

    Returns False, leaving the state as it is, if no forum has a new post. Posts of
    other runs are known by id and left out. ``progress`` names the files of an
    interrupted comment download to resume from. The posts are written before
    anything is derived from them, so later steps read them back instead of
    computing them again. A run that failed half way can be repeated under its
    name: it starts over unless both files are complete, then it only brings the
    watermarks up to date. With ``max_posts``, a watermark stays below the oldest post
    that the cap left out, so a later run finds it.
    """
    watermark_path = f"{root}/state/watermarks"
    known_path = f"{root}/state/known"
    marks_path = f"{root}/state/marks/run={run}"
    folder = f"{root}/posts/run={run}"
    if not paths.exists(spark, f"{known_path}/batch={run}/_SUCCESS"):
        watermarks = state.read_watermarks(spark, watermark_path, run)
        known = state.read_completed_ids(spark, known_path, except_batch=run)
        posts = new_posts(pages, watermarks, max_posts, known)
        sinks.write_raw(posts, f"{root}/posts", run)
        posts = files.read_posts(spark, folder)
        if posts.isEmpty():
            return False
        if max_posts is None:
            marks = incremental.next_watermarks(posts)
        else:
            marks = safe_watermarks(posts, eligible_posts(pages, watermarks, known))
        marks.write.mode("overwrite").parquet(marks_path)
        if progress is None:
            completed = spark.createDataFrame([], "id string")
            fetched = spark.createDataFrame([], schemas.COMMENT)
        else:
            completed, fetched = state.read_progress(spark, progress)
        comments = comments_with_resume(posts, envelopes, completed, fetched, comment_limit)
        sinks.write_raw(comments, f"{root}/comments", run)
        state_sinks.add_completed(known_path, posts.select("id"), run)

    latest = spark.read.schema("subreddit string, last_ingested_utc timestamp").parquet(marks_path)
    state_sinks.upsert_watermarks(spark, watermark_path, latest, run, as_of)
    return True
