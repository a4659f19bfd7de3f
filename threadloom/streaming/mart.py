"""The mart as a stream: posts and comments joined as they arrive.

A comment meets its post if its time lies within bounds around the post's. State holds what
can still meet: when the watermarks of both streams have passed a post's last moment for comments,
the post leaves, with nulls if none came. Copies of an id are dropped as long as the watermark
has not passed them; the first one counts.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators import filters
from threadloom.operators.cleaning import with_clean_text
from threadloom.plans import transform
from threadloom.schemas import PROCESSED_COMMENT, PROCESSED_POST


def _unique(staged: DataFrame, delay: str) -> DataFrame:
    """Staged rows under a watermark, one per id."""
    timed = staged.withColumn("created_at", F.col("created_at").cast("timestamp")).withWatermark("created_at", delay)
    return timed.dropDuplicatesWithinWatermark(["id"])


def stream_mart(posts: DataFrame, comments: DataFrame, delay: str, before: str, after: str) -> DataFrame:
    """Raw streams of posts and comments -> one row per comment with its post's columns; posts without comments stay.

    ``delay`` is how far records may come out of order; later ones are dropped. A comment counts from
    ``before`` its post's time to ``after`` it, both intervals such as ``2 hours``, so that a post need not
    be held for ever. A post without comments comes out once both streams have passed it by ``after`` and ``delay``.
    """
    cleaned = with_clean_text(posts, "selftext", "clean_selftext").select(*PROCESSED_POST.names)
    top = filters.top_level_only(comments)
    answers = with_clean_text(top, "body", "clean_body").select(*PROCESSED_COMMENT.names)
    left = _unique(transform.stage_posts(cleaned), delay).select(*[F.col(a).alias(b) for a, b in transform.MART_POST_COLUMNS])
    right = _unique(transform.stage_comments(answers), delay).select(
        *[F.col(a).alias(b) for a, b in transform.MART_COMMENT_COLUMNS], F.col("parent_post_id").alias("_parent")
    )
    met = (
        (F.col("post_id") == F.col("_parent"))
        & (F.col("comment_created_at") >= F.col("post_created_at") - F.expr(f"interval {before}"))
        & (F.col("comment_created_at") <= F.col("post_created_at") + F.expr(f"interval {after}"))
    )
    joined = left.join(right, met, "left").drop("_parent")
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("post_created_at", "comment_created_at")}
    return joined.withColumns(times)
