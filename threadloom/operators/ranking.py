"""First rows per group and ordered limits.

Each filter on ``row_number`` lets Spark cut every task's rows to the first N per
group before the shuffle, so no group arrives whole at one task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom import defaults


def first_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    n: int,
    rank: str = "rank",
) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def first_posts(
    posts: DataFrame,
    listing_order: Sequence[Column],
    max_posts: int,
    forum: str = "subreddit",
) -> DataFrame:
    """The first posts of every forum in listing order."""
    return first_per_group(posts, [forum], listing_order, max_posts, "_rank").drop("_rank")


def best_comments_first() -> list[Column]:
    """The order of a post's comments; unscored ones come last."""
    return [F.col("comment_score").desc_nulls_last(), F.col("comment_id")]


def top_comments(mart: DataFrame, n: int) -> DataFrame:
    """The best-scored comments of every post, from mart rows."""
    commented = mart.where(F.col("comment_id").isNotNull())
    return first_per_group(commented, ["post_id"], best_comments_first(), n)


def last_turns(
    conversations: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    n: int = defaults.MEMORY_TURNS,
) -> DataFrame:
    """The most recent turns of every conversation."""
    return first_per_group(
        conversations, [conversation], [F.col(turn).desc()], n, "recency"
    )


def ordered_limit(
    df: DataFrame, order_by: Sequence[Column], n: int = defaults.PREVIEW_ROWS
) -> DataFrame:
    """A reproducible first N rows; every task sends at most N."""
    return df.orderBy(*order_by).limit(n)
