"""Metadata maps carried by every chunk. The keys are part of the output format."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _string_map(entries: dict[str, Column]) -> Column:
    parts = []
    for key, value in entries.items():
        parts += [F.lit(key), value.cast("string")]
    return F.create_map(*parts)


def post_metadata() -> Column:
    """Reads the post columns of the mart."""
    return _string_map(
        {
            "POST_AUTHOR": F.col("post_author"),
            "LINK_FLAIR_TEXT": F.col("link_flair_text"),
            "POST_ID": F.col("post_id"),
            "SUBREDDIT": F.col("subreddit"),
            "POST_URL": F.col("post_url"),
            "type": F.lit("post"),
        }
    )


def comment_metadata() -> Column:
    """Reads the comment columns of the mart."""
    return _string_map(
        {
            "COMMENT_ID": F.col("comment_id"),
            "COMMENT_AUTHOR": F.col("comment_author"),
            "COMMENT_PARENT_ID": F.col("comment_parent_id"),
            "COMMENT_PERMALINK": F.col("comment_permalink"),
            "SUBREDDIT": F.col("subreddit"),
            "POST_ID": F.col("post_id"),
            "type": F.lit("comment"),
        }
    )
