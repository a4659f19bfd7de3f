"""Texts of ranked rows assembled into one document per key.

The rows come out of a top-n operator, so what is collected per key is bounded.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.ranking import best_comments_first, first_per_group


def assemble(
    ranked: DataFrame, key: str, text: str, rank: str = "rank", separator: str = "\n"
) -> DataFrame:
    """The texts of every key joined in rank order, as ``context``."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(rank), F.col(text).alias("text"))))
    return ranked.groupBy(key).agg(F.concat_ws(separator, parts["text"]).alias("context"))


def post_context(mart: DataFrame, n: int, separator: str = "\n") -> DataFrame:
    """Title, body and best comments of every post as one document.

    One scan and one shuffle: the mart rows of a post are cut to the best ones, which
    carry the post's own columns along.
    """
    rows = mart.select(
        "post_id", "post_title", "post_body", "comment_id", "comment_score", "comment_body"
    )
    # A post without comments has one row, and n = 0 still needs one for the post.
    best = first_per_group(rows, ["post_id"], best_comments_first(), max(n, 1))
    text = F.when(F.col("rank") <= n, F.col("comment_body"))
    parts = F.array_sort(F.collect_list(F.struct("rank", text.alias("text"))))
    posts = best.groupBy("post_id").agg(
        F.first("post_title").alias("post_title"),
        F.first("post_body").alias("post_body"),
        parts["text"].alias("_comments"),
    )
    context = F.concat_ws(separator, "post_title", "post_body", "_comments")
    return posts.select("post_id", context.alias("context"))
