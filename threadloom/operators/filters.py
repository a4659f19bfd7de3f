"""Row filters."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom import defaults
from threadloom.functions import text as X
from threadloom.functions.times import as_literal


def drop_low_quality(
    posts: DataFrame, column: str = "selftext", min_chars: int = defaults.MIN_POST_CHARS
) -> DataFrame:
    return posts.where(~X.is_low_quality(F.col(column), min_chars))


def drop_removed(comments: DataFrame, column: str = "body") -> DataFrame:
    return comments.where(~X.is_removed(F.col(column)))


def top_level_only(comments: DataFrame) -> DataFrame:
    """Direct replies to a post; a null depth is dropped."""
    return comments.where(F.col("depth") == 0)


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.where(X.is_non_empty(F.col(column)))


def rolling_window(
    df: DataFrame,
    column: str = "created_at",
    as_of: datetime | Column | None = None,
    days: int = defaults.INDEX_WINDOW_DAYS,
) -> DataFrame:
    """Rows of the last ``days`` days. The bound is a constant, so it reaches the scan."""
    kind = df.schema[column].dataType.simpleString()
    since = (as_literal(as_of) - F.make_dt_interval(days=F.lit(days))).cast(kind)
    return df.where(F.col(column) >= since)


def by_metadata(
    df: DataFrame,
    subreddits: list[str] | None = None,
    since: datetime | Column | None = None,
    until: datetime | Column | None = None,
    forum: str = "subreddit",
    created_at: str = "created_at",
) -> DataFrame:
    """Forum and date filter; on a table partitioned by them it prunes folders."""
    if subreddits is not None:
        df = df.where(F.col(forum).isin(*subreddits))
    if since is not None:
        df = df.where(F.col(created_at) >= F.lit(since))
    if until is not None:
        df = df.where(F.col(created_at) < F.lit(until))
    return df


def keyword_search(df: DataFrame, column: str, term: str) -> DataFrame:
    """Rows whose text contains the term, ignoring case."""
    return df.where(X.contains_term(F.col(column), term))


def word_search(df: DataFrame, column: str, words: list[str]) -> DataFrame:
    """Rows that have any of the words as a whole word, ignoring case."""
    return df.where(X.contains_any_word(F.col(column), words))


def min_relevance(
    df: DataFrame, score: str = "score", threshold: float = defaults.MIN_RELEVANCE
) -> DataFrame:
    return df.where(F.col(score) >= threshold)
