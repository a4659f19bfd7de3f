"""Joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000
MAX_LISTED_KEYS = 10_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and how many shares of that size they make.

    Counts are combined before the shuffle. At most ``rows / hot_rows`` keys qualify.
    """
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
    return counts.where(F.col("_key").isNotNull() & (F.col("_rows") > hot_rows)).select(
        "_key", F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_shares")
    )


def left_join_one_to_many(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_on: list[str],
    hot_rows: int | None = HOT_ROWS,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Left outer equi-join whose right side may be dominated by a few keys.

    Adaptive execution can split a hot partition of the preserved (left) side only.
    So the right side is counted per key first, in a job that reads just the key and
    combines counts before its shuffle. Without hot keys this is the plain join. Otherwise the rows of a hot key are
    spread over shares by a hash of ``spread_on`` and its left rows are repeated
    once per share; as a hot key always has a match, the shares that stay empty
    are recognised by their null right side and dropped.

    ``count_from`` may name a cheaper frame to count first, one with the same key
    column and at least the rows of the right side, such as the raw records behind it;
    the right side itself is then counted only for the keys that are hot there.

    Both sides must have distinct column names. ``hot_rows=None`` never counts.
    """
    matches = F.col(left_key) == F.col(right_key)
    spark = left.sparkSession
    key_type = right.schema[right_key].dataType.simpleString()

    def shares_of(df: DataFrame) -> DataFrame | None:
        # One entry stands for more than hot_rows rows; a list that is long all the same
        # stays a frame for Spark to join as it sees fit.
        frame = hot_keys(df, right_key, hot_rows)
        hot = frame.limit(MAX_LISTED_KEYS + 1).collect()
        if not hot:
            return None
        if len(hot) > MAX_LISTED_KEYS:
            return frame
        return F.broadcast(spark.createDataFrame(hot, f"_key {key_type}, _shares int"))

    shares = None
    counted = right if count_from is None else count_from
    if hot_rows is not None:
        shares = shares_of(counted)
        if shares is not None and count_from is not None:
            is_candidate = F.col(right_key) == F.col("_key")
            shares = shares_of(right.join(shares, is_candidate, "left_semi"))
    if shares is None:
        return left.join(right, matches, "left")

    def with_shares(df: DataFrame, key: str) -> DataFrame:
        return df.join(shares, F.col(key) == F.col("_key"), "left").drop("_key")

    spread_left = with_shares(left, left_key).withColumn(
        "_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1))
    )
    spread_right = with_shares(right, right_key).select(
        *right.columns,
        F.lit(True).alias("_matched"),
        F.pmod(F.xxhash64(*spread_on), F.coalesce("_shares", F.lit(1)))
        .cast("int")
        .alias("_right_share"),
    )
    joined = spread_left.join(
        spread_right, matches & (F.col("_share") == F.col("_right_share")), "left"
    )
    return joined.where(F.col("_shares").isNull() | F.col("_matched")).select(
        *left.columns, *right.columns
    )


def not_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``known``; the known keys are made distinct before the shuffle."""
    return df.join(known.select(key).distinct(), key, "left_anti")
