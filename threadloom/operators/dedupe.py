"""One row per key, chosen deterministically."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import stored

#: Most keys that are broadcast.
MAX_LISTED_KEYS = 200_000


def latest_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """Keeps the first row per key in ``order_by``; remaining columns break ties, except
    maps, which have no order.

    Each task cuts its own rows to one per key before the shuffle (a window group
    limit), so a key that holds much of the table sends one row per task.
    """
    ordered = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    ties = [F.col(c) for c in ordered if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*order_by, *ties)
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def latest_of_repeated(
    df: DataFrame, key: str, order_by: Sequence[Column], max_listed: int = MAX_LISTED_KEYS
) -> DataFrame:
    """:func:`latest_by_key` of a frame that can be read again, where few keys occur twice.

    A job that reads the key only finds those; their rows are shuffled and all others stay in
    place. With more of them than are broadcast, the whole frame is, and its result is stored.
    """
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
    repeated = stored(counts.where("_rows > 1").select("_key"), "repeated")
    n = repeated.count()
    if n > max_listed:
        return stored(latest_by_key(df, [key], order_by), "latest")
    if not n:
        return df
    same = F.col(key).eqNullSafe(F.col("_key"))
    once = df.join(F.broadcast(repeated), same, "left_anti")
    return once.unionByName(latest_by_key(df.join(F.broadcast(repeated), same, "left_semi"), [key], order_by))


def dedupe_records(df: DataFrame) -> DataFrame:
    """Posts or comments by id; the most recently created record survives."""
    return latest_by_key(df, ["id"], [F.col("created_utc").desc()])


def dedupe_landed(df: DataFrame) -> DataFrame:
    """The same for landed records, of which few occur twice in a run."""
    return latest_of_repeated(df, "id", [F.col("created_utc").desc()])


def merge_by_key(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """Union of two runs with one row per key."""
    return latest_by_key(
        current.unionByName(incoming, allowMissingColumns=True), keys, order_by
    )
