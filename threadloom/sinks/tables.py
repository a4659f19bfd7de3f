"""Writes. Rows are rebalanced on the partition columns, so a hot forum is split over
several files and small ones do not leave one file per task."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.times import as_literal
from threadloom.operators.dedupe import latest_by_key, merge_by_key
from threadloom.sources import paths

MAX_LISTED = 1000


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """Parquet partitioned by columns; an overwrite replaces only the partitions it writes."""
    (
        df.hint("rebalance", *by)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def merge_partitions(
    incoming: DataFrame, path: str, keys: list[str], by: list[str], order_by: list[Column]
) -> None:
    """Fold rows into a partitioned table, one row per key, rewriting only the partitions
    they fall into. A key must not move between partitions.

    Only those partitions are read: their values of the first partition column prune the
    scan, unless there are more of them than a filter should list.
    """
    spark = incoming.sparkSession
    merged = latest_by_key(incoming, keys, order_by)
    if paths.exists(spark, f"{path}/{by[0]}=*"):
        touched = incoming.select(*by).distinct()
        current = spark.read.schema(incoming.schema).parquet(path)
        values = [r[0] for r in touched.select(by[0]).distinct().limit(MAX_LISTED + 1).collect()]
        if len(values) <= MAX_LISTED:
            listed = F.col(by[0]).isin([v for v in values if v is not None])
            current = current.where(listed | F.col(by[0]).isNull() if None in values else listed)
        same = [F.col(f"c.{c}").eqNullSafe(F.col(f"t.{c}")) for c in by]
        current = current.alias("c").join(touched.alias("t"), same, "left_semi")
        merged = merge_by_key(current, incoming, keys, order_by)
    write_partitioned(merged, path, by)


def with_forum_date(df: DataFrame, created_at: str = "created_at") -> DataFrame:
    """Adds ``date``, for tables partitioned by forum and day."""
    return df.withColumn("date", F.to_date(created_at))


def write_raw(df: DataFrame, path: str, run: str) -> str:
    """Newline-delimited JSON, one folder per run, so a later run never replaces it."""
    folder = f"{path}/run={run}"
    df.write.mode("overwrite").json(folder)
    return folder


def with_ingested_at(df: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    return df.withColumn("ingested_at", as_literal(as_of).cast("timestamp_ntz"))


def append_staging(df: DataFrame, path: str, as_of: datetime | Column | None = None) -> None:
    """Append rows with their load time. A replay appends them again; read the table
    through :func:`current_rows`."""
    lowered = df.toDF(*[c.lower() for c in df.columns])
    with_ingested_at(lowered, as_of).write.mode("append").parquet(path)


def append_table(df: DataFrame, table: str, as_of: datetime | Column | None = None) -> None:
    """:func:`append_staging` into a catalog table."""
    lowered = df.toDF(*[c.lower() for c in df.columns])
    with_ingested_at(lowered, as_of).write.mode("append").saveAsTable(table)


def current_rows(staged: DataFrame, key: str = "id") -> DataFrame:
    """The last loaded row of every key of an append-only table."""
    return latest_by_key(staged, [key], [F.col("ingested_at").desc()])


def save_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)
