"""Ingest state: watermarks and progress. Missing or unreadable state means a first run."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.functions.times import parse_utc
from threadloom.sources import paths


def read_watermarks(spark: SparkSession, path: str, writer: str | None = None) -> DataFrame:
    """Watermarks of the newest complete version.

    A ``writer`` (a run or streaming batch) that is being repeated does not see the
    version it wrote itself.
    """
    versions = paths.complete_versions(spark, path)
    if versions and versions[-1].writer == writer:
        versions.pop()
    if not versions:
        return spark.createDataFrame([], schemas.WATERMARK)
    return (
        spark.read.schema(schemas.WATERMARK)
        .option("ignoreCorruptFiles", True)
        .parquet(versions[-1].folder)
    )


def read_watermark_json(spark: SparkSession, path: str) -> DataFrame:
    """Watermarks kept as one JSON object per file; files that do not parse are skipped."""
    if not paths.exists(spark, path):
        return spark.createDataFrame([], schemas.WATERMARK)
    raw = (
        spark.read.schema("subreddit string, last_ingested_utc string, updated_at string")
        .option("multiLine", True)
        .json(path)
    )
    return raw.select(
        "subreddit",
        parse_utc(F.col("last_ingested_utc")).alias("last_ingested_utc"),
        parse_utc(F.col("updated_at")).alias("updated_at"),
    ).where(F.col("subreddit").isNotNull() & F.col("last_ingested_utc").isNotNull())


def read_progress(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(completed post ids, comments fetched so far) from progress files."""
    if paths.exists(spark, path):
        state = spark.read.schema(schemas.PROGRESS).option("multiLine", True).json(path)
    else:
        state = spark.createDataFrame([], schemas.PROGRESS)
    completed = state.select(F.explode("completed_post_ids").alias("id")).distinct()
    comments = state.select(F.inline("comments"))
    return completed, comments


def read_completed_ids(
    spark: SparkSession, path: str, except_batch: str | None = None
) -> DataFrame:
    """The table :func:`threadloom.sinks.state.add_completed` writes, less one batch of it."""
    if not paths.exists(spark, f"{path}/batch=*"):
        return spark.createDataFrame([], "id string")
    rows = spark.read.schema("id string, batch string").parquet(path)
    if except_batch is not None:
        rows = rows.where(F.col("batch") != except_batch)
    return rows.select("id").distinct()
