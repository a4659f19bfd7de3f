"""File scans. Every reader takes a root or a glob and covers all forums in one job."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from threadloom import schemas
from threadloom.sources import paths


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """JSON records under an explicit schema, with no inference pass.

    Newline-delimited files are splittable and the default; ``multiline`` reads
    files that hold one JSON array, which cost one task per file. A missing path
    gives an empty frame of the same schema.
    """
    if not paths.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_posts(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.POST, multiline)


def read_comments(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.COMMENT, multiline)


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet folder; ``key=value`` subfolders become columns that prune the scan.

    With a schema given, a missing path is an empty frame.
    """
    if schema is None:
        return spark.read.parquet(path)
    if not paths.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
