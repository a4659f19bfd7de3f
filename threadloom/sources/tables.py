"""Tables by name: declared sources, upstream models and warehouse queries."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def load_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Registry of Parquet tables lying side by side in a folder."""
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)


def read_query(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """A SQL query over catalog tables, views and the frames named in ``{braces}``."""
    return spark.sql(query, **frames)


def spread(scan: DataFrame) -> DataFrame:
    """The rows of a scan dealt to all cores where its files make fewer tasks than there are cores.

    For expensive work on each row of small files; a larger scan stays as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
