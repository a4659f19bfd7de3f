"""Path checks through the session's Hadoop file systems."""

from typing import NamedTuple

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """True if the path, which may hold wildcards, matches anything."""
    fs, hadoop_path = _resolve(spark, path)
    return len(fs.globStatus(hadoop_path) or []) > 0


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)


class Version(NamedTuple):
    number: int
    writer: str
    folder: str


def version_folder(path: str, number: int, writer: str) -> str:
    return f"{path}/version={number:06d}-{writer}"


def complete_versions(spark: SparkSession, path: str) -> list[Version]:
    """The fully written versions below a path, oldest first."""
    fs, pattern = _resolve(spark, f"{path}/version=*/_SUCCESS")
    versions = []
    for marker in fs.globStatus(pattern) or []:
        folder = marker.getPath().getParent()
        number, writer = folder.getName().removeprefix("version=").split("-", 1)
        versions.append(Version(int(number), writer, folder.toString()))
    return sorted(versions)


def children(spark: SparkSession, pattern: str, parent: bool = False) -> list[str]:
    """The names of what a pattern with wildcards matches, or of the folders these lie in."""
    fs, hadoop_path = _resolve(spark, pattern)
    found = [s.getPath() for s in fs.globStatus(hadoop_path) or []]
    return [(p.getParent() if parent else p).getName() for p in found]


def touch(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _resolve(spark, path)
    fs.create(hadoop_path, True).close()
