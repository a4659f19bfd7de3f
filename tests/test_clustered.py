"""The clustered layout: same rows, and how few row groups a filter has to read."""

import glob

import numpy as np
import pyarrow.parquet as pq
import pytest

from threadloom.sinks import clustered

SCHEMA = "author string, flair int, t timestamp_ntz, body string"


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(40_000, numPartitions=4).selectExpr(
        "concat('a', cast(pmod(xxhash64(id), 500) as string)) as author", "cast(pmod(xxhash64(id, 1), 40) as int) as flair",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(pmod(xxhash64(id, 2), 100000) as int), 0) as t", "cast(id as string) as body",
    )
    odd = spark.createDataFrame([(None, None, None, "n"), ("a1", None, None, "m"), (None, 3, None, None)], SCHEMA)
    return made.unionByName(odd).cache()


def read_share(path, column, low, high):
    """Row groups whose range meets a filter, of all."""
    kept = total = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        place = meta.schema.to_arrow_schema().names.index(column)
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(place).statistics
            total += 1
            kept += stats is not None and stats.has_min_max and stats.min <= high and stats.max >= low
    return kept / total


def test_every_row_is_written_once(spark, rows, tmp_path):
    clustered.write_clustered(rows, str(tmp_path), ["author", "flair", "t"], files=64)
    back = spark.read.parquet(str(tmp_path))
    assert back.schema == rows.schema
    assert back.exceptAll(rows).count() == rows.exceptAll(back).count() == 0


def test_filters_on_any_column_read_few_row_groups(spark, rows, tmp_path):
    rows.repartition(64).write.parquet(f"{tmp_path}/plain")
    clustered.write_clustered(rows, f"{tmp_path}/curve", ["author", "flair", "t"], files=64)
    for column, low, high in (("author", "a300", "a300"), ("flair", 7, 7)):
        assert read_share(f"{tmp_path}/plain", column, low, high) > 0.95
        assert read_share(f"{tmp_path}/curve", column, low, high) < 0.45


def test_a_value_that_most_rows_share_is_split(spark, tmp_path):
    same = spark.range(20_000).selectExpr("'hot' as author", "id")
    clustered.write_clustered(same, str(tmp_path), ["author"], files=8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/*.parquet")]
    assert len(sizes) == 8 and max(sizes) < 4000


def test_edges(spark, rows, tmp_path):
    clustered.write_clustered(rows.limit(0), str(tmp_path), ["author", "t"])
    assert spark.read.schema(rows.schema).parquet(str(tmp_path)).count() == 0
    with pytest.raises(ValueError):
        clustered.curve_key(rows, ["author"] * 7)
    grid = [np.array(x) for x in zip(*((a, b) for a in range(4) for b in range(4)), strict=True)]
    assert sorted(clustered.interleaved(grid, 2)) == list(range(16))
