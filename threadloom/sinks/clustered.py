"""A layout for filters on several columns that are no partition columns.

Rows are written in the order of a curve over the ranks of some columns, so every file and row group
covers a small range of each of them, and the statistics that Parquet keeps let a scan pass over most
row groups for a filter on any one of the columns or on several. The ranks come from a bounded sample,
which only shapes the layout: every row is written.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
#: Ranks of a column; the curve interleaves so many bits of each.
RANK_BITS = 10


def interleaved(ranks: list[np.ndarray], bits: int = RANK_BITS) -> np.ndarray:
    """Numbers whose bits are those of the ranks in turn, highest first."""
    key = np.zeros(len(ranks[0]), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            key = key << 1 | (rank >> bit & 1)
    return key


def _comparable(column: Column, kind: str) -> Column:
    """The column as a number or a string, in its own order."""
    if kind == "string":
        return column
    if kind.startswith("timestamp"):
        return F.unix_micros(column.cast("timestamp"))
    if kind == "date":
        return F.unix_date(column)
    return column.cast("double")


def curve_key(df: DataFrame, by: list[str], sample_rows: int = SAMPLE_ROWS) -> Column:
    """The place of a row on the curve over the columns; nulls come first. At most six columns."""
    if not 0 < len(by) * RANK_BITS < 63:
        raise ValueError(f"the curve takes one to {62 // RANK_BITS} columns")
    kinds = dict(df.dtypes)
    columns = [_comparable(F.col(c), kinds[c]) for c in by]
    told = df.select(*[c.alias(f"c{k}") for k, c in enumerate(columns)])
    n = told.count()
    # A fixed seed; another sample would give another layout, never other rows.
    some = told.sample(min(1.0, 2 * sample_rows / max(n, 1)), seed=1).limit(sample_rows).toArrow() if n else None
    splits = []
    for k in range(len(by)):
        values = np.sort(_array(some.column(k).drop_null())) if some is not None else np.zeros(0)
        splits.append(values[np.linspace(0, len(values) - 1, 1 << RANK_BITS).astype(int)] if len(values) else values)
    shared = df.sparkSession.sparkContext.broadcast(splits)

    @F.arrow_udf("long")
    def place(*parts: pa.Array) -> pa.Array:
        ranks = []
        for part, own in zip(parts, shared.value, strict=True):
            rank = np.zeros(len(part), dtype=np.int64)
            on = part.is_valid().to_numpy(zero_copy_only=False)
            if len(own):
                rank[on] = np.minimum(np.searchsorted(own, _array(part.drop_null()), side="left") + 1, (1 << RANK_BITS) - 1)
            ranks.append(rank)
        return pa.array(interleaved(ranks))

    return place(*columns)


def _array(values: pa.Array) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if pa.types.is_string(values.type):
        return np.array(values.to_pylist(), dtype=object)
    return values.to_numpy(zero_copy_only=False)


def write_clustered(df: DataFrame, path: str, by: list[str], files: int | None = None, mode: str = "overwrite") -> None:
    """Parquet in the order of the curve. Without a number of files, as many as a shuffle has partitions.

    Only the columns of the curve go through Python. Rows of equal place are dealt by a hash of the columns as well, so
    one value that very many rows share is split over files.
    """
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["_curve", "_deal"]
    rows = df.withColumn("_curve", curve_key(df, by)).withColumn("_deal", F.xxhash64(*df.columns))
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).drop(*order).write.mode(mode).parquet(path)
