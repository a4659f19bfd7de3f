"""Tables, the shared scratch folder, held-out folds, word hashes and connected components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Records per Arrow batch sent to Python; texts can be long, so batches stay small.
BATCH_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a local session may leave that unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="threadloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where a column of df has the same one but for case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def plus(df: DataFrame, types: str) -> StructType:
    """The schema of df with the nullable columns of a DDL string behind it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(types).fields])


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids are in no fold."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(folds)


def texts_of(batch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column of an Arrow batch; null as empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(name)).cast("binary").to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(n, dtype=np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


class Rolling:
    """Polynomial hashes of slices of an array, from prefix sums modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = _powers(base, 1), _powers(self.inverse, 1)

    def __call__(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(values)
        if len(self.up) < n + 1:
            size = max(n + 1, 2 * len(self.up))
            self.up, self.down = _powers(self.base, size), _powers(self.inverse, size)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * self.up[:n], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts]


def unite(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the classes of i[k] and j[k] in an array of class labels (smallest member's index)."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return labels
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b), both long: rows (node, root), root the smallest node.

    Alternating star contractions. Every round takes minima with partial aggregation and
    joins them back, so a node with very many neighbours is split by adaptive execution,
    and is written to the shared folder. Nodes without an edge to another node have no row.
    """
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    pairs = stored(pairs.where("hi <> lo").distinct(), "edges")
    seen = None
    while True:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(down, "hi")
            .where("lo > m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(down.select("hi", F.col("m").alias("lo")))
        )
        pairs = stored(small.distinct(), "edges")
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if state == seen:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        seen = state


#: Text bytes that one step in Python takes at once; a longer text is a step of its own.
STEP_BYTES = 4 << 20


def steps(batches, name: str, limit: int = STEP_BYTES):
    """Cut Arrow batches into slices of bounded text size, at least one row each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name)).cast("binary")), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
