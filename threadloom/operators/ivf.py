"""Top-k similarity search over an inverted file: vectors stored by coarse cell.

An index folder holds ``vectors``, partitioned by cell, and ``cells``, one row per cell with
its centre, its number of rows and how far its rows reach from the centre. A question probes the
cells whose centres are nearest; their numbers are partition filters, so the other cells are not
read. The reach of a cell bounds the score of everything in it: where the best rows found
score higher than that, a cell is proved to hold nothing better. ``complete`` reads what is not
proved so for a question, which makes its answer exact; without it, the recall can be audited.

The centres are fitted on a bounded sample; every row is in the index. Their matrix
(MAX_CELLS rows at most) is broadcast. Scores and ties are those of the exact search.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import defaults
from threadloom.operators import similarity
from threadloom.session import stored, work_dir
from threadloom.sinks.tables import write_partitioned

MAX_CELLS = 16_384
#: Rows that the centres are fitted on, taken by a hash of the id.
SAMPLE_ROWS = 100_000
#: Rows that have no direction, all zeros, share a cell of their own; it scores 0 with every question.
NO_DIRECTION = -1
ANGLE_MARGIN = 1e-6


class Cells(NamedTuple):
    """The coarse quantizer: numbers, unit centres, row counts and reaches (greatest angle of a row to the centre)."""

    numbers: np.ndarray
    centres: np.ndarray
    rows: np.ndarray
    reach: np.ndarray

    def bounds(self, units: np.ndarray) -> np.ndarray:
        """The greatest score that a row of each cell can have, questions x cells."""
        angles = np.arccos(np.clip(units @ self.centres.T, -1, 1))
        best = np.cos(np.maximum(0, angles - self.reach - ANGLE_MARGIN))
        best[:, self.numbers == NO_DIRECTION] = 0
        best[~units.any(axis=1)] = 0  # a question without direction scores 0 everywhere
        return best


class Found(NamedTuple):
    #: (question_id, match_id, score, rank)
    hits: DataFrame
    #: Rows of the cells that were read, one reading of a cell per scan, as a share of all rows.
    share_read: float
    #: Questions whose answer a second scan had to prove or mend; 0 if not asked for.
    completed: int


def fit_cells(rows: DataFrame, cells: int, seed: int = 42, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Unit centres of k-means on a sample of rows (id, vec) of equal size."""
    usable = rows.where(F.exists("vec", lambda x: x != 0))
    n = usable.count()
    if not n:
        return np.zeros((0, 0))
    # By a hash, so that the same rows give the same centres in any order.
    part = min(1.0, sample_rows / n)
    chosen = usable.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < int(part * (1 << 20)) + 1)
    sample = stored(chosen.select(array_to_vector(F.col("vec").cast("array<double>")).alias("features")), "sample")
    means = KMeans(k=cells, seed=seed, maxIter=10, initMode="random", distanceMeasure="cosine")
    centres = np.array(means.fit(sample).clusterCenters())
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)


def _assigned(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """Rows with the cell of the nearest centre and the angle to it."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)
    at = rows.columns.index("vec")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = similarity._unit_rows(batch.column(at))
            cell, angle = np.full(len(units), NO_DIRECTION, dtype=np.int32), np.zeros(len(units))
            on = np.flatnonzero(units.any(axis=1))
            for k in range(0, len(on), 1024):
                some = on[k : k + 1024]
                nearness = units[some] @ shared.value.T
                cell[some] = nearness.argmax(axis=1)
                angle[some] = np.arccos(np.clip(nearness.max(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(angle)], names=[*batch.schema.names, "cell", "angle"]
            )

    fields = [*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())]
    return rows.mapInArrow(assign, T.StructType(fields))


def default_cells(n_rows: int) -> int:
    """About the square root of the rows, so that probing a few cells and ranking all centres cost alike."""
    return int(min(MAX_CELLS, max(1, round(n_rows**0.5))))


def build_index(
    corpus: DataFrame, path: str, corpus_id: str = "chunk_id", corpus_vector: str = "embedding", cells: int | None = None, seed: int = 42
) -> None:
    """Write the index of a corpus. Rows without an id or a vector take no part; vectors of different size are an error."""
    rows = corpus.select(F.col(corpus_id).alias("id"), F.col(corpus_vector).alias("vec"))
    rows = stored(rows.where(F.col("vec").isNotNull() & F.col("id").isNotNull()), "corpus")
    n, least, dims = rows.agg(F.count("*"), F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if n and least != dims:
        raise ValueError(f"the vectors have {least} to {dims} elements")
    centres = fit_cells(rows, min(cells or default_cells(n), max(n, 1)), seed)
    placed = _assigned(rows, centres)
    # A cell of very many rows is split over several files.
    write_partitioned(placed, f"{path}/vectors", ["cell"])
    spark = corpus.sparkSession
    written = spark.read.schema(placed.schema).parquet(f"{path}/vectors")
    counts = written.groupBy("cell").agg(F.count("*").alias("rows"), F.max("angle").alias("reach")).toArrow().to_pylist()
    none = [0.0] * (dims or 0)
    told = [(c["cell"], centres[c["cell"]].tolist() if c["cell"] >= 0 else none, c["rows"], c["reach"]) for c in counts]
    spark.createDataFrame(told, "cell int, centre array<double>, rows long, reach double").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    rows.limit(0).write.mode("overwrite").parquet(f"{path}/columns")


def read_cells(spark: SparkSession, path: str) -> Cells:
    rows = spark.read.parquet(f"{path}/cells").orderBy("cell").toArrow()
    centres = np.array(rows["centre"].to_pylist(), dtype=np.float64)
    return Cells(*(rows[c].to_numpy() if c != "centre" else centres for c in ("cell", "centre", "rows", "reach")))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The rows (id, vec, cell) of an index; filters on the cell prune its folders."""
    columns = spark.read.parquet(f"{path}/columns").schema
    return spark.read.schema(T.StructType([*columns.fields, T.StructField("cell", T.IntegerType())])).parquet(f"{path}/vectors")


def _asking(probes: int, cells, floors: bool):
    """Arrow function from (id, vec[, floor]) to (id, vec, asks): places in cells that a question must read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Cells = cells.value
        for batch in batches:
            units, asks = similarity._unit_rows(batch.column(1)), []
            step = max(1, (1 << 22) // max(len(own.numbers), 1))
            for k in range(0, len(units), step):
                some = units[k : k + step]
                order = np.argsort(-(some @ own.centres.T), axis=1, kind="stable")[:, :probes]
                if floors:
                    floor = batch.column(2).to_numpy(zero_copy_only=False)[k : k + step]
                    left = own.bounds(some) >= floor[:, None] - similarity.ROUNDING_MARGIN
                    np.put_along_axis(left, order, False, axis=1)
                    asks += [np.flatnonzero(row) for row in left]
                else:
                    asks += list(order)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(asks, pa.list_(pa.int32()))], names=["id", "vec", "asks"])

    return run


def _scan(index: DataFrame, asked: pa.Table, cells: Cells, schema: T.StructType, k: int, min_score: float | None) -> tuple[DataFrame, int]:
    """Partial top-k per task of the cells that the questions ask for, and how many rows these have."""
    arrow = similarity._arrow_schema(schema)
    ids = asked["id"].combine_chunks().cast(arrow.field("question_id").type)
    asks = asked["asks"].combine_chunks()
    places = asks.flatten().to_numpy()
    owner = np.repeat(np.arange(len(asks)), np.diff(asks.offsets.to_numpy()))
    order = np.argsort(places, kind="stable")
    used, first = np.unique(places[order], return_index=True)
    askers = dict(zip(cells.numbers[used].tolist(), np.split(owner[order], first[1:]), strict=True)) if len(used) else {}
    payload = index.sparkSession.sparkContext.broadcast((ids, similarity._unit_rows(asked["vec"]), askers))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units, askers = payload.value
        best = similarity._Best(len(ids), k, min_score)
        for batch in batches:
            own = batch.column(2).to_numpy()
            for cell in np.unique(own):
                part = batch.filter(pa.array(own == cell))
                similarity._score(best, units, similarity._unit_rows(part.column(1)), similarity._ids(part.column(0)), askers[int(cell)])
        yield similarity._to_batch(best, ids, arrow)

    read = index.where(F.col("cell").isin(list(askers))).select("id", "vec", "cell")
    return read.mapInArrow(scan, schema), int(cells.rows[used].sum())


def search(
    spark: SparkSession,
    path: str,
    questions: DataFrame,
    k: int = defaults.TOP_K,
    min_score: float | None = defaults.MIN_RELEVANCE,
    probes: int = 8,
    complete: bool = False,
    question_id: str = "question_id",
    question_vector: str = "embedding",
    max_broadcast_floats: int = similarity.MAX_BROADCAST_FLOATS,
) -> Found:
    """The k most similar rows of an index per question, from the cells nearest to it.

    With ``complete``, questions whose unread cells could hold a better row read those too, so the
    hits are those of the exact search. Questions go in blocks of bounded size, one scan each.
    """
    cells = read_cells(spark, path)
    index = read_vectors(spark, path)
    asked = questions.select(F.col(question_id).alias("id"), F.col(question_vector).alias("vec"))
    asked = stored(asked.where(F.col("vec").isNotNull() & F.col("id").isNotNull()), "questions")
    schema = similarity._result_schema(asked.schema["id"], index.schema["id"])
    n, least, dims = asked.agg(F.count("*"), F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if n and least != dims or n and len(cells.numbers) and cells.centres.shape[1] != dims:
        raise ValueError(f"the vectors have {cells.centres.shape[1]} elements, the questions' {least} to {dims}")
    shared = spark.sparkContext.broadcast(cells)
    types = T.StructType([*asked.schema.fields, T.StructField("asks", T.ArrayType(T.IntegerType()))])
    order = Window.partitionBy("question_id").orderBy(F.col("score").desc(), "match_id")
    hits, read, completed = work_dir(spark, "hits"), 0, 0
    spark.createDataFrame([], schema).withColumn("rank", F.lit(0)).write.parquet(hits)
    blocks = -(-n * dims // max_broadcast_floats) if n and len(cells.numbers) else 0
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        table = own.mapInArrow(_asking(probes, shared, False), types).toArrow()
        if not table.num_rows:
            continue
        partial, rows = _scan(index, table, cells, schema, k, min_score)
        read += rows
        best = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if complete:
            best = stored(best, "probed")
            lowest = F.lit(-1.0 if min_score is None else min_score)
            floors = best.where(F.col("rank") == k).select(F.col("question_id").alias("id"), F.col("score").alias("floor"))
            waiting = own.join(floors, "id", "left").select("id", "vec", F.coalesce("floor", lowest).alias("floor"))
            table = waiting.mapInArrow(_asking(probes, shared, True), types).where(F.size("asks") > 0).toArrow()
            if table.num_rows:
                more, rows = _scan(index, table, cells, schema, k, min_score)
                read, completed = read + rows, completed + table.num_rows
                best = best.drop("rank").unionByName(more)
                best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best.write.mode("append").parquet(hits)
    total = int(cells.rows.sum())
    return Found(spark.read.parquet(hits), read / total if total else 0.0, completed)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(question_id, wanted, held, recall) of a search's hits against those of the exact search."""
    both = exact.select("question_id", "match_id").join(
        found.select("question_id", "match_id", F.lit(1).alias("held")), ["question_id", "match_id"], "left"
    )
    counts = both.groupBy("question_id").agg(F.count("*").alias("wanted"), F.count("held").alias("held"))
    return counts.withColumn("recall", F.col("held") / F.col("wanted"))


def audited_search(
    spark: SparkSession,
    path: str,
    questions: DataFrame,
    audit: DataFrame,
    k: int = defaults.TOP_K,
    min_score: float | None = defaults.MIN_RELEVANCE,
    probes: int = 8,
    min_recall: float = 0.95,
    question_id: str = "question_id",
    question_vector: str = "embedding",
) -> tuple[Found, int]:
    """A search whose number of probes is raised until the mean recall of the audit questions reaches min_recall.

    Their exact answers come from a scan of the whole index. If twice the probes would be all cells, the
    search is completed instead. Returns the hits and the number of probes; 0 tells a completed search.
    """
    index = read_vectors(spark, path)
    names = {"corpus_id": "id", "corpus_vector": "vec", "question_id": question_id, "question_vector": question_vector}
    exact = stored(similarity.top_k(index, audit, k, min_score, **names), "exact")
    n_cells = spark.read.parquet(f"{path}/cells").count()
    while probes < n_cells:
        some = search(spark, path, audit, k, min_score, probes, False, question_id, question_vector)
        mean = recall(some.hits, exact).agg(F.avg("recall")).first()[0]
        if mean is None or mean >= min_recall:
            return search(spark, path, questions, k, min_score, probes, False, question_id, question_vector), probes
        probes *= 2
    return search(spark, path, questions, k, min_score, n_cells, True, question_id, question_vector), 0
