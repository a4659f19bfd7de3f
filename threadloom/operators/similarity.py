"""Exact top-k similarity search: for every question, its most similar chunks.

Questions that fit one block are sent to the corpus, which stays in place: each task scans its part
of it and keeps k rows per question. The block is broadcast and holds a bounded number of floats. More
questions never pass the driver: they and the corpus are dealt to parts of a bounded number of floats, and
each pair of parts meets in a task, which takes the questions block by block. k rows per question and task
leave a task, never all pairs.

Without a limit, every row of the corpus lists the questions it answers where it lies, some rows at a time:
no task keeps hits, and no hit is shuffled.

Scores are cosines rounded to six decimals, ties go to the smaller id, so the
result does not depend on the order of summation.
"""

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from threadloom import defaults
from threadloom.session import stored

SCORE_DECIMALS = 6
MAX_BROADCAST_FLOATS = 8_000_000  # 64 MB as doubles
#: Floats of each side that meet in a task, and the least rows of the corpus that are worth one.
CELL_FLOATS, CELL_ROWS = 2_000_000, 2000
ROUNDING_MARGIN = 2 * 10.0**-SCORE_DECIMALS
SCORES_AT_ONCE = 8_000_000
#: The same where all hits are wanted, as each of these scores may be one.
HITS_AT_ONCE = 1_000_000


def _unit_rows(vectors: pa.Array) -> np.ndarray:
    """A list column as a matrix of unit rows; rows without a finite length become zero."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if len(vectors) == 0:
        return np.zeros((0, 0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(len(vectors), -1)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    usable = np.isfinite(norms) & (norms > 0)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=usable)


def _ids(column: pa.Array) -> np.ndarray:
    """Ids in a form that sorts as Spark sorts them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.to_numpy(zero_copy_only=False)
    return values.astype(str) if values.dtype == object else values


def _first_copies(vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with the same vector, which tie for every question, the k smallest ids."""
    width = vectors.itemsize * vectors.shape[1]
    rows = np.ascontiguousarray(vectors).view(np.dtype((np.void, width))).ravel()
    distinct, group = np.unique(rows, return_inverse=True)
    if len(distinct) == len(rows):
        return vectors, ids
    order = np.lexsort((ids, group))
    rank = np.arange(len(order)) - np.searchsorted(group[order], group[order])
    kept = order[rank < k]
    return vectors[kept], ids[kept]


class _Best:
    """The k best rows per question seen so far, as flat arrays."""

    def __init__(self, n_questions: int, k: int, min_score: float | None):
        self.k = k
        # No row below its question's floor can enter any more.
        self.floor = np.full(n_questions, -np.inf if min_score is None else min_score)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, asking: np.ndarray | None = None) -> None:
        """Take in a block of unrounded scores, questions x rows; of some questions only if told which."""
        enough = self.k * len(self.floor)
        floor = self.floor if asking is None else self.floor[asking]
        near = scores >= (floor - ROUNDING_MARGIN)[:, None]
        if scores.shape[1] > self.k and np.count_nonzero(near) > 4 * enough:
            kth = np.partition(scores, -self.k, axis=1)[:, -self.k]
            near &= scores >= (kth - ROUNDING_MARGIN)[:, None]
        question, row = np.nonzero(near)
        score = np.round(scores[question, row], SCORE_DECIMALS) + 0.0
        question = question if asking is None else asking[question]
        above = score >= self.floor[question]
        self.parts.append((question[above], score[above], ids[row[above]]))
        self.waiting += np.count_nonzero(above)
        if self.waiting >= enough:
            self._cut()

    def _cut(self) -> None:
        question, score, ids = (np.concatenate(column) for column in zip(*self.parts))
        order = np.lexsort((ids, -score, question))
        question, score, ids = question[order], score[order], ids[order]
        rank = np.arange(len(question)) - np.searchsorted(question, question)
        best = rank < self.k
        full = rank == self.k - 1
        self.floor[question[full]] = score[full]
        self.parts = [(question[best], score[best], ids[best])]
        self.waiting = 0

    def result(self) -> tuple[np.ndarray, np.ndarray, list]:
        if not self.parts:
            return np.empty(0, dtype=np.int64), np.empty(0), []
        self._cut()
        question, score, ids = self.parts[0]
        return question, score, ids.tolist()


def _score(
    best: _Best, questions: np.ndarray, vectors: np.ndarray, ids: np.ndarray, asking: np.ndarray | None = None
) -> None:
    _score_distinct(best, questions, *_first_copies(vectors, ids, best.k), asking)


def _score_distinct(
    best: _Best, questions: np.ndarray, vectors: np.ndarray, ids: np.ndarray, asking: np.ndarray | None = None
) -> None:
    asked = questions if asking is None else questions[asking]
    step = max(1, SCORES_AT_ONCE // max(1, len(asked)))
    for at in range(0, len(vectors), step):
        best.add(asked @ vectors[at : at + step].T, ids[at : at + step], asking)


def _result_schema(questions: T.StructField, corpus: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("question_id", questions.dataType),
            T.StructField("match_id", corpus.dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _to_batch(best: _Best, question_ids: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
    question, score, ids = best.result()
    return pa.RecordBatch.from_arrays(
        [
            question_ids.take(pa.array(question)),
            pa.array(ids, schema.field("match_id").type),
            pa.array(score, pa.float64()),
        ],
        schema=schema,
    )


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    return pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])


def scan_top_k(
    corpus: DataFrame, questions: pa.Table, schema: T.StructType, k: int, min_score: float | None
) -> DataFrame:
    """Partial top-k per task against a broadcast question set; columns are (id, vec)."""
    arrow = _arrow_schema(schema)
    question_ids = questions["id"].combine_chunks().cast(arrow.field("question_id").type)
    payload = corpus.sparkSession.sparkContext.broadcast(
        (question_ids, _unit_rows(questions["vec"]))
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units = payload.value
        best = _Best(len(ids), k, min_score)
        for batch in batches:
            if batch.num_rows:
                _score(best, units, _unit_rows(batch.column(1)), _ids(batch.column(0)))
        yield _to_batch(best, ids, arrow)

    return corpus.mapInArrow(scan, schema)


def grid_top_k(
    corpus: DataFrame, questions: DataFrame, schema: T.StructType, k: int, min_score: float | None, dims: int, block_floats: int
) -> DataFrame:
    """Partial top-k where parts of the questions meet parts of the corpus; columns are (id, vec), both stored."""
    arrow = _arrow_schema(schema)
    block = max(1, block_floats // max(dims, 1))
    n_questions, n_corpus = questions.count(), corpus.count()
    tall = max(1, -(-n_questions * dims // CELL_FLOATS))
    busy = min(-(-3 * corpus.sparkSession.sparkContext.defaultParallelism // tall), -(-n_corpus // CELL_ROWS))
    wide = max(1, -(-n_corpus * dims // CELL_FLOATS), busy)

    def meet(asked: pa.Table, rows: pa.Table) -> pa.Table:
        if not (asked.num_rows and rows.num_rows):
            return arrow.empty_table()
        vectors, ids = _first_copies(_unit_rows(rows["vec"]), _ids(rows["id"]), k)
        found = []
        for at in range(0, asked.num_rows, block):
            some = asked.slice(at, block)
            best = _Best(some.num_rows, k, min_score)
            _score_distinct(best, _unit_rows(some["vec"]), vectors, ids)
            own_ids = some["id"].combine_chunks().cast(arrow.field("question_id").type)
            found.append(_to_batch(best, own_ids, arrow))
        return pa.Table.from_batches(found, arrow)

    def dealt(rows: DataFrame, parts: int, others: int, cell: Column) -> DataFrame:
        part = F.pmod(F.xxhash64("id", "vec"), F.lit(parts)).alias("part")
        copies = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("other")
        return rows.select("id", "vec", part, copies).select("id", "vec", cell.alias("cell")).repartition(tall * wide, "cell").groupBy("cell")

    left = dealt(questions, tall, wide, F.col("part") * wide + F.col("other"))
    right = dealt(_sized(corpus, dims), wide, tall, F.col("other") * wide + F.col("part"))
    return left.cogroup(right).applyInArrow(meet, schema)


def _sized_vector(id_: str, vector: str, dims: int) -> Column:
    message = F.concat(
        F.lit("the vector of "), F.col(id_).cast("string"), F.lit(f" has not {dims} elements")
    )
    return F.when(F.size(vector) == dims, F.col(vector)).otherwise(F.raise_error(message))


def _sized(rows: DataFrame, dims: int) -> DataFrame:
    """Rows (id, vec) whose vectors must have dims elements; another size fails, naming the id."""
    return rows.select("id", _sized_vector("id", "vec", dims).alias("vec"))


def _asked(questions: DataFrame, question_id: str, question_vector: str) -> tuple[DataFrame, int, int]:
    """The questions (id, vec), stored, how many they are and the elements of a vector."""
    asked = questions.select(F.col(question_id).alias("id"), F.col(question_vector).alias("vec"))
    asked = stored(asked.where(F.col("vec").isNotNull() & F.col("id").isNotNull()), "questions")
    n, least, dims = asked.agg(F.count("*"), F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if n and least != dims:
        raise ValueError(f"the questions' vectors have {least} to {dims} elements")
    return asked, n, dims


def best_first() -> Column:
    """The rank of a hit among those of its question."""
    return F.row_number().over(Window.partitionBy("question_id").orderBy(F.col("score").desc(), "match_id"))


def top_k(
    corpus: DataFrame,
    questions: DataFrame,
    k: int = defaults.TOP_K,
    min_score: float | None = defaults.MIN_RELEVANCE,
    corpus_id: str = "chunk_id",
    corpus_vector: str = "embedding",
    question_id: str = "question_id",
    question_vector: str = "embedding",
    max_broadcast_floats: int = MAX_BROADCAST_FLOATS,
) -> DataFrame:
    """(question_id, match_id, score, rank) of the k most similar chunks per question.

    The questions are stored before the search, and the corpus too if it is dealt to parts,
    so that a vector that a provider computes is computed once. Rows without an
    id or a vector take no part; vectors of different size are an error.
    """
    spark = corpus.sparkSession
    rows = corpus.select(F.col(corpus_id).alias("id"), F.col(corpus_vector).alias("vec"))
    rows = rows.where(F.col("vec").isNotNull() & F.col("id").isNotNull())
    asked, n, dims = _asked(questions, question_id, question_vector)
    schema = _result_schema(asked.schema["id"], rows.schema["id"])
    if not n:
        partial = spark.createDataFrame([], schema)
    elif n * dims <= max_broadcast_floats:
        partial = scan_top_k(_sized(rows, dims), asked.toArrow(), schema, k, min_score)
    else:
        found = grid_top_k(stored(rows, "corpus"), asked, schema, k, min_score, dims, max_broadcast_floats)
        partial = stored(found, "hits")

    return partial.withColumn("rank", best_first()).where(F.col("rank") <= k)


def _hits_per_row(
    units: np.ndarray, ids: pa.Array, vectors: pa.Array, least: float, kind: pa.ListType
) -> Iterator[pa.Array]:
    """For every vector the list of its hits (question_id, score), of some vectors at a time."""
    step = max(1, HITS_AT_ONCE // max(1, len(units)))
    for at in range(0, len(vectors), step):
        scores = _unit_rows(vectors.slice(at, step)) @ units.T
        row, question = np.nonzero(scores >= least - ROUNDING_MARGIN)
        score = np.round(scores[row, question], SCORE_DECIMALS) + 0.0
        above = score >= least
        row, question, score = row[above], question[above], score[above]
        hits = [ids.take(pa.array(question)), pa.array(score)]
        ends = np.searchsorted(row, np.arange(len(scores) + 1))
        yield pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.StructArray.from_arrays(hits, fields=list(kind.value_type))
        )


def scan_every_hit(corpus: DataFrame, questions: pa.Table, hits: T.ArrayType, least: float, vector: str) -> DataFrame:
    """The corpus with the hits of every row against a broadcast question set in place of its vector."""
    kind = to_arrow_type(hits)
    ids = questions["id"].combine_chunks().cast(kind.value_type.field("question_id").type)
    payload = corpus.sparkSession.sparkContext.broadcast((ids, _unit_rows(questions["vec"])))

    @F.arrow_udf(hits)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids, units = payload.value
        for vectors in batches:
            yield from _hits_per_row(units, ids, vectors, least, kind)

    # Nondeterministic, so that a filter on the hits does not score twice.
    found = scan.asNondeterministic()(F.col(vector)).alias("_hits")
    return corpus.select(*[c for c in corpus.columns if c != vector], found)


def grid_every_hit(
    corpus: DataFrame, questions: DataFrame, n_questions: int, hits: T.ArrayType, least: float, id_: str, vector: str, dims: int
) -> DataFrame:
    """The same where parts of the questions (id, vec) meet parts of the corpus; both are stored.

    A row comes back once per part of the questions. A task holds one part of them, and the corpus passes it by.
    """
    kind = to_arrow_type(hits)
    others = [c for c in corpus.columns if c != vector]
    n_corpus = corpus.count()
    tall = max(1, -(-n_questions * dims // CELL_FLOATS))
    busy = min(-(-3 * corpus.sparkSession.sparkContext.defaultParallelism // tall), -(-n_corpus // CELL_ROWS))
    wide = max(1, -(-n_corpus * dims // CELL_FLOATS), busy)

    def dealt(rows: DataFrame, part: Column, copies: int, cell: Column) -> DataFrame:
        spread = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_other")
        return rows.select("*", part.alias("_part"), spread).withColumn("_cell", cell).drop("_part", "_other")

    left = questions.select(F.col("id").alias("_id"), F.col("vec").alias("_vec"))
    left = dealt(left, F.pmod(F.xxhash64("_id", "_vec"), F.lit(tall)), wide, F.col("_part") * wide + F.col("_other"))
    right = corpus.select(*others, F.col(vector).alias("_vec"))
    right = dealt(right, F.pmod(F.xxhash64(id_, "_vec"), F.lit(wide)), tall, F.col("_other") * wide + F.col("_part"))
    both = left.withColumn("_row", F.lit(0)).unionByName(right.withColumn("_row", F.lit(1)), allowMissingColumns=True)
    # The questions of a cell come first.
    met = both.repartition(tall * wide, "_cell").sortWithinPartitions("_cell", "_row")
    schema = T.StructType([*[corpus.schema[c] for c in others], T.StructField("_hits", hits)])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asked, ready = None, [], None
        for batch in batches:
            keys = list(zip(batch["_cell"].to_pylist(), batch["_row"].to_pylist()))
            at = 0
            while at < len(keys):
                to = bisect_right(keys, keys[at], at)
                some, at = batch.slice(at, to - at), to
                if keys[to - 1][0] != cell:
                    cell, asked, ready = keys[to - 1][0], [], None
                if keys[to - 1][1] == 0:
                    asked.append(some.select(["_id", "_vec"]))
                    continue
                if not asked:
                    continue
                if ready is None:
                    table = pa.Table.from_batches(asked)
                    ready = _unit_rows(table["_vec"]), table["_id"].combine_chunks().cast(kind.value_type.field("question_id").type)
                done = 0
                for listed in _hits_per_row(*ready, some["_vec"], least, kind):
                    rows = some.slice(done, len(listed))
                    done += len(listed)
                    yield pa.RecordBatch.from_arrays([*[rows[c] for c in others], listed], names=[*others, "_hits"])

    return met.mapInArrow(meet, schema)


def every_hit(
    corpus: DataFrame,
    questions: DataFrame,
    min_score: float | None = defaults.MIN_RELEVANCE,
    corpus_id: str = "match_id",
    corpus_vector: str = "embedding",
    question_id: str = "question_id",
    question_vector: str = "embedding",
    max_broadcast_floats: int = MAX_BROADCAST_FLOATS,
) -> DataFrame:
    """The rows of ``corpus`` without their vectors, once per question they answer, with question_id and score.

    The hits of :func:`top_k` without a limit. The rows keep their other columns, so no join is needed;
    columns that are not used are not read while the questions fit a broadcast.
    """
    rows = corpus.where(F.col(corpus_vector).isNotNull() & F.col(corpus_id).isNotNull())
    others = [c for c in corpus.columns if c != corpus_vector]
    asked, n, dims = _asked(questions, question_id, question_vector)
    hit = _result_schema(asked.schema["id"], corpus.schema[corpus_id])
    hits = T.ArrayType(T.StructType([hit["question_id"], hit["score"]]))
    least = -np.inf if min_score is None else min_score
    if not n:
        listed = rows.select(*others, F.lit(None).cast(hits).alias("_hits"))
    elif n * dims <= max_broadcast_floats:
        sized = rows.withColumn(corpus_vector, _sized_vector(corpus_id, corpus_vector, dims))
        listed = scan_every_hit(sized, asked.toArrow(), hits, least, corpus_vector)
    else:
        kept = stored(rows, "corpus")
        sized = kept.withColumn(corpus_vector, _sized_vector(corpus_id, corpus_vector, dims))
        listed = grid_every_hit(sized, asked, n, hits, least, corpus_id, corpus_vector, dims)
    return listed.select(*others, F.inline("_hits"))


def label_centroids(vectors: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label, combined per task before the shuffle."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return vectors.groupBy(label).agg(vector_to_array(mean).alias("embedding"))
