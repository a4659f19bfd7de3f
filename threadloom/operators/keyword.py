"""Ranked keyword search: an inverted index by term bucket, and BM25 over it.

An index folder holds ``postings`` (term, id, tf, length) and ``terms`` (term, df), both partitioned
by a hash bucket of the term and sorted by it, and ``size``, the number and total length of
all documents. A search reads the buckets of the terms that are asked for and no other, and within
a bucket the statistics of row groups spare most of the other terms.

Words are what white space separates, in lower case. Scores are rounded to six decimals and ties go
to the smaller id, so the result does not depend on the order of summation.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import defaults
from threadloom.operators import similarity
from threadloom.session import stored
from threadloom.sources import paths

K1, B = 1.2, 0.75
BUCKETS = 64
SCORE_DECIMALS = 6
#: Most rows (question, term) that are sent to every task.
MAX_BROADCAST_TERMS = 200_000
#: Scores and parts of scores that a task holds at once.
SCORES_AT_ONCE = 4_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[ \\n\\t\\r]+"), "")


def _bucket(term: str, buckets: Column | int) -> Column:
    return F.pmod(F.xxhash64(term), buckets if isinstance(buckets, Column) else F.lit(buckets)).cast("int").alias("bucket")


def _count_words(rows: DataFrame) -> DataFrame:
    """(id, term, tf, length) of rows (id, words), each a document of its own."""
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL("term string, tf int, length long")])
    arrow = similarity._arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(row):
                continue
            coded = lists.flatten().dictionary_encode()
            pairs = row * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)
            distinct, tf = np.unique(pairs, return_counts=True)
            doc, term = np.divmod(distinct, len(coded.dictionary))
            length = np.bincount(row, minlength=batch.num_rows)[doc]
            columns = [batch.column(0).take(pa.array(doc)), coded.dictionary.take(pa.array(term)), tf, length]
            made = [pa.array(c).cast(f.type) for c, f in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays(made, schema=arrow)

    return rows.mapInArrow(count, schema)


def build_index(docs: DataFrame, path: str, id_col: str, text_col: str, buckets: int = BUCKETS) -> None:
    """Write the index of (id, text). Null ids take no part; rows that share an id are one document.

    A document's words are counted where its text is read, so one row per document and distinct word
    is shuffled, once; only rows that share an id are counted together. A bucket of a very frequent term is
    split over several files.
    """
    own = words(F.col(text_col))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), own.alias("words"))
    lengths = rows.groupBy("id").agg(F.sum(F.coalesce(F.size("words"), F.lit(0)).cast("long")).alias("length"), F.count("*").alias("copies"))
    lengths = stored(lengths, "lengths")
    shared = lengths.where("copies > 1").select("id", "length")
    if shared.isEmpty():
        counted = _count_words(rows)
    else:
        together = rows.join(shared, "id", "left_semi").select("id", F.explode("words").alias("term"))
        together = together.groupBy("id", "term").agg(F.count("*").cast("int").alias("tf")).join(shared, "id")
        counted = _count_words(rows.join(shared, "id", "left_anti")).unionByName(together)
    postings = counted.select(_bucket("term", buckets), "term", "id", "tf", "length")
    postings = postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term")
    postings.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    spark, schema = docs.sparkSession, postings.schema
    spark.createDataFrame([], schema).drop("bucket").write.mode("overwrite").parquet(f"{path}/columns")
    terms = _read(spark, path, "postings").groupBy("bucket", "term").agg(F.count("*").alias("df"))
    terms.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/terms")
    size = lengths.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("total"))
    size.withColumn("buckets", F.lit(buckets)).coalesce(1).write.mode("overwrite").parquet(f"{path}/size")


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Postings or terms; filters on the bucket prune folders. Empty tables have no folder."""
    kinds = {"postings": spark.read.parquet(f"{path}/columns").schema.simpleString()[7:-1].replace(":", " "), "terms": "term string,df bigint"}
    schema = f"{kinds[name]},bucket int"
    if not paths.exists(spark, f"{path}/{name}/bucket=*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def asked_terms(spark: SparkSession, path: str, questions: DataFrame, question_id: str, text: str) -> DataFrame:
    """Rows (question_id, term, idf) of the distinct words of questions that the index holds."""
    n, _, buckets = spark.read.parquet(f"{path}/size").select("n", "total", "buckets").first()
    rows = questions.where(F.col(question_id).isNotNull()).select(
        F.col(question_id).alias("question_id"), F.explode(F.array_distinct(words(F.col(text)))).alias("term")
    )
    asked = stored(rows.distinct().select("question_id", "term", _bucket("term", buckets)), "asked")
    used = [r["bucket"] for r in asked.select("bucket").distinct().collect()]  # at most one per bucket
    known = _read(spark, path, "terms").where(F.col("bucket").isin(used))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return asked.join(known, ["bucket", "term"]).select("bucket", "question_id", "term", idf.alias("idf"))


def search(
    spark: SparkSession,
    path: str,
    questions: DataFrame,
    k: int = defaults.TOP_K,
    question_id: str = "question_id",
    text: str = "question",
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """(question_id, match_id, score, rank): the k documents of highest BM25 score per question.

    Every document that holds a word of the question is scored. Questions without a word that the
    index holds have no row.
    """
    n, total = spark.read.parquet(f"{path}/size").select("n", "total").first()
    mean = F.lit(max(total, 1) / max(n, 1))
    asked = stored(asked_terms(spark, path, questions, question_id, text), "terms")
    used = [r["bucket"] for r in asked.select("bucket").distinct().collect()]
    postings = _read(spark, path, "postings").where(F.col("bucket").isin(used))
    tf = F.col("tf").cast("double")
    part = F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("length") / mean))
    if asked.limit(MAX_BROADCAST_TERMS + 1).count() <= MAX_BROADCAST_TERMS:
        scored = _score_documents(postings, asked, part, k)
    else:
        met = postings.join(asked, ["bucket", "term"])
        scored = met.groupBy("question_id", F.col("id").alias("match_id")).agg(F.round(F.sum(part), SCORE_DECIMALS).alias("score"))
    order = Window.partitionBy("question_id").orderBy(F.col("score").desc(), "match_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _score_documents(postings: DataFrame, asked: DataFrame, part: Column, k: int) -> DataFrame:
    """(question_id, match_id, score): the k best documents of each task per question.

    A word's part of a document's score is the same for all questions, so one row per document and asked
    word is shuffled, by document, and never a row per question and document.
    """
    spark = asked.sparkSession
    terms = asked.select("bucket", "term", "idf").distinct().withColumn("number", F.monotonically_increasing_id())
    terms = stored(terms, "numbered")
    met = postings.join(F.broadcast(terms), ["bucket", "term"]).select("id", "number", part.alias("part"))
    schema = similarity._result_schema(asked.schema["question_id"], postings.schema["id"])
    arrow = similarity._arrow_schema(schema)
    pairs = asked.join(terms.select("bucket", "term", "number"), ["bucket", "term"]).select("question_id", "number").toArrow()
    if not pairs.num_rows:
        return spark.createDataFrame([], schema)
    coded = pairs["question_id"].combine_chunks().cast(arrow.field("question_id").type).dictionary_encode()
    numbers, question = pairs["number"].to_numpy(), coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(numbers, kind="stable")
    known, first, times = np.unique(numbers[order], return_index=True, return_counts=True)
    payload = spark.sparkContext.broadcast((coded.dictionary, known, first, times, question[order].astype(np.int64)))

    def add(best: similarity._Best, some: pa.Table) -> None:
        """Whole documents, their rows side by side."""
        questions, known, first, times, asking = payload.value
        ids = some["id"].combine_chunks()
        starts = np.flatnonzero(np.append(True, pc.not_equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)))
        term = np.searchsorted(known, some["number"].to_numpy())
        parts, asks = some["part"].to_numpy(), np.append(0, np.cumsum(times[term]))
        ends = np.append(starts[1:], len(term))
        at = 0
        while at < len(starts):
            most = np.searchsorted(asks[ends], asks[starts[at]] + SCORES_AT_ONCE, "right")
            to = max(at + 1, min(most, at + SCORES_AT_ONCE // len(questions), len(starts)))
            own = slice(starts[at], ends[to - 1])
            n = times[term[own]]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[term[own]], n)
            doc = np.repeat(np.repeat(np.arange(to - at), ends[at:to] - starts[at:to]), n)
            cells = asking[place] * (to - at) + doc
            scores = np.bincount(cells, np.repeat(parts[own], n), len(questions) * (to - at)).reshape(len(questions), -1)
            scores[scores == 0] = -np.inf  # every part is above zero
            best.add(scores, similarity._ids(ids.take(pa.array(starts[at:to]))))
            at = to

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, left = similarity._Best(len(payload.value[0]), k, 0.0), None
        for batch in batches:
            some = pa.Table.from_batches([batch])
            some = some if left is None else pa.concat_tables([left, some])
            if some.num_rows:
                last = pc.index(some["id"], some["id"][-1]).as_py()  # this document may go on
                if last:
                    add(best, some.slice(0, last))
                left = some.slice(last)
        if left is not None:
            add(best, left)
        yield similarity._to_batch(best, payload.value[0], arrow)

    return met.repartition("id").sortWithinPartitions("id").mapInArrow(scan, schema)
