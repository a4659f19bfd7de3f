"""Mart -> chunks -> embeddings -> retrieval."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom import defaults
from threadloom.operators import chunking, context, embedding, filters, similarity
from threadloom.plans import manifest
from threadloom.session import stored
from threadloom.sinks import tables as sinks
from threadloom.sources import paths

MAX_BROADCAST_HITS = 200_000


def chunks_to_index(
    mart: DataFrame,
    as_of: datetime | Column | None = None,
    window_days: int | None = None,
) -> DataFrame:
    """Chunks of the posts and their comments, with ids; of the last days only if a window is given."""
    if window_days is not None:
        mart = filters.rolling_window(mart, "post_created_at", as_of, window_days)
    return chunking.with_chunk_id(chunking.corpus(mart))


PLACE = manifest.PLACE
INDEX_SCHEMA = (
    "doc_id string, chunk_no int, chunk_text string, metadata map<string, string>, "
    "created_at timestamp_ntz, chunk_id string, doc string, embedding array<float>, run string, "
    "subreddit string, date date"
)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an index; filters on subreddit and date prune its folders."""
    if not paths.exists(spark, f"{path}/subreddit=*"):
        return spark.createDataFrame([], INDEX_SCHEMA)
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def _as_indexed(chunks: DataFrame, oldest: datetime | None) -> DataFrame:
    doc = F.concat_ws("\x1f", F.col("metadata")["type"], "doc_id")
    incoming = chunks.withColumn("doc", doc).withColumn("date", F.to_date("created_at"))
    if oldest is not None:
        incoming = incoming.where(F.col("created_at").isNull() | (F.col("created_at") >= F.lit(oldest)))
    return incoming


def changed_documents(incoming: DataFrame, known: DataFrame, run: str, oldest: datetime | None = None) -> DataFrame:
    """(doc, places, moved_from) of incoming documents whose chunks or places are not those the manifest tells.

    One join on the document, of which the manifest's side keeps its buckets.
    """
    here = manifest.states(incoming, F.lit(run)).select("doc", "places", F.col("version").alias("wanted"))
    there = known.select(F.col("doc").alias("_doc"), F.col("places").alias("moved_from"), "version", F.col("run").alias("_run"), "oldest")
    same = (F.col("version") == F.col("wanted")) & (F.col("_run") != run)
    if oldest is not None:
        same = same & (F.col("oldest").isNull() | (F.col("oldest") >= F.lit(oldest)))
    joined = here.join(there, F.col("doc") == F.col("_doc"), "left")
    return joined.where(~F.coalesce(same, F.lit(False))).select("doc", "places", "moved_from")


def update_index(
    spark: SparkSession,
    chunks: DataFrame,
    path: str,
    run: str,
    provider: Callable[[], embedding.Provider] | None = None,
    oldest: datetime | None = None,
    buckets: int | None = None,
) -> None:
    """Bring the documents of ``chunks`` up to date in an index partitioned by forum and day.

    A document that is new or whose chunks differ replaces all it had, wherever that was;
    only its chunks are embedded, and only the partitions it touches are read and rewritten: a manifest
    tells what the index holds. With ``oldest``, rows created before it leave. ``run`` names what
    this call embeds; repeating a run embeds that again.
    """
    incoming = _as_indexed(chunks, oldest)
    held = manifest.Manifest(spark, path, buckets)
    if not paths.exists(spark, f"{path}/subreddit=*"):
        held.begin()
        made = embedding.embed_chunks(incoming, provider).withColumn("run", F.lit(run))
        sinks.write_partitioned(made, path, PLACE)
        held.create(manifest.states(read_index(spark, path), F.col("run")))
        held.end()
        return
    index = read_index(spark, path)
    if not held.usable():
        held.create(manifest.states(index, F.col("run")))
    known = held.current()
    changed = stored(changed_documents(incoming, known, run, oldest), "changed")
    names = changed.select("doc")
    leaving = F.col("run") == run
    stale = F.lit(False)
    if oldest is not None:
        leaving = leaving | F.coalesce(F.col("oldest") < F.lit(oldest), F.lit(False))
        stale = F.coalesce(F.col("created_at") < F.lit(oldest), F.lit(False))
    left = stored(known.where(leaving).select("doc", "places"), "leaving")
    places = changed.select(F.explode("places").alias("at")).unionByName(changed.select(F.explode("moved_from").alias("at")))
    touched = stored(places.unionByName(left.select(F.explode("places").alias("at"))).select("at.*").distinct(), "touched")
    before = manifest.in_places(index, touched)
    fresh = embedding.embed_chunks(incoming.join(names, "doc", "left_semi"), provider)
    kept = before.where(~stale & (F.col("run") != run)).join(names, "doc", "left_anti")
    held.begin()
    # Written aside first: the new rows are made from the partitions they replace.
    rows = stored(kept.unionByName(fresh.withColumn("run", F.lit(run))), "rows")
    manifest.replace_places(index, rows, touched, path)
    affected = names.unionByName(left.select("doc")).distinct()
    now = stored(manifest.states(rows.join(affected, "doc", "left_semi"), F.col("run")), "states")
    held.append(now, affected.join(now, "doc", "left_anti"))
    held.end()


def retrieve(
    index: DataFrame,
    questions: DataFrame,
    k: int | None = defaults.TOP_K,
    min_score: float | None = defaults.MIN_RELEVANCE,
    provider: Callable[[], embedding.Provider] | None = None,
) -> DataFrame:
    """The best chunks per question, with text and metadata; with ``k=None`` all that reach ``min_score``.

    ``questions`` has (question_id, question). The index may be cut down before, by
    forum and date, which prune its scan, or by metadata.
    """
    asked = embedding.embed_chunks(questions.select("question_id", "question"), provider, "question")
    if k is None:
        chunks = index.select(F.col("chunk_id").alias("match_id"), "chunk_text", "metadata", "embedding")
        # Catalyst drops the rank, which sorts all hits of a question in one task, where it is not used.
        every = similarity.every_hit(chunks, asked, min_score).withColumn("rank", similarity.best_first())
        return every.select("match_id", "question_id", "score", "rank", "chunk_text", "metadata")
    hits = similarity.top_k(index, asked, k, min_score)
    texts = index.select(F.col("chunk_id").alias("match_id"), "chunk_text", "metadata")
    if questions.count() * k <= MAX_BROADCAST_HITS:
        hits = F.broadcast(hits)  # spares the shuffle of the index
    return hits.join(texts, "match_id")


def answer_context(hits: DataFrame, separator: str = "\n\n") -> DataFrame:
    """One context per question from its retrieved chunks, best first."""
    return context.assemble(hits, "question_id", "chunk_text", separator=separator)
