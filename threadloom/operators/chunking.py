"""Text chunks with metadata, the unit of retrieval."""

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom import defaults
from threadloom.functions import metadata
from threadloom.functions.text import is_non_empty, join_title_body

# Tried in this order; the empty one cuts between characters.
SEPARATORS = ("\n\n", "\n", " ", "")


def chunk_spans(
    text: str, start: int, end: int, size: int, overlap: int, level: int = 0
) -> Iterator[tuple[int, int]]:
    """Offsets of the chunks of ``text[start:end]``.

    Pieces start at the occurrences of the first separator that is present and are
    packed into chunks of at most ``size`` characters. The next chunk restarts at
    the earliest piece that repeats at most ``overlap`` characters and still leaves
    room for the piece that did not fit. A piece of ``size`` or more is cut by the
    separators that remain.
    """
    while SEPARATORS[level] and text.find(SEPARATORS[level], start, end) < 0:
        level += 1
    separator = SEPARATORS[level]
    if not separator:
        yield from _character_spans(start, end, size, overlap)
        return
    cut = _cut_by_pieces if len(separator) > 1 else _cut_by_jumps
    for a, b, whole in cut(text, start, end, size, overlap, separator):
        if whole:
            yield a, b
        else:
            yield from chunk_spans(text, a, b, size, overlap, level + 1)


def _cut_by_pieces(
    text: str, start: int, end: int, size: int, overlap: int, separator: str
) -> Iterator[tuple[int, int, bool]]:
    """(from, to, True) per chunk and (from, to, False) per piece that is too long."""
    chunk: deque[int] = deque()  # where the pieces of the open chunk start
    at = start
    while at < end:
        inside = at + len(separator) if text.startswith(separator, at, end) else at
        following = text.find(separator, inside, end)
        piece_end = end if following < 0 else following
        if piece_end - at >= size:
            if chunk:
                yield chunk[0], at, True
                chunk.clear()
            yield at, piece_end, False
        else:
            if chunk and piece_end - chunk[0] > size:
                yield chunk[0], at, True
                while chunk and (at - chunk[0] > overlap or piece_end - chunk[0] > size):
                    chunk.popleft()
            chunk.append(at)
        at = piece_end
    if chunk:
        yield chunk[0], end, True


def _cut_by_jumps(
    text: str, start: int, end: int, size: int, overlap: int, separator: str
) -> Iterator[tuple[int, int, bool]]:
    """The same for a separator of one character, searched from chunk to chunk instead
    of from piece to piece."""
    head = at = start  # the open chunk covers head to at; a piece starts at at
    while at < end:
        # Take in all pieces that fit.
        reach = end if end - head <= size else text.rfind(separator, at + 1, head + size + 1)
        following = text.find(separator, at + 1, end)
        piece_end = end if following < 0 else following
        if piece_end - at >= size:
            if head < at:
                yield head, at, True
            yield at, piece_end, False
            head = at = piece_end
        elif reach > at:
            at = reach
        else:
            yield head, at, True
            earliest = max(at - overlap, piece_end - size, head + 1)
            head = text.find(separator, earliest, at + 1)
    if head < end:
        yield head, end, True


def _character_spans(start: int, end: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """The same where every character is a piece."""
    step = size - min(overlap, size - 1)
    while end - start > size:
        yield start, start + size
        start += step
    if end > start:
        yield start, end


def split_text(
    text: str, size: int = defaults.CHUNK_SIZE, overlap: int = defaults.CHUNK_OVERLAP
) -> list[str]:
    """The chunks of one text, stripped; empty ones are left out."""
    chunks = (text[a:b].strip() for a, b in chunk_spans(text, 0, len(text), size, overlap))
    return [c for c in chunks if c]


def split_column(
    text: Column, size: int = defaults.CHUNK_SIZE, overlap: int = defaults.CHUNK_OVERLAP
) -> Column:
    """Column form of :func:`split_text`; texts pass to Python in Arrow batches.

    Declared nondeterministic so that filters on the chunks do not repeat the split.
    """

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(texts: pa.Array) -> pa.Array:
        return pa.array(
            [None if t is None else split_text(t, size, overlap) for t in texts.to_pylist()],
            pa.list_(pa.string()),
        )

    return split.asNondeterministic()(text)


def chunk_posts(
    mart: DataFrame,
    size: int = defaults.CHUNK_SIZE,
    overlap: int = defaults.CHUNK_OVERLAP,
) -> DataFrame:
    """Post chunks: title and body split into overlapping chunks.

    The mart repeats a post, with the same columns, for each of its comments; one
    row per post is kept, first within each task.
    """
    columns = [
        "post_id",
        "post_title",
        "post_body",
        "post_author",
        "link_flair_text",
        "subreddit",
        "post_url",
        "post_created_at",
    ]
    posts = mart.select(*columns).dropDuplicates(["post_id"])
    text = join_title_body(F.col("post_title"), F.col("post_body"))
    return posts.select(
        F.col("post_id").alias("doc_id"),
        metadata.post_metadata().alias("metadata"),
        "subreddit",
        F.col("post_created_at").alias("created_at"),
        split_column(text, size, overlap).alias("_chunks"),
    ).select(
        "doc_id",
        F.posexplode("_chunks").alias("chunk_no", "chunk_text"),
        "metadata",
        "subreddit",
        "created_at",
    )


def chunk_contexts(
    contexts: DataFrame,
    size: int = defaults.CHUNK_SIZE,
    overlap: int = defaults.CHUNK_OVERLAP,
) -> DataFrame:
    """Chunks of assembled post documents (post_id, context)."""
    cut = contexts.select(
        F.col("post_id").alias("doc_id"), split_column(F.col("context"), size, overlap).alias("_chunks")
    )
    return cut.select("doc_id", F.posexplode("_chunks").alias("chunk_no", "chunk_text"))


def chunk_comments(mart: DataFrame) -> DataFrame:
    """Comment chunks: one per comment that has text, never split.

    ``created_at`` is the post's, so a comment leaves an index window with its post.
    """
    return mart.where(is_non_empty(F.col("comment_body"))).select(
        F.col("comment_id").alias("doc_id"),
        F.lit(0).alias("chunk_no"),
        F.col("comment_body").alias("chunk_text"),
        metadata.comment_metadata().alias("metadata"),
        "subreddit",
        F.col("post_created_at").alias("created_at"),
    )


def corpus(mart: DataFrame) -> DataFrame:
    """Post and comment chunks together."""
    return chunk_posts(mart).unionByName(chunk_comments(mart))


def with_chunk_id(chunks: DataFrame) -> DataFrame:
    """Adds ``chunk_id``, which changes when the text of the chunk does."""
    parts = [F.col("metadata")["type"], F.col("doc_id"), F.col("chunk_no").cast("string")]
    return chunks.withColumn("chunk_id", F.sha2(F.concat_ws("\x1f", *parts, "chunk_text"), 256))
