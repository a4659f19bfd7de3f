"""Embeddings. A provider turns a batch of texts into a matrix, one row per text."""

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.operators.joins import not_known

Provider = Callable[[list[str]], np.ndarray]

HASHING_DIMS = 256
EMBED_BATCH = 256


def hashing_provider(dims: int = HASHING_DIMS) -> Provider:
    """A provider that needs no service: unit vectors of hashed word counts.

    Words are what spaces separate, in lower case; a word counts in the dimension
    given by the first 32 bits of its MD5 digest.
    """

    @lru_cache(maxsize=100_000)
    def dimension(word: str) -> int:
        return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dims

    def embed(texts: list[str]) -> np.ndarray:
        vectors = np.zeros((len(texts), dims))
        for row, text in enumerate(texts):
            words = Counter(text.lower().split(" "))
            words.pop("", None)
            if words:
                places = [dimension(w) for w in words]
                counts = np.bincount(places, list(words.values()), minlength=dims)
                vectors[row] = counts / np.linalg.norm(counts)
        return vectors

    return embed


def embed_column(
    text: Column, provider: Callable[[], Provider] = hashing_provider, batch: int = EMBED_BATCH
) -> Column:
    """Column form of a provider: array<float>, null for null text.

    ``provider`` is a factory. Each task calls it once, so clients and models are
    set up per task and not per row, and hands it at most ``batch`` texts at a time.
    Declared nondeterministic so that a filter on the vectors does not embed twice.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = provider()
        for texts in batches:
            filled = texts.drop_null().to_pylist()
            rows: list = []
            for at in range(0, len(filled), batch):
                rows += list(np.asarray(run(filled[at : at + batch]), dtype=np.float32))
            vectors = pa.array(rows, pa.list_(pa.float32()))
            # Null texts take no vector: their index is null.
            present = texts.is_valid().to_numpy(zero_copy_only=False)
            places = pa.array(np.cumsum(present) - 1, pa.int64(), mask=~present)
            yield vectors.take(places)

    return embed.asNondeterministic()(text)


def hashed_counts(df: DataFrame, text: str, into: str, dims: int = HASHING_DIMS) -> DataFrame:
    """The vectors of :func:`hashing_provider` in a column, by built-in expressions and transformers.

    Null text gives a null vector, text without words one of zeros.
    """
    words = F.array_remove(F.split(F.lower(text), " "), "")
    digits = round(math.log(dims, 16))
    if 16**digits == dims:  # the last hexadecimal digits are the remainder
        names = [f"{d:0{digits}x}" for d in range(dims)]
        place = F.transform(words, lambda w: F.substring(F.md5(w), 9 - digits, digits))
    else:
        names = [str(d) for d in range(dims)]
        first = lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint")
        place = F.transform(words, lambda w: (first(w) % dims).cast("string"))
    counter = CountVectorizerModel.from_vocabulary(names, inputCol="_places", outputCol="_counts")
    counted = counter.transform(df.withColumn("_places", F.coalesce(place, F.array().cast("array<string>"))))
    normal = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit").transform(counted)
    vector = vector_to_array("_unit").cast("array<float>")
    return normal.withColumn(into, F.when(F.col(text).isNotNull(), vector)).drop("_places", "_counts", "_unit")


def embed_chunks(
    chunks: DataFrame,
    provider: Callable[[], Provider] | None = None,
    text: str = "chunk_text",
    into: str = "embedding",
) -> DataFrame:
    """Adds the vectors of a column of texts; without a provider, those of hashed word counts."""
    if provider is None:
        return hashed_counts(chunks, text, into)
    return chunks.withColumn(into, embed_column(F.col(text), provider))


def embed_new(
    chunks: DataFrame,
    index: DataFrame,
    provider: Callable[[], Provider] | None = None,
    key: str = "chunk_id",
) -> DataFrame:
    """Embeds only the chunks whose id the index does not hold; append the result to it."""
    return embed_chunks(not_known(chunks, index, key), provider)
