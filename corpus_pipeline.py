"""From raw documents to token ids: language, shared lines, near copies, benchmark leaks, pieces.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its
result is written as Parquet and read again as the next one's docs. All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import decontamination, language, line_dedup, pieces, simhash
from threadloom.llm.common import fold, fresh, stored, table

#: Texts whose language is less certain than this, or cannot be told, go.
MIN_LANGUAGE_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language the classifier can tell."""
    model = language.fit(docs, fold("doc_id", 5) != 0)
    lang, score = fresh(docs, "lang_pred", "score")
    told = language.predict(docs, model, into=(lang, score))
    return told.where((F.col(lang) != language.UNDETERMINED) & (F.col(score) >= MIN_LANGUAGE_SCORE)).select(docs.columns)


def remove_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines that many sources share out of the texts; no document goes."""
    cut = line_dedup.strip_shared_lines(docs, into=None)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near copies; documents without an id stay."""
    copies = stored(simhash.repeats(docs, words=3, max_bits=3).withColumnRenamed("id", "doc_id"), "copies")
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, also with other numbers, names or units."""
    found = decontamination.leaks(docs, table(spark, sf_dir, "benchmark"))
    leaked = stored(found.select(F.col("id").alias("doc_id")).distinct(), "leaked")
    return docs.join(leaked, "doc_id", "left_anti").select(docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether they decode to it."""
    encoded = pieces.encode(docs.select("doc_id", "lang", "source", "text"), verify_into="lossless")
    return encoded.select("doc_id", "lang", "source", "lossless", "piece_ids")


STAGES = [
    ("language", identify_language),
    ("shared lines", remove_shared_lines),
    ("near copies", remove_near_copies),
    ("benchmark leaks", remove_benchmark_leaks),
    ("pieces", encode_pieces),
]

#: SQL cannot express the classifier, the fingerprints or the segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
