"""Every registered query against its SQL on the smallest tables."""

import pytest
from check_oracles import connect, differences
from pyspark.sql import functions as F

from threadloom.catalog import ORACLES, QUERIES, models, retrieval
from threadloom.plans import manifest

SF_DIR = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, database, name):
    problem = differences(spark, database, SF_DIR, name, QUERIES[name], ORACLES.get(name))
    if problem == "no rows":  # the larger tables must show some
        problem = differences(spark, connect(LARGER), LARGER, name, QUERIES[name], ORACLES.get(name))
    assert problem == ""


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)


def test_a_landed_run_shuffles_its_texts_only_to_be_written(spark, tmp_path, monkeypatch):
    """Arrays are grouped in one shuffle; a run is not stored beside the table and a repeated one not shuffled."""
    kept = []
    monkeypatch.setattr(manifest, "stored", lambda df, name, store=manifest.stored: kept.append(df.columns) or store(df, name))
    rows = [(k, f"text {k}", "de", f"src{k % 3}", k) for k in range(30)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    result = models.transform_runs(spark, str(tmp_path)).collect()
    assert sorted(r["clean_selftext"] for r in result) == sorted(r[1] for r in rows)
    assert {r["title"] for r in result} == {f"src{k} de" for k in range(3)}
    assert kept and not any("clean_selftext" in columns for columns in kept)


def test_retrieve_filtered_counts_all_hits_however_many(spark, tmp_path):
    """More than 100,000 chunks of a forum answer one item."""
    n = 100_100
    words = F.concat(F.lit("the same few words in every post here "), F.col("id").cast("string"))
    posts = spark.range(n).select(
        F.col("id").alias("doc_id"), words.alias("text"), F.lit("de").alias("lang"), F.lit("src1").alias("source"), F.lit(40).cast("long").alias("n_chars")
    )
    posts.write.parquet(str(tmp_path / "documents.parquet"))
    talk = spark.createDataFrame([(1, 1, "user", "a comment of someone")], "conv_id long, turn long, role string, text string")
    talk.write.parquet(str(tmp_path / "conversations.parquet"))
    items = spark.createDataFrame([(1, "the same few words in every post here")], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    found = retrieval.retrieve_filtered(spark, str(tmp_path)).collect()
    assert [(r.question_id, r.n_hits) for r in found] == [(1, n)]
